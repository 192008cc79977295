"""Requests to rows, over saved answers."""

import json

import pytest

from vintara.sources import cache, readers, remote

REPLAY = "vintara.sources.readers:replay"


@pytest.fixture
def saved(tmp_path):
    def save(url, text):
        (tmp_path / readers.saved_name(url)).write_text(text)

    save.headers = {"folder": f"file://{tmp_path}"}
    return save


def test_papers_and_filings(spark, saved):
    saved(readers.feed_url("q", 2, "submittedDate"), "<entry><id>u</id><title>T</title><summary>s</summary><published>2024-01-05T0</published></entry>")
    assert [(r["title"], r["source_type"]) for r in remote.papers(spark, "q", 2, REPLAY, saved.headers).collect()] == [("T", "arxiv")]
    hits = [{"_source": {"ciks": [str(i)], "display_names": [f"N{i}"], "file_date": "2024-01-05", "sics": "7372"}} for i in range(3)]
    saved(readers.filing_search_url("q", "2024-01-01"), json.dumps({"hits": {"hits": hits}}))
    assert [r["title"] for r in remote.filings(spark, "q", "2024-01-01", most=2, transport=REPLAY, headers=saved.headers).collect()] == ["N0", "N1"]
    saved(readers.filing_url("1", "2-3"), "<totalAmountSold>12.5</totalAmountSold>")
    assert [r["amount"] for r in remote.filing_amounts(spark, [("1", "2-3")], REPLAY, saved.headers).collect()] == [12.5]


def test_rates_series_universe(spark, saved):
    saved(readers.curve_url(2024), 'Date,"10 Yr","1 Mo"\n01/03/2024,4.0,5\n\n01/02/2024,N/A,5\n')
    saved(readers.curve_url(2023), 'Date,"1 Mo","10 Yr"\n12/29/2023,5,3.5\n')
    got = {str(r["cutoff"]): r["rate"] for r in remote.rates_as_of(spark, ["2024-01-02", "2024-01-05"], transport=REPLAY, headers=saved.headers).collect()}
    assert got == {"2024-01-02": 0.035, "2024-01-05": 0.04}
    saved(readers.series_url("X", "k"), '{"observations":[{"date":"2024-01-01","value":"."},{"date":"2024-01-02","value":"3"}]}')
    assert [(r["series_id"], r["value"]) for r in remote.series(spark, ["X"], "k", transport=REPLAY, headers=saved.headers).collect()] == [("X", "."), ("X", "3")]
    row = lambda c, t="ETF": {"Code": c, "Exchange": "US", "Name": c.lower(), "Type": t}
    saved(readers.symbols_url("k"), json.dumps([row("A"), row("B", "Fund"), {"Code": "C"}]))
    saved(readers.symbols_url("k", delisted=True), json.dumps([row("A"), row("D")]))
    got = remote.universe(spark, "k", kind="ETF", transport=REPLAY, headers=saved.headers).collect()
    assert sorted((r["symbol"], r["delisted"]) for r in got) == [("A.US", False), ("D.US", True)]
    assert remote.today("2020-01-01") == "2020-01-01" and len(remote.today()) == 10


def test_count_windows_resumes(spark):
    schema = "namespace string, symbol string, data string, t_ingest string, seq long"
    answer = lambda n: json.dumps({"ops:world-patent-data": {"ops:biblio-search": {"@total-result-count": str(n)}}})
    kept = [("counts", "ipc:H01L:2018-01-01:2018-12-31", answer(7), "2020", 0)]
    classes, windows = spark.createDataFrame([("H01L",), ("G06F",)], "cls string"), spark.createDataFrame([("2018-01-01", "2018-12-31"), ("2019-01-01", "2019-12-31"), ("2019", "2019")], "since string, until string")
    read = lambda: spark.createDataFrame(kept, schema)
    store = lambda rows: kept.extend((r["namespace"], r["symbol"], r["data"], r["t_ingest"], r["seq"]) for r in cache.cache_rows(rows, "counts", "2020").collect())

    def call(name):
        if "within" not in readers.window_of(name) or ":H01L:2018" in name:
            raise RuntimeError("asked again")
        return answer(0 if "G06F" in name else 3)

    got = remote.count_windows(classes, windows, read(), call, store, read, "2018-12-31")
    assert sorted(map(tuple, got.collect())) == [("G06F", "2018-01-01", "2018-12-31", 0), ("H01L", "2018-01-01", "2018-12-31", 7)]

    def broken(name):
        raise RuntimeError("429")

    with pytest.raises(cache.FetchError):
        remote.count_windows(classes, windows, read(), broken, store, read)
