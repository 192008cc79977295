"""Pushdown into requests, one rate for all tasks, and cache-first compositions, over saved answers."""

import inspect
import json
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vintara.sources import cache, rate, readers, remote, tables

LOG = "namespace string, symbol string, data string, t_ingest string, seq long"


def noted(url, headers):
    """A transport that answers by rule and notes every address in the folder."""
    import re
    import uuid
    from pathlib import Path

    (Path(headers["folder"]) / uuid.uuid4().hex).write_text(f"{time.time()} {url}")
    if "/eod/" in url:
        sym, = re.findall(r"/eod/([^?]*)", url)
        return json.dumps([{"date": f"2024-01-{d:02d}", "close": d, "open": "x"} for d in range(1, 11)] + [{"date": None}] if sym != "BAD" else {"error": "quota"})
    if "series_id" in url:
        return json.dumps({"observations": [{"date": "2024-01-01", "value": "."}, {"date": "2024-01-02", "value": "3"}]})
    if "daily-treasury" in url:
        y = re.findall(r"value=(\d+)", url)[0]
        return f'Date,"10 Yr"\n01/02/{y},4.0\n02/03/{y},N/A\n'
    return "<fault>SERVER.EntityNotFound</fault>" if "G06F" in url else json.dumps({"ops:world-patent-data": {"ops:biblio-search": {"@total-result-count": "7"}}})


@pytest.fixture
def source(spark, tmp_path):
    import sys

    mod = tmp_path / "noted_transport.py"
    mod.write_text("import json, time\n" + inspect.getsource(noted))
    spark.sparkContext.addPyFile(str(mod))
    sys.path.insert(0, str(tmp_path))
    folder = tmp_path / "asked"
    folder.mkdir()
    key = tmp_path / "key"
    key.write_text(" <s3cret> ")

    def make(table, **options):
        return tables.source_table(spark, table, transport="noted_transport:noted", headers={"folder": str(folder)}, secret={"names": ["NO_SUCH_NAME"], "file": str(key)}, **options)

    make.asked = lambda: sorted(p.read_text().split(" ", 1)[1] for p in folder.iterdir())
    make.times = lambda: sorted(float(p.read_text().split(" ", 1)[0]) for p in folder.iterdir())
    yield make
    sys.modules.pop("noted_transport", None)
    sys.path.remove(str(tmp_path))


def plan(df):
    """What Spark still filters by itself: the conditions that stand in the physical plan."""
    return df._jdf.queryExecution().executedPlan().toString()


def test_bars_filters_reach_the_requests(source):
    df = source("bars", keys=["A.US", "B.US", "C.US"]).where("symbol in ('A.US', 'C.US') and symbol <> 'C.US' and date > '2024-01-03' and date <= '2024-01-06' and close > 4")
    assert [(r["symbol"], str(r["date"]), r["close"], r["open"]) for r in df.collect()] == [("A.US", "2024-01-05", 5.0, None), ("A.US", "2024-01-06", 6.0, None)]
    text = plan(df)
    assert "BatchScan source_table" in text and "close#" in text and " > 4.0" in text
    assert "2024-01" not in text and "IN (" not in text and "19726" not in text and "s3cret" not in text, text  # taken over by the requests
    asked = source.asked()
    assert len(asked) == 2 and all("from=2024-01-04&to=2024-01-06" in a and "api_token=s3cret" in a for a in asked)


def test_what_no_filter_admits_is_not_asked(source):
    df = source("bars", keys=["A.US"]).where("symbol = 'B.US'")
    assert df.count() == 0 and source.asked() == []
    assert source("bars", keys=["A.US"]).where("date > '2024-02-01' and date < '2024-01-01'").count() == 0 and source.asked() == []
    assert source("series", keys=["X"]).where("vintage = date '2024-02-01' and vintage = date '2024-02-02'").count() == 0


def test_vintage_curve_and_counts(source):
    df = source("series", keys=["X", "Y"]).where("series_id = 'X' and vintage = date '2024-02-01'")
    assert sorted((str(r["date"]), r["value"], str(r["vintage"])) for r in df.collect()) == [("2024-01-01", None, "2024-02-01"), ("2024-01-02", 3.0, "2024-02-01")]
    assert len(source.asked()) == 1 and "realtime_start=2024-02-01" in source.asked()[0]
    got = source("curve").where("date >= '2022-12-30' and date < '2024-01-02'").collect()
    assert [(str(r["date"]), r["tenor"], r["rate"]) for r in got] == [("2023-01-02", "10 Yr", 0.04)]
    assert len([a for a in source.asked() if "treasury" in a]) == 3
    w = [["2018-01-01", "2018-12-31"], ["2019-01-01", "2019-12-31"]]
    df = source("counts", keys=["H01L", "G06F", "A01B"], windows=w).where("cls <> 'x' and cls in ('H01L', 'G06F') and until <= '2018-12-31'")
    assert sorted((r["cls"], str(r["since"]), r["n"]) for r in df.collect()) == [("G06F", "2018-01-01", 0), ("H01L", "2018-01-01", 7)]
    assert len([a for a in source.asked() if "search" in a]) == 2


def test_an_error_of_the_source_fails(source):
    with pytest.raises(Exception, match="quota"):
        source("bars", keys=["BAD"]).collect()


def test_rate_holds_for_four_tasks():
    """Four tasks with a clock of their own, one of which is lost and run again: never more calls a minute than allowed, no slot twice."""
    limit, calls = 30, []
    for number in range(4):
        now = [1000.0 + number * 0.7]
        for _ in range(2 if number == 2 else 1):

            def sleep(s, now=now):
                now[0] += s

            lease = rate.Lease(number, 4, limit, lambda now=now: now[0], sleep)
            for _ in range(25):
                slot = lease.wait()
                calls.append((slot, now[0]))
                now[0] += 0.3
    assert max(Counter(s for s, _ in calls).values()) == 1
    times = sorted(t for _, t in calls)
    assert all(sum(t <= x < t + 60 for x in times) <= limit for t in times)
    with pytest.raises(ValueError):
        rate.Lease(4, 4, 1)


def test_tasks_of_a_job_share_the_rate(spark, source):
    asked = spark.createDataFrame([(f"S{i}",) for i in range(24)], "symbol string")
    call = lambda k: json.dumps([{"t": time.time()}])
    got = cache.fetch(asked, call, workers=4, per_minute=600).collect()
    times = sorted(json.loads(r["data"])[0]["t"] for r in got)
    assert len(times) == 24 and all(sum(t <= x < t + 1 for x in times) <= 11 for t in times)
    source("bars", keys=[f"S{i}" for i in range(16)], tasks="4", per_minute="600").count()
    times = source.times()
    assert len(times) == 16 and all(sum(t <= x < t + 1 for x in times) <= 11 for t in times)


def test_bars_cache_first(spark):
    kept = [("eod_cache", "A", json.dumps([{"date": "2024-01-02", "close": 1}]), "2024-01-03 00:00:00", 0), ("eod_cache", "B", "no json", "2024-01-03 00:00:00", 0)]
    read = lambda: spark.createDataFrame(kept, LOG)
    store = lambda rows: kept.extend((r["namespace"], r["symbol"], r["data"], r["t_ingest"], len(kept)) for r in cache.cache_rows(rows, "eod_cache", "2024-02-01 00:00:00").collect())
    asked = spark.createDataFrame([("A",), ("B",), ("C",), ("A",)], "symbol string")
    show = lambda df: sorted((r["symbol"], r["date"]) for r in df.collect())
    assert show(remote.bars(asked, read, "2024-02-01")) == [("A", "2024-01-02")] and len(kept) == 2
    call = lambda k: json.dumps([{"date": f"2024-01-{d:02d}", "close": d} for d in (2, 9)]) if k != "C" else "[]"
    assert show(remote.bars(asked, read, "2024-02-01", "2024-01-02", "2024-01-31", call, store, workers=2)) == [("A", "2024-01-02"), ("B", "2024-01-02"), ("B", "2024-01-09")]
    assert len(kept) == 4
    again = remote.bars(asked, read, "2024-02-01", "2024-01-02", "2024-01-31", call, store, renew=True)
    assert ("A", "2024-01-09") in show(again)


def test_other_compositions(spark, tmp_path):
    def save(url, text):
        (tmp_path / readers.saved_name(url)).write_text(text)

    replay, headers = "vintara.sources.readers:replay", {"folder": f"file://{tmp_path}"}
    save(readers.calendar_url("2024-01-01", "2024-01-31", "k"), json.dumps({"earnings": [{"code": "A", "report_date": "2024-01-05"}]}))
    assert [tuple(r) for r in remote.earnings(spark, "2024-01-01", "2024-01-31", "k", replay, headers).select("code").collect()] == [("A",)]
    save(readers.calendar_url("2025-01-01", "2025-01-31", "k"), "Forbidden")
    heard = []
    assert remote.earnings(spark, "2025-01-01", "2025-01-31", "k", replay, headers, heard.append).count() == 0 and heard
    save(readers.patent_search_url("q", 1, 25), "<x>SERVER.EntityNotFound</x>")
    assert remote.patent_search(spark, "q", transport=replay, headers=headers).count() == 0
    ref = {"document-id": {"@document-id-type": "docdb", "country": {"$": "EP"}, "doc-number": {"$": "1"}, "kind": {"$": "A1"}}}
    save(readers.patent_search_url("r", 1, 25), json.dumps({"ops:world-patent-data": {"ops:biblio-search": {"@total-result-count": "1", "ops:search-result": {"ops:publication-reference": ref}}}}))
    assert [r["ref"] for r in remote.patent_search(spark, "r", transport=replay, headers=headers).collect()] == ["EP.1.A1"]
    save(readers.exchanges_url("k"), json.dumps([{"Code": "US", "Name": "n", "Country": "USA", "Currency": "USD"}, {"Name": "x"}]))
    assert [r["code"] for r in remote.exchanges(spark, "k", replay, headers).collect()] == ["US"]
    (tmp_path / "key").write_text("k")
    for s, text in (("A", '{"General": {"Code": "A"}}'), ("B", "[]")):
        save(readers.fundamentals_url(s, "k"), text)
    kept = []
    read = lambda: spark.createDataFrame(kept, LOG)
    store = lambda rows: kept.extend(("fundamentals_cache", r["symbol"], r["data"], "2024-01-01 00:00:00", 0) for r in rows.collect())
    call = remote.market_call(readers.fundamentals_url, ("NO_SUCH_NAME",), readers.fundamentals_or_marker, replay, headers, str(tmp_path / "key"))
    asked = spark.createDataFrame([("A",), ("B",)], "symbol string")
    assert [r["symbol"] for r in remote.fundamentals(asked, read, "2024-01-02", call, store).collect()] == ["A"]
    assert len(kept) == 2 and remote.fundamentals(asked, read, "2024-01-02").select(F.count("*")).first()[0] == 1
