"""Writers, caches, readers, builders, completion of texts and marking of streams, on hand-made rows."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from vintara.functions.scalar import number
from vintara.operators import contracts, market, near_dup
from vintara.plans import build
from vintara.sources import cache, parsers, readers, schemas, writers
from vintara.streaming.marking import Marker


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_numbers_are_python_like(spark):
    d = spark.createDataFrame([(x,) for x in ("1", " 2.5 ", "1e3", ".5", "-3.", "1d", "1f", "", ".", None, "0x1", "1_0", "nan", "-inf")], "t string")
    got = [r[0] for r in d.select(number(F.col("t"))).collect()]
    assert got[:5] == [1.0, 2.5, 1000.0, 0.5, -3.0] and got[5:12] == [None] * 7 and got[12] != got[12] and got[13] == float("-inf")


def test_curve_refuses_false_days(spark):
    y = spark.createDataFrame([("13/45/2020", "1"), ("02/31/2020", "0.93"), ("1/2/20", "1"), ("01/03/2020", "1d")], "Date string, `1 Mo` string")
    assert [(r["date"], r["rates"]) for r in parsers.yield_curve(y, ["1 Mo", "9 Yr"]).collect()] == [("2020-02-31", {"1 Mo": 0.93 / 100})]


def test_risk_free_rate_looks_back_a_year(spark):
    c = spark.createDataFrame([("2019-12-30", {"10 Yr": 0.01}), ("2020-01-03", {"10 Yr": 0.02}), ("2020-01-04", {"2 Yr": 0.5})], "date string, rates map<string,double>")
    asks = spark.createDataFrame([("2020-01-02",), ("2020-01-05",), ("2018-01-01",), ("2020-01-05",)], "cutoff string")
    assert [(str(r[0]), r[1]) for r in sorted(market.risk_free_rate(c, asks).collect())] == [("2018-01-01", None), ("2020-01-02", 0.01), ("2020-01-05", 0.02)]


def test_typed_contract_lets_nan_pass(spark):
    con = contracts.TableContract("t", "operativ", [contracts.Field("t_ingest", "time"), contracts.Field("x", "gemessen"), contracts.Field("s", "status", nullable=True), contracts.Field("l", "list")])
    df = spark.createDataFrame([(0, "2020", float("nan"), None, []), (1, "", 1.0, "vermutet", None), (2, "2020", None, "?", [1])], "i long, t_ingest string, x double, s string, l array<int>")
    assert rows(contracts.validate_typed(df, con, "i").select("row_index", "field", "rule")) == [(1, "l", "pflichtfeld-fehlt-oder-null"), (1, "t_ingest", "zeit-spalte-fehlt"), (2, "s", "wert-nicht-im-vokabular"), (2, "x", "pflichtfeld-fehlt-oder-null")]
    other = df.select("i", "t_ingest", (F.col("x") > 0).alias("x"), F.lit(1).alias("s"), "l").where("i = 1").withColumn("kat_id", F.lit("a"))
    assert {r["rule"] for r in contracts.validate_typed(other, con, "i").collect()} == {"gemessen-nicht-numerisch", "ordinal-als-zahl", "pflichtfeld-fehlt-oder-null", "id-version-paarung", "zeit-spalte-fehlt"}
    assert contracts.validate_typed(df.limit(0), con, "i").count() == 0


def test_writers_edges(spark):
    bars = spark.createDataFrame([("A", 1, '{"date":"2020-01-01","close":1}'), ("A", 2, '{"date":"2020-01-01","close":null}'), ("A", 3, "no json"), ("B", 4, '{"datum":"2020-01-02T0","adjClose":"3"}')], "symbol string, seq long, bar string")
    assert rows(writers.current_rows(writers.bar_rows(bars, None), ["symbol", "datum"]).select("symbol", "datum", "close", "adjusted_close")) == [("A", "2020-01-01", None, None), ("B", "2020-01-02", None, 3.0)]
    with pytest.raises(Exception, match="reason"):
        writers.exclusion_rows(spark.createDataFrame([("fakt1", "  ", "a", None, True, 1)], "fact string, reason string, actor string, t_disclosed string, active boolean, seq long")).collect()
    facts = spark.createDataFrame([(None, "a", "b", "c", 1), (None, "a", "b", "c", 2), (7, "a", "b", "c", 3), (7, " a", "b ", "c", 4), (7, " ", "b", "c", 5)], "doc_id long, subject string, relation string, object string, seq long")
    assert [r[-1] for r in sorted(writers.fact_rows(facts).select("doc_id", "seq").collect(), key=lambda r: r[-1])] == [1, 2, 3]
    docs = spark.createDataFrame([("a", "d", None, 1), ("b", "d", "x", 2), ("c", "d", "rss", 3)], "title string, published_at string, source_type string, seq long")
    assert rows(writers.unknown_sources(docs, ["rss"])) == [("x", 1)]
    f = spark.createDataFrame([("A", "")], "symbol string, payload string")
    assert writers.read_fundamentals(f, "A").count() == 0
    raw, findings = writers.raw_document_rows(spark.createDataFrame([(1, "t", "x", "u", 0.5, "2020", 1), (1, "t", "y", "u", None, "2020", 2)], "doc_id long, title string, text string, url string, relevance double, published_at string, seq long"), "r", "2020")
    assert [(r["text"], r["accepted"]) for r in raw.collect()] == [("y", False)] and findings.count() == 1


def test_tables_are_made_once(spark):
    assert sorted(schemas.create_tables(spark, schemas.MARKET, "vin_test")) == sorted(schemas.MARKET)
    assert schemas.create_tables(spark, schemas.MARKET, "vin_test") == []
    with pytest.raises(ValueError):
        schemas.create_tables(spark, schemas.MARKET, "a;b")
    spark.sql("DROP DATABASE vin_test CASCADE")


LOG = "namespace string, symbol string, data string, t_ingest string, seq long"


def test_cache_ttl_and_corrupt(spark):
    log = spark.createDataFrame([("n", "A", "[1]", "2020-01-01 00:00:00", 1), ("n", "B", "{bad", "2020-01-01 00:00:00", 1), ("n", "C", "{}", "?", 1), ("m", "A", "{}", "2020-01-01 00:00:00", 1), ("n", "A", "[2]", "2020-01-02 00:00:00", 2)], LOG)
    read = lambda now, most=None: sorted((r["symbol"], r["data"]) for r in cache.read(log, "n", now, most).collect())
    assert read("2020-01-12 00:00:00", 10) == [("A", "[2]"), ("C", "{}")] and read("2020-01-12 00:00:01", 10) == [("C", "{}")] and read("2030-01-01 00:00:00") == [("A", "[2]"), ("C", "{}")]
    assert rows(cache.corrupt(log)) == [("n", "B")] and rows(cache.inventory(log)) == [("m", 1, 2), ("n", 3, 9)]
    assert cache.namespace("/x/eod_cache/") == "eod_cache" and cache.namespace(None) == cache.DEFAULT_NAMESPACE
    kept = cache.cache_rows(spark.createDataFrame([("A", "{}", 1), ("B", "3", 1), ("C", "x", 1)], "symbol string, data string, seq long"), "n", "2020")
    assert [r["symbol"] for r in kept.collect()] == ["A"]


def test_gzip_migration(spark, tmp_path):
    (tmp_path / "A").mkdir()
    (tmp_path / "A/AAPL.US.json.gz").write_bytes(gzip.compress(json.dumps({"a": "ä"}).encode()))
    (tmp_path / "A/BAD.json.gz").write_bytes(b"nope")
    (tmp_path / "A/CUT.json.gz").write_bytes(gzip.compress(b"[1,2,3]")[:-9])
    got = cache.migrate_gzip(spark, f"file://{tmp_path}", "eod_cache", "2020")
    assert [(r["namespace"], r["symbol"], json.loads(r["data"])) for r in got.collect()] == [("eod_cache", "AAPL.US", {"a": "ä"})]
    assert cache.migrate_gzip(spark, f"file://{tmp_path}/none", None, "2020").count() == 0


def test_prefetch(spark):
    def bars_call(symbol):
        if symbol.startswith("E"):
            raise RuntimeError("429 throttled")
        return {"M": "[]", "D": '{"error":"x"}'}.get(symbol[0], '[{"date":"2020-01-01","close":1}]')

    log = spark.createDataFrame([("eod_cache", "A1", "[]", "2020", 1)], LOG)
    asked = spark.createDataFrame([(x,) for x in ("A1", "A2", "M1", "E1", "D1", "A2")], "symbol string")
    stored = []
    got = cache.prefetch(asked, log, "eod_cache", bars_call, lambda d: stored.extend((r["symbol"], r["data"]) for r in d.collect()))
    assert got == {"fetched": 2, "skipped": 1, "errors": 2, "total": 5} and sorted(s for s, _ in stored) == ["A2", "M1"]
    with pytest.raises(cache.FetchError):
        cache.prefetch(spark.createDataFrame([("E1",), ("E2",)], "symbol string"), log, "eod_cache", bars_call, lambda d: None)
    assert cache.prefetch(asked, log, "eod_cache", bars_call, lambda d: None, stop=lambda: True)["fetched"] == 0


def test_readers(monkeypatch):
    assert readers.class_query("H01L", "2018-01-01", "2018-12-31") == 'ipc=H01L and pd within "20180101 20181231"' and readers.class_query("H01L", "2018") == 'ipc=H01L and pd within "2018"'
    assert readers.window_of(readers.window_key("H01L", "2018-01-01", "2018-12-31")) == readers.class_query("H01L", "2018-01-01", "2018-12-31")
    assert "startdt=2020-01-01" in readers.filing_search_url("a b", "2020-01-01") and "enddt" not in readers.filing_search_url("a", "2020-01-01")
    assert readers.series_url("X", "k", vintage="2020-01-01").endswith("&realtime_start=2020-01-01&realtime_end=2020-01-01")
    assert readers.filing_url("0012", "0001-2") == "https://www.sec.gov/Archives/edgar/data/12/00012/primary_doc.xml"
    monkeypatch.setenv("K_TEST", " <abc> ")
    assert readers.key(None, ("K_TEST",)) == "abc" and readers.key("x", ("K_TEST",)) == "x"
    with pytest.raises(readers.SourceError):
        readers.key(None, ("K_MISSING",))
    assert readers.fundamentals_or_marker('{"a":1}') == "{}" and json.loads(readers.fundamentals_or_marker('{"General":{}}')) == {"General": {}}
    assert readers.list_or_none('{"a":1}') == "[]"
    for bad in ("Forbidden", "<html>", '{"error":"x"}'):
        with pytest.raises(readers.SourceError):
            readers.full_list(bad)
    with pytest.raises(readers.SourceError):
        readers.curve_text("<html>")

    def fail(text):
        def call(*_):
            raise readers.SourceError(text)

        return call

    assert readers.no_results_as(fail("SERVER.EntityNotFound"), readers.NO_HITS) == readers.NO_HITS and readers.soft(fail("x"), warn=lambda m: None) == "[]"
    slept, renewed = [], []
    with pytest.raises(readers.SourceError):
        readers.patiently(fail("RobotDetected"), sleep=slept.append, renew=lambda: renewed.append(1))("k")
    assert slept == [4.5, 30, 4.5, 60, 4.5, 120, 4.5] and len(renewed) == 3
    with pytest.raises(readers.SourceError):
        readers.patiently(fail("bad key"), sleep=slept.append)("k")
    assert readers.access_token('{"access_token":"t"}') == "t" and readers.basic_auth("a", "b") == {"Authorization": "Basic YTpi"}
    with pytest.raises(readers.SourceError):
        readers.access_token("{}")
    clock = [0.0]
    tokens = iter("abc")
    tok = readers.Token(lambda: next(tokens), 10, lambda: clock[0])
    assert tok() == tok() == "a"
    clock[0] = 11
    assert tok() == "b"
    tok.drop()
    assert tok() == "c"


def test_data_source(spark, tmp_path):
    for n in "ab":
        (tmp_path / n).write_text(f'["{n}"]')
    spark.dataSource.register(readers.PayloadSource)
    read = lambda names: spark.read.format("payloads").option("requests", json.dumps({n: f"file://{tmp_path}/{n}" for n in names})).option("transport", "vintara.sources.readers:from_file").load()
    assert rows(read("ab")) == [("a", '["a"]'), ("b", '["b"]')]
    with pytest.raises(Exception):
        read("ax").collect()


def test_embed_counts_vectors(spark):
    d = spark.createDataFrame([(1, "a"), (2, None)], "id long, text string")
    got = {r["id"]: r["vec"] for r in readers.embed(d, lambda ts: [[1.0, 3.0] if t else [[1.0, 1.0], [3.0, 5.0]] for t in ts]).collect()}
    assert got == {1: [1.0, 3.0], 2: [2.0, 3.0]}
    with pytest.raises(Exception, match="vectors for"):
        readers.embed(d.coalesce(1), lambda ts: [[1.0]] * (len(ts) + 1)).collect()


def test_build_stops_and_resumes(spark):
    bars = json.dumps([{"date": "2020-01-01", "close": 1}, {"date": "2020-01-02", "close": 2}, {"close": 3}])
    log = spark.createDataFrame([("eod_cache", "A", bars, "2020", 1), ("eod_cache", "M", "[]", "2020", 1), ("fundamentals_cache", "B", '{"General":{}}', "2020", 1), ("fundamentals_cache", "N", "{}", "2020", 1)], LOG)
    cats = spark.createDataFrame([("A", "x"), ("M", "y"), ("N", "z"), ("Q", "q")], "symbol string, category string")
    out = {}
    got = build.build_market(log, cats, "2020", lambda name, df: out.update({name: rows(df)}))
    assert got == {"n_symbols": 1, "n_bars": 2, "n_fundamentals": 1, "n_meta": 3, "stopped": False} and set(out) == {"eod_price", "fundamentals", "entity_meta"}
    asked = iter([False, True])
    assert build.build_market(log, cats, "2020", lambda name, df: None, stop=lambda: next(asked))["stopped"]


def test_backfill_marks_and_resumes(spark):
    docs = spark.createDataFrame([(1, "epo", "EP1A1", "stub"), (2, "patent", "bad", ""), (3, "epo", "EP3A1", None), (4, "epo", "EP4A1", "x"), (5, "epo", "EP5A1", "y" * 200), (6, "news", "EP6A1", "")], "id long, source_type string, url string, text string")
    done, texts = [], []

    def write(name, df):
        (texts if name == "documents_text" else done).extend(map(tuple, df.collect()))

    def read(name):
        return docs if name == "documents" else spark.createDataFrame(done, "doc_id long, has_abstract boolean")

    def call(ref):
        if "4" in ref:
            raise RuntimeError("429")
        return "text" if "1" in ref.split(".")[1] else ""

    parse = lambda d: d.select("ref", F.col("data").alias("abstract"))
    got = build.backfill(read, write, call, parse, "r1", batch=2)
    assert got == {"open": 4, "completed": 1, "without": 2, "errors": 1} and [t[:2] for t in texts] == [(1, "stub text")] and sorted(done) == [(1, True), (2, False), (3, False)]
    assert build.backfill(read, write, call, parse, "r2", batch=2) == {"open": 1, "completed": 0, "without": 0, "errors": 1}
    facts_done = spark.createDataFrame([(1,), (3,)], "doc_id long")
    assert rows(build.reopened(facts_done, spark.createDataFrame([(1,)], "id long"))) == [(3,)]
    log = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "id long, text string, seq long")
    assert {r["id"]: r["text"] for r in build.current_documents(docs.where("id < 3"), log).collect()} == {1: "b", 2: ""}


def test_greedy_chain_and_ties(spark):
    v = spark.createDataFrame([(i, "b", "2020-01-01", [1.0, 0.1 * i]) for i in range(1, 13)] + [(20, "b", "2020-01-01", [0.0, 0.0]), (21, None, "2020-01-01", [1.0, 0.1])], "id long, block string, day string, vec array<double>").withColumn("day", F.col("day").cast("date"))
    got = {r["id"]: r["dup_of"] for r in near_dup.mark_greedy(v, 0.98).collect()}
    data = {r["id"]: r["vec"] for r in v.where("block is not null").collect()}
    cos = lambda a, b: sum(x * y for x, y in zip(a, b)) / ((sum(x * x for x in a) * sum(x * x for x in b)) ** 0.5 or 1)
    want, roots = {21: None}, []
    for i in sorted(data):
        best = max(((cos(data[i], data[r]), r) for r in roots if cos(data[i], data[r]) >= 0.98), default=(0, None))[1]
        want[i] = best
        if best is None:
            roots.append(i)
    assert got == want and len(roots) > 2
    assert near_dup.mark_greedy(v.limit(0), 0.98).count() == 0


def test_mean_vector_refuses_ragged(spark):
    d = spark.createDataFrame([([[1.0, 2.0], [3.0, 4.0]],)], "m array<array<double>>")
    assert d.select(near_dup.mean_vector(F.col("m"))).first()[0] == [2.0, 3.0]
    with pytest.raises(Exception, match="one length"):
        spark.createDataFrame([([[1.0], [3.0, 4.0]],)], "m array<array<double>>").select(near_dup.mean_vector(F.col("m"))).collect()


def test_stream_marks_and_evicts(spark, tmp_path):
    """The stream of batches decides as one run over all, and keeps only vectors in reach."""
    data = [(i, "b", f"2020-{m:02d}-01", [1.0, 0.05 * (i % 7)]) for i, m in enumerate([1] * 8 + [2] * 8 + [6] * 8)]
    schema = "id long, block string, day date, vec array<double>"
    frame = lambda d: spark.createDataFrame(d, "id long, block string, day string, vec array<double>").withColumn("day", F.col("day").cast("date"))
    src = tmp_path / "in"
    for k in range(3):
        frame(data[8 * k : 8 * k + 8]).coalesce(1).write.mode("append").parquet(str(src))
        marker = Marker(spark, f"file://{tmp_path}/state", 0.999)
        q = spark.readStream.schema(schema).parquet(str(src)).writeStream.foreachBatch(marker).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination()
    got = {r["id"]: r["dup_of"] for r in marker.done().collect()}
    assert got == {r["id"]: r["dup_of"] for r in near_dup.mark_greedy(frame(data), 0.999).collect()}
    assert sorted(r["id"] for r in marker.vectors(3).collect()) == list(range(16, 24))
    marker(frame(data[16:]), 2)  # run again after a failure
    assert {r["id"]: r["dup_of"] for r in marker.done().collect()} == got


def test_event_windows_on_a_stream(spark, tmp_path):
    from vintara.streaming import events as ev

    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    e.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = ev.tumbling(spark.readStream.schema(e.schema).parquet(str(tmp_path / "in")), late="40 days")
    q = stream.writeStream.outputMode("complete").format("memory").queryName("tumbled").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    key = lambda df: rows(df.select("start", "event_type", "n"))
    assert key(spark.table("tumbled")) == key(ev.tumbling(e))
