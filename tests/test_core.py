"""Golden cases of the point-in-time operators, contracts and the runner."""

import json

import pytest
from pyspark.sql import functions as F

from vintara.functions.scalar import canonical_entity, cosine, iso_day, patent_ref
from vintara.operators import collect, contracts, market, near_dup, recording, temporal
from vintara.plans.pipeline import ContractError, Pipeline, Step, Store, order
from vintara.sources import parsers


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def dated(df, *cols):
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("date"))
    return df


def test_vintages(spark):
    s = dated(frame(spark, [("a", "2020-06-01", "2020-06-04", 0.7), ("a", "2020-06-01", "2020-07-01", 0.9)], "k string, datum string, t_disclosed string, v double"), "datum", "t_disclosed")
    at = lambda c, **k: [r["v"] for r in temporal.latest_vintage(s, ["k", "datum"], "t_disclosed", ["v"], c, **k).collect()]
    assert at("2020-06-15") == [0.7] and at("2020-07-05") == [0.9] and at("2020-06-02") == [] and at("2020-06-04") == [0.7] and at("2020-06-04", inclusive=False) == [] and at(None) == [0.9]


def test_cross_section_keeps_null_value_and_drops_stale(spark):
    b = dated(frame(spark, [("AAA", "2020-01-04", 10.0), ("AAA", "2020-01-06", None), ("BBB", "2020-01-05", 20.0), ("CCC", "2019-01-05", 5.0), ("AAA", "2020-01-08", 99.0)], "symbol string, datum string, close double"), "datum")
    got = {r["symbol"]: r["value"] for r in market.cross_section(b, "2020-01-06", max_stale_days=30).collect()}
    assert got == {"AAA": None, "BBB": 20.0}
    assert {r["symbol"]: r["value"] for r in market.price_as_of(b, "2020-01-06").collect()} == {"AAA": 10.0, "BBB": 20.0, "CCC": 5.0}
    with pytest.raises(ValueError):
        market.cross_section(b, "2020-01-06", "bogus")


def test_as_of_modes(spark):
    o = dated(frame(spark, [(1, "2020-01-01", "2020-01-03"), (2, "2020-01-02", "2020-01-02"), (3, None, "2020-01-01")], "id int, t_disclosed string, t_ingest string"), "t_disclosed", "t_ingest")
    ids = lambda m: sorted(r["id"] for r in temporal.as_of(o, "2020-01-02", m).collect())
    assert ids("information") == [1, 2] and ids("operational") == [3] and ids("strict") == [2]
    with pytest.raises(ValueError):
        temporal.as_of(o, "2020-01-02", "both")


def test_first_wins_and_null_keys(spark):
    new = frame(spark, [(1, "a", 1), (1, "b", 2), (None, "c", 3), (None, "d", 4), (2, "e", 5)], "k int, v string, seq int")
    old = frame(spark, [(2, "x", 0), (None, "y", 0)], "k int, v string, seq int")
    assert [r[1] for r in rows(temporal.first_wins(new, old, ["k"], "seq").select("k", "v"))] == ["a", "c", "d"]


def test_plan_has_pushed_filter_and_no_cartesian(spark):
    b = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select(F.col("l_partkey").alias("symbol"), F.col("l_shipdate").alias("datum"), F.col("l_extendedprice").alias("close"))
    plan = market.cross_section(b, "1998-06-30")._jdf.queryExecution().toString()
    assert "LessThanOrEqual(l_shipdate" in plan and "Cartesian" not in plan and "SortMergeJoin" not in plan


def test_coverage(spark):
    b = dated(frame(spark, [("A", "2020-01-01")], "symbol string, datum string"), "datum")
    c = market.coverage(b, frame(spark, [("A",), ("B",)], "symbol string"), frame(spark, [("A", "x"), ("B", " ")], "symbol string, category string"))
    s = market.coverage_summary(c).first()
    assert (s["n"], s["n_complete"], s["percent"]) == (2, 1, 50.0)
    assert market.coverage_summary(c.where("false")).first()["percent"] == 0.0


def test_scalars(spark):
    d = frame(spark, [("TSMC, Inc",), ("Group Inc",), ("  Foo   Holdings  Ltd. ",), (None,)], "n string")
    assert [r[0] for r in d.select(canonical_entity(F.col("n"))).collect()] == ["TSMC", "Group Inc", "Foo", ""]
    d = frame(spark, [("KR20180138273A", "2020"), ("kaputt", "2020-02-01T00")], "p string, d string")
    assert rows(d.select(patent_ref(F.col("p")), F.col("p"))) == [("KR.20180138273.A", "KR20180138273A"), (None, "kaputt")]
    assert [str(r[0]) for r in d.select(iso_day(F.col("d"))).collect()] == ["None", "2020-02-01"]
    v = frame(spark, [([1.0, 0.0], [1.0, 0.0]), ([0.0, 0.0], [1.0, 0.0]), ([1.0], [1.0, 2.0]), ([], [])], "a array<double>, b array<double>")
    assert [r[0] for r in v.select(cosine(F.col("a"), F.col("b"))).collect()] == [1.0, 0.0, 0.0, 0.0]


CONTRACT = contracts.TableContract("t", "operativ", [contracts.Field("t_ingest", "time"), contracts.Field("x", "gemessen"), contracts.Field("s", "status"), contracts.Field("l", "list"), contracts.Field("b", "bool")])


def test_contract_rules(spark):
    good = {"t_ingest": "2020-01-01", "x": 1.5, "s": "vermutet", "l": [], "b": False}
    bad = [good | {"x": True}, good | {"s": 1}, good | {"s": "?"}, good | {"t_ingest": ""}, good | {"kat_id": "a"}, good | {"knoten_id": 1}, good | {"l": None}, {k: v for k, v in good.items() if k != "b"}]
    df = frame(spark, [(i, json.dumps(r)) for i, r in enumerate([good, *bad])], "row_index long, row string")
    got = rows(contracts.validate(df, CONTRACT))
    assert [(r[0], r[2]) for r in got] == [(1, "gemessen-nicht-numerisch"), (2, "ordinal-als-zahl"), (3, "wert-nicht-im-vokabular"), (4, "zeit-spalte-fehlt"), (5, "id-version-paarung"), (6, "verbotenes-feld"), (7, "pflichtfeld-fehlt-oder-null"), (8, "pflichtfeld-fehlt-oder-null")]
    assert contracts.contract_violations(contracts.TableContract("t", "nope"))[0][1] == "unbekannter-tabellen-typ"
    assert contracts.contract_violations(contracts.TableContract("t", "projektion"))[0][1] == "zeit-spalte-fehlt-im-kontrakt"


def test_pipeline_fails_closed(spark, tmp_path):
    store = Store(spark, "file://" + str(tmp_path))
    good = lambda i, c: spark.createDataFrame([("2020-01-01", 1.0)], "t_ingest string, x double")
    con = contracts.TableContract("a", "operativ", [contracts.Field("t_ingest", "time"), contracts.Field("x", "gemessen")])
    Pipeline([Step("b", ["a"], "b", lambda i, c: i["a"].drop("seq"), con), Step("a", [], "a", good, con)]).run(store)
    Pipeline([Step("a", [], "a", good, con)]).run(store)
    store.append("n", spark.range(7).repartition(3))
    store.append("n", spark.range(5).repartition(2))
    assert sorted(r["seq"] for r in store.get("n").collect()) == list(range(12)) and {r["id"] for r in store.get("n").where("seq >= 7").collect()} == set(range(5))
    assert store.get("a").count() == 2 and store.get("b").count() == 1 and store.get("zz").count() == 0 and store.tables() == ["a", "b", "n"]
    with pytest.raises(ContractError):
        Pipeline([Step("c", [], "c", lambda i, c: good(i, c).withColumn("t_ingest", F.lit("")), con)]).run(store)
    assert not store.has("c")
    with pytest.raises(ValueError):
        store.append("___", good({}, {}))
    with pytest.raises(ValueError):
        order([Step("a", ["b"], "a", good), Step("b", ["a"], "b", good)])


def test_recording(spark):
    log = frame(spark, [("r", 10, 4), ("s", 1, None)], "run_id string, n_found long, n_new long")
    d = frame(spark, [("r",)] * 9 + [("s",)], "run_id string")
    with pytest.raises(recording.RecordingError):
        recording.check_run(log, d, d.limit(0))
    docs = frame(spark, [(0.5,), (0.01,), (None,)], "relevance double").withColumn("title", F.lit("a")).withColumn("text", F.lit("b"))
    assert [r["accepted"] for r in recording.record_documents(docs).collect()] == [True, False, False]


def test_greedy_roots_only(spark):
    v = dated(frame(spark, [(1, 0, "2020-01-01", [1.0, 0.0]), (2, 0, "2020-01-02", [0.95, 0.31]), (3, 0, "2020-01-03", [0.8, 0.6]), (4, 0, "2020-03-01", [1.0, 0.0])], "id long, block int, day string, vec array<double>"), "day")
    got = {r["id"]: r["dup_of"] for r in near_dup.mark_greedy(v, 0.9).collect()}
    assert got == {1: None, 2: 1, 3: None, 4: None}
    assert {r["id"]: r["match"] for r in near_dup.best_match(v, 0.9).collect()} == {2: 1, 3: 2}


def test_parsers(spark):
    y = frame(spark, [("01/02/2020", "1.5", "N/A"), ("bad", "1", "1"), ("1/3/2020", "", "")], "Date string, `1 Mo` string, `2 Mo` string")
    assert [(r["date"], r["rates"]) for r in parsers.yield_curve(y, ["1 Mo", "2 Mo"]).collect()] == [("2020-01-02", {"1 Mo": 0.015})]
    e = frame(spark, [('{"earnings":[{"code":"A","report_date":"2020-01-01","actual":3},{"code":"B","report_date":"2020"}]}',)], "json string")
    assert [(r["code"], str(r["report_date"])) for r in parsers.earnings_calendar(e).collect()] == [("A", "2020-01-01")]
    x = frame(spark, [("<entry><id>u</id><title> A  b</title><summary>c</summary><published>2020-01-01T0</published></entry><entry><title></title></entry>",)], "xml string")
    assert [(r["title"], r["published_at"]) for r in parsers.atom_documents(x).collect()] == [("A b", "2020-01-01")]


def test_facts_need_one_clock(spark):
    with pytest.raises(ValueError):
        collect.facts_as_of(None, cutoff="2020-01-01", published_by="2020-01-01")
