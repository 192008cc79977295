"""The log of commits: writers at once, broken-off appends, checks in the write itself."""

import threading

import pytest
from pyspark.sql import functions as F

from vintara.operators.contracts import Field, TableContract
from vintara.plans.pipeline import ContractError, Pipeline, Step, Store

CONTRACT = TableContract("t", "operativ", [Field("t_ingest", "time"), Field("name", "text"), Field("n", "gemessen", nullable=True)])


def made(spark, ids, parts=3):
    return spark.createDataFrame([(i, f"r{i}") for i in ids], "id long, name string").repartition(parts)


def test_two_writers_at_once_leave_no_gap(spark, tmp_path):
    store, errors = Store(spark, f"file://{tmp_path}/s"), []

    def write(k):
        try:
            for j in range(3):
                Store(spark, f"file://{tmp_path}/s").append("t", made(spark, range(100 * k + 10 * j, 100 * k + 10 * j + 7)))
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    got = store.get("t").collect()
    assert sorted(r["seq"] for r in got) == list(range(63)) and len({r["id"] for r in got}) == 63
    # rows of one append lie side by side
    spans = {}
    for r in got:
        spans.setdefault(r["id"] // 10, []).append(r["seq"])
    assert all(max(x) - min(x) == 6 for x in spans.values())


def test_a_broken_off_append_is_invisible(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    store.append("t", made(spark, range(5)))
    lost = Store(spark, f"file://{tmp_path}/s")

    def fail(*a):
        raise OSError("lost before the commit")

    lost._make = fail
    with pytest.raises(OSError):
        lost.append("t", made(spark, range(5, 9)))
    bad = F.udf(lambda i: 1 // (i - 7), "int")
    with pytest.raises(Exception, match="ZeroDivision"):
        store.append("t", made(spark, range(5, 9)).withColumn("x", bad("id")))
    assert store.get("t").count() == 5
    assert store.append("t", made(spark, range(20, 23)).withColumn("more", F.lit(1.5))) == 3
    assert sorted((r["seq"], r["more"]) for r in store.get("t").collect()) == [(i, None) for i in range(5)] + [(5 + i, 1.5) for i in range(3)]
    assert store.tables() == ["t"]


def test_empty_appends_and_names(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    assert store.get("none").count() == 0 and store.tables() == []
    assert store.append("t", made(spark, []).withColumn("p", F.lit("own"))) == 0 and store.get("t").count() == 0
    store.append("t", made(spark, range(4)).withColumn("p", F.lit("own")).withColumn("seq", F.lit(99)))
    assert sorted((r["seq"], r["p"]) for r in store.get("t").collect()) == [(i, "own") for i in range(4)]
    for name in ("a/b", "", "a b"):
        with pytest.raises(ValueError):
            store.append(name, made(spark, [1]))
    with pytest.raises(ValueError, match="for itself"):
        store.append("t", made(spark, [1]).withColumn("append", F.lit(1)))


def test_a_breach_leaves_no_row_and_one_scan(spark, tmp_path):
    """The step's input is read once for checking and writing together."""
    store = Store(spark, f"file://{tmp_path}/s")
    reads = spark.sparkContext.accumulator(0)

    def counted(i):
        reads.add(1)
        return i

    count = F.udf(counted, "long")
    good = made(spark, range(6), 1).select(count("id").alias("id"), "name", F.lit("2024-01-01").alias("t_ingest"), F.lit(1.0).alias("n"))
    Pipeline([Step("a", [], "t", lambda inputs, ctx: good, CONTRACT)]).run(store)
    assert store.get("t").count() == 6 and "_broken" not in store.get("t").columns
    assert reads.value == 6
    worse = good.withColumn("name", F.when(F.col("id") % 3 != 0, F.col("name"))).withColumn("n", F.lit("text"))
    with pytest.raises(ContractError) as e:
        Pipeline([Step("a", [], "t", lambda inputs, ctx: worse, CONTRACT)]).run(store)
    assert e.value.step == "a" and {(r["field"], r["rule"]) for r in e.value.violations} == {("name", "pflichtfeld-fehlt-oder-null"), ("n", "gemessen-nicht-numerisch")}
    assert store.get("t").count() == 6
    kept = spark.read.parquet(f"file://{tmp_path}/s/t/_quarantine/*")
    assert kept.count() == 6 and kept.where("size(_broken) > 1").count() == 2
    assert sorted(r["seq"] for r in store.get("t").collect()) == list(range(6))


def test_collector_is_normalised_when_opened(spark, tmp_path):
    from vintara.operators import collect, market
    from vintara.sources import parsers, schemas

    name = "collector_opened"
    tables = schemas.open_collector(spark, name)
    assert set(tables) == set(schemas.COLLECTOR) and tables["documents"].count() == 0
    rows = [(1, " EPO ", None), (2, "arxiv", 1), (3, "epo", 1)]
    own = spark.createDataFrame(rows, "id long, source_type string, dup_of long")
    spark.table(f"{name}.documents").unionByName(own, allowMissingColumns=True).coalesce(1).write.mode("append").insertInto(f"{name}.documents")
    for _ in range(2):
        got = {r["id"]: (r["source_type"], r["dup_of"]) for r in schemas.open_collector(spark, name)["documents"].collect()}
        assert got == {1: ("patent", None), 2: ("paper", None), 3: ("patent", 1)}
    assert collect.table_if_there(spark, f"{name}.themes") is None and collect.table_if_there(spark, f"{name}.facts").count() == 0
    spark.sql(f"DROP DATABASE {name} CASCADE")
    ret = spark.createDataFrame([("b", 1.0), ("a", 2.0)], "symbol string, ret double")
    uni = spark.createDataFrame([("b", None, False), ("a", None, True)], "symbol string, category string, delisted boolean")
    assert [r["category"] for r in market.category_return(ret, uni, ordered=True).collect()] == ["a", "b"]
    curve = spark.createDataFrame([("02/01/2024", "3"), ("01/05/2024", "4")], "Date string, `10 Yr` string")
    assert [r["date"] for r in parsers.yield_curve(curve, ["10 Yr"], ordered=True).collect()] == ["2024-01-05", "2024-02-01"]
