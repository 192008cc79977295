"""Reads at a cut-off of each row against plain loops: ties, nulls, slices of a few days, strict cut-offs; windows by differences of sums."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from vintara.operators import market, temporal

D0 = dt.date(2020, 1, 1)
ON = lambda n: None if n is None else D0 + dt.timedelta(days=int(n))


def made(seed):
    r = np.random.default_rng(seed)
    known = [(int(r.integers(0, 4)) or None, ON(r.integers(-50, 120)), float(i)) for i in range(160)] + [(1, None, -1.0), (1, ON(7), None)]
    asks = [(i, int(r.integers(0, 6)) or None, ON(r.integers(-80, 400)) if i % 9 else None) for i in range(120)]
    return known, asks


@pytest.mark.parametrize("slices", [1, 10, 366])
@pytest.mark.parametrize("strict", [False, True])
def test_asof_join_equals_a_loop(spark, slices, strict):
    known, asks = made(slices)
    k = spark.createDataFrame(known, "key int, at date, v double")
    a = spark.createDataFrame(asks, "n int, key int, cut date").withColumn("_s", F.lit("clash"))
    got = {r["n"]: (r["at"], r["v"]) for r in temporal.asof_join(a, k, ["key"], "cut", "at", ["v"], strict, slices).collect()}
    want = {}
    for n, key, cut in asks:
        best = max(((at, v is not None, v or 0) for kk, at, v in known if kk == key and key is not None and at is not None and cut is not None and (at < cut if strict else at <= cut)), default=None)
        want[n] = (None, None) if best is None else (best[0], best[2] if best[1] else None)
    assert got == want


@pytest.mark.parametrize("slices", [1, 10, 366])
def test_trailing_equals_a_loop(spark, slices):
    known, asks = made(slices + 7)
    k = spark.createDataFrame(known, "key int, at date, v double")
    a = spark.createDataFrame(asks, "n int, key int, cut date")
    got = {r["n"]: (r["c"], r["s"]) for r in temporal.trailing(a, k, ["key"], "cut", "at", 9, {"c": F.count("v"), "s": F.sum("v")}, slices).collect()}
    for n, key, cut in asks:
        vs = [v for kk, at, v in known if kk == key and None not in (key, at, cut, v) and 0 <= (cut - at).days <= 9]
        assert got[n] == ((None, None) if None in (key, cut) else (len(vs), sum(vs) if vs else None))


def test_running_total_and_clash(spark):
    known, _ = made(3)
    k = spark.createDataFrame(known, "key int, at date, v double")
    for slices in (1, 13, 366):
        for r in temporal.running_total(k, ["key"], "at", "v", "total", slices).collect():
            assert r["total"] == (None if r["at"] is None else sum(v or 0 for kk, at, v in known if kk == r["key"] and at is not None and at <= r["at"]))
    with pytest.raises(ValueError, match="already has"):
        temporal.asof_join(k, k, ["key"], "at", "at", ["v"])


def test_window_counts_by_sums(spark):
    e = spark.createDataFrame([("a", ON(1)), ("a", ON(1)), ("a", ON(5)), ("b", ON(400)), (None, ON(1)), ("a", None)], "cls string, datum date")
    w = spark.createDataFrame([(ON(0), ON(2)), (ON(2), ON(5)), (ON(1), ON(6)), (ON(9), ON(3)), (ON(0), ON(4000)), (None, ON(2))], "since date, until date")
    out = market.window_counts(e, w, spark.createDataFrame([("a",), ("b",), ("c",)], "cls string"))
    got = {(r["cls"], r["since"], r["until"]): r["n"] for r in out.collect()}
    assert len(got) == 18 and {k for k, n in got.items() if n} == {("a", ON(0), ON(2)), ("a", ON(1), ON(6)), ("a", ON(0), ON(4000)), ("b", ON(0), ON(4000))}
    assert got["a", ON(1), ON(6)] == 3 and got["a", ON(0), ON(2)] == 2
    assert "explode(sequence" not in out._jdf.queryExecution().toString()
