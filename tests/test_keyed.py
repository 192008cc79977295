"""Compaction by key: equal to the log's last rows, files pruned, only touched files rewritten."""

import pytest
from pyspark.sql import functions as F

from vintara.plans.keyed import KeyedLog


def current(df):
    return {r["symbol"]: (r["seq"], r["v"]) for r in df.collect()}


def test_level_equals_the_log(spark, tmp_path):
    log = KeyedLog(spark, f"file://{tmp_path}/k", "symbol", file_rows=20)
    assert log.lookup().count() == 0 and log.compact() == {"rewritten": 0, "kept": 0, "made": 0}
    make = lambda ids, v: spark.createDataFrame([(f"s{i:03d}", v) for i in ids], "symbol string, v long").repartition(3)
    log.append(make(range(100), 1))
    log.append(make([3, 4], None))
    first = log.compact()
    assert first["rewritten"] == 0 and first["made"] >= 5
    log.append(make([5, 6, 200], 3))
    want = {f"s{i:03d}": 1 for i in range(100)} | {"s003": None, "s004": None, "s005": 3, "s006": 3, "s200": 3}
    assert {k: v for k, (_, v) in current(log.lookup()).items()} == want
    got = log.compact()
    # only the files around s005, s006 and s200 were written anew
    assert got["rewritten"] in (2, 3) and got["kept"] >= 2
    spans = sorted((r["low"], r["high"]) for r in log.level().collect())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert {k: v for k, (_, v) in current(log.lookup()).items()} == want
    one = log.lookup(["s050", "none"])
    assert {k: v for k, (_, v) in current(one).items()} == {"s050": 1}
    read = {f for f in one.inputFiles() if "/level/" in f}
    assert len(read) == 1 and len({f for f in log.lookup().inputFiles() if "/level/" in f}) == got["kept"] + got["made"]
    assert log.compact()["made"] == 0
    log.append(make([50], 9).withColumn("more", F.lit("x")))
    assert current(log.lookup(["s050"]))["s050"][1] == 9 and log.lookup(["s051"]).first()["more"] is None
    with pytest.raises(Exception, match="without a key"):
        log.append(spark.createDataFrame([(None, 1)], "symbol string, v long"))
