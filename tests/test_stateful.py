"""Marking a stream with keyed state: restarts from its checkpoint, state evicted, equal to one run over all."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from vintara.operators import near_dup
from vintara.streaming.stateful import mark_stream


def test_restart_and_bounded_state(spark, tmp_path):
    r = np.random.default_rng(2)
    base = r.standard_normal((6, 4))
    rows = []
    for i in range(160):
        v = base[int(r.integers(0, 6))] + r.standard_normal(4) * (0.02 if r.random() < 0.7 else 1)
        rows.append((i, f"b{i % 2}", dt.date(2024, 1, 1) + dt.timedelta(days=i * 2), [float(x) for x in v]))
    schema = "id long, block string, day date, vec array<double>"
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    src, out, sizes = str(tmp_path / "in"), str(tmp_path / "out"), []
    try:
        for k in range(4):
            part = rows[40 * k : 40 * k + 40]
            if k:
                part = part + rows[40 * k - 2 : 40 * k]  # repeats of documents decided before
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
            # a new query each time, from the checkpoint of the last
            q = mark_stream(spark.readStream.schema(schema).parquet(src), 0.98).writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(availableNow=True).start()
            q.awaitTermination()
            sizes.append(sum(o["numRowsTotal"] for o in q.lastProgress["stateOperators"]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    got = [(x["id"], x["dup_of"]) for x in spark.read.parquet(out).collect()]
    want = {x["id"]: x["dup_of"] for x in near_dup.mark_greedy(spark.createDataFrame(rows, schema), 0.98).collect()}
    assert len(got) == len(rows) and dict(got) == want and any(v is not None for v in want.values())
    # bounded: the state after four times the input is no larger than after the first quarter, but for what a batch brings
    assert sizes[-1] <= sizes[0] * 1.6, sizes
