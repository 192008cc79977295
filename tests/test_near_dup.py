"""Near-duplicates of vectors: the index against brute force, greedy choice in rounds, nothing left behind."""

from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from vintara.durable import shared_dir
from vintara.operators import near_dup


def left_behind(spark):
    top = Path(shared_dir(spark).removeprefix("file://")) / "vintara"
    return {p.name for p in top.iterdir()} if top.exists() else set()


def brute(v, threshold, days=near_dup.DAYS):
    """Pairs ``(id, match)`` of rows ``(id, block, day, vec)``."""
    x = np.array([r[3] for r in v])
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    ids, day, block = (np.array([r[k] for r in v]) for k in (0, 2, 1))
    sim = x @ x.T
    ok = (sim >= threshold) & (block[:, None] == block) & (np.abs(day[:, None] - day) <= days) & (ids[:, None] > ids)
    return {(int(ids[i]), int(ids[j])): sim[i, j] for i, j in zip(*np.nonzero(ok))}


def frame(spark, v):
    return spark.createDataFrame([(i, str(b), int(d), [float(y) for y in x]) for i, b, d, x in v], "id long, block string, d int, vec array<double>").withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), F.col("d"))).drop("d")


def test_tables_follow_the_threshold():
    assert near_dup.plan_tables(0.25, 0.99) == (0, 1) and near_dup.plan_tables(0.95, 1.0) == (0, 1)
    for t in (0.85, 0.9, 0.95, 0.99):
        planes, tables = near_dup.plan_tables(t, 0.99)
        side = 1 - np.arccos(t) / np.pi
        assert planes > 4 and tables <= near_dup.TABLES and 1 - (1 - side**planes) ** tables >= 0.99


@pytest.mark.parametrize("tile", [8, 256])
def test_index_recall_on_the_embeddings(spark, tile, monkeypatch):
    """All of the embeddings at sf0.1, each with a noisy copy, as the table itself has no near pairs."""
    monkeypatch.setattr(near_dup, "TILE", tile)
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").limit(2000 if tile > 8 else 400).collect()
    r = np.random.default_rng(2)
    v = []
    for x in rows:
        e = np.array(x["embedding"], float)
        d = x["vec_id"] % 365
        v += [(x["vec_id"], x["label"], d, e), (100_000 + x["vec_id"], x["label"], d + int(r.integers(-21, 22)), e + r.standard_normal(len(e)) * np.linalg.norm(e) * r.uniform(0.02, 0.055))]
    want = brute(v, 0.9)
    got = {(x["id"], x["match"]): x["sim"] for x in near_dup.near_pairs(frame(spark, v), 0.9).collect()}
    assert set(got) <= set(want) and len(got) >= 0.97 * len(want) > 300
    assert all(abs(got[p] - want[p]) < 1e-9 for p in got)
    every = {(x["id"], x["match"]) for x in near_dup.near_pairs(frame(spark, v), 0.9, recall=1).collect()}
    assert every == set(want)


def test_tiles_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "TILE", 4)
    r = np.random.default_rng(4)
    v = [(i, i % 2, int(r.integers(-60, 60)), r.standard_normal(3)) for i in range(240)] + [(300 + i, 0, 3, [1, 0, 0]) for i in range(40)]
    df = frame(spark, v)
    want = brute(v, 0.3)
    assert {(x["id"], x["match"]) for x in near_dup.near_pairs(df, 0.3).collect()} == set(want)
    best = {}
    for (i, m), s in want.items():
        best[i] = max(best.get(i, (-1, -1)), (round(s, 12), m))
    assert {x["id"]: x["match"] for x in near_dup.best_match(df, 0.3).collect()} == {i: m for i, (_, m) in best.items()}
    new = {(x["id"], x["match"]) for x in near_dup.near_pairs(df.where("id >= 200"), 0.3, earlier=df.where("id < 200")).collect()}
    assert new == {p for p in want if p[0] >= 200}


def test_odd_rows_pair_with_none(spark):
    df = spark.createDataFrame([(1, "b", "2024-01-01", [1.0, 2.0]), (2, "b", "2024-01-01", [1.0, None]), (3, "b", "2024-01-01", []), (4, "b", None, [1.0, 2.0]), (5, None, "2024-01-01", [1.0, 2.0]), (6, "b", "2024-01-01", [1.0, 2.0, 3.0]), (7, "b", "2024-01-01", None), (None, "b", "2024-01-01", [1.0, 2.0]), (8, "b", "2024-01-02", [2.0, 4.0]), (8, "b", "2024-01-02", [2.0, 4.0]), (9, "b", "2024-01-02", [0.0, 0.0])], "id long, block string, day string, vec array<double>").withColumn("day", F.col("day").cast("date")).withColumn("x", F.lit(1))
    assert {(x["id"], x["match"]) for x in near_dup.near_pairs(df, 0.99).collect()} == {(8, 1)}
    assert near_dup.mark_greedy(df.where("false"), 0.9).count() == 0


def slow_originals(pairs):
    by = {}
    for i, m in pairs:
        by.setdefault(i, []).append(m)
        by.setdefault(m, [])
    kept = set()
    for i in sorted(by):
        if not kept & set(by[i]):
            kept.add(i)
    return kept


def test_greedy_rounds(spark):
    """A chain of 10,000 takes under 20 turns, and random graphs settle as one task would settle them."""
    before = left_behind(spark)
    chain = spark.range(1, 10_000).select("id", (F.col("id") - 1).alias("match"))
    kept, turns = near_dup.originals(chain, last_pairs=0)
    assert turns < 20 and kept.where("id % 2 = 0").count() == kept.count() == 5000
    near_dup.forget(kept)
    r = np.random.default_rng(8)
    some = {(int(max(a, b)), int(min(a, b))) for a, b in r.integers(0, 300, (700, 2)) if a != b}
    df = spark.createDataFrame(sorted(some), "id long, match long")
    for last in (0, 100, 10**6):
        kept, _ = near_dup.originals(df, last_pairs=last)
        assert {x["id"] for x in kept.collect()} == slow_originals(some)
        near_dup.forget(kept)
    assert left_behind(spark) == before
