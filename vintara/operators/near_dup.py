"""Semantic near-duplicates of embedded documents inside a block and a window of days.

Vectors are looked for by signed random projections where the threshold lets them pay: two
unit vectors of cosine ``c`` fall on one side of a random plane with chance ``1 - acos(c) / pi``,
so vectors that agree on all planes of one of several tables are candidates, and planes and
tables are chosen for a wanted recall. A bucket (of a table, or of the whole block and days
where no index pays) is cut into tiles of bounded size that meet in pairs, so none is skipped
and no task holds a bucket whole. A pair of tiles is one matrix product; the cosine is exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..durable import durable, forget
from ..shipping import ship

DAYS = 21
#: Vectors of a tile; most tables of an index; the share of all pairs that an index may compare at most to be worth it.
TILE, TABLES, WORTH = 256, 16, 0.25
#: Most open pairs that one task settles in id order; beyond it they are settled in rounds first.
LAST_PAIRS = 200_000
_KEY = ["block", "b", "dim", "t", "sig", "x", "y"]


def plan_tables(threshold: float, recall: float) -> tuple[int, int]:
    """``planes, tables`` of an index that finds a pair at ``threshold`` with a chance of at least ``recall``; ``(0, 1)``, all pairs of a block and window, where none is worth it or all pairs are asked for."""
    best = (0, 1)
    if 0 < threshold < 1 and 0 < recall < 1:
        side = 1 - math.acos(threshold) / math.pi
        for planes in range(1, 31):
            tables = math.ceil(math.log(1 - recall) / math.log(1 - side**planes))
            if tables <= TABLES and tables / 2**planes <= min(WORTH, best[1] / 2 ** best[0]):
                best = (planes, tables)
    return best


def _signed(planes: int, tables: int, days: int):
    """Rows ``id, block, day (number), dim, new, b, t, sig, u``: a unit vector in each table; ``b`` counts windows of days."""

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spaces: dict[int, np.ndarray] = {}
        for batch in batches:
            vec = batch.column("vec")
            flat, ends = vec.values.to_numpy(zero_copy_only=False).astype(np.float64), vec.offsets.to_numpy()
            sizes = np.diff(ends)
            for dim in np.unique(sizes[sizes > 0]).tolist():
                at = np.flatnonzero(sizes == dim)
                v = flat[ends[at][:, None] + np.arange(dim)]
                norm = np.sqrt((v * v).sum(1))
                at, v = at[norm > 0], v[norm > 0] / norm[norm > 0][:, None]
                if not len(at):
                    continue
                if dim not in spaces:
                    spaces[dim] = np.random.default_rng([17, dim]).standard_normal((dim, planes * tables))
                bits = (v @ spaces[dim] > 0).reshape(len(at), tables, planes)
                sig = (bits * (1 << np.arange(planes))).sum(2).astype(np.int64)
                own = batch.take(pa.array(at))
                whole = pa.ListArray.from_arrays(pa.array(np.arange(0, v.size + 1, dim, dtype=np.int32)), pa.array(v.ravel()))
                b = np.floor_divide(own.column("day").to_numpy(), days + 1)
                for t in range(tables):
                    yield pa.RecordBatch.from_arrays([own.column("id"), own.column("block"), own.column("day"), own.column("new"), pa.array(np.full(len(at), dim)), pa.array(b), pa.array(np.full(len(at), t)), pa.array(sig[:, t]), whole], ["id", "block", "day", "new", "dim", "b", "t", "sig", "u"])

    return fn


def _compared(threshold: float, days: int, best: bool):
    """Pairs of each group of two tiles ``x, y`` whose cosine reaches the threshold; with ``best`` the best match of each id alone."""

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = batch.column("rows"), []
            ends, dims = rows.offsets.to_numpy(), batch.column("dim").to_pylist()
            own = {n: rows.values.field(n).to_numpy(zero_copy_only=False) for n in ("id", "day", "tile", "away", "new")}
            u = rows.values.field("u")
            flat, at = u.values.to_numpy(), u.offsets.to_numpy()
            for i, (x, y) in enumerate(zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())):
                s, e = int(ends[i]), int(ends[i + 1])
                v = flat[at[s] : at[e]].reshape(e - s, dims[i])
                r = {n: a[s:e] for n, a in own.items()}
                left, right = np.flatnonzero(r["tile"] == x), np.flatnonzero(r["tile"] == y)
                sim = v[left] @ v[right].T
                p, q = np.nonzero((sim >= threshold) & (sim > 0))
                score, p, q = sim[p, q], left[p], right[q]
                p, q = np.where(r["id"][p] > r["id"][q], p, q), np.where(r["id"][p] > r["id"][q], q, p)
                fit = (r["id"][p] > r["id"][q]) & ~(r["away"][p] & r["away"][q]) & (np.abs(r["day"][p] - r["day"][q]) <= days) & r["new"][p]
                if x == y:  # each pair stands twice
                    fit &= left[np.nonzero((sim >= threshold) & (sim > 0))[0]] == p
                ids, matches, score = r["id"][p[fit]], r["id"][q[fit]], score[fit]
                if best and len(ids):
                    order = np.lexsort((matches, score.round(12), ids))
                    last = np.r_[ids[order][1:] != ids[order][:-1], True]
                    ids, matches, score = (a[order][last] for a in (ids, matches, score))
                out.append((ids, matches, score))
            cols = [np.concatenate([o[k] for o in out]) if out else np.zeros(0) for k in range(3)]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64())], ["id", "match", "sim"])

    return fn


def _found(docs: DataFrame, threshold: float, days: int, recall: float, earlier: DataFrame | None, best: bool) -> DataFrame:
    """Pairs as they are found, an id or a pair more than once where several tables or tiles have it."""
    ship(docs.sparkSession)
    planes, tables = plan_tables(threshold, recall)
    cols = [F.col("id").cast("long").alias("id"), F.col("block").cast("string").alias("block"), F.datediff(F.col("day"), F.lit("1970-01-01").cast("date")).cast("long").alias("day"), F.col("vec").cast("array<double>").alias("vec")]
    rows = docs.select(*cols, F.lit(True).alias("new"))
    if earlier is not None:
        rows = rows.union(earlier.select(*cols, F.lit(False)))
    rows = rows.where(F.col("id").isNotNull() & F.col("block").isNotNull() & F.col("day").isNotNull() & F.col("vec").isNotNull() & ~F.exists("vec", lambda x: x.isNull()))
    signed = rows.mapInArrow(_signed(planes, tables, days), "id long, block string, day long, new boolean, dim long, b long, t long, sig long, u array<double>")
    # at home in its own window of days, and a visitor in the one before: two within the days meet in one of them
    placed = signed.select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("away")).withColumn("b", F.col("b") - F.col("away").cast("long"))
    key = [k for k in _KEY if k not in ("x", "y")]
    sizes = placed.groupBy(*key).agg(F.count("*").alias("m"), F.bool_or("new").alias("any"), F.bool_or(~F.col("away")).alias("home")).where("m > 1 and any and home").select(*key, F.ceil(F.col("m") / TILE).cast("int").alias("tiles"))
    tiled = placed.join(sizes, key).withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int"))
    each = tiled.select("*", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("o")).select("*", F.least("tile", "o").alias("x"), F.greatest("tile", "o").alias("y"))
    packed = each.groupBy(*_KEY).agg(F.collect_list(F.struct("id", "day", "tile", "away", "new", "u")).alias("rows")).where(F.size("rows") > 1)
    return packed.select("dim", "x", "y", "rows").mapInArrow(_compared(threshold, days, best), "id long, match long, sim double")


def near_pairs(docs: DataFrame, threshold: float, days: int = DAYS, recall: float = 0.99, earlier: DataFrame | None = None) -> DataFrame:
    """``id, match, sim``: pairs of a document and an earlier one of its block within the days whose cosine reaches the threshold.

    ``docs`` has ``id`` (long), ``block``, ``day``, ``vec``. From a threshold of about 0.8 on, an index
    finds a pair at the threshold with a chance of ``recall`` and more alike ones with more;
    ``recall=1`` asks for all pairs. Below it all pairs are compared. Documents of ``earlier`` are
    matches only. Documents without an id, a day, a block or a vector of some length, or with a
    null in it, pair with none; vectors of different sizes don't pair. An empty table gives an
    empty table.
    """
    found = _found(docs, threshold, days, recall, earlier, False)
    return found if plan_tables(threshold, recall)[1] == 1 else found.groupBy("id", "match").agg(F.max("sim").alias("sim"))


def _best(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("id").agg(F.max_by("match", F.struct(F.round("sim", 12), "match")).alias("match"), F.max("sim").alias("sim"))


def best_match(docs: DataFrame, threshold: float, days: int = DAYS, recall: float = 0.99) -> DataFrame:
    """``id, match, sim``: per document the most similar earlier one of its block within the days, if it reaches the threshold.

    Of similarities equal to twelve places the highest id wins. Each two tiles give one match an
    id at most, so copies cost no pairs. Otherwise as ``near_pairs``.
    """
    return _best(_found(docs, threshold, days, recall, None, True))


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Originals among the ids of sorted open pairs, in id order."""
    states: dict[int, bool] = {}
    at, dup = None, False
    for batch in batches:
        for i, m in zip(batch.column("id").to_pylist(), batch.column("match").to_pylist()):
            if i != at:
                if at is not None:
                    states[at] = not dup
                at, dup = i, False
            dup |= states.setdefault(m, True)  # a match that is no id is original
    if at is not None:
        states[at] = not dup
    yield pa.RecordBatch.from_arrays([pa.array([i for i, o in states.items() if o], pa.int64())], ["id"])


def originals(pairs: DataFrame, last_pairs: int = LAST_PAIRS) -> tuple[DataFrame, int]:
    """``id`` of those ids and matches of ``pairs`` (``id, match``, each match less than its id) that the greedy choice in id order keeps, as a written table, and the number of joins it took in turn.

    An id is original if none of its matches is. Where one match of an id is open, the id is its
    opposite; such chains are followed by pointers that double, so a chain of c takes log2(c)
    turns. Then whatever is near an original is a duplicate, duplicates are no matches any more,
    and what is left is looked at again; ids that stand in no special order take few rounds.
    As soon as at most ``last_pairs`` pairs are open one task settles them. Written tables of
    past rounds are deleted.
    """
    rest, kept, turns = durable(pairs.select("id", "match"), "open"), None, 0
    keep = lambda df: df if kept is None else kept.union(df)
    while (n := rest.count()) > last_pairs:
        turns += 1
        links = durable(rest.groupBy("id").agg(F.count("*").alias("c"), F.min("match").alias("to")), "links")
        free = durable(rest.select(F.col("match").alias("id")).distinct().join(links.select("id"), "id", "left_anti"), "free")
        # opposite: whether an id is what ``to`` is not
        chain = durable(links.where("c = 1").select("id", "to", F.lit(True).alias("opposite")), "chain")
        while True:
            up = chain.select(F.col("id").alias("to"), F.col("to").alias("next"), F.col("opposite").alias("turned"))
            longer = durable(chain.join(up, "to", "left").select("id", F.coalesce("next", "to").alias("to"), (F.col("opposite") != F.coalesce("turned", F.lit(False))).alias("opposite"), F.col("next").isNotNull().alias("moved")), "chain")
            forget(chain)
            chain = longer.drop("moved")
            chain._vintara_path = longer._vintara_path
            if longer.where("moved").isEmpty():
                break
            turns += 1
        known = chain.join(free.select(F.col("id").alias("to")), "to", "left_semi")
        good = durable(free.union(known.where(~F.col("opposite")).select("id")), "good")
        near = rest.join(good.select(F.col("id").alias("match")), "match", "left_semi").select("id")
        gone = durable(near.union(known.where("opposite").select("id")).distinct(), "gone")
        left = rest.join(gone, "id", "left_anti").join(gone.select(F.col("id").alias("match")), "match", "left_anti").select("id", "match")
        nxt = durable(left, "open")
        # without a match that may be original
        alone = links.select("id").join(gone, "id", "left_anti").join(nxt.select("id").distinct(), "id", "left_anti")
        both = durable(keep(good.union(alone).distinct()), "originals")
        for used in (rest, links, free, chain, good, gone, *([kept] if kept is not None else [])):
            forget(used)
        rest, kept = nxt, both
    if n:
        ship(pairs.sparkSession)
        turns += 1
        some = rest.coalesce(1).sortWithinPartitions("id", "match").mapInArrow(_settled, "id long")
        both = durable(keep(some).distinct(), "originals")
        if kept is not None:
            forget(kept)
        kept = both
    elif kept is None:
        kept = durable(rest.select("id"), "originals")
    forget(rest)
    return kept, turns


def mark_greedy(docs: DataFrame, threshold: float, days: int = DAYS, earlier: DataFrame | None = None, recall: float = 0.99, last_pairs: int = LAST_PAIRS) -> DataFrame:
    """``id, dup_of``: documents in id order, each a duplicate of the best earlier one that is none itself, else null.

    ``earlier`` has documents decided in runs before, with ``dup_of``; those that are no
    duplicates are looked for as matches, and not among themselves. Otherwise as ``near_pairs``.
    """
    known = None if earlier is None else earlier.where("dup_of is null")
    pairs = durable(near_pairs(docs, threshold, days, recall, known), "near-pairs")
    kept, _ = originals(pairs, last_pairs)
    marked = pairs.join(kept.select(F.col("id").alias("match")), "match", "left_semi").join(kept, "id", "left_anti")
    out = durable(_best(marked).select("id", F.col("match").alias("dup_of")), "marks")
    forget(pairs)
    forget(kept)
    return docs.select("id").join(out, "id", "left")


def mean_vector(tokens: Column) -> Column:
    """Token matrix to sentence vector: the mean over tokens; a flat or a ragged matrix, or an empty one, is an error."""
    width = F.size(F.get(tokens, F.lit(0)))
    even = (F.size(tokens) > 0) & (width > 0) & F.forall(tokens, lambda r: F.size(r) == width)
    total = F.aggregate(tokens, F.array_repeat(F.lit(0.0), width), lambda s, r: F.zip_with(s, r, lambda a, b: a + b.cast("double")))
    return F.when(even, F.transform(total, lambda x: x / F.size(tokens))).otherwise(F.raise_error(F.lit("a token matrix needs rows of one length")).cast("array<double>"))
