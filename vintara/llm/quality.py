"""Operator 5: document quality by Bradley-Terry pairwise ranking.

A document's utility is a weighted sum of features of its whole text. Weights are learnt
from preference pairs (a label-1 document is preferred to a label-0 one) by logistic loss on
the difference of the two feature vectors. All learnable rows take part: they are dealt to
groups of about ``GROUP`` rows by a hash, and within a group every label-1 row is compared with
every label-0 row; each Newton step is one Spark job that adds up gradients and Hessians. The
cut is an exact quantile of the utilities of all these rows, each class weighted to its share
among the learnable labels: the share of label 0. Scores map the cut to 0.3.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, forget, id_text, map_arrow, table

CUT = 0.3
#: Rows of a group in which all preference pairs are compared; bins and most rows of the last bin of the search for a quantile.
GROUP, BINS = 256, 1024
_SYMBOLS = [ord(c) for c in "#$%&*@^~+=<>{}[]\\/_`"]
_POINTS = [ord(c) for c in ".,;:?'\"()-"]
FEATURES = 16


def features(text: str) -> list[float]:
    """Feature vector of one whole text; the empty text has a defined one."""
    raw = text.encode()
    n = max(1, len(raw))
    h = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower = int(h[65:91].sum()), int(h[97:123].sum())
    words = text.split()
    k = max(1, len(words))
    same = sum(map(operator.eq, words, words[1:]))
    root = math.sqrt
    return [
        root(upper / max(1, upper + lower)), root(h[33] / n), root(h[124] / n), root(int(h[_SYMBOLS].sum()) / n), root(int(h[_POINTS].sum()) / n),
        root(int(h[48:58].sum()) / n), root(h[10] / n), root(h[32] / n), root(int(h[128:].sum()) / n), root(int(h[:9].sum() + h[14:32].sum()) / n),
        root(same / k), len(set(words)) / k, math.log1p(len(raw) / k), math.log1p(len(words)), len(set(words)) / k * math.log1p(len(words)), float(not words),
    ]


def held_out(doc_id, mod: int = 5, rest: int = 0):
    """Whether a row is held out: crc32 of the id as text, modulo ``mod``, is ``rest``."""
    return F.coalesce(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod == rest, F.lit(False))


def learnable(labels: DataFrame, label: str, mod: int, rest: int) -> tuple[DataFrame, dict[int, int]]:
    """``doc_id, label`` of all rows that may be learnt from, and the count of each class. Null ids and labels are passed over; a repeated row counts once."""
    known = labels.select(F.col("doc_id").alias("doc_id"), F.col(label).cast("int").alias("label")).where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).distinct().where(~held_out(F.col("doc_id"), mod, rest))
    return known, {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, mod: int, rest: int, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """``doc_id, text, label`` of at most ``per_class`` learnable rows of each class, those of the smallest id hashes, and the count of each class among all of them."""
    known, counts = learnable(labels, label, mod, rest)
    picked = [known.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    chosen = picked[0].union(picked[1])  # at most 2 * per_class ids
    return id_text(docs).join(F.broadcast(chosen), "doc_id"), counts


@dataclass
class PairwiseRanker:
    """Bradley-Terry weights over standardised features, with the calibration of the score."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    cut: float
    slope: float = 1.0

    def utility(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weight

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip(self.slope * (self.utility(x) - self.cut) + math.log(CUT / (1 - CUT)), -40, 40)
        return 1 / (1 + np.exp(-z))


def group_sums(x: np.ndarray, y: np.ndarray, mean: np.ndarray, scale: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Number of preference pairs of a group, and over them the summed gradient and Hessian of the logistic loss at ``w``, as one flat array."""
    z = np.clip((x - mean) / scale, -8, 8)
    good, bad = z[y == 1], z[y == 0]
    out = np.zeros(1 + FEATURES + FEATURES * FEATURES)
    step = max(1, (1 << 20) // max(1, len(bad)))
    for i in range(0, len(good) if len(bad) else 0, step):
        part = good[i : i + step]
        p = 1 / (1 + np.exp(-np.clip((part @ w)[:, None] - (bad @ w)[None, :], -40, 40)))
        r, v = 1 - p, p * (1 - p)
        both = part.T @ v @ bad
        hess = (part.T * v.sum(1)) @ part + (bad.T * v.sum(0)) @ bad - both - both.T
        out += np.concatenate([[p.size], bad.T @ r.sum(0) - part.T @ r.sum(1), hess.ravel()])
    return out


def _summed(groups: DataFrame, of) -> np.ndarray:
    """The sum of ``of(x, y)``, a flat array, over all groups; one row a batch comes to the driver."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [of(np.array(x).reshape(-1, FEATURES), np.array(y)) for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist())]
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array([np.sum(parts, axis=0).tolist()], pa.list_(pa.float64()))], ["s"])

    got = [r["s"] for r in map_arrow(groups, sums, "s array<double>").collect()]
    return np.array([math.fsum(v) for v in zip(*got)])


def fit(groups: DataFrame, reject_share: float, l2: float = 1e-3) -> PairwiseRanker:
    """Fit by Newton steps on all preference pairs of all ``groups`` (``x``, ``y``: feature vectors in a row, labels); without both classes every score is 0.5."""
    near = lambda v: np.array([float(f"{a:.11g}") for a in v])  # noqa: E731  sums in another order give the same model
    start = _summed(groups, lambda x, y: np.concatenate([[(y == 0).sum(), (y == 1).sum()], x.sum(0)]))
    n_bad, n_good = (int(start[0]), int(start[1])) if len(start) else (0, 0)
    if not n_bad or not n_good:
        return PairwiseRanker(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), math.log(CUT / (1 - CUT)))
    n = n_bad + n_good
    mean = near(start[2:] / n)
    spread = np.sqrt(_summed(groups, lambda x, y: ((x - mean) ** 2).sum(0)) / n)
    scale = near(np.where(spread > 1e-9, spread, 1.0))
    w = np.zeros(FEATURES)
    for _ in range(25):
        at = w
        s = _summed(groups, lambda x, y: group_sums(x, y, mean, scale, at))
        pairs = max(1.0, s[0])
        step = np.linalg.solve(s[1 + FEATURES :].reshape(FEATURES, FEATURES) / pairs + l2 * np.eye(FEATURES), s[1 : 1 + FEATURES] / pairs + l2 * w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    model = PairwiseRanker(mean, scale, near(w), 0.0)

    def utilities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array(model.utility(np.array(x).reshape(-1, FEATURES))), pa.array(y, pa.int32())], ["u", "y"])

    rows = durable(map_arrow(groups, utilities, "u double, y int"), "utilities")
    model.cut = quantile(rows, reject_share / n_bad, (1 - reject_share) / n_good, reject_share)
    forget(rows)
    return model


def quantile(rows: DataFrame, w0: float, w1: float, share: float) -> float:
    """The middle between the first utility ``u`` up to which the rows weigh at least ``share`` (``w0``, ``w1`` by label ``y``) and the next; bins are narrowed, so that no more than ``BINS`` rows come to the driver at a time."""
    counts = [F.count("*").alias("n"), F.sum((F.col("y") == 0).cast("long")).alias("n0"), F.min("u").alias("low"), F.max("u").alias("high")]
    low, high = rows.agg(F.min("u"), F.max("u")).first()
    past0 = past1 = 0
    after = None
    while True:
        part = rows.where(F.col("u").between(low, high))
        whole = part.count() <= BINS
        width = (high - low) / BINS
        name = F.col("u") if whole or not width else F.least(F.floor((F.col("u") - low) / width), F.lit(BINS - 1))
        bins = part.groupBy(name.alias("b")).agg(*counts).orderBy("b").collect()
        for i, r in enumerate(bins):
            total = w0 * (past0 + r["n0"]) + w1 * (past1 + r["n"] - r["n0"])
            if total >= share - 1e-12 or i == len(bins) - 1:
                break
            past0, past1 = past0 + r["n0"], past1 + r["n"] - r["n0"]
        after = bins[i + 1]["low"] if i + 1 < len(bins) else after
        if r["low"] == r["high"]:
            last = w0 if r["n0"] == r["n"] else w1  # of equal utilities the next is the same unless all are needed
            same = r["n"] > 1 and total - last >= share - 1e-12
            return r["low"] if same or after is None else (r["low"] + after) / 2
        low, high = r["low"], r["high"]


def learn(docs: DataFrame, labels: DataFrame) -> PairwiseRanker:
    """Fit on all learnable labels; only sums come to the driver."""
    known, counts = learnable(labels, "quality", 5, 0)
    total = sum(counts.values())
    base = id_text(docs).where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([features(t) for t in b.column("text").to_pylist()], pa.list_(pa.float64()))], ["doc_id", "x"])

    found = map_arrow(base, vectors, f"doc_id {dict(base.dtypes)['doc_id']}, x array<double>").join(known, "doc_id")
    group = F.pmod(F.xxhash64("doc_id", "x"), F.lit(max(1, -(-total // GROUP))))
    sorted_rows = F.sort_array(F.collect_list(F.struct("label", "x")))
    groups = durable(found.groupBy(group.alias("g")).agg(sorted_rows.alias("rows")).select(F.flatten("rows.x").alias("x"), F.col("rows.label").alias("y")), "preferences")
    model = fit(groups, counts.get(0, 0) / total if total else 0.0)
    forget(groups)
    return model


def score_documents(docs: DataFrame, model: PairwiseRanker, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score``, a row per input row; null texts count as empty, other columns are not read."""
    base = id_text(docs, id_col, text_col)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features(t) for t in b.column("text").to_pylist()]).reshape(b.num_rows, FEATURES)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(model.score(x))], ["doc_id", "score"])

    return map_arrow(base, scored, f"doc_id {dict(base.dtypes)['doc_id']}, score double")


def keep_good(docs: DataFrame, labels: DataFrame, learn_from: DataFrame | None = None) -> DataFrame:
    """``docs`` without the rows whose text scores below the cut; all columns pass through."""
    model = learn(docs if learn_from is None else learn_from, labels)
    # the columns travel as one struct, so that no name of theirs can clash
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features(t) for t in b.column("text").to_pylist()]).reshape(b.num_rows, FEATURES)
            yield b.filter(pa.array(model.score(x) >= CUT)).select(["row"])

    return map_arrow(base, kept, base.select("row").schema).select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    """Registered query ``op5_quality``."""
    docs = table(spark, sf_dir, "documents")
    out = score_documents(docs, learn(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
