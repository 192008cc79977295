"""Operator 9 [native]: weighted SimHash fingerprints and Hamming search by permuted block tables.

DataFrame expressions only. Terms are runs of two words; a term's weight is its length in
bytes, at most 15, so that runs of short function words count less. Each bit of a term's
XXH64 votes with that weight.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_words, durable, id_text, shingle_structs, table
from .simhash import LANES, fingerprint, likeness, to_hex, votes

#: Rows of a bucket of neighbouring ids, and the most buckets (beyond it they grow; the sort spills).
BUCKET_ROWS, MOST_BUCKETS = 1024, 16384
_FAN = 128


def weighted_terms(df: DataFrame, text, keep: list[str]) -> DataFrame:
    """``keep`` columns with a row per term: ``h`` (null for a text without words) and ``w``."""
    terms = df.select(*keep, F.explode_outer(shingle_structs(ascii_words(text), 2)).alias("s"))
    some = F.col("s").isNotNull()
    size = F.coalesce(F.octet_length("s.w1"), F.lit(0)) + F.coalesce(F.octet_length("s.w2"), F.lit(0))
    return terms.select(*keep, F.when(some, F.xxhash64("s.w1", "s.w2")).alias("h"), F.least(size, F.lit(15)).alias("w"))


def text_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` (long), a row per input row; a text without words has fingerprint 0."""
    base = id_text(docs, id_col, text_col).withColumn("rid", F.monotonically_increasing_id())
    return votes(weighted_terms(base, F.col("text"), ["rid", "doc_id"]), ["rid", "doc_id"], "h", "w").select("doc_id", fingerprint().alias("fp"))


def block_masks(radius: int, blocks: int) -> list[int]:
    """Masks (as signed longs) of the tables: a choice of ``blocks - radius`` of the blocks that 64 bits are cut into, each."""
    if not 0 <= radius < blocks <= 16:
        raise ValueError("0 <= radius < blocks <= 16 is needed")
    edge = [round(64 * i / blocks) for i in range(blocks + 1)]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    return [signed(sum(((1 << edge[i + 1]) - (1 << edge[i])) for i in kept)) for kept in combinations(range(blocks), blocks - radius)]


def _keyed(prints: DataFrame, masks: list[int]) -> DataFrame:
    """``prints`` (with ``fp``) once per table: ``t`` its number, ``k`` the fingerprint's bits in it."""
    return prints.select("*", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("t", "k"))


def _meet(a, b, t, masks: list[int], radius: int):
    """Whether two fingerprints of one bucket of table ``t`` are within ``radius``, and ``t`` is the first table that they meet in."""
    x = a.bitwiseXOR(b)
    first = F.lit(None)
    for i in reversed(range(len(masks))):
        first = F.when(x.bitwiseAND(F.lit(masks[i])) == 0, F.lit(i)).otherwise(first)
    return (F.bit_count(x) <= radius) & (first == t)


def within_radius(fps: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """``a, b, distance``: all pairs ``a < b`` of distinct fingerprints (longs) at most ``radius`` bits apart.

    The 64 bits are cut into ``blocks``; two fingerprints within the radius agree on at least
    ``blocks - radius`` whole blocks, so a table per choice of that many blocks, keyed by
    their bits, holds every such pair in one bucket. ``fps`` has a column ``fp``; nulls and
    repeats are ignored, so a group of exact copies is one fingerprint here. The result grows
    with the number of near pairs; to group near copies use ``near_simhash``, which emits a
    spanning forest instead, and for a set of queries ``near_search``.
    """
    masks = block_masks(radius, blocks)
    one = fps.select("fp").where("fp is not null").distinct()
    a, b = _keyed(one, masks).withColumnRenamed("fp", "a"), _keyed(one, masks).withColumnRenamed("fp", "b")
    on = (a["t"] == b["t"]) & (a["k"] == b["k"]) & (F.col("a") < F.col("b")) & _meet(F.col("a"), F.col("b"), a["t"], masks, radius)
    return a.join(b, on).select("a", "b", F.bit_count(F.col("a").bitwiseXOR(F.col("b"))).cast("int").alias("distance"))


def near_search(prints: DataFrame, queries: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """``fp, near_rows, least_id``: for each distinct fingerprint of ``queries`` the rows of ``prints`` within ``radius`` bits of it, its own among them, and their smallest id.

    ``prints`` has ``doc_id, fp``, a row per document; equal fingerprints are counted into
    one before anything meets. All tables of all fingerprints are searched (``within_radius``
    says why that finds every one); no pair leaves the join but into the sums. Null ids are
    counted but name nothing.
    """
    masks = block_masks(radius, blocks)
    each = prints.groupBy("fp").agg(F.count("*").alias("n"), F.min("doc_id").alias("low"))
    a, b = _keyed(queries.select("fp").distinct(), masks).withColumnRenamed("fp", "q"), _keyed(each, masks)
    on = (a["t"] == b["t"]) & (a["k"] == b["k"]) & _meet(F.col("q"), F.col("fp"), a["t"], masks, radius)
    return a.join(b, on).groupBy("q").agg(F.sum("n").alias("near_rows"), F.min("low").alias("least_id")).withColumnRenamed("q", "fp")


def _bucket(key, bounds: list[int]):
    """Number of bounds below ``key``, by a search in two levels of literals."""
    rows = [bounds[i : i + _FAN] for i in range(0, len(bounds), _FAN)]
    lits = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    if len(rows) == 1:
        return F.size(F.filter(lits(bounds), lambda b: b < key))
    coarse = F.size(F.filter(lits([r[-1] for r in rows[:-1]]), lambda b: b < key))
    return coarse * _FAN + F.size(F.filter(F.element_at(F.array(*[lits(r) for r in rows]), coarse + 1), lambda b: b < key))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``bucket, rn, ghost, doc_id, text, next_text``: each row beside the next by descending id, the last beside the first.

    Rows are dealt into buckets of neighbouring ids, and the top row of a bucket also goes, as
    a ghost, to the end of the bucket above it (the very top one to the lowest bucket), so one
    exchange of the texts gives every row its neighbour. Ids are integers; a null id counts as
    the lowest; rows of one id are ordered by text. Ghosts stay, flagged.
    """
    lowest = -(1 << 63)
    base = id_text(docs, id_col, text_col).withColumn("key", F.coalesce(F.col("doc_id").cast("long"), F.lit(lowest)))
    n = base.agg(F.count("*").alias("n"), F.max("key").alias("top")).first()
    if n["n"] == 0:
        bounds = [0]
    else:
        k = min(MOST_BUCKETS, -(-n["n"] // BUCKET_ROWS))
        got = base.agg(F.percentile_approx("key", F.array(*[F.lit((i + 1) / k) for i in range(k)]), F.lit(max(10000, 20 * k))).alias("q")).first()["q"]
        bounds = sorted({*got, n["top"]})
    own = _bucket(F.col("key"), bounds)
    placed = base.withColumn("own", own)
    edge = F.array_contains(F.array(*[F.lit(b).cast("long") for b in bounds]), F.col("key"))
    spots = F.when(edge, F.array(F.struct(F.col("own").alias("bucket"), F.lit(False).alias("ghost")), F.struct(((F.col("own") + 1) % len(bounds)).alias("bucket"), F.lit(True).alias("ghost")))).otherwise(F.array(F.struct(F.col("own").alias("bucket"), F.lit(False).alias("ghost"))))
    dealt = placed.select("doc_id", "key", "text", F.inline(spots).alias("bucket", "ghost"))
    by = Window.partitionBy("bucket").orderBy("ghost", F.desc("key"), "text")
    return dealt.select("bucket", "ghost", "doc_id", "text", F.row_number().over(by).alias("rn"), F.lead("text").over(by).alias("next_text"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints (longs ``fp``, ``efp``; ``nfp`` is the next document's) of every text and of its edited text, a row per input row.

    The edited text has its last ``floor(n_chars / 3)`` code points replaced by the first as
    many of the next document. Columns: ``doc_id, n_chars, edited_sha256, fp, efp, nfp``. Null
    texts count as empty; a table of one row has itself as next. Other columns of ``docs`` are
    not read.
    """
    pairs = with_next(docs, id_col, text_col)
    cut = F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 3) as int))"), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), cut))
    # the digest travels as five longs, so that the vote sums stay in a hash aggregate
    digest = [F.conv(F.substring("sha", 13 * i + 1, 13), 16, 10).cast("long").alias(f"d{i}") for i in range(5)]
    meta = ["bucket", "rn", "ghost", "doc_id", "n_chars", *[f"d{i}" for i in range(5)]]
    texts = (
        pairs.withColumn("edited", F.when(~F.col("ghost"), edited))
        .withColumn("sha", F.sha2("edited", 256))
        .select("bucket", "rn", "ghost", "doc_id", F.length("text").cast("long").alias("n_chars"), *digest, F.posexplode(F.array("text", "edited")).alias("kind", "t"))
        .where("t is not null")
    )
    terms = weighted_terms(texts, F.col("t"), [*meta, "kind"])
    h, w = F.coalesce("h", F.lit(0)), F.when(F.col("h").isNull(), F.lit(0)).otherwise(F.col("w")).cast("long")
    sums = [F.sum(F.shiftrightunsigned(h, j).bitwiseAND(F.lit(LANES)) * w).alias(f"s{j}") for j in range(32)]
    voted = terms.groupBy("bucket", "rn", "kind").agg(F.sum(w).alias("total"), F.max("doc_id").alias("doc_id"), F.max("ghost").alias("ghost"), F.max("n_chars").alias("n_chars"), *[F.max(f"d{i}").alias(f"d{i}") for i in range(5)], *sums)
    prints = voted.select("bucket", "rn", "kind", "doc_id", "ghost", "n_chars", *[f"d{i}" for i in range(5)], fingerprint().alias("fp"))
    sha = F.concat(*[F.lpad(F.lower(F.conv(F.col(f"d{i}").cast("string"), 10, 16)), 13 if i < 4 else 12, "0") for i in range(5)])
    both = prints.groupBy("bucket", "rn").agg(
        F.max("doc_id").alias("doc_id"), F.max("ghost").alias("ghost"), F.max("n_chars").alias("n_chars"), *[F.max(f"d{i}").alias(f"d{i}") for i in range(5)],
        F.max(F.when(F.col("kind") == 0, F.col("fp"))).alias("fp"), F.max(F.when(F.col("kind") == 1, F.col("fp"))).alias("efp"),
    )
    following = both.withColumn("nfp", F.lead("fp").over(Window.partitionBy("bucket").orderBy("rn"))).where(~F.col("ghost"))
    return following.select("doc_id", "n_chars", sha.alias("edited_sha256"), "fp", "efp", "nfp")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 20, radius: int = 3) -> DataFrame:
    """``edited_fingerprints`` in hex with likenesses, and what a search by the block tables finds.

    Searched for is each row whose id is divisible by ``every``: ``near_docs`` is the number
    of other rows whose fingerprint is within ``radius`` bits, ``near_least`` the smallest id
    among these and itself. Both are null for all other rows, null ids included. A row per
    input row; an empty table gives an empty table.
    """
    rows = durable(edited_fingerprints(docs, id_col, text_col), "prints")
    asked = F.coalesce(F.col("doc_id") % every == 0, F.lit(False))
    found = near_search(rows.select("doc_id", "fp"), rows.where(asked), radius)
    searched = rows.where(asked).join(found, "fp").select(*rows.columns, (F.col("near_rows") - 1).alias("near_docs"), F.col("least_id").alias("near_least"))
    others = rows.where(~asked).select("*", F.lit(None).cast("long").alias("near_docs"), F.lit(None).cast(dict(rows.dtypes)["doc_id"]).alias("near_least"))
    return searched.union(others).select(
        "doc_id", "n_chars", "edited_sha256", to_hex(F.col("fp")).alias("fingerprint"), to_hex(F.col("efp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("efp")).alias("near_edited"), likeness(F.col("fp"), F.col("nfp")).alias("near_next"), "near_docs", "near_least",
    )


def query(spark, sf_dir: str) -> DataFrame:
    """Registered query ``op9_document_fingerprints``."""
    return report(table(spark, sf_dir, "documents"))
