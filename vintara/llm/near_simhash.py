"""Operator 1: SimHash near-duplicates through vantage-point trees.

Fingerprints are built by DataFrame expressions (``simhash.py``). Distinct fingerprints are
then linked: the 64 bits are cut into ``trees`` blocks, so that two fingerprints within
``radius`` bits are within ``radius // trees`` bits on one block at least. Each block has a
vantage-point tree whose top levels deal fingerprints out to shards: a fingerprint has one
home shard, and also visits each other shard that its ball may reach by the triangle bound
``|d(x, v) - d(y, v)| <= d(x, y)``. In a shard, homes meet visitors by exact 64-bit distance.
A shard returns a spanning forest of what it links, never all pairs, and distributed
union-find joins the forests.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_words, durable, forget, id_text, lower_ascii, map_pandas, shingle_structs, table
from .components import connected_components
from .minhash import similar_links, sketched, verified
from .simhash import fingerprint, to_hex, votes

#: Sampled fingerprints that shape a tree, at least and per leaf, and the most levels of a tree. They set speed and balance only, never the result.
SAMPLE, PER_LEAF, DEPTH = 8192, 4, 17


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``doc_id, fp``: a row per input row.

    A-Z are lower-cased; words lie between ASCII white space; each shingle, repeats
    included, votes with its XXH64 (seed 42). Fewer words than ``shingle``: the whole
    sequence is the one shingle. Null, empty and blank texts have fingerprint 0.
    """
    base = id_text(docs, id_col, text_col).select(F.monotonically_increasing_id().alias("rid"), "doc_id", ascii_words(lower_ascii(F.col("text"))).alias("w"))
    terms = base.select("rid", "doc_id", F.explode_outer(shingle_structs(F.col("w"), shingle)).alias("s"))
    hashed = terms.select("rid", "doc_id", F.when(F.col("s").isNotNull(), F.xxhash64(F.concat_ws(" ", *[f"s.w{i + 1}" for i in range(shingle)]))).alias("h"))
    return votes(hashed, ["rid", "doc_id"], "h").select("doc_id", fingerprint().alias("fp"))


class VantageTree:
    """Balanced vantage-point tree over the bits in ``mask``, as flat arrays in heap order."""

    def __init__(self, sample: np.ndarray, mask: int, depth: int, seed: int = 7):
        self.mask, self.depth = np.uint64(mask), depth
        self.vantage = np.zeros((1 << depth) - 1 or 1, np.uint64)
        self.radius = np.zeros_like(self.vantage, dtype=np.int64)
        rng = np.random.default_rng(seed)
        members = {0: sample}
        for node in range((1 << depth) - 1):
            x = members.pop(node)
            pool = x if len(x) else sample
            if len(pool) == 0:
                pool = np.zeros(1, np.uint64)
            best = None
            for v in pool[rng.integers(0, len(pool), 6)]:
                d = self.distance(x, v) if len(x) else np.zeros(1, np.int64)
                mu = int(np.median(d))
                off = abs(float((d <= mu).mean()) - 0.5)
                if best is None or off < best[0]:
                    best = (off, v, mu, d)
            _, self.vantage[node], self.radius[node], d = best
            inside = d <= self.radius[node]
            members[2 * node + 1] = x[inside] if len(x) else x
            members[2 * node + 2] = x[~inside] if len(x) else x

    def distance(self, x: np.ndarray, v) -> np.ndarray:
        return np.bitwise_count((x ^ v) & self.mask).astype(np.int64)

    def home(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each fingerprint."""
        node = np.zeros(len(x), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (self.distance(x, self.vantage[node]) > self.radius[node])
        return node - ((1 << self.depth) - 1)

    def visits(self, x: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """``(index, leaf)`` of every leaf that the ball of radius ``reach`` around a fingerprint may touch."""
        at, node = np.arange(len(x)), np.zeros(len(x), np.int64)
        for _ in range(self.depth):
            d, mu = self.distance(x[at], self.vantage[node]), self.radius[node]
            near, far = d - reach <= mu, d + reach > mu
            at, node = np.concatenate([at[near], at[far]]), np.concatenate([2 * node[near] + 1, 2 * node[far] + 2])
        return at, node - ((1 << self.depth) - 1)


def block_masks(trees: int) -> list[int]:
    """Disjoint bit masks that cover all 64 bits."""
    edge = [round(64 * i / trees) for i in range(trees + 1)]
    return [((1 << edge[i + 1]) - 1) ^ ((1 << edge[i]) - 1) for i in range(trees)]


class Forest:
    """Union-find over fingerprints; ``join`` is true for edges of a spanning forest."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        r = x
        while (p := up.get(r, r)) != r:
            r = p
        while (p := up.get(x, x)) != r:
            up[x], x = r, p
        return r

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def link_shard(homes: np.ndarray, visitors: np.ndarray, radius: int, forest: Forest, block: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Spanning edges among home-visitor pairs within ``radius`` bits, by blocks of bounded size."""
    step = max(1, block // max(1, len(homes)))
    for i in range(0, len(visitors), step):
        part = visitors[i : i + step]
        a, b = np.nonzero(np.bitwise_count(part[:, None] ^ homes[None, :]) <= radius)
        for x, y in zip(part[a].view(np.int64).tolist(), homes[b].view(np.int64).tolist()):
            if x != y and forest.join(x, y):
                yield x, y


def link_fingerprints(fps: DataFrame, radius: int = 3, trees: int = 2, shard: int = 4096) -> DataFrame:
    """``a, b``: edges between distinct fingerprints whose components equal those of all pairs within ``radius``.

    ``fps`` has one distinct non-null ``fp`` per row. ``shard`` is the number of home
    fingerprints a shard aims at and the most it holds: a fuller leaf is split into salted
    parts, each of which gets that leaf's visitors. Visitors are streamed.
    """
    spark = fps.sparkSession
    n = fps.count()
    depth = min(DEPTH, max(0, int(np.ceil(np.log2(max(1, n / shard))))))
    sample = np.array([r[0] for r in fps.orderBy(F.xxhash64("fp"), "fp").limit(max(SAMPLE, PER_LEAF << depth)).collect()], np.int64).view(np.uint64)
    grown = [VantageTree(sample, m, depth) for m in block_masks(trees)]
    reach = radius // trees

    def homes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = pdf["fp"].to_numpy(np.int64).view(np.uint64)
            yield pd.DataFrame({"leaf": np.concatenate([t.home(x) + (k << depth) for k, t in enumerate(grown)])})

    sizes = {r["leaf"]: r["n"] for r in map_pandas(fps, homes, "leaf long").groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    parts = np.ones(trees << depth, np.int64)
    for leaf, k in sizes.items():
        parts[leaf] = -(-k // shard)
    first = np.concatenate([[0], np.cumsum(parts)[:-1]])

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = pdf["fp"].to_numpy(np.int64).view(np.uint64)
            salt = (x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
            for k, t in enumerate(grown):
                own = t.home(x) + (k << depth)
                yield pd.DataFrame({"shard": first[own] + (salt % parts[own].astype(np.uint64)).astype(np.int64), "visits": False, "fp": x.view(np.int64)})
                at, leaf = t.visits(x, reach)
                leaf = leaf + (k << depth)
                keep = leaf >= own[at]  # a pair meets in the later of its two home leaves
                at, leaf = at[keep], leaf[keep]
                times = parts[leaf]
                at, leaf = np.repeat(at, times), np.repeat(leaf, times)
                part = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
                yield pd.DataFrame({"shard": first[leaf] + part, "visits": True, "fp": x[at].view(np.int64)})

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, own, forest = None, [], Forest()
        for pdf in batches:
            s, vis, x = pdf["shard"].to_numpy(), pdf["visits"].to_numpy(bool), pdf["fp"].to_numpy(np.int64).view(np.uint64)
            cut = np.flatnonzero((s[1:] != s[:-1]) | (vis[1:] != vis[:-1])) + 1
            for i, j in zip([0, *cut.tolist()], [*cut.tolist(), len(s)]):
                if i == j:
                    continue
                if s[i] != now:
                    now, own, forest = s[i], [], Forest()
                if not vis[i]:
                    own.append(x[i:j])
                elif own:
                    own = [np.concatenate(own)]
                    edges = list(link_shard(own[0], x[i:j], radius, forest))
                    if edges:
                        yield pd.DataFrame(np.array(edges, np.int64), columns=["a", "b"])

    tasks = int(max(1, min(int(parts.sum()), max(int(spark.conf.get("spark.sql.shuffle.partitions")), parts.sum() // 8))))
    dealt = map_pandas(fps, deal, "shard long, visits boolean, fp long").repartition(tasks, "shard").sortWithinPartitions("shard", "visits")
    return map_pandas(dealt, meet, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 3, trees: int = 2, shingle: int = 3) -> DataFrame:
    """``doc_id, fingerprint, component_id``, a row per input row, however often a row repeats.

    Fingerprints within ``radius`` bits are linked; ``component_id`` is the smallest document
    id reachable (null ids are ignored for it, and a component of null ids alone has null).
    Empty and null texts share fingerprint 0 and are linked like any other. Other columns of
    ``docs`` are not read. An empty table gives an empty table.
    """
    rows = durable(fingerprints(docs, id_col, text_col, shingle), "simhash")
    each = durable(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fps")
    label = connected_components(link_fingerprints(each.select("fp"), radius, trees))
    rooted = each.join(label.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("component", "fp").alias("root"), "least")
    low = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(low, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", to_hex(F.col("fp")).alias("fingerprint"), "component_id")


def word_runs(text, k: int = 5):
    """The set that two texts are compared on, as 64-bit hashes: runs of ``k`` words, or the whole sequence where there are fewer; of a text without words, zero."""
    # the outer transforms name the words and the runs, which are made once, not once a use
    made = lambda words: F.array_distinct(F.transform(shingle_structs(words, k), lambda s: F.xxhash64(*[s[f"w{i + 1}"] for i in range(k)])))
    runs = F.transform(F.array(ascii_words(lower_ascii(text))), made)
    return F.get(F.transform(runs, lambda a: F.when(F.size(a) == 0, F.array(F.lit(0).cast("long"))).otherwise(a)), F.lit(0))


def similar_texts(texts: DataFrame, shingle: int = 5, radius: int = 3, trees: int = 2) -> DataFrame:
    """``a, b``: verified links between texts whose sets of ``shingle``-word shingles have a Jaccard similarity of at least 0.8.

    ``texts`` is a written table with distinct long ids ``id``, distinct texts ``text``, and their
    sketches (``minhash.sketched`` by ``word_runs``). SimHash fingerprints of the shingles meet in
    the vantage-point trees; as texts at 0.8 lie about ten bits apart, beyond what 64 bits can
    tell from chance, pairs outside ``radius`` are added by MinHash sketches of the same
    shingles (``minhash.py``). Both are verified exactly.
    """
    members = word_runs(F.col("text"), shingle)
    prints = durable(fingerprints(texts.select("id", "text"), "id", "text", shingle).select(F.col("doc_id").alias("id"), "fp"), "simhash")
    least = durable(prints.groupBy("fp").agg(F.min("id").alias("a")), "fps")
    same = prints.join(least, "fp").where("id <> a").select("a", F.col("id").alias("b"))
    edges = link_fingerprints(least.select("fp"), radius, trees).toDF("fa", "fb")
    across = edges.join(least.select(F.col("fp").alias("fa"), "a"), "fa").join(least.select(F.col("fp").alias("fb"), F.col("a").alias("b")), "fb").select("a", "b")
    close = verified(texts, members, same.union(across))
    for used in (prints, least):
        forget(used)
    return close.union(similar_links(texts, members))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: that of the smallest id.

    Texts are linked at a Jaccard similarity of at least 0.8 of their sets of shingles of
    ``shingle`` words (words and short texts as in ``fingerprints``; texts without words are
    alike), see ``similar_texts``. Rows with a null id have no name to be kept by and stay; of
    rows that repeat the kept id, all of the group stay. A row is judged by its own text,
    whatever other rows have its id. All columns pass through.
    """
    name = lambda text: F.unhex(F.md5(text))
    base = id_text(docs, id_col, text_col)
    each = base.select("text").distinct().select(F.monotonically_increasing_id().alias("id"), "text", name(F.col("text")).alias("k"))
    texts = durable(sketched(each, word_runs(F.col("text"), shingle)), "texts")
    label = connected_components(similar_texts(texts, shingle))
    rooted = texts.select("id", "k").join(label.withColumnRenamed("node", "id"), "id", "left").select("k", F.coalesce("component", "id").alias("root"))
    rows = base.select("doc_id", name(F.col("text")).alias("k")).join(rooted, "k").select("doc_id", "k", "root")
    least = rows.groupBy("root").agg(F.min("doc_id").alias("least"))
    found = rows.join(least, "root").where("doc_id <> least").select(F.col("doc_id").alias("__dropped"), F.col("k").alias("__text")).distinct()
    same = name(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))) == F.col("__text")
    return docs.join(found, (F.col(f"`{id_col}`") == F.col("__dropped")) & same, "left_anti")


def query(spark, sf_dir: str) -> DataFrame:
    """Registered query ``op1_simhash_near_dedup``."""
    return near_duplicates(table(spark, sf_dir, "documents"))
