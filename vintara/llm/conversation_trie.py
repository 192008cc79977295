"""Operator 11: the prefix trie of conversations, from a Cartesian tree over their LCP array.

A conversation is the sequence of its turns; each turn is named by a digest of role and text.
Conversations are sorted by their sequences, over all partitions; each partition is a block. In
the array of common prefixes of neighbours, a node of the trie is a maximal interval whose
values do not fall below its depth: in a block, nearest smaller values to both sides come from
one pass with a stack, equal values falling into one node, and depths at which nothing
branches are expanded afterwards. What touches an end of a block is a part of a node; the part
that it belongs to is the nearest smaller one among the minima of the blocks, two numbers a
block, and parts are added up by Spark. All values of a node are sums or minima over its interval, so
a part holds a few numbers however many conversations share the prefix.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, forget, map_arrow, map_pandas, table
from .minhash import BROADCAST_IDS

#: Hex digits that name a turn; conversation ids of one chunk of a list; rows of an Arrow batch.
NAME, CHUNK, ROWS = 32, 8192, 8192
#: Turns of a head, and of how many ids the smallest lends its head.
HEADS, SPAN = 6, 100
EMPTY = hashlib.sha256(b"").hexdigest()
PARTS = "block long, kind int, depth long, side int, open boolean, conv_id long, parent_conv_id long, parent_side int, n_convs long, n_children long, n_leaves long, saved_tokens long, above long, ends_sha256 string, seq int, ids string, first string, last string, lens array<long>, low long"


def named_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: of each conversation the sorted turns as ``name, size`` (digest, code points of the text).

    Turns go by ``turn``, null first, equal ones by their names. Null roles and texts are empty;
    rows without a ``conv_id`` belong to none. Texts don't leave their task.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    name = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").isNotNull().alias("has"), F.col("turn").alias("turn"), name.alias("name"), F.length(text).cast("long").alias("size")).alias("t"))
    return rows.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list("t")), lambda t: F.struct(t["name"].alias("name"), t["size"].alias("size"))).alias("turns"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: the first h turns of the conversation ``conv_id - conv_id % 100``, then the own turns from the h-th on; h = crc32(conv_id) % 6."""
    turns = named_turns(conversations).withColumns({"base": F.col("conv_id") - F.col("conv_id") % SPAN, "h": (F.crc32(F.col("conv_id").cast("string")) % HEADS).cast("int")})
    turns = durable(turns, "turns")
    heads = turns.where("conv_id = base").select("base", F.slice("turns", 1, HEADS - 1).alias("head"))
    own = F.when(F.size("turns") > F.col("h"), F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(1)))).otherwise(F.slice("turns", 1, 0))
    first = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    return turns.join(heads, "base", "left").select("conv_id", F.concat(first, own).alias("turns"))


def _common(a: str, b: str) -> int:
    """Turns that two conversations begin with alike."""
    lo, hi = 0, min(len(a), len(b)) // NAME
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[: mid * NAME] == b[: mid * NAME]:
            lo = mid
        else:
            hi = mid - 1
    return lo


class _Node:
    """An interval on the stack: ``depth`` is its LCP value, ``start`` its first conversation in the block."""

    __slots__ = ("depth", "start", "n", "low", "leaves", "children", "shared", "ends", "kids", "sizes")

    def __init__(self, depth: int, start: int, sizes: np.ndarray):
        self.depth, self.start, self.sizes = depth, start, sizes
        self.n = self.leaves = self.children = self.shared = 0
        self.low: int | None = None
        self.ends: list[int] = []
        self.kids: list[int] = []

    def take(self, conv: int, at_end: bool) -> None:
        self.n += 1
        self.low = conv if self.low is None else min(self.low, conv)
        if at_end:
            self.ends.append(conv)


class Block:
    """The part of the trie that one sorted block of conversations makes.

    ``rows``: per node and depth ``depth, side, open, conv, parent row, n, children, leaves,
    saved, above``, where side 0 begins at the block's first conversation, 1 behind it, and open ones
    hold the last. ``above`` are the code points of the common text above the node's last turn.
    """

    def __init__(self):
        self.rows: list[tuple] = []
        self.parents: list[int] = []
        self.ends: dict[int, list[int]] = {}
        self.stack: list[_Node] = []
        self.count, self.low = 0, None
        self.first = self.last = None
        self.first_sizes = np.zeros(1, np.int64)

    def add(self, conv: int, key: str, sizes: np.ndarray) -> None:
        """The next conversation; ``sizes`` are the code points of its first 0, 1, 2... turns together."""
        depth, stack = len(sizes) - 1, self.stack
        if self.count == 0:
            self.first, self.first_sizes = key, sizes
            stack.append(_Node(0, 0, sizes))
            lcp = 0
        else:
            lcp = _common(self.last, key)
            self.low = lcp if self.low is None else min(self.low, lcp)
            if lcp < stack[-1].depth:
                stack[-1].leaves += 1  # nothing goes on from the conversation before
            while stack[-1].depth > lcp:
                top = stack.pop()
                if stack[-1].depth < lcp:
                    stack.append(_Node(lcp, top.start, top.sizes))
                self._close(top, stack[-1], False)
            stack[-1].shared += int(sizes[lcp])
        if depth > lcp:
            stack.append(_Node(depth, self.count, sizes))
        stack[-1].take(conv, True)
        self.last, self.count = key, self.count + 1

    def end(self) -> None:
        while self.stack:
            top = self.stack.pop()
            self._close(top, self.stack[-1] if self.stack else None, True)

    def _close(self, node: _Node, parent: _Node | None, still_open: bool) -> None:
        """Rows of the node for every depth below its parent's, then its sums into the parent."""
        side, at = int(node.start > 0), len(self.rows)
        for d in range(parent.depth + 1 if parent else 0, node.depth + 1):
            above = int(node.sizes[d - 1]) if d else 0
            self.rows.append((d, side, still_open, node.low, node.n, node.children if d == node.depth else 1, node.leaves, node.shared - (node.n - 1) * above, above))
            self.parents.append(len(self.rows) - 2)
        self.parents[at] = -1
        last = len(self.rows) - 1
        for kid in node.kids:
            self.parents[kid] = last
        if node.ends:
            self.ends[last] = node.ends
        if parent:
            parent.kids.append(at)
            parent.n += node.n
            parent.low = node.low if parent.low is None else min(parent.low, node.low)
            parent.leaves += node.leaves
            parent.shared += node.shared
            parent.children += 1


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parts of a partition: kind 0 whole nodes, 1 parts at an end of the block, 2 chunks of the conversations that end in such a part, 3 the block itself."""
    from pyspark import TaskContext

    number, block = TaskContext.get().partitionId(), Block()
    for batch in batches:
        for conv, key, sizes in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "key", "sizes")]):
            block.add(conv, key, np.cumsum([0, *sizes]))
    if not block.count:
        return
    block.end()
    schema = pa.schema([(n, {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}[k]) for n, k in (x.split() for x in PARTS.split(", "))])
    edge = [r[1] == 0 or r[2] for r in block.rows]

    def rows() -> Iterator[dict]:
        for i, (depth, side, still_open, conv, n, children, leaves, saved, above) in enumerate(block.rows):
            p, ends = block.parents[i], block.ends.get(i, [])
            row = {"block": number, "kind": int(edge[i]), "depth": depth, "side": side, "open": still_open, "conv_id": conv, "n_convs": n, "n_children": children, "n_leaves": leaves, "saved_tokens": saved, "above": above}
            if p >= 0:
                row |= {"parent_side": block.rows[p][1]} if edge[p] else {"parent_conv_id": block.rows[p][3]}
            if not edge[i]:
                row["ends_sha256"] = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest() if ends else EMPTY
            yield row
            for seq in range(0, len(ends) if edge[i] else 0, CHUNK):
                yield {"block": number, "kind": 2, "depth": depth, "side": side, "seq": seq // CHUNK, "ids": ",".join(map(str, ends[seq : seq + CHUNK]))}
        yield {"block": number, "kind": 3, "first": block.first, "last": block.last, "lens": block.first_sizes.tolist(), "low": block.low}

    some: list[dict] = []
    for row in rows():
        some.append(row)
        if len(some) == ROWS:
            yield pa.RecordBatch.from_pylist(some, schema)
            some = []
    if some:
        yield pa.RecordBatch.from_pylist(some, schema)


def _borders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What each block has in common with the one before."""
    for df in batches:
        lcp = [-1 if before is None else _common(before, first) for before, first in zip(df["before"], df["first"])]
        yield pd.DataFrame({"block": df["block"], "lcp": lcp, "shared": [0 if l < 0 else int(s[l]) for l, s in zip(lcp, df["lens"])], "size": [len(s) - 1 for s in df["lens"]], "last_size": df["last"].str.len() // NAME, "low": df["low"]})


class Minima:
    """Minima of the blocks and of the borders between them, for nearest smaller values to the left."""

    def __init__(self, borders: pd.DataFrame):
        b = borders.sort_values("block")
        self.at = {int(x): i for i, x in enumerate(b["block"])}
        self.lcp, self.shared, self.size, self.last_size = (b[c].astype("int64").tolist() for c in ("lcp", "shared", "size", "last_size"))
        self.low = [1 << 60 if pd.isna(x) else int(x) for x in b["low"]]
        # one array: the border before a block, the block, the next border...; over it the minima of runs of 1, 2, 4...
        self.tables = [np.ravel(np.column_stack([self.lcp, self.low])).astype(np.int64)]
        while len(self.tables[-1]) > 1 << len(self.tables) - 1:
            t, step = self.tables[-1], 1 << len(self.tables) - 1
            self.tables.append(np.minimum(t[:-step], t[step:]))

    def owner(self, block: int, side: int, depth: int) -> int:
        """Where the node of this part begins: ``2 i`` at the first conversation of the i-th block, ``2 i + 1`` within it."""
        i = 2 * self.at[block] + side
        # the nearest entry at or before i that is less than the depth, by halving runs
        for level in range(len(self.tables) - 1, -1, -1):
            t, width = self.tables[level], 1 << level
            if i - width + 1 >= 0 and t[i - width + 1] >= depth:
                i -= width
        return max(i, 0)


def _owned(minima: Minima):
    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            out = []
            for r in df.itertuples(index=False):
                i = minima.at[r.block]
                children, leaves, saved = r.n_children, r.n_leaves, r.saved_tokens
                if r.side == 0 and minima.lcp[i] >= r.depth:  # goes on from the block before
                    saved += minima.shared[i] - r.above
                    if minima.size[i] > r.depth and minima.lcp[i] > r.depth:
                        children -= 1  # and so does its first child
                if r.open and (i + 1 == len(minima.lcp) or minima.lcp[i + 1] < minima.last_size[i]):
                    leaves += 1
                out.append((minima.owner(r.block, r.side, r.depth), r.block, r.side, r.depth, r.parent_side, r.conv_id, r.n_convs, children, leaves, saved))
            yield pd.DataFrame(out, columns=["owner", "block", "side", "depth", "parent_side", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"])

    return fn


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for each run of rows of one owner and depth; the lists pass by as a stream."""
    done, at, h = [], None, None
    for batch in batches:
        for owner, depth, ids in zip(*[batch.column(c).to_pylist() for c in ("owner", "depth", "ids")]):
            if (owner, depth) == at:
                h.update(b"," + ids.encode())
            else:
                if at:
                    done.append((*at, h.hexdigest()))
                at, h = (owner, depth), hashlib.sha256(ids.encode())
    if at:
        done.append((*at, h.hexdigest()))
    cols = list(zip(*done)) or [()] * 3
    yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())], ["owner", "depth", "ends_sha256"])


def trie(sequences: DataFrame) -> DataFrame:
    """The trie of ``sequences`` (``conv_id`` long and distinct, ``turns`` array of ``name, size``), a row per node.

    Columns ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256``. An empty table has no node, not even the root. One sequence must fit a task;
    a block's rows are held in one, so blocks are as small as the session's shuffle partitions.
    The digest of the ids that end in a node is one hash over them in order, so one task reads
    them through, in chunks, without holding them.
    """
    keyed = durable(sequences.select("conv_id", F.array_join(F.transform("turns", lambda t: t["name"]), "").alias("key"), F.transform("turns", lambda t: t["size"]).alias("sizes")), "sequences")
    parts = durable(map_arrow(keyed.orderBy("key", "conv_id"), _blocks, PARTS, rows=4096), "trie-parts")
    one = Window.orderBy("block")  # a row per block
    ends = parts.where("kind = 3").select("block", "first", "last", "lens", "low").withColumn("before", F.lag("last").over(one))
    minima = Minima(map_pandas(ends, _borders, "block long, lcp long, shared long, size long, last_size long, low long").toPandas())

    edge = durable(map_pandas(parts.where("kind = 1").select("block", "side", "depth", "open", F.coalesce("parent_side", F.lit(-1)).alias("parent_side"), "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "above"), _owned(minima), "owner long, block long, side int, depth long, parent_side int, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"), "trie-edges")
    total = durable(edge.groupBy("owner", "depth").agg(F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")], F.min(F.struct("block", "side", "parent_side")).alias("p")), "trie-totals")
    # which node a part at an end of a block belongs to, for its children
    of = durable(edge.select("owner", "depth", "block", "side").join(total.select("owner", "depth", F.col("conv_id").alias("up")), ["owner", "depth"]).select(F.col("block").alias("ub"), F.col("side").alias("us"), F.col("depth").alias("ud"), "up"), "trie-owners")
    known = F.broadcast(of) if of.count() <= BROADCAST_IDS else of

    whole = parts.where("kind = 0").join(known, (F.col("block") == F.col("ub")) & (F.col("parent_side") == F.col("us")) & (F.col("depth") - 1 == F.col("ud")), "left")
    whole = whole.select("conv_id", "depth", F.coalesce("parent_conv_id", "up").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")

    chunks = parts.where("kind = 2").join(edge.select(F.col("block").alias("eb"), F.col("side").alias("es"), F.col("depth").alias("ed"), "owner"), (F.col("block") == F.col("eb")) & (F.col("side") == F.col("es")) & (F.col("depth") == F.col("ed"))).select("owner", "depth", "block", "seq", "ids")
    hashed = map_arrow(chunks.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "block", "seq"), _digested, "owner long, depth long, ends_sha256 string")
    split = total.join(known, (F.col("p.block") == F.col("ub")) & (F.col("p.parent_side") == F.col("us")) & (F.col("depth") - 1 == F.col("ud")), "left").join(hashed, ["owner", "depth"], "left")
    split = split.select("conv_id", "depth", F.col("up").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))
    out = durable(whole.union(split), "trie")
    for used in (keyed, parts, edge, total, of):
        forget(used)
    return out


def query(spark, sf_dir: str) -> DataFrame:
    """Registered query ``op11_conversation_trie``: the trie of all rebuilt ``conversations``."""
    return trie(rebuilt(table(spark, sf_dir, "conversations")))


#: CRC-32 of the digits of an id, bit by bit.
CRC32 = "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split_regex(conv_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)), lambda c, b: list_reduce([xor(c, b), 1, 2, 3, 4, 5, 6, 7, 8], lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)), 4294967295)"

SQL = f"""
WITH t AS (SELECT conv_id, md5(concat(length(coalesce(role, ''))::VARCHAR, ':', coalesce(role, ''), coalesce(text, ''))) AS name, length(coalesce(text, ''))::BIGINT AS size, turn FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list({{'name': name, 'size': size}} ORDER BY turn NULLS FIRST, name) AS turns, ({CRC32} % 6)::BIGINT AS h FROM t GROUP BY conv_id),
r AS (SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns FROM c LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % 100),
m AS (SELECT conv_id, d, list_transform(turns[1:d], lambda x: x.name) AS prefix, coalesce(turns[d].size, 0) AS size, len(turns) AS len FROM r, unnest(range(0, len(turns) + 1)) u(d)),
n AS (SELECT d, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, max(size) AS size, coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len = d), '') AS ends FROM m GROUP BY d, prefix),
k AS (SELECT n.*, (SELECT count(*) FROM n x WHERE x.d = n.d + 1 AND x.prefix[1:n.d] = n.prefix) AS n_children FROM n),
s AS (SELECT a.d, a.prefix, sum((k.n_convs - 1) * k.size)::BIGINT AS saved_tokens, count(*) FILTER (WHERE k.n_children = 0) AS n_leaves FROM k, unnest(range(0, k.d + 1)) u(d), n a WHERE a.d = u.d AND a.prefix = k.prefix[1:u.d] GROUP BY 1, 2)
SELECT k.conv_id, k.d AS depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children, s.n_leaves, s.saved_tokens, sha256(k.ends) AS ends_sha256
FROM k JOIN s USING (d, prefix) LEFT JOIN n p ON p.d = k.d - 1 AND p.prefix = k.prefix[1:k.d - 1]
"""
