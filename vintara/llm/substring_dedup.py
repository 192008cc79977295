"""Operator 13: repeated passages by relative Lempel-Ziv parsing.

A window is ``WINDOW`` consecutive words of one document; it is a repeat if the same words also
start earlier, in a document of a smaller id or earlier in the same one. Every word that a
repeat covers goes.

Windows meet by anchors: the word run of ``GRAM`` words of a window with the smallest hash is
the same in every copy of the window, so consecutive windows with one anchor form a passage (at
most 34 words), and passages can share a window only under one anchor. Anchors are counted over
all texts; what has an anchor of its own is no repeat. Copies of one passage collapse to their
first place by an aggregate with map-side combine; the others are repeats whole. What is left,
different passages under one anchor, is dealt out by anchor into reference blocks. Each block
is indexed (its suffixes ranked by prefix doubling, to the length of a window), and each passage
is factored greedily against what stands earlier in the block: a factor of at least ``WINDOW``
words is a repeated span, and the windows across its end are looked up one by one. Anchors with
very many different passages are cut into single windows, which meet by an aggregate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, forget, map_arrow, table
from .minhash import BROADCAST_IDS
from .words import Memo

WINDOW, GRAM = 20, 6
#: Positions of a window at which an anchor may start.
REACH = WINDOW - GRAM + 1
#: Most different passages of an anchor that are parsed in one reference block, and words of a block (a block holds whole anchors).
FULL, BLOCK_WORDS = 256, 1 << 18
_B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _C
    return h ^ (h >> np.uint64(29))


def _grams(ids: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of ``k`` words."""
    h = np.zeros(max(0, len(ids) - k + 1), np.uint64)
    for j in range(k):
        h = h * _B + ids[j : len(ids) - k + 1 + j]
    return _mixed(h)


def _word_ids(memo: Memo, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts as 64-bit hashes, one after another, and where each text ends."""
    split = [t.split() for t in texts]  # bytes split at exactly the six ASCII blanks
    words = [w for s in split for w in s]
    memo.learn(words)
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words)), np.cumsum([len(s) for s in split], dtype=np.int64)


def _memo() -> Memo:
    return Memo(lambda words: [xxhash.xxh64_intdigest(w) for w in words])


def passages_of(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, number of windows, anchor and content hash of each passage of texts laid end to end."""
    none = np.zeros(0, np.int64)
    if len(ids) < WINDOW:
        return none, none, none, none
    grams, whole = _grams(ids, GRAM), _grams(ids, WINDOW)
    doc = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    s = np.flatnonzero(doc[: len(whole)] == doc[WINDOW - 1 :])
    if not len(s):
        return none, none, none, none
    at = (np.arange(len(whole)) + np.lib.stride_tricks.sliding_window_view(grams, REACH).argmin(1))[s]
    begins = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (s[1:] != s[:-1] + 1)])
    n = np.diff(np.r_[begins, len(s)])
    a = s[begins]
    content = _mixed(whole[a] * _B + whole[a + n - 1] + n.astype(np.uint64))
    return a, n, grams[at[begins]].view(np.int64), content.view(np.int64)


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memo = _memo()
    for batch in batches:
        ids, ends = _word_ids(memo, batch.column("text").cast(pa.binary()).to_pylist())
        a, n, anchor, content = passages_of(ids, ends)
        row = np.searchsorted(ends, a, side="right")
        first = np.r_[np.zeros(1, np.int64), ends][row]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(row)), batch.column("k").take(pa.array(row)), pa.array(a - first), pa.array(n.astype(np.int32)), pa.array(anchor), pa.array(content)], ["doc_id", "k", "a", "n", "anchor", "content"])


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the passages listed in ``wanted``."""
    memo = _memo()
    names = ["anchor", "content", "doc_id", "a", "words"]
    for batch in batches:
        ids, ends = _word_ids(memo, batch.column("text").cast(pa.binary()).to_pylist())
        wanted = batch.column("wanted").to_pylist()
        rows = [(i, w["anchor"], w["content"], w["a"], ids[b + w["a"] : b + w["a"] + w["n"] + WINDOW - 1].view(np.int64)) for i, (b, some) in enumerate(zip([0, *ends.tolist()], wanted)) for w in some]
        for at in range(0, len(rows), 4096):
            i, anchor, content, a, words = zip(*rows[at : at + 4096])
            yield pa.RecordBatch.from_arrays([pa.array(anchor, pa.int64()), pa.array(content, pa.int64()), batch.column("doc_id").take(pa.array(i)), pa.array(a, pa.int64()), pa.array(words, pa.list_(pa.int64()))], names)


class Reference:
    """A block of passages, one after another, indexed by the classes of their windows.

    ``source[i]`` is the first place of the block where the words of the window at ``i`` stand;
    ``-1`` where no window starts. Suffixes are ranked by their first 1, 2, 4, 8 and 16 words,
    and windows by the ranks of 16 words and of 4 behind them.
    """

    def __init__(self, passages: list[np.ndarray]):
        self.ends = np.cumsum([len(p) for p in passages])
        self.words = np.concatenate(passages)
        rank = {1: np.unique(self.words, return_inverse=True)[1]}
        for k in (1, 2, 4, 8):
            ahead = np.r_[rank[k][k:], np.full(min(k, len(rank[k])), -1)] + 1
            rank[2 * k] = np.unique(rank[k] * (len(self.words) + 2) + ahead, return_inverse=True)[1]
        starts = np.concatenate([np.arange(e - len(p), e - WINDOW + 1) for e, p in zip(self.ends, passages)])
        _, first, cls = np.unique(rank[16][starts] * (len(self.words) + 2) + rank[4][starts + 16], return_index=True, return_inverse=True)
        self.source = np.full(len(self.words), -1)
        self.source[starts] = starts[first[cls]]

    def factors(self, p: int, earlier) -> Iterator[tuple[int, int]]:
        """``start, end`` (words of passage ``p``) of its factors of at least a window; ``earlier(q, j)`` tells whether the window at ``j`` of passage ``q`` stands before that at the same words here."""
        begin, end = (self.ends[p - 1] if p else 0), self.ends[p]
        i = begin
        while i + WINDOW <= end:
            j = self.source[i]
            q = int(np.searchsorted(self.ends, j, side="right"))
            if j == i or not earlier(q, j - (self.ends[q - 1] if q else 0), i - begin):
                i += 1
                continue
            n = WINDOW
            while i + n < end and j + n < self.ends[q] and self.words[i + n] == self.words[j + n]:
                n += 1
            yield int(i - begin), int(i + n - begin)
            i += n - WINDOW + 1  # the first window across the factor's end


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated spans of the passages of a partition, sorted by anchor and place."""
    names = ["anchor", "content", "doc_id", "a", "s", "e"]
    kinds = [pa.int64(), pa.int64(), None, pa.int64(), pa.int64(), pa.int64()]

    def parse(block: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        ref, out = Reference([b[4] for b in block]), []
        for p, (anchor, content, doc, a, _) in enumerate(block):
            before = lambda q, j, i: (block[q][2], block[q][3] + j) != (doc, a + i)  # noqa: B023,E731  blocks are sorted by place, and rows of one id may stand at the same place
            out += [(anchor, content, doc, a, a + s, a + e) for s, e in ref.factors(p, before)]
        cols = list(zip(*out)) or [()] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, t or kind) for c, t in zip(cols, kinds)], names)

    block, n, kind = [], 0, pa.int64()
    for batch in batches:
        kind = batch.column("doc_id").type
        flat, offsets = batch.column("words").values.to_numpy(), batch.column("words").offsets.to_numpy()
        for i, row in enumerate(zip(*[batch.column(c).to_pylist() for c in ("anchor", "content", "doc_id", "a")])):
            if n >= BLOCK_WORDS and row[0] != block[-1][0]:
                yield parse(block, kind)
                block, n = [], 0
            block.append((*row, flat[offsets[i] : offsets[i + 1]].copy()))
            n += len(block[-1][4])
    if block:
        yield parse(block, kind)


def _held(df: DataFrame, keys: DataFrame, on: list[str], how: str) -> DataFrame:
    """``df`` joined with a written table, broadcast only if counted to be small."""
    return df.join(F.broadcast(keys) if keys.count() <= BROADCAST_IDS else keys, on, how)


def repeated_spans(docs: DataFrame, full: int = FULL) -> DataFrame:
    """``doc_id, k, s, e``: spans of words (from 0, end excluded) that repeats cover; spans may overlap. ``docs`` has ``doc_id, k, text``, ``k`` naming the row's text. A written table."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    occ = durable(map_arrow(docs, _occurrences, f"doc_id {kind}, k long, a long, n int, anchor long, content long"), "passages")
    counted = occ.groupBy("anchor").agg(F.count("*").alias("c"), F.min("content").alias("low"), F.max("content").alias("high")).where("c > 1")
    shared = durable(counted.select("anchor", (F.col("low") != F.col("high")).alias("mixed")), "anchors")
    own = durable(_held(occ, shared, ["anchor"], "inner"), "shared")
    forget(occ)
    forget(shared)
    # the first place of each passage; rows of one id may share it
    firsts = durable(own.groupBy("anchor", "content").agg(F.min(F.struct("doc_id", "a", "k", "n")).alias("f"), F.count("*").alias("c"), F.first("mixed").alias("mixed")).select("anchor", "content", "c", "mixed", F.col("f.doc_id").alias("fd"), F.col("f.a").alias("fa"), F.col("f.k").alias("fk"), F.col("f.n").alias("n")), "firsts")
    again = own.select("doc_id", "k", "a", "n", "anchor", "content").join(firsts.where("c > 1").select("anchor", "content", "fd", "fa"), ["anchor", "content"]).where(~(F.col("doc_id").eqNullSafe(F.col("fd")) & (F.col("a") == F.col("fa"))))
    copies = again.select("doc_id", "k", F.col("a").alias("s"), (F.col("a") + F.col("n") + WINDOW - 1).alias("e"))

    # words of different passages under one anchor, fetched from the documents that have them first
    wanted = durable(firsts.where("mixed").groupBy(F.col("fd").alias("wd"), F.col("fk").alias("wk")).agg(F.collect_list(F.struct("anchor", "content", F.col("fa").alias("a"), "n")).alias("wanted")), "wanted")
    hold = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS // 64 else wanted
    texts = docs.join(hold, (F.col("k") == F.col("wk")) & F.col("doc_id").eqNullSafe(F.col("wd"))).select("doc_id", "text", "wanted")
    words = durable(map_arrow(texts, _contents, f"anchor long, content long, doc_id {kind}, a long, words array<long>"), "words")
    crowded = durable(words.groupBy("anchor").agg(F.count("*").alias("c")).where(F.col("c") > full).select("anchor"), "crowded")
    blocks = _held(words, crowded, ["anchor"], "left_anti").repartition("anchor").sortWithinPartitions("anchor", F.col("doc_id").asc_nulls_first(), "a")
    found = map_arrow(blocks, _parsed, f"anchor long, content long, doc_id {kind}, a long, s long, e long", rows=4096)

    many = _held(words, crowded, ["anchor"], "left_semi")
    single = durable(many.select("anchor", "content", "doc_id", "a", F.explode(F.transform(F.sequence(F.lit(0), F.size("words") - WINDOW), lambda i: F.struct((F.col("a") + i).alias("s"), F.xxhash64(F.slice("words", i + 1, WINDOW)).alias("w")))).alias("x")).select("anchor", "content", "doc_id", "a", "x.s", "x.w"), "windows")
    lead = single.groupBy("anchor", "w").agg(F.min(F.struct("doc_id", "s")).alias("f"), F.count("*").alias("c")).where("c > 1").select("anchor", "w", F.col("f.doc_id").alias("fd"), F.col("f.s").alias("fs"))
    later = single.join(lead, ["anchor", "w"]).where(~(F.col("doc_id").eqNullSafe(F.col("fd")) & (F.col("s") == F.col("fs"))))
    found = found.union(later.select("anchor", "content", "doc_id", "a", "s", (F.col("s") + WINDOW).alias("e")))

    # found at a first place: of every row that has the passage there
    here = found.select(F.col("anchor").alias("ra"), F.col("content").alias("rc"), F.col("doc_id").alias("rd"), F.col("a").alias("rp"), "s", "e")
    partly = own.where("mixed").select("doc_id", "k", "a", "anchor", "content").join(here, (F.col("anchor") == F.col("ra")) & (F.col("content") == F.col("rc")) & (F.col("a") == F.col("rp")) & F.col("doc_id").eqNullSafe(F.col("rd"))).select("doc_id", "k", "s", "e")
    out = durable(copies.union(partly), "spans")
    for used in (own, firsts, wanted, words, crowded, single):
        forget(used)
    return out


def _removed(text_at: int, width: int):
    """For ``mapInArrow``: rows of ``width`` columns and the spans behind them, with the text at ``text_at`` rewritten."""

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, n_words, n_removed = [], [], []
            for text, spans in zip(batch.column(text_at).cast(pa.binary()).to_pylist(), batch.column(width).to_pylist()):
                words = (text or b"").split()
                n_words.append(len(words))
                if not spans:
                    n_removed.append(0)
                else:
                    cover = np.zeros(len(words) + 1, np.int64)
                    np.add.at(cover, [x["s"] for x in spans], 1)
                    np.add.at(cover, [x["e"] for x in spans], -1)
                    stay = np.cumsum(cover[:-1]) == 0
                    words = [words[i] for i in np.flatnonzero(stay)]
                    n_removed.append(len(stay) - len(words))
                kept.append(None if text is None else b" ".join(words))
            cols = [pa.array(kept, pa.binary()).cast(pa.string()) if i == text_at else batch.column(i) for i in range(width)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())], [*[f"c{i}" for i in range(width)], "n_words", "n_removed"])

    return fn


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``text_col`` as its kept words, joined by one space, and ``n_words``, ``n_removed`` beside it.

    Words lie between ASCII white space and are compared as they are. Null texts stay null, with
    no words. Rows of one id count as one document: of equal windows at one place of it neither
    is earlier. Null ids come before all others. Other columns pass through; a column already
    named ``n_words`` or ``n_removed`` is replaced. Texts are kept whole, however long. An empty
    table gives an empty table.
    """
    names = [c for c in docs.columns if c not in ("n_words", "n_removed")]
    key, text = F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    spans = repeated_spans(docs.select(key.alias("doc_id"), F.xxhash64(key, text).alias("k"), text.alias("text")))
    cover = spans.groupBy(F.col("doc_id").alias("_sd"), F.col("k").alias("_sk")).agg(F.collect_set(F.struct("s", "e")).alias("_spans"))
    rows = docs.select(*[(F.col(f"`{c}`").cast("string") if c == text_col else F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(names)], key.alias("_d"), F.xxhash64(key, text).alias("_k"))
    beside = rows.join(cover, (F.col("_k") == F.col("_sk")) & F.col("_d").eqNullSafe(F.col("_sd")), "left").select(*[f"c{i}" for i in range(len(names))], "_spans")
    schema = ", ".join([f"c{i} {beside.schema[i].dataType.simpleString()}" for i in range(len(names))] + ["n_words long", "n_removed long"])
    return map_arrow(beside, _removed(names.index(text_col), len(names)), schema).toDF(*names, "n_words", "n_removed")


def query(spark, sf_dir: str) -> DataFrame:
    """Registered query ``op13_substring_dedup``: per document its words, the removed ones, and the digest of what stays."""
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


SQL = """
WITH split AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws FROM documents),
wins AS (SELECT doc_id, i, md5(array_to_string(ws[i + 1:i + 20], ' ')) AS w FROM split, unnest(range(0, len(ws) - 19)) t(i)),
ranked AS (SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS r FROM wins),
gone AS (SELECT DISTINCT doc_id, i + j AS pos FROM ranked, unnest(range(0, 20)) t(j) WHERE r > 1),
words AS (SELECT doc_id, unnest(ws) AS w, unnest(range(0, len(ws))) AS pos FROM split),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY pos) AS kept, count(*) AS c FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY 1)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(c, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM split LEFT JOIN kept USING (doc_id)
"""
