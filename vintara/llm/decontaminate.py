"""Operator 4: benchmark decontamination by SimHash of item-sized windows.

Every whole document is slid over with windows of a few sizes, each a benchmark item's own
or up to a quarter shorter. A window's 64-bit SimHash comes from differences of packed
cumulative votes, so a window costs the same at any size. Windows meet the fingerprints of
equally long parts of the items in multi-index tables: at most ``RADIUS`` bits apart means at
most ``RADIUS // 4`` on one of four 16-bit blocks, and a table per block lists the parts for
every such value, so no window within the radius is missed. Candidates are verified by exact
Jaccard similarity of five-word shingles, plain or weighted by how many distinct items of the
whole benchmark share a shingle, whichever is more, between the item and the best alignment
of an item-long window.

Windows come at steps of one to four words, so a passage may lie between two of them. What the
steps pass over is found by word pairs: of each item so many pairs are looked up at every word
of a document that a passage without any of them would lack more than a fifth of the item's
shingles. They also stand for items of one word, and for those too long for the vote lanes.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import durable, id_text, map_arrow, table
from .words import Memo

SHINGLE, SIMILARITY, RADIUS, BLOCKS = 5, 0.8, 11, 4
#: Items that are looked for at a time, which bounds what every worker holds; all items are looked for.
ITEM_BLOCK = 20_000
#: Longest window; the vote lanes hold fewer than 2^15 terms.
LONGEST = 1 << 14
#: Words slid over at a time; a longer text goes in parts that overlap by the longest window.
STREAM_WORDS = 1 << 17
_LANES = np.uint64(0x0001000100010001)
_TOPS = np.uint64(0x8000800080008000)


def _scramble(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hash(word: str) -> int:
    """Hash of a word's letters and digits in lower case; 0 if it has none, and then it counts as no word."""
    bare = word if word.isalnum() else "".join(c for c in word if c.isalnum())
    if not bare:
        return 0
    return xxhash.xxh64_intdigest(bare.lower().encode()) or 1


def hashes(texts: list[str], memo: Memo) -> list[np.ndarray]:
    """Hashes of the words of each text."""
    words = [t.split() for t in texts]
    memo.learn(chain.from_iterable(words))
    rows = (np.fromiter(map(memo.__getitem__, w), np.uint64, len(w)) for w in words)
    return [x[x != 0] for x in rows]


def pair_terms(h: np.ndarray) -> np.ndarray:
    """The terms that vote: runs of two words."""
    with np.errstate(over="ignore"):
        return _scramble(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:])


def shingles(h: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """Hashes of each run of ``k`` words; the whole sequence where there are fewer."""
    k = min(k, len(h))
    if k == 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - k + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            out = _scramble(out * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - k + 1 + i])
    return out


def cumulative_votes(terms: np.ndarray) -> np.ndarray:
    """16 rows of packed counters: row ``j`` counts bits ``j, j+16, j+32, j+48`` in four 16-bit lanes.

    A lane may overflow in the running sum; differences are taken modulo 2^64 and are exact
    while a window has fewer than 2^15 terms.
    """
    out = np.zeros((16, len(terms) + 1), np.uint64)
    for j in range(16):
        np.cumsum((terms >> np.uint64(j)) & _LANES, out=out[j, 1:])
    return out


def fingerprints_between(votes: np.ndarray, low: slice | np.ndarray, high: slice | np.ndarray, terms: np.ndarray | int) -> np.ndarray:
    """Fingerprints of windows of ``terms`` terms: a bit is 1 if over half of them have it."""
    over = (np.uint64(0x7FFF) - (np.asarray(terms, np.uint64) >> np.uint64(1))) * _LANES
    out = None
    for j in range(16):
        bits = (((votes[j][high] - votes[j][low] + over) & _TOPS) >> np.uint64(15)) << np.uint64(j)
        out = bits if out is None else out | bits
    return out


def size_classes(lengths: list[int]) -> list[int]:
    """Window sizes such that every length has one between 4/5 of itself and itself."""
    out: list[int] = []
    for n in sorted(set(lengths)):
        if not out or out[-1] < -(-4 * n // 5):
            out.append(n)
    return out


def stride(size: int) -> int:
    """Step between windows: a power of two, at most a sixth of the size."""
    return 4 if size >= 24 else 2 if size >= 12 else 1


class Items:
    """The items of one block with their multi-index tables per window size."""

    def __init__(self, items: list[tuple[int, str]], shares: dict[int, int] | None = None):
        memo = Memo(lambda ws: map(word_hash, ws))
        words = [(k, h) for (k, _), h in zip(items, hashes([t or "" for _, t in items], memo)) if len(h)]
        self.ids = [k for k, _ in words]
        self.length = [len(h) for _, h in words]
        self.sets = [set(shingles(h).tolist()) for _, h in words]
        if shares is None:  # these are all items
            shares = defaultdict(int)
            for s in {h.tobytes(): s for (_, h), s in zip(words, self.sets)}.values():
                for x in s:
                    shares[x] += 1
        #: A shingle that many distinct items share says less about each.
        self.weight = {x: 1.0 / shares.get(x, 1) for s in self.sets for x in s}
        self.total = [sum(self.weight[x] for x in s) for s in self.sets]
        self.classes = size_classes([n for n in self.length if n <= LONGEST])
        self.longest = max(self.classes, default=0)
        self._find_pairs([h for _, h in words])
        parts: dict[int, list[tuple[int, int, int]]] = defaultdict(list)  # size -> (fingerprint, item, offset)
        for i, (_, h) in enumerate(words):
            if not 1 < len(h) <= LONGEST:
                continue
            size = max((c for c in self.classes if 1 < c <= len(h)), default=0)
            if not size:
                continue
            v = cumulative_votes(pair_terms(h))
            at = np.arange(len(h) - size + 1)
            for o, f in zip(at.tolist(), fingerprints_between(v, at, at + size - 1, size - 1).tolist()):
                parts[size].append((f, i, o))
        self.tables = {size: self._table(p) for size, p in parts.items()}

    def _find_pairs(self, words: list[np.ndarray]) -> None:
        """The pairs (or, of an item of one word, the word) to look up: sorted codes, item and offset of each.

        Taken from the rarest on, until the shingles that hold one of them are more than a
        fifth of the item's, both by number and by weight: any passage of a similarity of
        ``SIMILARITY`` or more has at least one of the pairs.
        """
        terms = [pair_terms(h) for h in words]
        common = defaultdict(int)
        for t in terms:
            for x in t.tolist():
                common[x] += 1
        got: list[tuple[int, int, int]] = []
        self.singles: dict[int, list[int]] = defaultdict(list)
        for i, (h, t) in enumerate(zip(words, terms)):
            if len(h) == 1:
                self.singles[int(h[0])].append(i)
                continue
            k, sh, own, held = min(SHINGLE, len(h)), shingles(h).tolist(), self.sets[i], set()
            pairs = t.tolist()
            for j in sorted(range(len(pairs)), key=lambda j: (common[pairs[j]], j)):
                new = set(sh[max(0, j - k + 2) : j + 1]) - held
                if not new:
                    continue
                held |= new
                got.append((pairs[j], i, j))
                if len(held) > (1 - SIMILARITY) * len(own) and sum(self.weight[x] for x in held) > (1 - SIMILARITY) * self.total[i]:
                    break
        got.sort()
        self.pair = np.array([g[0] for g in got], np.uint64)
        self.pair_item, self.pair_at = np.array([g[1] for g in got], np.int64), np.array([g[2] for g in got], np.int64)
        self.marked = np.zeros(1 << 16, np.bool_)
        self.marked[(self.pair & np.uint64(0xFFFF)).astype(np.int64)] = True
        self.single = np.array(sorted(self.singles), np.uint64)

    def pairs_in(self, terms: np.ndarray, h: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """``(place, item, offset)`` of each looked-up pair among ``terms``, and of each one-word item among the words ``h``."""
        at = np.flatnonzero(self.marked[(terms & np.uint64(0xFFFF)).astype(np.int64)])
        low, high = np.searchsorted(self.pair, terms[at], "left"), np.searchsorted(self.pair, terms[at], "right")
        some = high > low
        for p, a, b in zip(at[some].tolist(), low[some].tolist(), high[some].tolist()):
            for j in range(a, b):
                yield p, int(self.pair_item[j]), int(self.pair_at[j])
        if len(self.single):
            for p in np.flatnonzero(np.isin(h, self.single)).tolist():
                for i in self.singles[int(h[p])]:
                    yield p, i, 0

    @staticmethod
    def _table(parts: list[tuple[int, int, int]]):
        """Parts, and per block the parts near each 16-bit value as ``first`` and ``member`` arrays."""
        f = np.array([p[0] for p in parts], np.uint64)
        flips = [0] + [sum(1 << b for b in c) for r in range(1, RADIUS // BLOCKS + 1) for c in combinations(range(16), r)]
        blocks = []
        for b in range(BLOCKS):
            own = ((f >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.int64)
            value = (own[:, None] ^ np.array(flips)[None, :]).ravel()
            member = np.repeat(np.arange(len(f)), len(flips))
            order = np.argsort(value, kind="stable")
            first = np.searchsorted(value[order], np.arange((1 << 16) + 1))
            blocks.append((first.astype(np.int32), member[order].astype(np.int32)))
        return f, np.array([p[1] for p in parts]), np.array([p[2] for p in parts]), blocks

    def near(self, size: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(window, item, offset)`` of every window within ``RADIUS`` bits of a part of this size."""
        f, item, offset, blocks = self.tables[size]
        got_w, got_p = [], []
        for b, (first, member) in enumerate(blocks):
            value = ((prints >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.int32)
            lo = first[value]
            n = first[value + 1] - lo
            w = np.flatnonzero(n)
            if not len(w):
                continue
            n, lo = n[w], lo[w]
            at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            w, p = np.repeat(w, n), member[at]
            ok = np.bitwise_count(prints[w] ^ f[p]) <= RADIUS
            got_w.append(w[ok])
            got_p.append(p[ok])
        if not got_w:
            return (np.zeros(0, np.int64),) * 3
        w, p = np.concatenate(got_w), np.concatenate(got_p)
        return w, item[p], offset[p]

    def similarity(self, i: int, h: np.ndarray, start: int, runs: list[int] | None = None) -> tuple[float, int]:
        """Best Jaccard similarity, plain or weighted, of item ``i`` with the item-long windows around ``start``, and its place; 0 where none can reach ``SIMILARITY``.

        ``runs`` are the shingles of the whole of ``h``, if it has as many words as a shingle.
        """
        n, slack = self.length[i], max(8, self.length[i] // 4)
        own, weight, total = self.sets[i], self.weight, self.total[i]
        k = min(SHINGLE, n)
        low = max(0, min(start - slack, len(h) - n))
        high = max(low, min(start + slack, len(h) - n))
        sh = runs[low : high + n - k + 1] if runs is not None and k == SHINGLE else shingles(h[low : high + n], k).tolist()
        # no window here shares more with the item than all of them do
        most = own.intersection(sh)
        if len(most) < SIMILARITY * len(own) - 1e-9 and sum(weight[x] for x in most) < SIMILARITY * total - 1e-9:
            return 0.0, low
        wide = n - k + 1
        # the window slides by a shingle: counts of its distinct shingles, those of the item and others, plain and by weight
        count: dict[int, int] = {}
        common, other, both, rest = 0, 0, 0.0, 0.0
        best = (0.0, low)
        for e, x in enumerate(sh):
            c = count.get(x, 0)
            count[x] = c + 1
            if not c:
                if x in own:
                    common, both = common + 1, both + weight[x]
                else:
                    other, rest = other + 1, rest + weight.get(x, 1.0)
            if e >= wide:
                x = sh[e - wide]
                count[x] -= 1
                if not count[x]:
                    if x in own:
                        common, both = common - 1, both - weight[x]
                    else:
                        other, rest = other - 1, rest - weight.get(x, 1.0)
            if common and (e >= wide - 1 or e == len(sh) - 1):
                got = max(round(both / (total + rest), 12), common / (len(own) + other))
                if got > best[0]:
                    best = (got, low + max(0, e - wide + 1))
        return best


def _streams(docs: list[np.ndarray], reach: int) -> Iterator[tuple[np.ndarray, list[tuple[int, int, int, int]]]]:
    """Word hashes of many documents end to end, with ``(document, first word, place, words)`` of each part.

    Parts start at multiples of eight, so windows at equal steps start at the same words of a
    document whatever stands before it.
    """
    hold, parts, at = [], [], 0
    for d, h in enumerate(docs):
        for s in range(0, max(1, len(h)), STREAM_WORDS):
            x = h[s : s + STREAM_WORDS + reach]
            if not len(x):
                continue
            hold.append(np.concatenate([x, np.zeros(-len(x) % 8, np.uint64)]))
            parts.append((d, s, at, len(x)))
            at += len(hold[-1])
            if at >= STREAM_WORDS:
                yield np.concatenate(hold), parts
                hold, parts, at = [], [], 0
    if hold:
        yield np.concatenate(hold), parts


def find_items(docs: list[np.ndarray], items: Items) -> list[tuple[int, int, float, int]]:
    """``(document, item, similarity, first word)`` of each item that a document holds, its best place."""
    best: dict[tuple[int, int], tuple[float, int]] = {}
    tried: set[tuple[int, int, int]] = set()
    runs: dict[int, list[int] | None] = {}

    def judge(p: int, i: int, s: int) -> None:
        """Compare item ``i`` with the windows around place ``s`` of part ``p``, once per stretch of eight words."""
        d, first, where, _ = parts[p]
        guess = first + s - where
        if (d, i, guess // 8) in tried or best.get((d, i), (0.0, 0))[0] >= 1.0:
            return
        tried.add((d, i, guess // 8))
        if d not in runs:
            runs[d] = shingles(docs[d]).tolist() if len(docs[d]) >= SHINGLE else None
        sim, start = items.similarity(i, docs[d], guess, runs[d])
        if sim >= SIMILARITY and sim > best.get((d, i), (0.0, 0))[0]:
            best[d, i] = (sim, start)

    for h, parts in _streams(docs, items.longest + 8):
        pairs = pair_terms(h)
        votes = cumulative_votes(pairs)
        place = np.array([p[2] for p in parts])
        words = np.array([p[3] for p in parts])
        for size in items.tables:
            step, terms = stride(size), size - 1
            starts, prints = [], []
            if len(h) >= size and terms > 0:
                at = np.arange(0, len(h) - size + 1, step)
                got = fingerprints_between(votes, slice(0, len(h) - size + 1, step), slice(terms, len(h), step), terms)
                part = np.searchsorted(place, at, "right") - 1
                inside = at + size <= place[part] + words[part]
                starts.append(at[inside])
                prints.append(got[inside])
            # the last window of each part, and a part shorter than the window as a whole
            low = np.maximum(place, place + words - size)
            n = place + words - low
            some = (n >= 2) & (5 * n >= 4 * size)
            if some.any():
                starts.append(low[some])
                prints.append(fingerprints_between(votes, low[some], low[some] + n[some] - 1, n[some] - 1))
            if terms == 0:  # one-word items: the word itself
                continue
            if not starts:
                continue
            at = np.concatenate(starts)
            w, item, offset = items.near(size, np.concatenate(prints))
            if not len(w):
                continue
            part = np.searchsorted(place, at[w], "right") - 1
            for p, i, s in zip(part.tolist(), item.tolist(), (at[w] - offset).tolist()):
                judge(p, i, s)
        for at, i, offset in items.pairs_in(pairs, h):
            p = int(np.searchsorted(place, at, "right")) - 1
            if at + min(2, items.length[i]) <= place[p] + words[p]:
                judge(p, i, at - offset)
    return [(d, items.ids[i], sim, at) for (d, i), (sim, at) in sorted(best.items())]


_MEMO: list[Memo] = []


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``doc_id, item_id, similarity, first_word``: a row per document row and item that it holds.

    Words are runs without white space, compared by their letters and digits in lower case.
    Items and documents without words, null or empty, match nothing; an item of a single word
    is held by every document that has the word. Rows that repeat in ``docs`` give rows that repeat; of items that repeat
    an id each is looked for. Items come to the driver in blocks of ``ITEM_BLOCK``.
    """
    base = id_text(docs, id_col, text_col)
    kind, item_kind = dict(base.dtypes)["doc_id"], dict(benchmark.dtypes)[item_col]
    item_type = to_arrow_type(benchmark.schema[item_col].dataType)
    found = None

    def search(chosen: list[tuple[int, str]], shares: dict[int, int] | None = None) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = Items(chosen, shares)
            if not _MEMO:
                _MEMO.append(Memo(lambda ws: map(word_hash, ws)))
            for b in batches:
                got = find_items(hashes(b.column("text").to_pylist(), _MEMO[0]), items)
                ids = b.column("doc_id").take(pa.array([g[0] for g in got], pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, pa.array([g[1] for g in got], item_type), pa.array([g[2] for g in got], pa.float64()), pa.array([g[3] for g in got], pa.int64())], ["doc_id", "item_id", "similarity", "first_word"])

        return map_arrow(base, run, f"doc_id {kind}, item_id {item_kind}, similarity double, first_word bigint")

    for block in _item_blocks(benchmark, item_col, item_text):
        found = search(*block) if found is None else found.union(search(*block))
    return search([]) if found is None else found


def _item_blocks(benchmark: DataFrame, item_col: str = "item_id", item_text: str = "text") -> Iterator[tuple[list[tuple[int, str]], dict[int, int] | None]]:
    """The items in their order, ``ITEM_BLOCK`` at a time, with the number of distinct items of all blocks that share each of their shingles (those of one item left out); none where one block holds all."""
    rows = benchmark.select(F.col(item_col), F.col(item_text)).orderBy(item_col, item_text).toLocalIterator()
    take = lambda: [(r[0], r[1]) for r in islice(rows, ITEM_BLOCK)]
    block, after = take(), take()
    shares = _shares(benchmark, item_text) if after else None
    while block:
        own = None
        if shares is not None:
            memo = Memo(lambda ws: map(word_hash, ws))
            held = {x for h in hashes([t or "" for _, t in block], memo) for x in shingles(h).view(np.int64).tolist()}
            of = benchmark.sparkSession.createDataFrame([(x,) for x in held], "x long")
            own = {r["x"] & ((1 << 64) - 1): r["n"] for r in shares.join(of, "x").collect()}
        yield block, own
        block, after = after, take()


def _shares(benchmark: DataFrame, item_text: str) -> DataFrame:
    """``x, n``: the shingles of more than one distinct item, and of how many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(lambda ws: map(word_hash, ws))
        for b in batches:
            got = hashes(b.column("text").to_pylist(), memo)
            sets = [np.unique(shingles(h)).view(np.int64).tolist() for h in got]
            yield pa.RecordBatch.from_arrays([pa.array([h.tobytes() for h in got], pa.binary()), pa.array(sets, pa.list_(pa.int64()))], ["words", "xs"])

    items = map_arrow(benchmark.select(F.coalesce(F.col(item_text), F.lit("")).alias("text")).distinct(), run, "words binary, xs array<bigint>")
    return durable(items.distinct().select(F.explode("xs").alias("x")).groupBy("x").agg(F.count("*").alias("n")).where("n > 1"), "shares")


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item; all columns pass through.

    Rows are judged singly, so null and repeated ids need no care. Each block of items is
    looked for in what the blocks before it left.
    """
    # the columns travel as one struct, so that no name of theirs can clash
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    schema, many = kept.schema, False

    def without(chosen: list[tuple[int, str]], shares: dict[int, int] | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = Items(chosen, shares)
            if not _MEMO:
                _MEMO.append(Memo(lambda ws: map(word_hash, ws)))
            for b in batches:
                clean = np.ones(b.num_rows, np.bool_)
                clean[[g[0] for g in find_items(hashes(b.column("text").to_pylist(), _MEMO[0]), items)]] = False
                yield b.filter(pa.array(clean))

        return run

    for block in _item_blocks(benchmark):
        kept = map_arrow(durable(kept, "clean") if many else kept, without(*block), schema)
        many = True
    return kept.select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    """Registered query ``op4_decontaminate``."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
