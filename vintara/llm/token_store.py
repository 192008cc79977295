"""Operator 3: token ids in binary shards with a minimal perfect hash index.

A store is a folder of shards. ``N.bin`` is the raw payload: the ids of one document after
another, little-endian, unsigned 16-bit where every id fits and else 32-bit. ``N.idx`` holds,
per document in file order, its key and where its ids start, and a minimal perfect hash from
keys to documents: levels of bit arrays (Limasset et al., "Fast and scalable minimal perfect
hashing", 2017) in which a key's bit is set where no other key of the level falls; the number
of bits set before it is its place. Each place stores a fingerprint of its key, so a foreign
key is told with a chance of 2^-32 of a mistake, and then the key itself is compared. Shards
hold ranges of ascending keys.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import default_path, split_words
from .common import durable, id_text, map_arrow, map_pandas, new_dir, table
from .files import get, pack, put, unpack
from .fingerprint import _bucket
from .words import MARKS, Memo, is_run

#: Documents that a shard aims at, and the most shards of a store.
SHARD_DOCS, MOST_SHARDS = 4096, 16384
END = 2
_LOWEST = -(1 << 63)


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of integers (splitmix64)."""
    with np.errstate(over="ignore"):
        z = x.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) % (1 << 64))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit integers."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.size, self.bits, self.rank, self.marks = arrays["level_size"], arrays["level_bits"], arrays["level_rank"], arrays["fingerprint"]
        self.first = np.concatenate([[0], np.cumsum(self.size)]).astype(np.int64)

    @staticmethod
    def build(keys: np.ndarray, gamma: float = 2.0) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Arrays of the hash, and the place of each key."""
        left, sizes, levels, where = np.arange(len(keys)), [], [], []
        level = 0
        while len(left):
            m = -(-max(64, int(gamma * len(left))) // 64) * 64
            h = (_mix(keys[left], level) % np.uint64(m)).astype(np.int64)
            alone = np.bincount(h, minlength=m) == 1
            mine = alone[h]
            where.append((left[mine], h[mine] + sum(sizes)))
            sizes.append(m)
            levels.append(alone)
            left = left[~mine]
            level += 1
        flags = np.concatenate(levels) if levels else np.zeros(0, np.bool_)
        words = np.packbits(flags, bitorder="little").view(np.uint64) if len(flags) else np.zeros(0, np.uint64)
        rank = np.concatenate([[0], np.cumsum(np.bitwise_count(words))]).astype(np.int64)
        arrays = {"level_size": np.array(sizes, np.int64), "level_bits": words, "level_rank": rank, "fingerprint": np.zeros(len(keys), np.uint32)}
        place = np.empty(len(keys), np.int64)
        for who, bit in where:
            place[who] = PerfectHash(arrays)._rank(bit)
        arrays["fingerprint"][place] = (_mix(keys, 977) >> np.uint64(32)).astype(np.uint32)
        return arrays, place

    def _rank(self, bit: np.ndarray) -> np.ndarray:
        word = self.bits[bit >> 6]
        below = word & ((np.uint64(1) << (bit & 63).astype(np.uint64)) - np.uint64(1))
        return self.rank[bit >> 6] + np.bitwise_count(below)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, or -1 where no level has its bit or the fingerprint differs."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, m in enumerate(self.size.tolist()):
            if not len(left):
                break
            bit = (_mix(keys[left], level) % np.uint64(m)).astype(np.int64) + self.first[level]
            hit = (self.bits[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) == 1
            out[left[hit]] = self._rank(bit[hit])
            left = left[~hit]
        known = out >= 0
        wrong = known.copy()
        wrong[known] = self.marks[out[known]] != (_mix(keys[known], 977) >> np.uint64(32)).astype(np.uint32)
        out[wrong] = -1
        return out


def write_shard(uri: str, keys: list[int | None], payloads: list[bytes], width: int) -> dict:
    """Write one shard; ``keys`` ascend, null keys first, a key may repeat."""
    n = len(keys)
    known = np.array([k is not None for k in keys], np.bool_)
    key = np.array([0 if k is None else k for k in keys], np.int64)
    size = np.array([len(p) // width for p in payloads], np.int64)
    start = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    distinct, first, count = np.unique(key[known], return_index=True, return_counts=True)
    arrays, place = PerfectHash.build(distinct)
    document, repeats = np.empty(len(distinct), np.int64), np.empty(len(distinct), np.int64)
    document[place], repeats[place] = first + int((~known).sum()), count
    put(uri + ".bin", *payloads)
    put(uri + ".idx", pack({"width": width, "docs": n, "tokens": int(start[-1])}, {"key": key, "known": known, "start": start, "document": document, "repeats": repeats, **arrays}))
    return {"docs": n, "tokens": int(start[-1])}


class Shard:
    """Reader of one shard."""

    def __init__(self, uri: str):
        self.meta, self.at = unpack(uri + ".idx")
        self.index = PerfectHash(self.at)
        self.raw = get(uri + ".bin")
        self.ids = np.frombuffer(self.raw, np.dtype(f"<u{self.meta['width']}"), self.meta["tokens"])

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.at["start"][i] : self.at["start"][i + 1]]

    def find(self, key: int) -> list[np.ndarray]:
        """Ids of each document of ``key``, in constant time; none if the shard hasn't it."""
        place = int(self.index.find(np.array([key], np.int64))[0])
        if place < 0:
            return []
        i = int(self.at["document"][place])
        if self.at["key"][i] != key:
            return []
        return [self.document(j) for j in range(i, i + int(self.at["repeats"][place]))]


@dataclass
class TokenStore:
    """A written store: folder, and per shard its number, key range, documents, tokens and first token."""

    folder: str
    shards: list[dict]

    def get(self, key: int) -> list[np.ndarray]:
        """Ids of each document of ``key``: the shard by its range, the document by the perfect hash."""
        firsts = np.array([s["low"] for s in self.shards], np.int64)
        i = int(np.searchsorted(firsts, key, "right")) - 1
        return Shard(f"{self.folder}/{self.shards[i]['shard']:06d}").find(key) if i >= 0 else []

    def read(self, spark: SparkSession) -> DataFrame:
        """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files, each found by its key where it has one of its own."""
        folder = self.folder
        rows = [(s["shard"], s["first"]) for s in self.shards]
        if not rows:
            return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for number, first in zip(pdf["shard"].tolist(), pdf["first"].tolist()):
                    s = Shard(f"{folder}/{number:06d}")
                    key, known, start, n = s.at["key"], s.at["known"], s.at["start"], s.meta["docs"]
                    doc = np.arange(n)
                    place = s.index.find(key[known])
                    if (place < 0).any():
                        raise RuntimeError(f"shard {number}: a key is missing from its index")
                    run_no = np.arange(n) - np.maximum.accumulate(np.where(np.r_[True, (key[1:] != key[:-1]) | (known[1:] != known[:-1])], np.arange(n), 0))
                    doc[known] = s.at["document"][place] + run_no[known]
                    crc = [zlib.crc32(s.document(i).astype("<u4").tobytes()) for i in doc.tolist()]
                    yield pd.DataFrame({"doc_id": pd.arrays.IntegerArray(key.copy(), ~known), "start": first + start[doc], "n_tokens": start[doc + 1] - start[doc], "ids_crc32": np.array(crc, np.int64)})

        frame = spark.createDataFrame(rows, "shard long, first long").repartition(min(len(rows), 2000), "shard")
        return map_pandas(frame, run, "doc_id long, start long, n_tokens long, ids_crc32 long")


@lru_cache(maxsize=2)
def _word_ids(path: str, end: int) -> tuple[Memo, str]:
    """The library's ids of words, remembered for the life of a worker, and the width that holds them."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; the library's own threads would take the others'
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    kind = "<u2" if max(tok.get_vocab_size(), end + 1) <= 1 << 16 else "<u4"
    code, width = ("H", 2) if kind == "<u2" else ("I", 4)
    suffix = getattr(tok.model, "end_of_word_suffix", None)
    ends = np.zeros(tok.get_vocab_size(), np.bool_)
    if suffix:
        ends[[i for s, i in tok.get_vocab().items() if s.endswith(suffix)]] = True

    def encode(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tok.encode_batch_fast(texts, add_special_tokens=False)]

    def learn_runs(words: list[str]) -> Iterator[bytes | None]:
        """Ids of words of letters alone, in runs of many that are cut again after each token that ends a word; none for other words."""
        known = {}
        runs = list(filter(is_run, words))
        lines = [runs[i : i + 500] for i in range(0, len(runs), 500)]
        for part, ids in zip(lines, encode(list(map(" ".join, lines)))):
            stop = ((np.flatnonzero(ends[ids]) + 1) * width).tolist()
            if len(stop) == len(part):  # else one is more than one word to the tokenizer, or it marks no ends
                raw = array(code, ids).tobytes()
                known.update((w, raw[at:to]) for w, at, to in zip(part, [0, *stop], stop))
        return map(known.get, words)

    heads = Memo(learn_runs)

    def work(words: list[str]) -> Iterator[bytes]:
        """A word of letters and its trailing marks are looked up apart, in lower case, as the tokenizer sees them; any other word is encoded whole."""
        low = [w.rstrip(MARKS).lower() for w in words]
        heads.learn(low)
        head = list(map(heads.__getitem__, low))
        rest = [w if h is None else w[len(x) :] for w, x, h in zip(words, low, head)]
        odd = list(set(rest))
        tail = {r: array(code, ids).tobytes() for r, ids in zip(odd, encode(odd))}
        return (tail[r] if h is None else h + tail[r] for h, r in zip(head, rest))

    return Memo(work), kind


def write_store(docs: DataFrame, path: str | None = None, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> TokenStore:
    """Encode every whole text with the tokenizers library, append ``end``, and write the ids in ascending id order.

    Ids are integers. Rows with a null id come first and can't be looked up; rows that repeat
    an id stand side by side, ordered by their ids. Null texts count as empty and hold ``end``
    alone. An empty table gives a store without shards. Other columns are not read.
    """
    path = path or default_path()
    spark = docs.sparkSession
    base = id_text(docs, id_col, text_col).withColumn("key", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOWEST)))
    n = base.count()
    if n == 0:
        return TokenStore(new_dir(spark, "tokens"), [])
    k = min(MOST_SHARDS, -(-n // SHARD_DOCS))
    got = base.agg(F.percentile_approx("key", F.array(*[F.lit((i + 1) / k) for i in range(k)]), F.lit(max(10000, 20 * k))).alias("q"), F.max("key").alias("top")).first()
    bounds = sorted({*got["q"], got["top"]})
    folder = new_dir(spark, "tokens")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, kind = _word_ids(path, end)
        tail = np.array([end], kind).tobytes()
        for b in batches:
            words = list(map(split_words, b.column("text").to_pylist()))
            memo.learn(chain.from_iterable(words))
            out = [b"".join(map(memo.__getitem__, w)) + tail for w in words]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("key"), b.column("shard"), pa.array([len(tail)] * b.num_rows, pa.int32()), pa.array(out, pa.binary())], ["doc_id", "key", "shard", "width", "ids"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, low, width, keys, payloads, done = None, None, 0, [], [], []

        def close() -> None:
            if keys:
                s = write_shard(f"{folder}/{now:06d}", keys, payloads, width)
                done.append((now, low, s["docs"], s["tokens"]))

        for b in batches:
            for doc, key, shard, w, ids in zip(*(b.column(c).to_pylist() for c in ("doc_id", "key", "shard", "width", "ids"))):
                if shard != now:
                    close()
                    now, low, width, keys, payloads = shard, key, w, [], []
                keys.append(doc)
                payloads.append(ids)
        close()
        if done:
            cols = list(zip(*done))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["shard", "low", "docs", "tokens"])

    base = base.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("shard", _bucket(F.col("key"), bounds).cast("int"))
    coded = map_arrow(base, encode, "doc_id long, key long, shard int, width int, ids binary")
    dealt = coded.repartitionById(len(bounds), F.col("shard")).sortWithinPartitions("shard", "key", "ids")
    rows = durable(map_arrow(dealt, write, "shard long, low long, docs long, tokens long"), "manifest").orderBy("shard").collect()
    shards, first = [], 0
    for r in rows:
        shards.append({**r.asDict(), "first": first})
        first += r["tokens"]
    return TokenStore(folder, shards)


def query(spark, sf_dir: str) -> DataFrame:
    """Registered query ``op3_token_store``: written, then read back from the files."""
    return write_store(table(spark, sf_dir, "documents")).read(spark)
