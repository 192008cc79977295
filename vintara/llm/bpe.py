"""Operator 6: BPE encoding and decoding through a minimal acyclic transducer.

Frequent words are compiled, with their ids, into an automaton whose equal suffixes are one
state; the number of words passed on the way gives a word's place, and so its ids. The
automaton is a flat file in the shared folder, memory-mapped by every worker. Words that it
does not hold are merged exactly, pair by pair, in the order of the tokenizer's ranks.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, forget, id_text, map_arrow, new_dir, table
from .files import pack, put, unpack
from .words import Memo

#: Words of the corpus that the lexicon holds at most, and the characters that such a word has
#: at most. Both bound only how often the slow way is taken; the ids are the same without them.
LEXICON_WORDS, LEXICON_CHARS = 50_000, 64
#: Above every rank of a pair.
NEVER = 1 << 30


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = {b: chr(b) for b in plain}, 0
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + extra)
            extra += 1
    return [out[b] for b in range(256)]


class WordBpe:
    """A byte-level BPE with word ends, read from a tokenizers JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"]
        self.names = {i: s for s, i in self.vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names |= {i: s for s, i in self.special.items()}
        self.ranks: dict[int, tuple[int, int]] = {}
        for rank, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ", 1)
            self.ranks[self.vocab[a] << 20 | self.vocab[b]] = (rank, self.vocab[a + b])
        symbols = byte_symbols()
        pairs = sorted((pair, rank, new) for pair, (rank, new) in self.ranks.items())
        self.pair_key, self.pair_rank, _ = np.array(pairs, np.int64).reshape(-1, 3).T
        self.rank_id = np.array([new for _, new in sorted(self.ranks.values())], np.int64)
        self.inner = [self.vocab[s] for s in symbols]
        self.last = [self.vocab[s + self.end] for s in symbols]
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(pattern)
        self.cut = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)))

    def merge(self, raw: bytes) -> list[int]:
        """Exact ids of one word: always the pair of lowest rank, the leftmost of equals."""
        s = [self.inner[b] for b in raw]
        s[-1] = self.last[raw[-1]]
        get, far = self.ranks.get, (NEVER, 0)
        pairs = [get(a << 20 | b, far) for a, b in zip(s, s[1:])]
        while pairs:
            low = min(pairs)
            if low is far or low[0] == far[0]:
                break
            i = pairs.index(low)
            s[i : i + 2] = [low[1]]
            del pairs[i]
            if i:
                pairs[i - 1] = get(s[i - 1] << 20 | s[i], far)
            if i < len(pairs):
                pairs[i] = get(s[i] << 20 | s[i + 1], far)
        return s

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols; ``NEVER`` for pairs that don't merge and for the filler -1."""
        key = a << 20 | b
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where((a >= 0) & (b >= 0) & (self.pair_key[at] == key), self.pair_rank[at], NEVER)

    def merge_all(self, words: list[bytes]) -> list[list[int]]:
        """``merge`` of each word; words of a like length take a step at a time together, long ones go singly."""
        out: list[list[int]] = [[]] * len(words)
        size = np.fromiter(map(len, words), np.int64, len(words))
        inner, last = np.array(self.inner, np.int64), np.array(self.last, np.int64)
        for low, top in ((0, 6), (6, 10), (10, 16), (16, 32)):
            rows = np.flatnonzero((size > low) & (size <= top))
            if not len(rows):
                continue
            n = size[rows]
            inside = np.arange(top) < n[:, None]
            s = np.full((len(rows), top), -1, np.int64)
            s[inside] = inner[np.frombuffer(b"".join(words[i] for i in rows.tolist()), np.uint8)]
            s[np.arange(len(rows)), n - 1] = last[np.fromiter((words[i][-1] for i in rows.tolist()), np.int64, len(rows))]
            r = self.pair_ranks(s[:, :-1], s[:, 1:])
            while len(rows):
                # the pair of lowest rank in each word, the leftmost of equals
                i = r.argmin(1) if r.shape[1] else np.zeros(len(rows), np.int64)
                best = r[np.arange(len(rows)), i] if r.shape[1] else np.full(len(rows), NEVER)
                live = best < NEVER
                for k, ids, m in zip(rows[~live].tolist(), s[~live].tolist(), n[~live].tolist()):
                    out[k] = ids[:m]
                rows, s, r, n, i, best = rows[live], s[live], r[live], n[live] - 1, i[live], best[live]
                if not len(rows):
                    break
                at = np.arange(len(rows))
                cols = np.arange(s.shape[1] - 1)
                s = np.take_along_axis(s, cols + (cols > i[:, None]), 1)
                s[at, i] = self.rank_id[best]
                r = np.take_along_axis(r, cols[:-1] + (cols[:-1] >= i[:, None]), 1)
                left, right = np.flatnonzero(i > 0), np.flatnonzero(i < r.shape[1])
                r[left, i[left] - 1] = self.pair_ranks(s[left, i[left] - 1], s[left, i[left]])
                r[right, i[right]] = self.pair_ranks(s[right, i[right]], s[right, i[right] + 1])
        for k in np.flatnonzero(size > top).tolist():
            out[k] = self.merge(words[k])
        return out

    def pieces(self, word: str) -> list[str | int]:
        """What the model sees of a word: lower-cased runs, and the ids of special tokens written out."""
        if "<|" in word:
            out, at = [], 0
            for m in self.cut.finditer(word):
                out += [*self.pieces_plain(word[at : m.start()]), self.special[m.group()]]
                at = m.end()
            return out + self.pieces_plain(word[at:])
        return self.pieces_plain(word)

    def pieces_plain(self, word: str) -> list[str]:
        if not word.isascii():
            word = "".join(c.lower() for c in unicodedata.normalize("NFC", word))
        else:
            word = word.lower()
        return self.pattern.findall(word)

    def decode(self, ids: list[int]) -> str:
        """Token strings joined by spaces, as a tokenizer without a decoder gives."""
        return " ".join(self.names[i] for i in ids if i in self.names)


class Lexicon:
    """Minimal acyclic automaton from words (bytes) to id sequences, over flat arrays.

    ``edge`` holds ``state << 8 | byte`` in ascending order, ``to`` the next state, ``skip``
    how many words lie before it; ``final`` marks word ends; ``start`` and ``ids`` hold the
    outputs in word order.
    """

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.edge, self.to, self.skip, self.final, self.start, self.ids = (arrays[k] for k in ("edge", "to", "skip", "final", "start", "ids"))

    @staticmethod
    def compile(words: dict[bytes, list[int]]) -> dict[str, np.ndarray]:
        """Arrays of the automaton. States are merged from the longest suffix on as words come in order (Daciuk et al., 2000)."""
        keys = sorted(w for w in words if w)
        known: dict[tuple, int] = {}
        rows: list[tuple[bool, tuple]] = []
        path: list[list] = [[False, []]]  # [final, [(byte, state)]]

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                final, edges = path.pop()
                sig = (final, tuple(edges))
                if sig not in known:
                    known[sig] = len(rows)
                    rows.append(sig)
                path[-1][1][-1] = (path[-1][1][-1][0], known[sig])

        before = b""
        for w in keys:
            k = 0
            while k < min(len(w), len(before)) and w[k] == before[k]:
                k += 1
            close(k)
            for b in w[k:]:
                path[-1][1].append((b, -1))
                path.append([False, []])
            path[-1][0] = True
            before = w
        close(0)
        rows.append((path[0][0], tuple(path[0][1])))
        size = [0] * len(rows)  # words below a state; children come before their parents
        edge, to, skip = [], [], []
        for i, (final, edges) in enumerate(rows):
            n = int(final)
            for b, t in edges:
                edge.append((len(rows) - 1 - i) << 8 | b)
                to.append(len(rows) - 1 - t)
                skip.append(n)
                n += size[t]
            size[i] = n
        order = np.argsort(np.array(edge, np.int64), kind="stable")
        lens = [len(words[w]) for w in keys]
        return {
            "edge": np.array(edge, np.int64)[order], "to": np.array(to, np.int32)[order], "skip": np.array(skip, np.int32)[order],
            "final": np.array([r[0] for r in reversed(rows)], np.bool_), "start": np.concatenate([[0], np.cumsum(lens)]).astype(np.int64),
            "ids": np.array([i for w in keys for i in words[w]], np.int32),
        }

    def find(self, words: list[bytes]) -> np.ndarray:
        """Place of each word, or -1; all words take a step at a time."""
        n = len(words)
        out = np.full(n, -1, np.int64)
        if not n or not len(self.edge):
            return out
        size = np.fromiter(map(len, words), np.int64, n)
        flat = np.frombuffer(b"".join(words), np.uint8)
        first = np.cumsum(size) - size
        live, state, place = np.flatnonzero(size > 0), np.zeros(n, np.int64), np.zeros(n, np.int64)
        depth = 0
        while len(live):
            key = state[live] << 8 | flat[first[live] + depth]
            at = np.minimum(np.searchsorted(self.edge, key), len(self.edge) - 1)
            hit = self.edge[at] == key
            live, at = live[hit], at[hit]
            place[live] += self.skip[at]
            state[live] = self.to[at]
            depth += 1
            done = size[live] == depth
            ends = live[done]
            ends = ends[self.final[state[ends]]]
            out[ends] = place[ends]
            live = live[~done]
        return out

    def output(self, place: int) -> list[int]:
        return self.ids[self.start[place] : self.start[place + 1]].tolist()


def encode_pieces(pieces: list[str], model: WordBpe, lexicon: Lexicon) -> dict[str, list[int]]:
    """Ids of each distinct piece: from the automaton, or merged."""
    raw = [p.encode() for p in pieces]
    place = lexicon.find(raw).tolist()
    merged = iter(model.merge_all([r for r, k in zip(raw, place) if k < 0]))
    return {p: lexicon.output(k) if k >= 0 else next(merged) for p, k in zip(pieces, place)}


class Coder:
    """Encodes whole texts word by word with a bounded memo; ``view`` turns the ids of a word into what is kept of them."""

    def __init__(self, model: WordBpe, lexicon: Lexicon, view):
        self.model, self.lexicon, self.view = model, lexicon, view
        self.memo = Memo(self._work)

    def _work(self, words: list[str]) -> Iterator:
        cut = [self.model.pieces(w) for w in words]
        ids = encode_pieces(list({p for c in cut for p in c if isinstance(p, str)}), self.model, self.lexicon)
        for c in cut:
            yield self.view([i for p in c for i in (ids[p] if isinstance(p, str) else (p,))])


def split_words(text: str) -> list[str]:
    """Words between Unicode white space (not U+001C to U+001F, which Python's split would cut at)."""
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return [w for w in regex.split(r"\p{White_Space}+", text) if w]
    return text.split()


def frequent_words(docs: DataFrame, words: int = LEXICON_WORDS) -> list[str]:
    """At most ``words`` of the most frequent words of the whole texts of all documents, words of one count together in or out.

    Only a histogram of the counts (a row per sixteenth of an octave, under 1,024 rows) and
    the chosen words come to the driver, however many partitions or words there are.
    """
    each = id_text(docs).select(F.explode(F.split("text", r"\s+")).alias("w")).where(F.length("w").between(1, LEXICON_CHARS))
    counts = durable(each.groupBy("w").agg(F.count("*").alias("n")).where("n > 1").select("w", F.floor(F.log2("n") * 16).cast("int").alias("step")), "words")
    total, low = 0, None
    for r in sorted(counts.groupBy("step").count().collect(), reverse=True):
        total += r["count"]
        if total > words:
            break
        low = r["step"]
    top = [] if low is None else [r["w"] for r in counts.where(F.col("step") >= low).select("w").collect()]
    forget(counts)
    return top


def build_lexicon(docs: DataFrame, path: str, words: int = LEXICON_WORDS) -> str:
    """Compile the lexicon and write it to the shared folder; returns its URI.

    It holds the vocabulary's own whole words and the pieces of the most frequent words.
    """
    top = frequent_words(docs, words)
    model = WordBpe(path)
    back = {s: b for b, s in enumerate(byte_symbols())}
    whole = [bytes(back[c] for c in s[: -len(model.end)]) for s in model.vocab if s.endswith(model.end) and len(s) > len(model.end)]
    pieces = {p.encode() for w in top for p in model.pieces(w) if isinstance(p, str)}
    raw = [r for r in pieces.union(whole) if r]
    entries = dict(zip(raw, model.merge_all(raw)))
    uri = new_dir(docs.sparkSession, "lexicon") + "/lexicon.bin"
    put(uri, pack({}, Lexicon.compile(entries)))
    return uri


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode_documents(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids array<int>``, a row per input row; null texts count as empty and have no ids."""
    path = path or default_path()
    uri = build_lexicon(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")), path)
    base = id_text(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(WordBpe(path), Lexicon(unpack(uri)[1]), tuple)
        for b in batches:
            texts = list(map(split_words, b.column("text").to_pylist()))
            coder.memo.learn(chain.from_iterable(texts))
            out = [[i for x in w for i in coder.memo[x]] for w in texts]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return map_arrow(base, run, f"doc_id {dict(base.dtypes)['doc_id']}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, text``: the token strings of ``ids`` joined by spaces; ids outside the vocabulary give nothing; null ids count as none."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = WordBpe(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([model.decode(i or []) for i in b.column("ids").to_pylist()], pa.string())], ["doc_id", "text"])

    return map_arrow(encoded.select("doc_id", "ids"), run, f"doc_id {dict(encoded.dtypes)['doc_id']}, text string")


@lru_cache(maxsize=1)
def _written(path: str, uri: str) -> Coder:
    """Coder whose memo, kept for the life of a worker, holds the ids and the tokens of a word as they are written."""
    model = WordBpe(path)
    return Coder(model, Lexicon(unpack(uri)[1]), lambda ids: (" ".join(map(str, ids)), model.decode(ids)) if ids else None)


def digest_documents(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encoding and decoding in one pass, keeping digests only.

    A row per input row; null texts count as empty. Other columns are not read.
    """
    path = path or default_path()
    uri = build_lexicon(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")), path)
    base = id_text(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, sha = _written(path, uri).memo, hashlib.sha256
        for b in batches:
            n, a, d = [], [], []
            texts = list(map(split_words, b.column("text").to_pylist()))
            memo.learn(chain.from_iterable(texts))
            for w in texts:
                got = list(filter(None, map(memo.__getitem__, w)))
                ids = " ".join(map(itemgetter(0), got))
                n.append(ids.count(" ") + 1 if ids else 0)
                a.append(sha(ids.encode()).hexdigest())
                d.append(sha(" ".join(map(itemgetter(1), got)).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_arrow(base, run, f"doc_id {dict(base.dtypes)['doc_id']}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def query(spark, sf_dir: str) -> DataFrame:
    """Registered query ``op6_bpe_transducer``."""
    return digest_documents(table(spark, sf_dir, "documents"))
