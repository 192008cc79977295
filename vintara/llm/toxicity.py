"""Operator 10: toxicity by a bidirectional gated recurrent network with attention pooling.

Each word is a vector: an embedding of the word, if the training rows have it often enough,
beside the mean embedding of the runs of three and of five bytes in it. Two gated recurrent layers read a window
of words in both directions, attention pools their states, and a logistic unit scores the
window. A document is scored on all of its overlapping windows and has the highest score.
Network and training are numpy; training is multiple-instance: of a toxic document, the
window that the network holds for most toxic counts.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, map_arrow, table
from .quality import held_out, labelled_sample
from .words import Memo

CUT = 0.7
#: Most labelled rows of each class that the network is trained on, and most words it knows by themselves.
SAMPLE_PER_CLASS, VOCABULARY = 1000, 4096
WINDOW, STEP = 64, 48
HIDDEN, WORD_DIM, CHAR_DIM, BUCKETS = 8, 6, 6, 8192
#: Lengths of the runs of bytes that a word's spelling is read in.
GRAMS = (3, 5)
#: Windows that go through the network at a time.
BATCH = 4096


def bare(word: str) -> str:
    """A word's letters and digits in lower case."""
    return (word if word.isalnum() else "".join(c for c in word if c.isalnum())).lower()


def gram_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the runs of ``GRAMS`` bytes of all words, one word after another, with where each word's begin; ``^`` and ``$`` stand at the ends."""
    raw = [b"^" + w.encode() + b"$" + b"$" * (not w) for w in words]
    flat = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64)
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    word, left = np.repeat(np.arange(len(raw)), size), np.repeat(np.cumsum(size), size) - np.arange(len(flat))
    codes, owners = [], []
    for k in GRAMS:
        at = np.flatnonzero(left >= k)
        x = np.full(len(at), k, np.uint64)
        with np.errstate(over="ignore"):
            for i in range(k):
                x = (x + flat[at + i]) * np.uint64(0x9E3779B97F4A7C15)
                x ^= x >> np.uint64(29)
        codes.append((x & np.uint64(BUCKETS - 1)).astype(np.int64))
        owners.append(word[at])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(codes)[order], np.searchsorted(owner[order], np.arange(len(raw)))


def windows(n: int) -> list[int]:
    """First words of the overlapping windows over ``n`` words; the last one ends with the text."""
    return [0] if n <= WINDOW else [*range(0, n - WINDOW, STEP), n - WINDOW]


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """Weights. Input projections of a direction are laid out as update, reset, candidate."""

    vocabulary: dict[str, int]
    weights: dict[str, np.ndarray]
    shift: float = 0.0
    slope: float = 1.0
    #: True where there was nothing to learn from: every score is 0.5.
    even: bool = False

    @staticmethod
    def fresh(vocabulary: dict[str, int], lean: np.ndarray, seed: int = 5) -> Network:
        """Random weights; the first entry of a word's embedding is ``lean``, its log odds in the training rows."""
        r = np.random.default_rng(seed)
        d, h = WORD_DIM + CHAR_DIM, HIDDEN
        w = {"word": 0.1 * r.standard_normal((len(vocabulary) + 1, WORD_DIM)), "char": 0.1 * r.standard_normal((BUCKETS, CHAR_DIM)), "att": 0.3 * r.standard_normal(2 * h), "out": 0.3 * r.standard_normal(2 * h), "bias": np.zeros(1)}
        w["word"][0], w["word"][1:, 0] = 0, lean
        for s in "fb":
            w["W" + s], w["U" + s], w["c" + s] = r.standard_normal((d, 3 * h)) / math.sqrt(d), r.standard_normal((h, 3 * h)) / math.sqrt(h), np.zeros(3 * h)
        return Network(vocabulary, w)

    def vectors(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
        """Input vector of each bare word, its row in the vocabulary, and its runs of bytes."""
        row = np.array([self.vocabulary.get(w, 0) for w in words], np.int64)
        code, first = gram_rows(words)
        count = np.diff(np.append(first, len(code)))
        mean = np.add.reduceat(self.weights["char"][code], first) / count[:, None]
        return np.concatenate([self.weights["word"][row], mean], 1), row, (code, first)

    def projected(self, words: list[str]) -> np.ndarray:
        """Input projections of bare words for both directions, ``6 * HIDDEN`` wide."""
        x = self.vectors(words)[0]
        return np.concatenate([x @ self.weights["W" + s] + self.weights["c" + s] for s in "fb"], 1).astype(np.float32)

    def score_windows(self, rows: np.ndarray, table_: np.ndarray) -> np.ndarray:
        """Raw scores of windows; ``rows`` (words x windows) index ``table_``, whose row 0 is padding."""
        h, n = HIDDEN, rows.shape[1]
        w = {k: v.astype(np.float32) for k, v in self.weights.items() if k in ("Uf", "Ub", "att", "out")}
        energy = np.zeros((rows.shape[0], n), np.float32)
        value = np.zeros_like(energy)
        for s, cols, order in (("f", slice(0, 3 * h), range(rows.shape[0])), ("b", slice(3 * h, 6 * h), range(rows.shape[0] - 1, -1, -1))):
            own, u = np.ascontiguousarray(table_[:, cols]), w["U" + s]
            part = slice(0, h) if s == "f" else slice(h, 2 * h)
            head = np.stack([w["att"][part], w["out"][part]], 1)
            state = np.zeros((n, h), np.float32)
            for t in order:
                x, r = own[rows[t]], state @ u
                gate = x[:, : 2 * h]
                gate += r[:, : 2 * h]
                gate *= 0.5
                np.tanh(gate, out=gate)
                gate *= 0.5
                gate += 0.5
                cand = r[:, 2 * h :]
                cand *= gate[:, h:]
                cand += x[:, 2 * h :]
                np.tanh(cand, out=cand)
                cand -= state
                cand *= gate[:, :h]
                state += cand
                both = state @ head
                energy[t] += both[:, 0]
                value[t] += both[:, 1]
        energy[rows == 0] = -1e9
        energy -= energy.max(0)
        np.exp(energy, out=energy)
        return (energy * value).sum(0) / energy.sum(0) + np.float32(self.weights["bias"][0])

    def probability(self, raw: np.ndarray) -> np.ndarray:
        """Document scores from raw ones: the cut between the classes is at ``CUT``."""
        if self.even:
            return np.full(len(raw), 0.5)
        return 1 / (1 + np.exp(-np.clip(self.slope * (raw - self.shift) + math.log(CUT / (1 - CUT)), -40, 40)))

    def step(self, docs: list[list[str]], y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the mean logistic loss over windows given as bare words."""
        g = {k: np.zeros_like(v) for k, v in self.weights.items()}
        w, h, n = self.weights, HIDDEN, len(docs)
        index: dict[str, int] = {}
        for d in docs:
            for x in d:
                index.setdefault(x, len(index) + 1)
        rows = np.zeros((max(map(len, docs)), n), np.int64)
        for i, d in enumerate(docs):
            rows[: len(d), i] = [index[x] for x in d]
        mask = (rows > 0).astype(float)
        names = list(index)
        vec, vocab_row, (code, first) = self.vectors(names)
        vec = np.concatenate([np.zeros((1, vec.shape[1])), vec])
        saved, states = {}, np.zeros((rows.shape[0], n, 2 * h))
        for s in "fb":
            proj = vec @ w["W" + s] + w["c" + s]
            order = range(rows.shape[0]) if s == "f" else range(rows.shape[0] - 1, -1, -1)
            state, log = np.zeros((n, h)), []
            for t in order:
                x, r = proj[rows[t]], state @ w["U" + s]
                z, q = _sigmoid(x[:, :h] + r[:, :h]) * mask[t][:, None], _sigmoid(x[:, h : 2 * h] + r[:, h : 2 * h])
                c = np.tanh(x[:, 2 * h :] + q * r[:, 2 * h :])
                log.append((t, state, z, q, c, r[:, 2 * h :]))
                state = state + z * (c - state)
                states[t][:, slice(0, h) if s == "f" else slice(h, 2 * h)] = state
            saved[s] = log
        e = np.where(mask > 0, states @ w["att"], -1e9)
        a = np.exp(e - e.max(0))
        a /= a.sum(0)
        v = states @ w["out"]
        raw = (a * v).sum(0) + w["bias"][0]
        d_raw = (_sigmoid(raw) - y) / n
        g["bias"][0] = d_raw.sum()
        d_v = a * d_raw
        d_e = a * (v - (a * v).sum(0)) * d_raw
        g["out"], g["att"] = np.einsum("tn,tnk->k", d_v, states), np.einsum("tn,tnk->k", d_e, states)
        d_states = d_v[:, :, None] * w["out"] + d_e[:, :, None] * w["att"]
        d_vec = np.zeros_like(vec)
        for s in "fb":
            d_proj = np.zeros((len(vec), 3 * h))
            back = np.zeros((n, h))
            for t, prev, z, q, c, rc in reversed(saved[s]):
                d = back + d_states[t][:, slice(0, h) if s == "f" else slice(h, 2 * h)]
                d_c = d * z * (1 - c * c)
                m = mask[t][:, None]
                d_z = d * (c - prev) * z * (1 - z) * m
                d_q = d_c * rc * q * (1 - q)
                d_in = np.concatenate([d_z, d_q, d_c], 1)
                d_r = np.concatenate([d_z, d_q, d_c * q], 1)
                g["U" + s] += prev.T @ d_r
                back = d * (1 - z) + d_r @ w["U" + s].T
                np.add.at(d_proj, rows[t], d_in)
            d_proj[0] = 0
            g["W" + s], g["c" + s] = vec.T @ d_proj, d_proj.sum(0)
            d_vec += d_proj @ w["W" + s].T
        d_vec = d_vec[1:]
        np.add.at(g["word"], vocab_row, d_vec[:, :WORD_DIM])
        g["word"][0] = 0
        count = np.diff(np.append(first, len(code)))
        np.add.at(g["char"], code, np.repeat(d_vec[:, WORD_DIM:] / count[:, None], count, 0))
        return g


class Scorer:
    """Scores whole texts with a network; projections of words are remembered, boundedly."""

    def __init__(self, net: Network, most: int = 120_000):
        self.net = net
        pad = np.zeros((1, 6 * HIDDEN), np.float32)
        pad[:, :HIDDEN] = pad[:, 3 * HIDDEN : 4 * HIDDEN] = -60  # an update gate of zero: padding changes no state
        self.table, self.used = np.concatenate([pad, np.zeros((2 * most, 6 * HIDDEN), np.float32)]), 1
        self.memo = Memo(self._rows, most)

    def _rows(self, words: list[str]) -> Iterator[int]:
        if self.used + len(words) > len(self.table):
            if self.memo:
                raise RuntimeError("rows of remembered words would be lost")
            self.table = np.concatenate([self.table[:1], np.zeros((len(words), 6 * HIDDEN), np.float32)])
            self.used = 1
        at = self.used
        self.table[at : at + len(words)] = self.net.projected([bare(w) for w in words])
        self.used += len(words)
        return iter(range(at, at + len(words)))

    def window_scores(self, split: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Raw scores of all windows of texts given as words, and the text that each belongs to; a text without words has one window of padding."""
        fresh = {w for ws in split for w in ws}
        new = sum(w not in self.memo for w in fresh)
        if self.used + new > len(self.table) or len(self.memo) + new > self.memo.most:
            self.memo.clear()
            self.used = 1
        self.memo.learn(fresh)
        owner, cols = [], []
        for i, ws in enumerate(split):
            r = np.fromiter(map(self.memo.__getitem__, ws), np.int32, len(ws))
            if len(r) < WINDOW:
                r = np.concatenate([r, np.zeros(WINDOW - len(r), np.int32)])
            starts = windows(len(ws))
            cols.append(np.lib.stride_tricks.sliding_window_view(r, WINDOW)[starts])
            owner.append(np.full(len(starts), i))
        at, rows = np.concatenate(owner), np.concatenate(cols)
        out = np.empty(len(rows), np.float32)
        order = np.argsort((rows > 0).sum(1), kind="stable")
        for i in range(0, len(order), BATCH):
            pick = order[i : i + BATCH]
            part = np.ascontiguousarray(rows[pick].T)
            tall = max(1, int((part > 0).sum(0).max()))
            out[pick] = self.net.score_windows(part[:tall], self.table)
        return out, at

    def raw(self, texts: list[str]) -> np.ndarray:
        """Highest raw score over all windows of each text."""
        out = np.full(len(texts), -np.inf)
        if len(texts):
            score, at = self.window_scores([t.split() for t in texts])
            np.maximum.at(out, at, score)
        return out


def train(texts: list[str], y: np.ndarray, epochs: int = 10, batch: int = 48, rate: float = 0.02, decay: float = 0.1, seed: int = 5) -> Network:
    """Fit the network and calibrate it; without both classes every score is 0.5."""
    words = [[bare(w) for w in t.split()] for t in texts]
    toxic, clean = Counter(), Counter()
    for ws, k in zip(words, y):
        (toxic if k else clean).update(set(ws))
    n1, n0 = max(1, int(y.sum())), max(1, int((1 - y).sum()))
    def odds(w: str) -> float:
        """Log odds of a word, drawn to zero by twice their standard error."""
        a, b = toxic[w] + 0.5, clean[w] + 0.5
        x = math.log(a / n1) - math.log(b / n0)
        return math.copysign(max(0.0, abs(x) - 2 * math.sqrt(1 / a + 1 / b)), x)

    lean_of = {w: x for w in toxic.keys() | clean.keys() if w and toxic[w] + clean[w] >= 5 and (x := odds(w))}
    common = sorted(lean_of, key=lambda w: (-abs(lean_of[w]), w))[:VOCABULARY]
    lean = np.array([lean_of[w] for w in common])
    net = Network.fresh({w: i + 1 for i, w in enumerate(common)}, lean)
    if not y.sum() or not (1 - y).sum():
        net.slope, net.shift, net.even = 0.0, 0.0, True
        return net
    rng = np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in net.weights.items()}
    v = {k: np.zeros_like(x) for k, x in net.weights.items()}
    t = 0
    for epoch in range(epochs):
        # of each document the window that looks worst: by the words' log odds at first, by the network later
        starts = [windows(len(ws) or 1) for ws in words]
        if epoch:
            score, at = Scorer(net).window_scores(words)
            worst = [int(np.argmax(score[a:b])) for a, b in zip(np.searchsorted(at, np.arange(len(words))), np.searchsorted(at, np.arange(len(words)), "right"))]
        else:
            odds = [[lean[net.vocabulary[w] - 1] if w in net.vocabulary else 0.0 for w in ws] or [0.0] for ws in words]
            worst = [int(np.argmax([max(o[s : s + WINDOW]) for s in ss])) for o, ss in zip(odds, starts)]
        chosen, target = [], []
        for i in rng.permutation(len(words)).tolist():
            pick = worst[i] if y[i] or rng.random() < 0.7 else int(rng.integers(len(starts[i])))
            chosen.append((words[i] or [""])[(s := starts[i][pick]) : s + WINDOW])
            target.append(y[i])
        for b in range(0, len(chosen), batch):
            g = net.step(chosen[b : b + batch], np.array(target[b : b + batch], float))
            t += 1
            for k in g:
                m[k] += 0.1 * (g[k] - m[k])
                v[k] += 0.001 * (g[k] ** 2 - v[k])
                net.weights[k] *= 1 - decay * rate * (k in ("word", "char", "Wf", "Wb"))
                net.weights[k] -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    score, at = Scorer(net).window_scores(words)
    raw = np.full(len(words), -np.inf)
    np.maximum.at(raw, at, score)
    bad, good = np.sort(raw[y == 1]), np.sort(raw[y == 0])
    cuts = np.unique(raw)
    wrong = np.searchsorted(bad, cuts, "right") / len(bad) + 1 - np.searchsorted(good, cuts, "right") / len(good)
    least = np.flatnonzero(wrong == wrong.min())
    i = int(least[-1])
    net.shift = float((cuts[int(least[0])] + cuts[min(i + 1, len(cuts) - 1)]) / 2)
    return net


def learn(docs: DataFrame, labels: DataFrame) -> Network:
    """Train on a bounded sample of the learnable labels, whose texts come to the driver (at most ``2 * SAMPLE_PER_CLASS``)."""
    sample, _ = labelled_sample(docs, labels, "toxic", 3, 1, SAMPLE_PER_CLASS)
    got = sorted({(r["label"], r["doc_id"], r["text"]) for r in sample.toLocalIterator()})
    return train([r[2] for r in got], np.array([r[0] for r in got], int))


#: The scorer of the network that this worker last used.
_SCORERS: dict[str, Scorer] = {}


def score_documents(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score``, a row per input row; null texts count as empty, other columns are not read."""
    base = id_text(docs, id_col, text_col)
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[name] = Scorer(net)
        for b in batches:
            raw = _SCORERS[name].raw(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(net.probability(raw), pa.float64())], ["doc_id", "score"])

    return map_arrow(base, run, f"doc_id {dict(base.dtypes)['doc_id']}, score double")


def query(spark, sf_dir: str) -> DataFrame:
    """Registered query ``op10_toxicity``."""
    docs = table(spark, sf_dir, "documents")
    out = score_documents(docs, learn(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
