"""More of the training-data operators: recall at every length, plain scorers, gradients, empty tables, long texts, clashing names."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vintara.llm import bpe, decontaminate, fingerprint, licenses, line_dedup, near_simhash, quality, token_store, toxicity, viterbi
from vintara.llm.words import Memo

SF = "/root/testdata/sf0.001"


def hashed(text):
    return decontaminate.hashes([text], Memo(lambda ws: map(decontaminate.word_hash, ws)))[0]


def slow_items(docs, items):
    """``{(document, item): similarity}`` of 0.8 or more: every item-long window of every document, with Python sets."""
    sets = [set(decontaminate.shingles(hashed(t)).tolist()) for t in items]
    lens = [len(hashed(t)) for t in items]
    shares = {}
    for s in {hashed(t).tobytes(): s for t, s in zip(items, sets)}.values():
        for x in s:
            shares[x] = shares.get(x, 0) + 1
    weigh = lambda s: sum(1 / shares.get(x, 1) for x in s)
    out = {}
    for d, text in enumerate(docs):
        h = hashed(text)
        for i, (own, n) in enumerate(zip(sets, lens)):
            if not n or not len(h):
                continue
            sh = decontaminate.shingles(h, min(5, n)).tolist()
            wide = max(1, n - min(5, n) + 1)
            for s in range(max(1, len(sh) - wide + 1)):
                win = set(sh[s : s + wide])
                got = max(len(win & own) / len(win | own), weigh(win & own) / weigh(win | own))
                if got >= 0.8 and got > out.get((d, i), 0):
                    out[d, i] = got
    return out


def test_op4_word_hashes_of_one_length_are_distinct():
    words = np.random.default_rng(1).integers(97, 123, (1_000_000, 10), np.uint8)
    some = {bytes(w).decode() for w in words}
    assert len({decontaminate.word_hash(w) for w in some}) == len(some)


def test_op4_equals_brute_force():
    r = np.random.default_rng(3)
    word = lambda k: " ".join(f"w{int(x)}" for x in r.integers(0, 4000, k))
    items = [word(int(n)) for n in r.integers(1, 70, 60)] + ["solo", "two words", "three word item", ""]
    items += [items[5], items[6] + " tail", " ".join(items[7].split()[::-1])]
    docs = []
    for _ in range(250):
        t = items[int(r.integers(0, len(items)))].split()
        for _ in range(int(r.integers(0, 3))):
            if t:
                t[int(r.integers(0, len(t)))] = "changed"
        if r.random() < 0.3:
            t = t[1:]
        docs.append(f"{word(int(r.integers(0, 60)))} {' '.join(t)} {word(int(r.integers(0, 60)))}")
    docs += ["", "solo", "w1"]
    book = decontaminate.Items(list(enumerate(items)))
    memo = Memo(lambda ws: map(decontaminate.word_hash, ws))
    got = {(d, i): s for d, i, s, _ in decontaminate.find_items(decontaminate.hashes(docs, memo), book)}
    want = slow_items(docs, items)
    assert set(got) == set(want) and len(want) > 100
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 12, 16, 24, 30, 47, 60, 120, 700])
def test_op4_finds_planted_items_of_every_length(n):
    r = np.random.default_rng(n)
    word = lambda k: [f"w{int(x)}" for x in r.integers(0, 10**12, k)]
    items = [word(n) for _ in range(60)]
    docs = [" ".join([*word(int(r.integers(0, 90))), *t, *word(int(r.integers(0, 90)))]) for t in items]
    clean = [" ".join(word(150)) for _ in range(20)]
    memo = Memo(lambda ws: map(decontaminate.word_hash, ws))
    found = decontaminate.find_items(decontaminate.hashes(docs + clean, memo), decontaminate.Items([(i, " ".join(t)) for i, t in enumerate(items)]))
    assert {(d, i) for d, i, s, _ in found if s == 1.0} == {(i, i) for i in range(60)} and all(d < 60 for d, *_ in found)


def test_op4_very_long_item():
    words = [f"w{i}" for i in range(40_000)]
    items = decontaminate.Items([("a", " ".join(words)), ("b", "x y z")])
    memo = Memo(lambda ws: map(decontaminate.word_hash, ws))
    text = " ".join(["pre", "fix", *words[:20_000], "changed", *words[20_001:], "end"])
    assert [(d, i) for d, i, *_ in decontaminate.find_items(decontaminate.hashes([text, "x y z w1"], memo), items)] == [(0, "a"), (1, "b")]


def test_op4_id_types_and_clashing_names(spark):
    docs = spark.createDataFrame([("d1", "alpha beta gamma delta epsilon zeta", 1, 2), ("d2", "none", 3, 4)], "doc_id string, text string, row int, `__text` int")
    bench = spark.createDataFrame([(1.5, "alpha beta gamma delta epsilon zeta")], "item_id double, text string")
    assert [(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, bench).collect()] == [("d1", 1.5)]
    kept = decontaminate.keep_clean(docs, bench)
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == ["d2"]
    assert decontaminate.keep_clean(docs, bench.limit(0)).count() == 2 and decontaminate.contaminated(docs.limit(0), bench).count() == 0


def test_op5_equals_plain_scorer(spark):
    d, lab = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    m = quality.learn(d, lab)
    got = {r["doc_id"]: r["score"] for r in quality.score_documents(d, m).collect()}
    for r in d.collect():
        x = quality.features(r["text"] or "")
        u = sum(w * max(-8.0, min(8.0, (v - a) / b)) for w, v, a, b in zip(m.weight, x, m.mean, m.scale))
        z = max(-40.0, min(40.0, m.slope * (u - m.cut) + math.log(0.3 / 0.7)))
        assert abs(got[r["doc_id"]] - 1 / (1 + math.exp(-z))) < 1e-9
    clash = d.withColumn("row", F.lit(1)).withColumn("__text", F.lit(2))
    assert quality.keep_good(clash, lab).columns == clash.columns and quality.keep_good(clash.limit(0), lab, d).count() == 0


def tiny_network():
    names = {"a": 1, "bb": 2, "ccc": 3}
    net = toxicity.Network.fresh(names, np.array([1.0, -0.5, 0.3]), seed=3)
    net.weights["bias"][0] = 0.2
    return net


def plain_raw(net, words):
    """Score of one window, a word and a number at a time."""
    w, h = net.weights, toxicity.HIDDEN
    vec = []
    for x in words:
        raw = b"^" + x.encode() + b"$" + b"$" * (not x)
        codes = []
        for k in toxicity.GRAMS:
            for i in range(len(raw) - k + 1):
                c = k
                for b in raw[i : i + k]:
                    c = (c + b) * 0x9E3779B97F4A7C15 % 2**64
                    c ^= c >> 29
                codes.append(c % toxicity.BUCKETS)
        spelled = sum(w["char"][c] for c in codes) / len(codes)
        vec.append(np.concatenate([w["word"][net.vocabulary.get(x, 0)], spelled]))
    states = [np.zeros(2 * h) for _ in words]
    for s, part, order in (("f", slice(0, h), range(len(words))), ("b", slice(h, 2 * h), range(len(words) - 1, -1, -1))):
        state = np.zeros(h)
        for t in order:
            x, r = vec[t] @ w["W" + s] + w["c" + s], state @ w["U" + s]
            z, q = 1 / (1 + np.exp(-(x[:h] + r[:h]))), 1 / (1 + np.exp(-(x[h : 2 * h] + r[h : 2 * h])))
            state = (1 - z) * state + z * np.tanh(x[2 * h :] + q * r[2 * h :])
            states[t][part] = state
    e = np.array([s @ w["att"] for s in states])
    a = np.exp(e - e.max())
    return float((a / a.sum()) @ np.array([s @ w["out"] for s in states]) + w["bias"][0])


DOCS10 = [["a", "bb", "x", "a"], ["ccc"], ["y", "zz", "bb"]]


def test_op10_equals_plain_scorer():
    net = tiny_network()
    got = toxicity.Scorer(net).raw([" ".join(d) for d in DOCS10])
    assert np.allclose(got, [plain_raw(net, d) for d in DOCS10], atol=1e-4)
    long = [f"w{i}" for i in range(150)]
    assert abs(toxicity.Scorer(net).raw([" ".join(long)])[0] - max(plain_raw(net, long[s : s + 64]) for s in toxicity.windows(150))) < 1e-4


def test_op10_gradient():
    net, y = tiny_network(), np.array([1.0, 0.0, 1.0])
    g = net.step(DOCS10, y)

    def loss():
        return sum(math.log1p(math.exp(-r if k else r)) for r, k in ((plain_raw(net, d), k) for d, k in zip(DOCS10, y))) / 3

    r = np.random.default_rng(0)
    for name, w in net.weights.items():
        flat = np.flatnonzero(np.abs(g[name].ravel()) > 0) if name in ("char", "word") else np.arange(w.size)
        for i in r.choice(flat, min(6, len(flat)), replace=False):
            old = w.flat[i]
            w.flat[i] = old + 1e-5
            up = loss()
            w.flat[i] = old - 1e-5
            down = loss()
            w.flat[i] = old
            assert abs((up - down) / 2e-5 - g[name].flat[i]) < 1e-6, name


ONE = "doc_id long, text string"


def test_empty_tables(spark):
    d = spark.createDataFrame([], ONE)
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    outs = [near_simhash.near_duplicates(d), near_simhash.keep_one(d), line_dedup.dedup_lines(d), token_store.write_store(d).read(spark), quality.keep_good(d, lab), bpe.digest_documents(d), licenses.scan(d), viterbi.count_tokens(d), fingerprint.report(d), toxicity.score_documents(d, toxicity.learn(d, lab))]
    assert [x.count() for x in outs] == [0] * len(outs)


def test_long_text_beside_null_and_repeats(spark):
    long = " ".join(f"word{i % 977}" for i in range(60_000)) + "\n" + "x" * 20_000
    d = spark.createDataFrame([(1, long), (2, None), (3, ""), (3, ""), (4, long)], ONE).withColumn("id", F.lit(1)).withColumn("row", F.lit(2)).withColumn("h", F.lit(3))
    n = {r["doc_id"]: r["n_dropped"] for r in line_dedup.dedup_lines(d).collect()}
    assert n == {1: 0, 2: 0, 3: 0, 4: 2}
    kept = near_simhash.keep_one(d)
    assert kept.columns == d.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2]
    assert bpe.digest_documents(d).count() == fingerprint.report(d).count() == licenses.scan(d).count() == viterbi.count_tokens(d).count() == 5
    assert token_store.write_store(d).read(spark).count() == 5


def test_lexicon_words_are_the_most_frequent(spark):
    d = spark.createDataFrame([(1, "a a a a b b b c c d"), (2, "a b e e")], ONE)
    assert sorted(bpe.frequent_words(d, 3)) == ["a", "b"] and sorted(bpe.frequent_words(d, 4)) == ["a", "b", "c", "e"] and bpe.frequent_words(d, 0) == []


def test_quality_learns_from_every_label(spark, monkeypatch):
    """The model and the cut follow from all learnable rows, by a plain fit over the same pairs, and far more rows than 3,000 a class count."""
    r = np.random.default_rng(4)
    rows = [(i, "good words stand here " * int(r.integers(1, 9)) if y else "BAD!! #$ " * int(r.integers(1, 9)) + "x" * int(r.integers(0, 30)), y) for i in range(9000) for y in [int(r.random() < 0.5)]]
    d, lab = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string"), spark.createDataFrame([(x[0], x[2]) for x in rows], "doc_id long, quality int")
    seen = []
    fitted = quality.fit
    monkeypatch.setattr(quality, "fit", lambda g, *a: seen.append(g.selectExpr("sum(size(y))").first()[0]) or fitted(g, *a))
    m = quality.learn(d, lab)
    known = [(x, y) for i, x, y in rows if zlib.crc32(str(i).encode()) % 5]
    assert seen == [len(known)] and len(known) > 6500
    x = np.array([quality.features(t) for t, _ in known])
    assert np.allclose(m.mean, x.mean(0)) and np.allclose(m.scale, np.where(x.std(0) > 1e-9, x.std(0), 1))
    u, n0 = np.sort(m.utility(x)), sum(y == 0 for _, y in known)
    assert m.cut == pytest.approx((u[n0 - 1] + u[n0]) / 2)
