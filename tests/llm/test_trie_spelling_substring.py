"""Operators 11 to 13 against brute force: hot groups, small blocks, nulls, ties, repeated rows, empty tables, clashing names."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vintara.llm import conversation_trie, spelling, substring_dedup


def slow_trie(rows):
    """``(depth, conv_id, ...)`` rows of the trie of ``rows`` (conv_id, turn, role, text), node by node."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [x[3:] for x in sorted(t)] for c, t in own.items()}
    made = {c: own.get(c - int(np.fmod(c, 100)), [])[: zlib.crc32(str(c).encode()) % 6] + t[zlib.crc32(str(c).encode()) % 6 :] for c, t in own.items()}
    members, kids = defaultdict(list), defaultdict(set)
    for c, t in made.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
            if d:
                kids[tuple(t[: d - 1])].add(tuple(t[:d]))

    def below(p):
        return [p] + [x for k in kids[p] for x in below(k)]

    out = []
    for p, m in members.items():
        under = below(p)
        ends = sorted(c for c in m if len(made[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), sum(not kids[x] for x in under), sum((len(members[x]) - 1) * (len(x[-1][1]) if x else 0) for x in under), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.mark.parametrize("partitions", ["1", "7", "64"])
def test_op11_equals_brute_force(spark, partitions):
    r = np.random.default_rng(5)
    rows = []
    for c in range(0, 420):
        for turn in range(int(r.integers(0, 9))):
            # a third of the conversations say the same for long
            word = "same" if c % 3 == 0 and turn < 6 else f"t{int(r.integers(0, 3))}é"
            rows.append((c, None if turn == 0 and c % 7 == 0 else turn, None if c % 11 == 0 else "user", None if r.random() < 0.1 else word * turn))
    rows += [(None, 0, "user", "lost"), (150, 3, "user", "tie"), (150, 3, "user", "tie"), (-5, 0, "a", "b"), (901, 0, "x", "y")]
    rows += [(500 + i, 0, "user", "copy") for i in range(120)]
    was = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("depth", F.lit("clash"))
        got = sorted([tuple(x) for x in conversation_trie.trie(conversation_trie.rebuilt(df)).select(*COLUMNS).collect()], key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was[1])
    assert got == slow_trie(rows)


def test_op11_long_and_empty(spark):
    rows = [(c, t, "u", f"turn {t}") for c in (600, 601, 602) for t in range(1500)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = conversation_trie.trie(conversation_trie.rebuilt(df))
    assert out.count() == 1501 and out.where("n_convs = 3 and n_leaves = 1").count() == 1501
    assert conversation_trie.trie(conversation_trie.rebuilt(df.where("false"))).count() == 0


def slow_spelling(docs):
    n = Counter()
    for d, text in docs:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for w in spelling.RUN.findall(low):
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            n[w if h % 97 else w[: h % len(w)] + w[h % len(w) + 1 :]] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    near = lambda a, b: a != b and (len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1 or abs(len(a) - len(b)) == 1 and any((max(a, b, key=len)[:i] + max(a, b, key=len)[i + 1 :]) == min(a, b, key=len) for i in range(max(len(a), len(b)))))
    beside = {w: [x for x in n if near(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(beside[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    root = lambda w: w if form[w] is None else root(form[w])
    return sorted((w, form[w], root(w), n[w], len(beside[w]), n[form[w]] if form[w] else None) for w in n)


@pytest.mark.parametrize("full", [3, 256])
def test_op12_equals_brute_force(spark, full, monkeypatch):
    r = np.random.default_rng(9)
    monkeypatch.setattr(spelling, "HELD", 40)
    stems = ["prefixed", "prefix", "straße", "aaaaaa", "aaaaa", "Éclairs", "interstate"]
    words = []
    for _ in range(900):
        w = list(stems[int(r.integers(0, len(stems)))])
        for _ in range(int(r.integers(0, 3))):
            at = int(r.integers(0, len(w)))
            kind = int(r.integers(0, 3))
            if kind == 0:
                w[at] = "abéz"[int(r.integers(0, 4))]
            elif kind == 1:
                w.insert(at, "axé"[int(r.integers(0, 3))])
            elif len(w) > 2:
                del w[at]
        words.append("".join(w))
    docs = [(i, " ".join(words[int(j)] for j in r.integers(0, len(words), 60)) + " 12,Prefix—prefix") for i in range(90)]
    docs += [(None, "straße " * 7), (None, None), (7, ""), (8, docs[8][1]), (1000, "q" * 5000 + " " + ("q" * 4999 + " ") * 4 + ("q" * 5000 + " ") * 8)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("word", F.lit("clash"))
    near = spelling.near_words
    monkeypatch.setattr(spelling, "near_words", lambda w: near(w, full))
    got = sorted(tuple(x) for x in spelling.variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect())
    assert got == slow_spelling(docs)


def test_op12_full_bucket_and_empty(spark):
    words = spark.createDataFrame([("commonprefix" + chr(97 + i // 26) + chr(97 + i % 26), 3 + i) for i in range(500)], "word string, n long")
    pairs = spelling.near_words(words, full=8)
    two = [divmod(i, 26) for i in range(500)]
    assert pairs.count() == sum((a[0] == b[0]) != (a[1] == b[1]) for i, a in enumerate(two) for b in two[:i])
    assert spelling.variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def slow_repeats(docs):
    split = [(d, (t or "").encode().split()) for d, t in docs]
    rank = lambda d: (d is not None, d or 0)
    first = {}
    for d, ws in split:
        for i in range(len(ws) - 19):
            w = tuple(ws[i : i + 20])
            first[w] = min(first.get(w, (rank(d), i)), (rank(d), i))
    out = []
    for d, ws in split:
        gone = {j for i in range(len(ws) - 19) if first[tuple(ws[i : i + 20])] < (rank(d), i) for j in range(i, i + 20)}
        kept = b" ".join(w for j, w in enumerate(ws) if j not in gone)
        out.append((d, len(ws), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def planted(r, n=160):
    word = lambda k: [f"w{int(x)}" for x in r.integers(0, 60, k)]
    shared = [word(int(k)) for k in r.integers(19, 70, 12)] + [["the"] * 90, ["a", "b"] * 40]
    docs = []
    for i in range(n):
        t = []
        for _ in range(int(r.integers(0, 5))):
            p = list(shared[int(r.integers(0, len(shared)))] if r.random() < 0.8 else shared[0])
            if r.random() < 0.4:
                p[int(r.integers(0, len(p)))] = "changed"
            t += word(int(r.integers(0, 30))) + p[int(r.integers(0, 8)) :]
        docs.append((i, " ".join(t)))
    return docs


@pytest.mark.parametrize(("full", "block"), [(256, 1 << 18), (2, 100), (0, 100)])
def test_op13_equals_brute_force(spark, full, block, monkeypatch):
    docs = planted(np.random.default_rng(full + 1))
    docs += [(i, docs[3][1]) for i in range(200, 260)]  # copies
    docs += [(None, None), (None, docs[5][1]), (7, docs[7][1]), (8, docs[9][1] + " more"), (300, ""), (301, "\t\x0b "), (302, "x y " * 30), (303, " ".join(f"u{i % 700}" for i in range(3000)))]
    monkeypatch.setattr(substring_dedup, "FULL", full)
    spans = substring_dedup.repeated_spans
    monkeypatch.setattr(substring_dedup, "repeated_spans", lambda d: spans(d, full))
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"k": F.lit(1), "n_words": F.lit("clash"), "spans": F.lit("x")})
    out = substring_dedup.remove_repeats(df)
    assert {"k", "spans"} <= set(out.columns)
    got = sorted([tuple(x) for x in out.select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256)).collect()], key=repr)
    assert got == slow_repeats(docs)


def test_op13_blocks_are_parsed_in_small_pieces(monkeypatch):
    monkeypatch.setattr(substring_dedup, "WINDOW", 20)
    r = np.random.default_rng(1)
    base = r.integers(0, 1 << 62, 33)
    block = [base, base[5:], np.r_[base[:24], r.integers(0, 9, 6)], r.integers(0, 1 << 62, 25)]
    ref = substring_dedup.Reference(block)
    got = [list(ref.factors(p, lambda q, j, i: True)) for p in range(4)]
    assert got == [[], [(0, 28)], [(0, 24)], []]


def test_op13_empty(spark):
    assert substring_dedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
