"""Training-data operators against brute force, the tokenizers library, and defined edge cases."""

import hashlib
import re
import textwrap
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from vintara.llm import bpe, decontaminate, fingerprint, licenses, line_dedup, minhash, near_simhash, quality, token_store, toxicity, viterbi
from vintara.llm.components import connected_components

SF = "/root/testdata/sf0.001"
EDGES = [(1, "The cat sat on the mat."), (1, "The cat sat on the mat."), (2, ""), (3, None), (None, "The cat sat on the mat. "), (4, "日本語 テキスト"), (5, "word " * 5000), (6, "a\x1cb \x85 É <|endoftext|> x")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGES, "doc_id long, text string").withColumn("fp", F.lit(1)).withColumn("key", F.lit("x")).withColumn("k", F.lit(2))


def word_tokenizer():
    t = Tokenizer.from_file(bpe.default_path())
    t.no_truncation()
    t.no_padding()
    return t


def simhash(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    sh = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << j for j in range(64) if 2 * sum(x >> j & 1 for x in h) > len(h))


def classes(fps, ids, radius=3):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    group = {}
    for i, d in enumerate(ids):
        if d is not None:
            group.setdefault(find(i), []).append(d)
    return [min(group[find(i)]) if find(i) in group else None for i in range(len(ids))]


@pytest.mark.parametrize("which", ["docs", "edge"])
def test_op1_equals_brute_force(which, request):
    df = request.getfixturevalue(which)
    data = [(r["doc_id"], simhash(r["text"])) for r in df.collect()]
    want = sorted(zip([d for d, _ in data], [f"{f:016x}" for _, f in data], classes([f for _, f in data], [d for d, _ in data])), key=str)
    assert sorted(map(tuple, near_simhash.near_duplicates(df).collect()), key=str) == want


def test_op1_trees_lose_no_pair(spark):
    r = np.random.default_rng(1)
    base = r.integers(0, 1 << 63, 300).astype(np.uint64)
    near = np.concatenate([base, *[base ^ (np.uint64(1) << r.integers(0, 64, 300).astype(np.uint64)) ^ (np.uint64(1) << r.integers(0, 64, 300).astype(np.uint64)) for _ in range(3)]])
    fps = np.unique(near).tolist()
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    edges = near_simhash.link_fingerprints(df, shard=64)
    comp = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    mine = [comp.get(int(np.uint64(f).view(np.int64)), int(np.uint64(f).view(np.int64))) for f in fps]
    want = classes(fps, list(range(len(fps))))
    assert len(set(zip(mine, want))) == len(set(mine)) == len(set(want))


def test_components(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5), (None, 3)], "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(chain).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert connected_components(chain.limit(0)).count() == 0


def test_op2_lines(spark):
    a = "the quick brown fox jumps over the lazy dog near the river bank at dawn every single day of the long warm summer while birds sing above the old stone mill and children play by the bridge"
    near = a.replace("lazy", "sleepy")
    df = spark.createDataFrame([(1, f"{a}\n\nunique one here"), (2, f"{near}\nanother line"), (3, f"{a}\n"), (4, None), (5, "")], "doc_id long, text string").withColumn("k", F.lit(1)).withColumn("line", F.lit(1))
    got = {r["doc_id"]: (r["text"], r["n_dropped"]) for r in line_dedup.dedup_lines(df).collect()}
    assert got == {1: (f"{a}\n\nunique one here", 0), 2: ("another line", 1), 3: ("", 1), 4: (None, 0), 5: ("", 0)}
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_op2_compares_whole_words(spark):
    han = "一二三四五六七八九十甲乙丙丁戊己庚辛"
    lines = ["- https://github.com/org/alpha", "- https://github.com/net/gamma", "See https://example.com/report-2021.pdf", "See https://example.com/terms", "https://abc.io/page/1", "https://abc.io/page/2", f"{han} {han[:9]}子丑寅卯辰巳午未申", f"{han} {han[:9]}天地玄黄宇宙洪荒日", "ab\u2028cd", "ab\u2028ef"]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    assert [r["text"] for r in line_dedup.dedup_lines(df).orderBy("doc_id").collect()] == lines


def test_op2_recall(docs):
    base = docs.select("doc_id", "text")
    text = {hashlib.md5(r["line"].encode()).digest(): r["line"] for r in line_dedup.lines_of(base).collect()}
    shingle = lambda s: set(re.findall(r"(?=(.{14}))", s)) or {s}  # noqa: E731  every place, as op2's contract of round 3 says; word starts alone before
    sets = {k: shingle(v) for k, v in text.items()}
    ids, want = sorted(sets), set()
    for i, x in enumerate(ids):
        for y in ids[i + 1 :]:
            a, b = sets[x], sets[y]
            if 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and len(a & b) >= 0.8 * len(a | b):
                want.add((x, y))
    root = {bytes(r["key"]): r["g"] for r in line_dedup.line_groups(base).collect()}
    assert sum(x in root and root.get(x) == root.get(y) for x, y in want) >= 0.95 * len(want)


def test_op2_loses_no_pair(spark):
    r = np.random.default_rng(5)
    vocabulary = [f"{a}{b}" for a in "bdfglmn" for b in ("ara", "ero", "ilu", "onte")]
    phrases = [" ".join(r.choice(vocabulary, 5)) for _ in range(20)]
    lines = [" ".join(r.choice(phrases, 12, replace=False)) for _ in range(700)]
    for i in range(150):
        w = lines[i].split()
        w[int(r.integers(0, len(w)))] = "changed"
        lines.append(" ".join(w))
    lines = sorted(set(lines))
    sets = [set(re.findall(r"(?<!\S)(?=(\S.{0,15}))", x)) for x in lines]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    root = {bytes(r["key"]): r["g"] for r in line_dedup.line_groups(df).collect()}
    mine = [root.get(hashlib.md5(x.encode()).digest(), x) for x in lines]
    up = list(range(len(lines)))
    for i, a in enumerate(sets):
        for j in range(i):
            if 5 * len(a & sets[j]) >= 4 * len(a | sets[j]) and up[i] != up[j]:
                old, new = max(up[i], up[j]), min(up[i], up[j])
                up = [new if x == old else x for x in up]
    assert len(set(up)) <= len(lines) - 150
    assert len(set(zip(mine, up))) == len(set(mine)) == len(set(up))


def test_minhash_join_equals_brute_force(spark, monkeypatch):
    r = np.random.default_rng(9)
    monkeypatch.setattr(minhash, "BLOCK", 8)
    monkeypatch.setattr(minhash, "FULL", 6)
    base = [set(r.choice(60, int(r.integers(1, 25)), replace=False).tolist()) for _ in range(150)]
    sets = [*base, *base[:20], *[{*list(b)[1:], 99} for b in base if len(b) > 8], *[{*range(12), 100 + i} - {i % 12} for i in range(60)], set()]
    df = spark.createDataFrame([(i, sorted(s)) for i, s in enumerate(sets)], "id long, set array<long>")
    hashed = F.transform("set", lambda x: F.xxhash64(x))
    comp = {x["node"]: x["component"] for x in connected_components(minhash.similar_links(minhash.sketched(df, hashed), hashed)).collect()}
    up = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and 5 * len(a & sets[j]) >= 4 * len(a | sets[j]) and up[i] != up[j]:
                old, new = max(up[i], up[j]), min(up[i], up[j])
                up = [new if x == old else x for x in up]
    assert [comp.get(i, i) for i in range(len(sets))] == up and len(set(up)) < len(sets) - 30
    assert minhash.similar_links(minhash.sketched(df.limit(0), hashed), hashed).count() == 0


@pytest.mark.parametrize("which", ["docs", "edge"])
def test_op3_round_trip(which, request, spark):
    df = request.getfixturevalue(which)
    t = word_tokenizer()
    store = token_store.write_store(df)
    got = sorted(store.read(spark).collect(), key=lambda r: r["start"])
    want = [(r["doc_id"], [*t.encode(r["text"] or "", add_special_tokens=False).ids, 2]) for r in df.collect()]
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in got) == sorted((str(d), len(i), crc(i)) for d, i in want)
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    keys = [-1 if r["doc_id"] is None else r["doc_id"] for r in got]
    assert keys == sorted(keys)
    for d, ids in want[:20]:
        if d is not None:
            assert any(x.tolist() == ids for x in store.get(d))
    assert store.get(10**12) == []
    assert token_store.write_store(df.limit(0)).read(spark).count() == 0


def test_op3_words_and_marks(spark):
    odd = ["İ& ñtaas,!! Ciónjaar&&& don't, a<|endoftext|>, ß. ǅ! ª# x-y, 12&& &", "é'll. E\u0301, e\u0301&& Σας, ... ,a a,b ŉ! ǰ$ ſt. ﬁ, İ", "<|startoftext|>&& x<|endoftext|> |x| <x>,"]
    t = word_tokenizer()
    df = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    store = token_store.write_store(df)
    for i, x in enumerate(odd):
        assert store.get(i)[0].tolist() == [*t.encode(x, add_special_tokens=False).ids, 2]


def test_op3_perfect_hash():
    keys = np.random.default_rng(0).choice(10**9, 20_000, replace=False)
    arrays, place = token_store.PerfectHash.build(keys)
    h = token_store.PerfectHash(arrays)
    assert sorted(place.tolist()) == list(range(20_000)) and (h.find(keys) == place).all() and (h.find(keys + 10**10) >= 0).mean() < 0.001


def test_op4_finds_items(docs, spark):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [(r[0], r[1]) for r in bench.orderBy("item_id").collect()]
    filler = " ".join(f"w{i}" for i in range(300))
    words = items[1][1].split()
    planted = spark.createDataFrame([(10**6, f"{filler} {items[0][1]} {filler}"), (10**6 + 1, items[1][1]), (10**6 + 2, filler), (10**6 + 3, None), (10**6 + 4, ""), (10**6 + 5, f"{filler} " + " ".join([*words[: len(words) // 2], "changed", *words[len(words) // 2 + 1 :]]) + " end")], "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(planted, bench).collect()}
    assert {(10**6, items[0][0]), (10**6 + 1, items[1][0])} <= got and not any(d in (10**6 + 2, 10**6 + 3, 10**6 + 4) for d, _ in got)
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, bench).collect()}
    norm = lambda s: f" {' '.join(re.sub(r'[^\w\s]|_', '', s.lower()).split())} "
    want = {(r["doc_id"], k) for r in docs.collect() for k, t in items if norm(t) in norm(r["text"])}
    assert want <= found
    assert decontaminate.keep_clean(planted, bench).count() == 6 - len({d for d, _ in got})


def test_op4_repeated_and_templated_items(spark, monkeypatch):
    words = [f"w{i}" for i in range(50)]
    docs = spark.createDataFrame([(1, " ".join([*words[:25], "changed", *words[26:]])), (2, " ".join(f"v{i}" for i in range(90)))], "doc_id long, text string")
    other = " ".join([*words[:5], *(f"u{i}" for i in range(45))])
    for copies in (1, 2, 10):
        bench = spark.createDataFrame([*((i, " ".join(words)) for i in range(copies)), (99, other)], "item_id long, text string")
        whole = sorted(map(tuple, decontaminate.contaminated(docs, bench).collect()))
        assert [(d, i) for d, i, *_ in whole] == [(1, i) for i in range(copies)]
        assert [r["doc_id"] for r in decontaminate.keep_clean(docs, bench).collect()] == [2]
        monkeypatch.setattr(decontaminate, "ITEM_BLOCK", 1)
        assert sorted(map(tuple, decontaminate.contaminated(docs, bench).collect())) == whole
        monkeypatch.undo()


def test_op5_held_out_accuracy_and_edges(spark, edge):
    d, lab = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    model = quality.learn(d, lab)
    out = quality.score_documents(d, model).join(lab, "doc_id").where(quality.held_out(F.col("doc_id"))).collect()
    assert sum((r["score"] >= quality.CUT) == bool(r["quality"]) for r in out) >= 0.95 * len(out)
    assert quality.score_documents(edge, model).count() == len(EDGES)
    assert {r["score"] for r in quality.score_documents(edge, quality.learn(d, lab.limit(0))).collect()} == {0.5}
    assert set(quality.keep_good(d, lab).columns) == set(d.columns)


def test_op6_equals_library(docs, edge):
    t = word_tokenizer()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for df in (docs, edge):
        want = []
        for r in df.collect():
            ids = t.encode(r["text"] or "", add_special_tokens=False).ids
            want.append((str(r["doc_id"]), len(ids), sha(" ".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False))))
        got = [(str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.digest_documents(df).collect()]
        assert sorted(got) == sorted(want)
    back = {r["doc_id"]: r["text"] for r in bpe.decode_documents(bpe.encode_documents(docs)).collect()}
    for r in docs.limit(5).collect():
        assert back[r["doc_id"]] == t.decode(t.encode(r["text"], add_special_tokens=False).ids, skip_special_tokens=False)


def test_op6_merges_together_and_singly():
    m, r = bpe.WordBpe(bpe.default_path()), np.random.default_rng(3)
    words = [bytes(r.choice(list(b"abeinorst\xc3\xa9"), n).tolist()) for n in r.integers(1, 45, 3000)] + [b"a" * n for n in range(1, 40)]
    assert m.merge_all(words) == [m.merge(w) for w in words]
    assert m.merge_all([]) == []


def test_op6_automaton():
    words = {w.encode(): [i, i + 1] for i, w in enumerate(["a", "ab", "abc", "bc", "tops", "taps", "top", "tap"])}
    lex = bpe.Lexicon(bpe.Lexicon.compile(words))
    place = lex.find([*words, b"", b"t", b"tapsy"]).tolist()
    assert [lex.output(p) for p in place[:-3]] == list(words.values()) and place[-3:] == [-1] * 3
    assert len(lex.final) < 1 + sum(map(len, words))  # suffixes are shared


def test_op7_rules(spark):
    df = spark.createDataFrame([(1, "x y.\nReleased under the MIT License.\nmore"), (2, "Licensed under the Apache License, Version 2.0."), (3, "This work is licensed under the GNU General Public License, version 3."), (4, "a license to read"), (5, None), (6, "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n1. no"), (7, "All rights reserved.\nLicensed under CC BY-NC 4.0.")], "doc_id long, text string")
    got = {r["doc_id"]: r["licenses"] for r in licenses.scan(df).collect()}
    assert got == {1: ["MIT"], 2: ["Apache-2.0"], 3: ["GPL-3.0"], 4: [], 5: [], 6: [], 7: ["Proprietary", "CC-BY-NC-4.0"]}
    assert all(w == licenses.normalise(w) for ws in licenses.SENTENCES.values() for w in ws)


def test_op7_narrow_lines():
    grant, notice = licenses.SENTENCES["mit-grant"][0], licenses.SENTENCES["mit-notice"][0]
    for width in (20, 40, 50, 60, 200):
        text = "\n".join(f"# {x}" for s in (grant + ":", "", notice + ".") for x in textwrap.wrap(s, width) or [""])
        found = licenses.identifiers(text)
        assert [f[3] for f in found] == ["mit-grant", "mit-notice"]
        assert licenses.licences(found) == [("MIT", 0, len(text))]


FULL_TEXTS = {
    "MIT": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "BSD-2-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.", "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."],
    "Apache-2.0": ['Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.', "You may obtain a copy of the License at", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'],
    "GPL-3.0": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}
FULL_TEXTS["BSD-3-Clause"] = [*FULL_TEXTS["BSD-2-Clause"], "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."]


def slow_licences(text):
    """Every run of pieces looked up, every choice of sentences tried, hits merged and nested ones dropped pair by pair."""
    known = {w: k for k, ws in licenses.SENTENCES.items() for w in ws}
    pieces = [(at, x, n) for at, x in licenses.sentences(text) if (n := licenses.normalise(x))]
    found, i, no = [], 0, 0
    while i < len(pieces):
        ends = [j for j in range(i, len(pieces)) if " ".join(p[2] for p in pieces[i : j + 1]) in known]
        if ends:
            j = ends[-1]
            found.append((no, pieces[i][0], pieces[j][0] + len(pieces[j][1].rstrip()), known[" ".join(p[2] for p in pieces[i : j + 1])]))
        i, no = (ends[-1] if ends else i) + 1, no + 1
    hits = []
    for name, seqs in licenses.RULES.items():
        for seq in seqs:
            ways = [[f] for f in found if f[3] == seq[0]]
            for want in seq[1:]:
                ways = [w + [f] for w in ways for f in found if f[3] == want and 0 < f[0] - w[-1][0] <= licenses.GAP + 1]
            for start in {w[0][0] for w in ways}:  # the earliest way from each start
                w = min((w for w in ways if w[0][0] == start), key=lambda w: [f[0] for f in w])
                hits.append([name, w[0][0], w[-1][0], w[0][1], w[-1][2]])
    again = True
    while again:
        again = False
        for a in hits:
            b = next((b for b in hits if b is not a and a[0] == b[0] and a[1] <= b[1] and b[1] - a[2] <= licenses.GAP + 1), None)
            if b:
                a[2], a[4], again = max(a[2], b[2]), max(a[4], b[4]), True
                hits.remove(b)
                break
    return sorted(((n, s, e) for n, _, _, s, e in hits if not any(m != n and s2 <= s and e2 >= e and e2 - s2 > e - s for m, _, _, s2, e2 in hits)), key=lambda x: (x[1], x[2], x[0]))


@pytest.mark.parametrize("width", [30, 45, 60, 80, 100])
@pytest.mark.parametrize("mark", ["", "# ", " * ", "// "])
def test_op7_whole_texts_wrapped(width, mark):
    for name, parts in FULL_TEXTS.items():
        text = "\n".join(mark + x for part in parts for x in [*textwrap.wrap(part, width), ""])
        assert [x[0] for x in licenses.licences(licenses.identifiers(text))] == [name]
        assert licenses.licences(licenses.identifiers(text)) == slow_licences(text)


def test_op7_equals_slow_version():
    r = np.random.default_rng(4)
    parts = [p for ps in FULL_TEXTS.values() for p in ps] + ["Released under the MIT license.", "SPDX-License-Identifier: GPL-2.0-or-later", "All rights reserved.", "The boost licence of readers.", "Prose with a notice; more of it!", "x y z.", "Open database.", "..."]
    for _ in range(150):
        text = "\n".join("\n".join(textwrap.wrap(parts[int(i)], int(r.integers(25, 200)))) for i in r.integers(0, len(parts), int(r.integers(1, 14))))
        assert licenses.licences(licenses.identifiers(text)) == slow_licences(text)


def test_op7_edges(spark, edge):
    got = licenses.scan(edge.withColumn("licenses", F.lit(1)).withColumn("starts", F.lit("x"))).collect()
    assert len(got) == len(EDGES) and all(r["licenses"] == [] for r in got)
    assert licenses.scan(edge.limit(0)).count() == 0
    long = "word " * 400_000 + "\nReleased under the MIT License.\n" + "word " * 100
    twice = spark.createDataFrame([(1, long), (1, long)], "doc_id long, text string")
    assert [r["licenses"] for r in licenses.scan(twice).collect()] == [["MIT"]] * 2


def test_op8_equals_library(docs, edge):
    path = viterbi.default_path()
    t = Tokenizer(models.Unigram(viterbi.unigram_vocabulary(path), unk_id=0, byte_fallback=True))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    for df in (docs, edge):
        got = sorted((str(r["doc_id"]), r["n_tokens"]) for r in viterbi.count_tokens(df).collect())
        assert got == sorted((str(r["doc_id"]), len(t.encode(r["text"] or "").ids)) for r in df.collect())
    odd = [" a", "a  b", "▁x", "<unk> <0x41>", "\x00\x07", "🙂🙃 é"]
    assert viterbi.count_texts(odd, path) == [len(t.encode(x).ids) for x in odd]


def test_op9_edited_texts(docs, edge):
    for df in (docs, edge.where("doc_id is not null").dropDuplicates(["doc_id"])):
        data = sorted(((r["doc_id"], r["text"] or "") for r in df.collect()), reverse=True)
        want = {}
        for i, (d, x) in enumerate(data):
            k, nxt = len(x) // 3, data[(i + 1) % len(data)][1]
            want[d] = (len(x), hashlib.sha256((x[: len(x) - k] + nxt[:k]).encode()).hexdigest())
        got = fingerprint.report(df).collect()
        assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in got} == want
        fp = {d: r["fingerprint"] for r in got for d in [r["doc_id"]]}
        for i, (d, x) in enumerate(data):
            r = next(r for r in got if r["doc_id"] == d)
            assert r["near_next"] == 1 - (int(fp[d], 16) ^ int(fp[data[(i + 1) % len(data)][0]], 16)).bit_count() / 64
            k, nxt = len(x) // 3, data[(i + 1) % len(data)][1]
            edited = weighted_simhash(x[: len(x) - k] + nxt[:k])
            assert int(fp[d], 16) == weighted_simhash(x) and int(r["edited_fingerprint"], 16) == edited
            assert r["near_edited"] == 1 - (int(fp[d], 16) ^ edited).bit_count() / 64
            near = [e for e in fp if (int(fp[e], 16) ^ int(fp[d], 16)).bit_count() <= 3]
            assert (r["near_docs"], r["near_least"]) == ((len(near) - 1, min(near)) if d % 20 == 0 else (None, None))
    assert fingerprint.report(edge).count() == len(EDGES) and fingerprint.report(edge.limit(0)).count() == 0


def weighted_simhash(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    terms = [(xxhash.xxh64_intdigest(b.encode(), xxhash.xxh64_intdigest(a.encode(), 42)), min(15, len(a.encode()) + len(b.encode()))) for a, b in zip(w, w[1:])]
    if len(w) == 1:
        terms = [(xxhash.xxh64_intdigest(w[0].encode(), 42), min(15, len(w[0].encode())))]
    total = sum(x for _, x in terms)
    return sum(1 << j for j in range(64) if 2 * sum(x for h, x in terms if h >> j & 1) > total)


def test_op9_block_tables(spark):
    r = np.random.default_rng(2)
    x = np.unique(np.concatenate([b := r.integers(0, 1 << 62, 200), b ^ (1 << r.integers(0, 62, 200)), b ^ (7 << r.integers(0, 60, 200))]))
    got = {(p["a"], p["b"]) for p in fingerprint.within_radius(spark.createDataFrame([(int(v),) for v in x], "fp long")).collect()}
    assert got == {(int(p), int(q)) for i, p in enumerate(x) for q in x[i + 1 :] if int(p ^ q).bit_count() <= 3}


def test_op10_separates_and_edges(spark, edge):
    r = np.random.default_rng(0)
    word = lambda: "".join(r.choice(list("abcdef"), 5))
    texts = [" ".join(word() for _ in range(150)) for _ in range(160)]
    y = np.arange(160) % 2
    texts = [t.replace(" ", " nasty ", 1) if k else t for t, k in zip(texts, y)]
    net = toxicity.train(texts[:120], y[:120])
    p = net.probability(toxicity.Scorer(net).raw(texts[120:]))
    assert ((p >= toxicity.CUT) == y[120:]).mean() >= 0.9
    assert toxicity.windows(64) == [0] and toxicity.windows(200)[-1] == 136
    out = toxicity.score_documents(edge, net).collect()
    assert len(out) == len(EDGES) and all(0 <= r["score"] <= 1 for r in out)
