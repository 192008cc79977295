"""Operator 12: spelling variants grouped by an even-partition pigeonhole join.

Words are counted over all texts. Two words within one edit agree on one half of the shorter:
a word of ``l`` code points is indexed under its two halves (the first of ``l // 2``), and
words of ``l`` or ``l + 1`` code points probe the same substrings, the second half shifted by
what they are longer. A full bucket, as of a common prefix, is split by the same rule: the
half that holds the edit is cut in two again, and again, so that a key is all of the word but
the range that holds the edit. The last ranges are one code point (or none, for an inserted
one), so a bucket then holds no more words than there are letters. Nothing is capped.
Candidates are verified in the join by a banded edit distance; pairs met twice count once.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, forget, map_arrow, table

#: Shortest words, fewest occurrences, and the part of a form's occurrences that a variant may have.
LENGTH, LEAST, RATIO = 5, 3, 2
#: One (document, word) in so many has a letter deleted.
ODDS = 97
#: Most rows of a bucket whose words are compared with one another.
FULL = 256
#: Most distinct words that a task holds before it hands its counts on.
HELD = 300_000
#: Runs of a lower-cased text.
RUN = re.compile("[a-zÀ-ÿ]+")
#: Longest text, in bytes, whose runs are listed at once.
LONG = 16 << 20


def thinned(doc: bytes, word: str) -> str:
    """``word`` of the document ``doc`` (``b"<doc_id>:"``), without one letter where 97 divides the checksum of both."""
    h = zlib.crc32(word.encode(), zlib.crc32(doc))
    if h % ODDS:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[str] = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            text, doc = text.lower().decode(), f"{doc}:".encode()  # of bytes, lower() changes A-Z alone
            runs = RUN.finditer(text) if len(text) > LONG else None
            while True:
                some = Counter(m[0] for m in islice(runs, 1 << 20)) if runs else Counter(RUN.findall(text))
                for word, n in some.items():
                    held[thinned(doc, word)] += n
                if len(held) > HELD:
                    yield out()
                    held.clear()
                if not runs or not some:
                    break
    if held:
        yield out()


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n``: the words of at least ``LENGTH`` code points that occur at least ``LEAST`` times in all texts together."""
    texts = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("doc"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    counted = map_arrow(texts, _counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where((F.col("n") >= LEAST) & (F.length("word") >= LENGTH))


def _key(word: Column, lo: Column, hi: Column, longer: Column) -> Column:
    """What stands outside the range that holds the edit; a longer word's range has one code point more."""
    return F.concat_ws("\n", F.substring(word, F.lit(1), lo), F.substring(word, hi + longer + 1, F.length(word)))


def _keyed(rows: DataFrame) -> DataFrame:
    """``rows`` (``word, n, l, edit, longer, lo, hi``) with ``h``, the hash of the bucket."""
    return rows.withColumn("h", F.xxhash64("l", "edit", "lo", "hi", _key(F.col("word"), F.col("lo"), F.col("hi"), F.col("longer"))))


def _ranges(*pairs) -> Column:
    return F.explode(F.array(*[F.struct(lo.cast("int").alias("lo"), hi.cast("int").alias("hi")) for lo, hi in pairs]))


def near_words(words: DataFrame, full: int = FULL) -> DataFrame:
    """``a, b, na, nb``: all pairs of words (``word``, distinct, and ``n``) that differ by exactly one inserted, deleted or replaced code point, once each, as a written table."""
    # as what a word meets others: 0 replaced, its own length; 1 inserted, the shorter; 2 inserted, the longer
    roles = words.select("word", "n", F.explode(F.array(*map(F.lit, (0, 1, 2)))).alias("role"))
    rows = roles.select("word", "n", (F.length("word") - (F.col("role") == 2).cast("int")).alias("l"), (F.col("role") > 0).cast("int").alias("edit"), (F.col("role") == 2).cast("int").alias("longer"))
    zero, half = F.lit(0), F.floor(F.col("l") / 2)
    rows = rows.select("*", _ranges((zero, half), (half, F.col("l"))).alias("r")).select("word", "n", "l", "edit", "longer", "r.lo", "r.hi")
    level, scratch, pairs = durable(_keyed(rows), "segments"), [], []
    while True:
        scratch.append(level)
        sizes = durable(level.groupBy("h").agg(F.count("*").alias("m")).where("m > 1"), "sizes")
        scratch.append(sizes)
        last = F.col("hi") - F.col("lo") + F.col("edit") <= 1
        met = level.join(sizes, "h")
        small = met.where((F.col("m") <= full) | last)
        x = small.where("longer = 0").select("h", F.col("word").alias("a"), F.col("n").alias("na"), "edit")
        y = small.where("longer = edit").select("h", F.col("word").alias("b"), F.col("n").alias("nb"), "edit")
        fit = (x["h"] == y["h"]) & (x["edit"] == y["edit"]) & ((x["edit"] == 1) | (F.col("a") < F.col("b"))) & (F.levenshtein(F.col("a"), F.col("b"), 1) == 1)
        pairs.append(durable(x.join(y, fit).select("a", "b", "na", "nb"), "near-words"))
        lo, hi = F.col("lo"), F.col("hi")
        mid = F.floor((lo + hi) / 2)
        # a range of one code point ends, for an inserted one, in the empty ranges before and behind it
        cut = F.when(hi - lo > 1, F.array(F.struct(lo.alias("lo"), mid.cast("int").alias("hi")), F.struct(mid.cast("int").alias("lo"), hi.alias("hi")))).otherwise(F.array(F.struct(lo.alias("lo"), lo.alias("hi")), F.struct(hi.alias("lo"), hi.alias("hi"))))
        crowded = met.where((F.col("m") > full) & ~last).select("word", "n", "l", "edit", "longer", F.explode(cut).alias("r")).select("word", "n", "l", "edit", "longer", "r.lo", "r.hi")
        level = durable(_keyed(crowded), "segments")
        if level.isEmpty():
            scratch.append(level)
            break
    every = pairs[0]
    for more in pairs[1:]:
        every = every.union(more)
    out = durable(every.distinct(), "near-words")
    for used in (*scratch, *pairs):
        forget(used)
    return out


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: from each word of ``forms`` (``word, form``) along the forms to the last; pointers double, so chains of c take log2(c) rounds. Forms must not lead in circles."""
    cur = durable(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        up = cur.select(F.col("word").alias("root"), F.col("root").alias("next"))
        nxt = durable(cur.join(up, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        forget(cur)
        cur = nxt
        if cur.where("moved").isEmpty():
            return cur.drop("moved")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word counted in ``docs``.

    A word's form is its near word of most occurrences (of several the first in code-point
    order), if it has at least ``RATIO`` times the word's. Null texts have no words; a null id
    counts as empty text; rows that repeat count each; other columns are not looked at. A table
    without words gives an empty table.
    """
    words = durable(word_counts(docs, id_col, text_col), "words")
    pairs = near_words(words)
    both = pairs.select(F.col("a").alias("word"), "na", F.col("b").alias("near"), F.col("nb").alias("m")).union(pairs.select("b", "nb", "a", "na"))
    best = both.groupBy("word", F.col("na").alias("n")).agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), F.col("near").alias("near"))).alias("f"))
    some = F.col("f.m") * -1 >= RATIO * F.col("n")
    near = durable(best.select("word", "n_near", F.when(some, F.col("f.near")).alias("form"), F.when(some, -F.col("f.m")).alias("form_n")), "forms")
    forget(pairs)
    ends = roots(near.where("form is not null"))
    out = words.join(near, "word", "left").join(ends, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")


def query(spark, sf_dir: str) -> DataFrame:
    """Registered query ``op12_spelling_variants``: every counted word of ``documents`` with its form and root."""
    return variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


#: CRC-32 of a string's UTF-8 bytes, bit by bit.
CRC32 = "list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(trim(regexp_replace(hex(encode({0})), '(..)', '\\1 ', 'g')), ' '), lambda b: ('0x' || b)::BIGINT)), lambda c, b: list_reduce([xor(c, b), 1, 2, 3, 4, 5, 6, 7, 8], lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END))"

SQL = f"""
WITH RECURSIVE runs AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents),
low AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS c FROM runs GROUP BY ALL),
summed AS (SELECT run, c, xor({CRC32.format("concat(doc_id, ':', run)")}, 4294967295) AS h FROM low),
words AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, sum(c)::BIGINT AS n FROM summed GROUP BY 1 HAVING sum(c) >= 3 AND length(word) >= 5),
cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM words, unnest(range(1, length(word) + 1)) t(i)),
pairs AS (SELECT x.word, x.n, y.word AS near, y.n AS m FROM cut x JOIN cut y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
 UNION SELECT x.word, x.n, y.word, y.n FROM words x JOIN cut y ON x.word = y.rest
 UNION SELECT y.word, y.n, x.word, x.n FROM words x JOIN cut y ON x.word = y.rest),
best AS (SELECT word, n, count(*) AS n_near, arg_min(near, (-m, near)) AS near, max(m) AS m FROM pairs GROUP BY 1, 2),
forms AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.m >= 2 * w.n THEN b.near END AS form, CASE WHEN b.m >= 2 * w.n THEN b.m END AS form_n FROM words w LEFT JOIN best b USING (word)),
chain AS (SELECT word, word AS root, form AS next FROM forms UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON c.next = f.word)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM forms f JOIN chain c ON f.word = c.word AND c.next IS NULL
"""
