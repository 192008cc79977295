"""Similarity join of sets by MinHash sketches, DataFrame expressions only.

A sketch is the ``SKETCH`` smallest hashes of a set, that is, a sample of it under one random
order that all sets share. Two sets with a Jaccard similarity of 4/5 have two of their ``BANDS``
smallest hashes in common (all but fewer than 2 in 10,000 such pairs), and two that have a common
phrase alone rarely do. So hashes that other sets have too are found first, and each two of these
are a bucket. In a bucket every set meets the smallest one. Buckets that this does not join into
one component are gone through: in small ones every two that are not joined meet, full ones are
split by a third hash of the sketch first. Two that meet are compared exactly on the whole sets
if ``AGREE`` hashes of their sketches agree (all but about 3 in 100,000 of the pairs at 4/5 do, and
more above); only similar pairs leave the join. Each set that is compared is made once or once a part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, forget
from .components import connected_components

#: As a fraction: 4/5.
SIMILARITY = (4, 5)
#: Smallest hashes that are kept; those of them that make buckets in twos; those that split full buckets; hashes that have to agree.
SKETCH, BANDS, THIRDS, AGREE = 12, 6, 8, 5
#: Most sets of a bucket that is not split further, and sets of a bucket that meet the whole of it in one task.
FULL, BLOCK = 128, 512
#: Most parts in which whole sets are compared, one after another, so that the sets of a part alone are moved, and members or pairs of a part before there are more.
PASSES, AT_ONCE = 16, 15_000
#: Most ids (longs) that are broadcast; beyond it they are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def similar(x, y):
    """Whether two sets have a Jaccard similarity of at least ``SIMILARITY``, in whole numbers; sets too unequal in size are told first."""
    num, den = SIMILARITY
    n, m = F.size(x), F.size(y)
    return (den * F.least(n, m) >= num * F.greatest(n, m)) & ((num + den) * F.size(F.array_intersect(x, y)) >= num * (n + m))


def alike(n, m, x, y):
    """Whether sets of ``n`` and ``m`` members with the sketches ``x`` and ``y`` may be similar: sizes allow it, and ``AGREE`` of the smaller sketch (half of a shorter one) are in the other."""
    num, den = SIMILARITY
    need = F.least(F.lit(AGREE), F.ceil(F.least(F.size(x), F.size(y)) / 2))
    return (den * F.least(n, m) >= num * F.greatest(n, m)) & (F.size(F.array_intersect(x, y)) >= need)


def _only(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``id`` is in ``ids`` (a written table); broadcast only if counted to be few."""
    return df.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id", "left_semi")


def _buckets(keys: DataFrame) -> DataFrame:
    """``keys`` (``h, id``) of the buckets with company, with their size ``m`` and smallest id ``a``."""
    groups = keys.groupBy("h").agg(F.count("*").alias("m"), F.min("id").alias("a")).where("m > 1")
    return durable(keys.join(groups, "h"), "buckets")


def _shared(held: DataFrame) -> DataFrame:
    """``id, hs``: those of the first ``BANDS`` hashes of each sketch that another set has there too; a single hash stands twice."""
    single = held.select("id", F.explode(F.slice("sk", 1, BANDS)).alias("h"), (F.col("n") == 1).alias("one"))
    company = single.groupBy("h").agg(F.count("*").alias("m")).where("m > 1").select("h")
    of = single.join(company, "h").groupBy("id").agg(F.collect_list("h").alias("hs"), F.max("one").alias("one"))
    return of.where("one or size(hs) > 1").select("id", F.when(F.col("one"), F.concat("hs", "hs")).otherwise(F.array_sort("hs")).alias("hs"))


def _twos(hs) -> list:
    """A key for each two of the hashes ``hs``, at most ``BANDS``, null where there are fewer."""
    x = [F.get(hs, F.lit(i)) for i in range(BANDS)]
    return [F.when(x[j].isNotNull(), F.xxhash64(x[i], x[j])) for j in range(1, BANDS) for i in range(j)]


def _split(full: DataFrame, hashes: DataFrame, own: DataFrame) -> DataFrame:
    """``h, id, root``: the members of full buckets (``h, id, root``) under each further hash of their sketches, by the three hashes together."""
    both = [F.array(F.get("hs", F.lit(i)), F.get("hs", F.lit(j))) for j in range(1, BANDS) for i in range(j)]
    at = F.array_position(F.array(*_twos(F.col("hs"))), F.col("h"))
    parts = full.join(hashes, "id").join(own.select("id", F.slice("sk", 1, THIRDS).alias("sk")), "id").select("id", "root", "sk", F.element_at(F.array(*both), at.cast("int")).alias("parts"))
    # a set without a further hash goes on with those that have none either: in its like it has none to share
    further = F.array_except("sk", "parts")
    more = parts.select("id", "root", "parts", F.explode(F.when(F.size(further) > 0, further).otherwise(F.array(F.lit(0).cast("long")))).alias("t"))
    return more.select("id", "root", F.xxhash64(F.array_sort(F.concat("parts", F.array("t")))).alias("h")).distinct()


def verified(rows: DataFrame, members, pairs: DataFrame) -> DataFrame:
    """Those of ``pairs`` (``a, b``) whose sets are similar, compared whole; ``rows`` and ``members`` as of ``similar_links``.

    What the sets are made of travels to the pairs, and the sets are built there.
    """
    pairs = durable(pairs, "pairs")
    ids = durable(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids")
    made_of = durable(_only(rows.drop("n", "sk"), ids), "own")
    side = lambda s: made_of.select(F.col("id").alias(s), F.struct(*made_of.columns).alias(f"r{s}"))
    beside = pairs.join(side("a"), "a").join(side("b"), "b")
    sets = beside.select("a", "b", "rb", "ra.*").select("a", "b", "rb", members.alias("sa")).select("a", "b", "sa", "rb.*").select("a", "b", "sa", members.alias("sb"))
    # the transform names both sets, which are built once, not once a use
    alike_sets = F.get(F.transform(F.array(F.struct("sa", "sb")), lambda p: similar(p["sa"], p["sb"])), F.lit(0))
    out = durable(sets.where(alike_sets).select("a", "b"), "links")
    for used in (pairs, ids, made_of):
        forget(used)
    return out


def sketched(rows: DataFrame, members) -> DataFrame:
    """``rows`` with ``n`` and ``sk``, size and sketch of the set that the column ``members``, an array of distinct longs that are hashes, is made of."""
    return rows.withColumn("_set", members).withColumn("n", F.size("_set")).withColumn("sk", F.slice(F.sort_array("_set"), 1, SKETCH)).drop("_set")


def similar_links(rows: DataFrame, members) -> DataFrame:
    """``a, b``: verified links between sets of a similarity of at least 4/5.

    ``rows`` is a written table with distinct long ids ``id``, ``n`` and ``sk`` (``sketched``) and
    what ``members`` is made of; it is read more than once. Empty sets are linked to none. Pairs that
    other links join already may be left out; of all others a pair is missed with the chances
    named above. An empty table gives an empty table.
    """
    scratch: list[DataFrame] = []

    def keep(df: DataFrame, what: str) -> DataFrame:
        scratch.append(durable(df, what))
        return scratch[-1]

    held = rows.select("id", "n", "sk")
    hashes = keep(_shared(held), "hashes")
    near = _buckets(hashes.select("id", F.explode(F.array_compact(F.array(*_twos(F.col("hs"))))).alias("h")))
    scratch.append(near)
    own = keep(_only(held, keep(near.select("id").distinct(), "ids")), "own")
    side = lambda s: own.select(*[F.col(c).alias(f"{c}{s}") for c in ("id", "n", "sk")])
    first = near.where("id <> a").select(F.col("a").alias("ida"), F.col("id").alias("idb")).distinct()
    fit = alike(F.col("na"), F.col("nb"), F.col("ska"), F.col("skb"))
    stars = _all(_compared(rows, members, keep(first.join(side("a"), "ida").join(side("b"), "idb").where(fit).select(F.col("ida").alias("a"), F.col("idb").alias("b")), "first")))
    # of a bucket of two there is nothing more to compare
    label = connected_components(stars).withColumnRenamed("node", "id")
    rest = _mixed(near.where("m > 2").select("h", "id").join(label, "id", "left").select("h", "id", F.coalesce("component", "id").alias("root")), keep)
    few = rest.where(F.col("m") <= FULL)
    full = rest.where(F.col("m") > FULL)
    if not full.isEmpty():
        few = few.unionByName(_mixed(_split(full.select("h", "id", "root"), hashes, own), keep))
    links = stars if rest.isEmpty() else _all([stars, *_met(rows, members, few, own, keep)])
    for used in scratch:
        forget(used)
    return links


def _mixed(keys: DataFrame, keep) -> DataFrame:
    """``keys`` (``h, id, root``) of the buckets with members of more than one component, with their size ``m``."""
    keys = keep(keys, "rooted")
    apart = keys.groupBy("h").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("m")).where("low <> high").select("h", "m")
    return keep(keys.join(apart, "h"), "mixed")


def _met(rows: DataFrame, members, rest: DataFrame, own: DataFrame, keep) -> list[DataFrame]:
    """Links (``a, b``) between members of the buckets ``rest`` (``h, id, root, m``) that are not joined yet."""
    of = rest.groupBy("id").agg(F.sort_array(F.collect_set("h")).alias("hs"))  # a few dozen at most
    rest = keep(rest.join(own.join(of, "id"), "id").withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int")), "meeting")
    side = lambda df, s, *more: df.select(*more, *[F.col(c).alias(f"{c}{s}") for c in ("id", "n", "sk", "root", "hs", "set") if c in df.columns])
    fit = alike(F.col("na"), F.col("nb"), F.col("ska"), F.col("skb"))

    def sides(df: DataFrame):
        """Both sides of a bucket, cut into blocks on the left and copied to each block on the right, the condition under which two that are not joined meet, and that for the first bucket that they share."""
        x = side(df, "a", "h", "blocks", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"))
        y = side(df, "b", "h", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        once = F.get(F.array_intersect("hsa", "hsb"), F.lit(0)) == x["h"]
        return x, y, (x["h"] == y["h"]) & (x["block"] == y["block"]) & (F.col("roota") != F.col("rootb")) & fit, once

    # members whose sketch is like that of another, then these alone with their sets; only what is similar leaves the second join
    x, y, meet, _ = sides(rest)
    some = keep(x.join(y, meet, "left_semi").select("h", "blocks", *[F.col(f"{c}a").alias(c) for c in ("id", "n", "sk", "root", "hs")]), "some")
    ids = keep(some.select("id").distinct(), "ids")
    sets = keep(_only(rows, ids).select("id", members.alias("set")), "sets")
    found, passes = [], max(1, min(PASSES, some.count() // AT_ONCE))
    for k in range(passes):
        x, y, meet, once = sides(some.where(F.pmod(F.xxhash64("h"), F.lit(passes)) == k).join(sets, "id"))
        pairs = x.join(y, (F.col("ida") < F.col("idb")) & meet & once & similar(F.col("seta"), F.col("setb")))
        # one link from a member to each component that it is near
        found.append(durable(pairs.groupBy("idb", "roota").agg(F.min("ida").alias("a")).select("a", F.col("idb").alias("b")), "links"))
    return found


def _compared(rows: DataFrame, members, pairs: DataFrame) -> list[DataFrame]:
    """As ``verified`` for pairs (a written table) in which a set stands many times: each set is made once a part and is moved to the sets that it meets."""
    found, passes = [], max(1, min(PASSES // 4, pairs.count() // AT_ONCE))
    for k in range(passes):
        part = pairs.where(F.pmod(F.xxhash64("a"), F.lit(passes)) == k)
        ids = durable(part.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids")
        sets = durable(_only(rows, ids).select("id", members.alias("set")), "sets")
        side = lambda s, sets=sets: sets.select(F.col("id").alias(s), F.col("set").alias(f"s{s}"))
        found.append(durable(part.join(side("a"), "a").join(side("b"), "b").where(similar(F.col("sa"), F.col("sb"))).select("a", "b"), "links"))
        for used in (ids, sets):
            forget(used)
    return found


def _all(parts: list[DataFrame]) -> DataFrame:
    every = parts[0]
    for more in parts[1:]:
        every = every.union(more)
    return every
