"""Point-in-time reads: what was knowable at a date.

Reads at one cut-off are a filter, an aggregate with map-side combine, or an anti join. Reads
at a cut-off of each row lay both tables over one another in time. None needs a self join. Cut-offs are inclusive unless said otherwise. Nulls: a row without the date that
a cut-off tests is not admitted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Open end of a validity interval.
OPEN_END = "9999-12-31"


def day(value) -> Column:
    """A date literal from an ISO string or date; a column as it is."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def as_of(df: DataFrame, cutoff, mode: str = "information", disclosed: str = "t_disclosed", ingested: str = "t_ingest") -> DataFrame:
    """Rows knowable at ``cutoff``.

    ``information``: disclosed at or before it. ``operational``: ingested strictly before it.
    ``strict``: disclosed and ingested at or before it.
    """
    t = day(cutoff)
    rules = {"information": F.col(disclosed) <= t, "operational": F.col(ingested) < t, "strict": (F.col(disclosed) <= t) & (F.col(ingested) <= t)}
    if mode not in rules:
        raise ValueError(f"mode {mode!r} is not one of {sorted(rules)}")
    return df.where(rules[mode])


def asof_latest_row(df: DataFrame, key: list[str], date: str, cutoff, cols: list[str]) -> DataFrame:
    """Per key the latest date at or before ``cutoff`` and the values of its row, null values included."""
    return df.where(F.col(date) <= day(cutoff)).groupBy(*key).agg(F.max(date).alias(date), *[F.max_by(c, date).alias(c) for c in cols])


def asof_last_non_null(df: DataFrame, key: list[str], date: str, cutoff, col: str) -> DataFrame:
    """Per key the last value that is not null at or before ``cutoff``, and its date; keys without one are absent."""
    return df.where((F.col(date) <= day(cutoff)) & F.col(col).isNotNull()).groupBy(*key).agg(F.max(date).alias(date), F.max_by(col, date).alias(col))


def latest_vintage(df: DataFrame, key: list[str], disclosed: str, cols: list[str], cutoff=None, inclusive: bool = True, tie: str | None = None) -> DataFrame:
    """Per key the newest vintage disclosed up to ``cutoff`` (before it, if not ``inclusive``; the newest of all without one).

    Equal disclosure times are settled by the larger ``tie``.
    """
    if cutoff is not None:
        df = df.where(F.col(disclosed) <= day(cutoff) if inclusive else F.col(disclosed) < day(cutoff))
    order = F.struct(disclosed, tie) if tie else F.col(disclosed)
    return df.groupBy(*key).agg(F.max(disclosed).alias(disclosed), *[F.max_by(c, order).alias(c) for c in cols])


def valid_at(df: DataFrame, at, start: str = "t_valid_from", end: str = "t_valid_to") -> DataFrame:
    """Rows whose half-open interval ``[start, end)`` holds the date; an open end is ``9999-12-31``."""
    return df.where((F.col(start) <= day(at)) & (day(at) < F.col(end)))


def stale_filter(df: DataFrame, date: str, cutoff, max_days: int) -> DataFrame:
    """Rows whose date is at most ``max_days`` before ``cutoff``."""
    return df.where(F.datediff(day(cutoff), F.col(date)) <= max_days)


def upsert_view(log: DataFrame, key: list[str], seq: str, cols: list[str]) -> DataFrame:
    """The current row of each key in an append-only log: that of the highest sequence number."""
    return log.groupBy(*key).agg(F.max(seq).alias(seq), *[F.max_by(c, seq).alias(c) for c in cols])


def first_wins(new: DataFrame, existing: DataFrame | None, key: list[str], seq: str) -> DataFrame:
    """Rows of ``new`` to insert: the first of each key, unless the key exists.

    A key with a null part is distinct from every other, as in a UNIQUE constraint.
    """
    null = F.lit(False)
    for k in key:
        null = null | F.col(k).isNull()
    rest = [c for c in new.columns if c not in (*key, seq)]
    known = new.where(~null).groupBy(*key).agg(F.min(seq).alias(seq), *[F.min_by(c, seq).alias(c) for c in rest]).select(*new.columns)
    if existing is not None:
        known = known.join(existing.select(*key), key, "left_anti")
    return known.unionByName(new.where(null))


#: Days of a slice of time; a key's rows of one slice meet in one task.
SLICE_DAYS = 366


def _slice(time: str, days: int) -> Column:
    return F.floor(F.datediff(F.col(time).cast("date"), F.lit("1970-01-01").cast("date")) / days)


def running_total(df: DataFrame, key: list[str], time: str, value: str, out: str, slice_days: int = SLICE_DAYS) -> DataFrame:
    """``df`` with ``out``, the sum of ``value`` over the rows of the key up to the row's day, those of equal days together.

    A key's days are cut into slices: sums within a slice, and one carried-over sum a slice, so
    a hot key is not summed in one task. Null values count as nothing; rows without a day have null.
    """
    cut = df.withColumn("_s", _slice(time, slice_days))
    per = cut.where("_s is not null").groupBy(*key, "_s").agg(F.sum(value).alias("_v"))
    before = per.withColumn("_c", F.sum("_v").over(Window.partitionBy(*key).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1))).drop("_v")
    same = F.col("a._s") == F.col("b._s")
    for k in key:
        same = same & F.col(f"a.`{k}`").eqNullSafe(F.col(f"b.`{k}`"))
    day_of = F.col(time).cast("date")
    inside = cut.withColumn("_i", F.sum(value).over(Window.partitionBy(*key, "_s").orderBy(day_of).rangeBetween(Window.unboundedPreceding, 0)))
    total = F.when(F.col("a._s").isNotNull(), F.coalesce("_i", F.lit(0)) + F.coalesce("_c", F.lit(0)))
    return inside.alias("a").join(before.alias("b"), same, "left").select(*[F.col(f"a.`{c}`") for c in df.columns], total.alias(out))


def asof_join(asks: DataFrame, known: DataFrame, key: list[str], ask_time: str, time: str, cols: list[str], strict: bool = False, slice_days: int = SLICE_DAYS) -> DataFrame:
    """Each row of ``asks`` with ``time`` and ``cols`` of the key's latest row of ``known`` at or before its own cut-off; null without one.

    ``strict``: before it. Cut-offs are dates. Rows equal in key and time are settled by the
    largest ``cols``. Rows of ``known`` without a time are left out; asks without a cut-off or
    with a null key find nothing. No pairs are made: both tables are laid one over the other,
    and the last value goes on in time. A key is cut into slices of time, each with the value
    carried over from the slices before, so hot keys are split.
    """
    clash = set(asks.columns) & {time, *cols}
    if clash:
        raise ValueError(f"asks already has {sorted(clash)}")
    ks = [f"_k{i}" for i in range(len(key))]
    shift = F.date_sub(F.col(ask_time).cast("date"), 1) if strict else F.col(ask_time).cast("date")
    ask_row = F.struct(*[F.col(f"`{c}`").alias(f"f{i}") for i, c in enumerate(asks.columns)])
    value = F.struct(F.col(time).alias("t"), *[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(cols)])
    left = asks.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(key, ks)], shift.alias("_t"), F.lit(1).alias("_ask"), ask_row.alias("_row"))
    right = known.where(F.col(time).isNotNull()).select(*[F.col(f"`{c}`").alias(k) for c, k in zip(key, ks)], F.col(time).cast("date").alias("_t"), F.lit(0).alias("_ask"), value.alias("_value"))
    whole = F.lit(True)
    for k in ks:
        whole = whole & F.col(k).isNotNull()
    right = right.where(whole)
    both = left.unionByName(right, allowMissingColumns=True).withColumn("_s", _slice("_t", slice_days))
    carried = right.withColumn("_s", _slice("_t", slice_days)).groupBy(*ks, "_s").agg(F.max("_value").alias("_value"), F.lit(0).alias("_from"))
    # a slice without rows of its own takes its carried value from the last that has some
    asked = left.where(whole).select(*ks, _slice("_t", slice_days).alias("_s")).where("_s is not null").distinct()
    over = Window.partitionBy(*ks).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    slices = asked.join(carried, [*ks, "_s"], "full").withColumn("_over", F.last("_value", ignorenulls=True).over(over)).select(*[F.col(k).alias(f"{k}_") for k in ks], F.col("_s").alias("_s_"), "_over")
    inside = Window.partitionBy(*ks, "_s").orderBy("_t", "_ask", "_value").rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumn("_last", F.last("_value", ignorenulls=True).over(inside)).where("_ask = 1")
    same = F.col("_s") == F.col("_s_")
    for k in ks:
        same = same & (F.col(k) == F.col(f"{k}_"))
    got = F.when(F.col("_t").isNotNull() & whole, F.coalesce("_last", "_over"))
    out = seen.join(slices, same, "left").select("_row", got.alias("_got"))
    return out.select(*[F.col("_row").getField(f"f{i}").alias(c) for i, c in enumerate(asks.columns)], F.col("_got.t").alias(time), *[F.col("_got").getField(f"v{i}").alias(c) for i, c in enumerate(cols)])


def trailing(asks: DataFrame, known: DataFrame, key: list[str], ask_time: str, time: str, days: int, aggs: dict[str, Column], slice_days: int = SLICE_DAYS) -> DataFrame:
    """Each row of ``asks`` with aggregates over the key's rows of ``known`` in the ``days`` up to its cut-off, both ends included.

    ``aggs`` maps new names to aggregates over columns of ``known``, such as ``F.avg("volume")``,
    that pass over nulls. Asks without a cut-off or with a null key have the aggregates of no
    rows. One range window over both tables; slices of time are as wide as the window at
    least, and a row also stands in the next slice if a window of that can reach it.
    """
    wide = max(slice_days, days + 1)
    ks = [f"_k{i}" for i in range(len(key))]
    origin = F.lit("1970-01-01").cast("date")
    on = lambda c: F.datediff(F.col(c).cast("date"), origin)
    ask_row = F.struct(*[F.col(f"`{c}`").alias(f"f{i}") for i, c in enumerate(asks.columns)])
    left = asks.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(key, ks)], on(ask_time).alias("_t"), ask_row.alias("_row"), F.floor(on(ask_time) / wide).alias("_s"))
    rows = known.withColumns({k: F.col(f"`{c}`") for c, k in zip(key, ks)}).withColumn("_t", on(time)).where("_t is not null")
    own = F.floor(F.col("_t") / wide)
    rows = rows.withColumn("_s", F.explode(F.when(F.floor((F.col("_t") + days) / wide) > own, F.array(own, own + 1)).otherwise(F.array(own))))
    both = left.withColumn("_is", F.lit(True)).unionByName(rows.withColumn("_is", F.lit(False)), allowMissingColumns=True)
    over = Window.partitionBy(*ks, "_s").orderBy("_t").rangeBetween(-days, 0)
    got = both.withColumns({f"_a{i}": a.over(over) for i, a in enumerate(aggs.values())}).where("_is")
    lost = F.col("_t").isNull()
    for k in ks:
        lost = lost | F.col(k).isNull()
    return got.select(*[F.col("_row").getField(f"f{i}").alias(c) for i, c in enumerate(asks.columns)], *[F.when(~lost, F.col(f"_a{i}")).alias(n) for i, n in enumerate(aggs)])
