"""Market operators over daily bars: cross-sections, returns, turnover, coverage, windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import number
from .temporal import asof_join, asof_last_non_null, asof_latest_row, day, running_total, stale_filter, trailing

FIELDS = ("open", "high", "low", "close", "adjusted_close", "volume")


def bar_window(bars: DataFrame, start=None, end=None) -> DataFrame:
    """Bars in the closed window, an open end where none is given."""
    if start is not None:
        bars = bars.where(F.col("datum") >= day(start))
    return bars if end is None else bars.where(F.col("datum") <= day(end))


def cross_section(bars: DataFrame, cutoff, field: str = "close", max_stale_days: int | None = None) -> DataFrame:
    """``symbol, datum, value``: each symbol's latest bar at or before ``cutoff``, dropped if older than the limit."""
    if field not in FIELDS:
        raise ValueError(f"field {field!r} is not one of {FIELDS}")
    out = asof_latest_row(bars, ["symbol"], "datum", cutoff, [field]).withColumnRenamed(field, "value")
    return out if max_stale_days is None else stale_filter(out, "datum", cutoff, max_stale_days)


def cross_section_by(section: DataFrame, meta: DataFrame, level: str) -> DataFrame:
    """A cross-section with the group of each symbol; a symbol without one stays, in the null group."""
    if level not in ("category", "sector"):
        raise ValueError(f"level {level!r} is neither category nor sector")
    return section.join(meta.select("symbol", F.col(level).alias("grp")), "symbol", "left")


def price_as_of(bars: DataFrame, cutoff, field: str = "close", max_stale_days: int | None = None) -> DataFrame:
    """Like ``cross_section``, with the last value that is not null."""
    out = asof_last_non_null(bars, ["symbol"], "datum", cutoff, field).withColumnRenamed(field, "value")
    return out if max_stale_days is None else stale_filter(out, "datum", cutoff, max_stale_days)


def total_return(bars: DataFrame, field: str = "adjusted_close", fallback: str = "close") -> DataFrame:
    """``symbol, ret``: last over first value less one; symbols with under two values or a first of zero are absent."""
    v = bars.withColumn("v", F.coalesce(field, fallback)).where("v is not null")
    got = v.groupBy("symbol").agg(F.count("*").alias("n"), F.min_by("v", "datum").alias("a"), F.max_by("v", "datum").alias("b"))
    return got.where("n >= 2 and a <> 0").select("symbol", (F.col("b") / F.col("a") - 1).alias("ret"))


def category_return(returns: DataFrame, universe: DataFrame, ordered: bool = False) -> DataFrame:
    """``category, ret, delisted, n``: equally weighted means; symbols without a category stand for themselves. ``ordered``: by category."""
    joined = returns.join(universe, "symbol").withColumn("category", F.coalesce("category", F.col("symbol").cast("string")))
    out = joined.groupBy("category").agg(F.avg("ret").alias("ret"), F.bool_or("delisted").alias("delisted"), F.count("*").alias("n"))
    return out.orderBy("category") if ordered else out


def turnover(bars: DataFrame, shares: DataFrame, cutoff, days: int = 90) -> DataFrame:
    """``symbol, turnover``: mean volume over the window up to ``cutoff`` by shares; absent without volume or shares above zero."""
    mean = bars.where((F.col("datum") <= day(cutoff)) & (F.col("datum") >= F.date_sub(day(cutoff), days)) & F.col("volume").isNotNull()).groupBy("symbol").agg(F.avg("volume").alias("v"))
    return mean.join(shares.where("shares > 0"), "symbol").select("symbol", (F.col("v") / F.col("shares")).alias("turnover"))


def quarter_window(quarters: DataFrame, cutoff, key: str, k: int = 4, gap: tuple[int, int] = (60, 130)) -> DataFrame:
    """The last ``k`` fiscal periods filed by ``cutoff`` of each key, absent unless each gap between two is within ``gap`` days.

    One aggregate: the periods of a key, a few hundred at most, are sorted in an array.
    """
    rest = [c for c in quarters.columns if c not in (key, "fiscal")]
    known = quarters.where(F.col("filed") <= day(cutoff)).groupBy(key).agg(F.slice(F.sort_array(F.collect_list(F.struct("fiscal", *rest)), asc=False), 1, k).alias("last"))
    gaps = F.zip_with(F.slice("last", 1, k - 1), F.slice("last", 2, k - 1), lambda a, b: F.datediff(a["fiscal"], b["fiscal"])) if k > 1 else F.array().cast("array<int>")
    good = known.where((F.size("last") == k) & F.forall(gaps, lambda g: g.between(*gap)))
    return good.select(key, F.posexplode("last").alias("_at", "_q")).select(key, "_q.*", (F.col("_at") + 1).alias("rn"))


def strict_sum(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Sum per key, null as soon as one value does not read as a number."""
    v = number(F.col(value).cast("string"))
    return df.groupBy(key).agg(F.when(F.count(v) == F.count("*"), F.sum(v)).alias(out))


def inventory(bars: DataFrame, fundamentals: DataFrame, meta: DataFrame) -> DataFrame:
    """One row of counts: symbols with bars, fundamentals, meta rows."""
    tagged = bars.select(F.lit(0).alias("kind"), "symbol").union(fundamentals.select(F.lit(1), F.lit(None))).union(meta.select(F.lit(2), F.lit(None)))
    return tagged.agg(F.countDistinct(F.when(F.col("kind") == 0, F.col("symbol"))).alias("n_symbols"), F.count_if(F.col("kind") == 1).alias("n_fundamentals"), F.count_if(F.col("kind") == 2).alias("n_meta"))


def freshness(bars: DataFrame) -> DataFrame:
    """One row: the latest date and the latest ingestion, null on an empty table."""
    return bars.agg(F.max("datum").alias("last_date"), F.max("t_ingest").alias("last_ingest"))


def coverage(bars: DataFrame, fundamentals: DataFrame, meta: DataFrame) -> DataFrame:
    """``symbol, last_date, has_fundamentals, category`` of every symbol of any of the three tables; a blank category is none."""
    last = bars.groupBy("symbol").agg(F.max("datum").alias("last_date"))
    fund = fundamentals.select("symbol", F.lit(True).alias("f")).distinct()
    cats = meta.select("symbol", F.nullif(F.trim("category"), F.lit("")).alias("category"))
    out = last.join(fund, "symbol", "full").join(cats, "symbol", "full")
    return out.select("symbol", "last_date", F.coalesce("f", F.lit(False)).alias("has_fundamentals"), "category")


def coverage_first(rows: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` coverage rows by symbol."""
    return rows.orderBy("symbol").limit(limit)


def coverage_summary(rows: DataFrame, limit: int | None = None) -> DataFrame:
    """Counts over coverage rows and the share, in percent, of those that have a bar, fundamentals and a category.

    With a limit the complete ones are counted among the first rows by symbol, the share is of
    those, and ``n_counted`` is their number; the other counts are of all rows.
    """
    c = lambda cond: F.count_if(cond)
    whole = F.col("last_date").isNotNull() & F.col("has_fundamentals") & F.col("category").isNotNull()
    every = [F.count("*").alias("n"), c(whole).alias("n_complete"), c(F.col("last_date").isNotNull()).alias("n_prices"), c(F.col("has_fundamentals")).alias("n_fundamentals"), c(F.col("category").isNotNull()).alias("n_category")]
    share = lambda n: F.when(F.col(n) > 0, F.round(100.0 * F.col("n_complete") / F.col(n), 1)).otherwise(F.lit(0.0))
    got = rows.agg(*every)
    if limit is None:
        return got.withColumn("percent", share("n"))
    first = coverage_first(rows, limit).agg(F.count("*").alias("n_counted"), c(whole).alias("n_complete"))
    return got.drop("n_complete").join(F.broadcast(first)).withColumn("percent", share("n_counted"))  # one row each


def priority_union(active: DataFrame, delisted: DataFrame, key: str, seq: str) -> DataFrame:
    """Both lists, one row per key: an active row beats a delisted one, the last active wins, the first delisted wins."""
    cols = [c for c in active.columns if c != key]
    both = active.withColumn("delisted", F.lit(False)).withColumn("_p", F.col(seq).cast("long")).unionByName(delisted.withColumn("delisted", F.lit(True)).withColumn("_p", -F.col(seq).cast("long")))
    rank = F.struct(~F.col("delisted"), F.col("_p"))
    return both.groupBy(key).agg(*[F.max_by(c, rank).alias(c) for c in cols], F.max_by("delisted", rank).alias("delisted"))


def risk_free_rate(curve: DataFrame, asks: DataFrame, tenor: str = "10 Yr") -> DataFrame:
    """``cutoff, rate``: for each distinct date of ``asks`` the rate of the last day at or before it that has the tenor; null before the first.

    ``curve`` has ``date`` and the map ``rates``. The dates asked for are a small list; days
    meet them by year, a year without a day at or before the date taking the last one of the
    years before, as whole years are read one after another.
    """
    have = curve.select(F.col("date").cast("date").alias("date"), F.col("rates")[tenor].alias("rate")).where("rate is not null")
    want = asks.select(F.col("cutoff").cast("date").alias("cutoff")).where("cutoff is not null").distinct()
    inside = have.join(want, (F.year("date") == F.year("cutoff")) & (F.col("date") <= F.col("cutoff"))).groupBy("cutoff").agg(F.max_by("rate", "date").alias("rate"))
    before = have.groupBy(F.year("date").alias("y")).agg(F.max_by("rate", "date").alias("before"))
    last = want.join(before, F.year("cutoff") - 1 == F.col("y"), "left").select("cutoff", "before")
    return last.join(inside, "cutoff", "left").select("cutoff", F.coalesce("rate", "before").alias("rate"))


def window_counts(events: DataFrame, windows: DataFrame, classes: DataFrame, cutoff=None) -> DataFrame:
    """Events of each class in each window ``[since, until)``, zeros kept; with a cut-off only windows that had ended by it.

    ``windows`` and ``classes`` are small lists. Events are counted per class and day and summed
    up along the days; a window is the difference of the sums before its two ends, so its length
    costs nothing. A window that ends before it begins, or lacks an end, counts none.
    """
    if cutoff is not None:
        windows = windows.where(F.col("until") <= day(cutoff))
    daily = events.where("cls is not null and datum is not null").groupBy("cls", "datum").agg(F.count("*").alias("c"))
    sums = running_total(daily, ["cls"], "datum", "c", "total").select("cls", F.col("datum").alias("last"), "total")
    grid = windows.crossJoin(classes).select("cls", "since", "until")
    ends = grid.select("cls", F.explode(F.array("since", "until")).alias("edge")).where("edge is not null").distinct()
    before = asof_join(ends, sums, ["cls"], "edge", "last", ["total"], strict=True).select("cls", "edge", F.coalesce("total", F.lit(0)).alias("total"))
    low, high = (before.select("cls", F.col("edge").alias(e), F.col("total").alias(f"_{e}")) for e in ("since", "until"))
    n = F.greatest(F.coalesce(F.col("_until") - F.col("_since"), F.lit(0)), F.lit(0))
    return grid.join(low, ["cls", "since"], "left").join(high, ["cls", "until"], "left").select("cls", "since", "until", n.alias("n"))


def price_as_of_each(asks: DataFrame, bars: DataFrame, field: str = "close") -> DataFrame:
    """``asks`` (``symbol, cutoff``, more may follow) with ``datum`` and ``value``: the symbol's last value that is not null at or before the row's cut-off."""
    if field not in FIELDS:
        raise ValueError(f"field {field!r} is not one of {FIELDS}")
    return asof_join(asks, bars.where(F.col(field).isNotNull()).select("symbol", "datum", F.col(field).alias("value")), ["symbol"], "cutoff", "datum", ["value"])


def rate_as_of_each(asks: DataFrame, curve: DataFrame, tenor: str = "10 Yr") -> DataFrame:
    """``asks`` with ``date`` and ``rate`` of the curve's last day at or before the row's ``cutoff`` that has the tenor; for any number of cut-offs."""
    have = curve.select(F.col("date").cast("date").alias("date"), F.col("rates")[tenor].alias("rate"), F.lit(0).alias("_one")).where("rate is not null")
    return asof_join(asks.withColumn("_one", F.lit(0)), have, ["_one"], "cutoff", "date", ["rate"]).drop("_one")


def turnover_each(asks: DataFrame, bars: DataFrame, shares: DataFrame, days: int = 90) -> DataFrame:
    """``asks`` with ``turnover``: mean volume of the symbol over the window up to the row's cut-off by shares; null without volume or shares above zero."""
    mean = trailing(asks, bars.where("volume is not null").select("symbol", "datum", "volume"), ["symbol"], "cutoff", "datum", days, {"_mean": F.avg("volume")})
    known = shares.where("shares > 0").select("symbol", F.col("shares").alias("_shares"))
    return mean.join(known, "symbol", "left").select(*asks.columns, (F.col("_mean") / F.col("_shares")).alias("turnover"))


def fallback_lookup(df: DataFrame, pairs: DataFrame, singles: DataFrame, a: str, b: str, value: str) -> DataFrame:
    """Value by the pair ``(a, b)``, else by ``b`` alone; rows without either are dropped. Both maps have unique keys."""
    p = pairs.withColumnRenamed(value, "_p")
    s = singles.withColumnRenamed(value, "_s")
    return df.join(p, [a, b], "left").join(s, b, "left").withColumn(value, F.coalesce("_p", "_s")).where(F.col(value).isNotNull()).drop("_p", "_s")


def present(flag: Column) -> Column:
    """A truth value with null as false."""
    return F.coalesce(flag, F.lit(False))
