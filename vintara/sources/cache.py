"""A cache of payloads by namespace and symbol: an append-only log, the last entry of a key counts.

``log`` has ``namespace, symbol, data, t_ingest, seq``: ``data`` the JSON text (in Parquet the
codec compresses it), ``t_ingest`` the UTC time of writing as text. An empty object or list
is an entry too: it marks that there is nothing to fetch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship
from .writers import current_rows

DEFAULT_NAMESPACE, BARS_NAMESPACE = "fundamentals_cache", "eod_cache"


def namespace(path: str | None) -> str:
    """The last part of a path, which keeps datasets apart; the default where there is none."""
    return str(path or "").rstrip("/\\").replace("\\", "/").rsplit("/", 1)[-1] or DEFAULT_NAMESPACE


def entries(log: DataFrame, space: str | None = None) -> DataFrame:
    """The current entries, of one namespace or of all."""
    return current_rows(log if space is None else log.where(F.col("namespace") == space), ["namespace", "symbol"])


def cache_rows(rows: DataFrame, space: str, t_ingest: str) -> DataFrame:
    """Rows to append for fetched payloads (``symbol, data, seq``); what is neither an object nor a list is not cached."""
    kind = F.schema_of_variant(F.try_parse_json("data"))
    return rows.where(F.coalesce(kind.rlike("^(OBJECT|ARRAY)"), F.lit(False))).select(F.lit(space).alias("namespace"), F.col("symbol").cast("string").alias("symbol"), "data", F.lit(t_ingest).alias("t_ingest"), "seq")


def age_days(t_ingest: Column, now: str) -> Column:
    """Age in days; null where the time cannot be read."""
    at = F.try_to_timestamp(t_ingest, F.lit("yyyy-MM-dd HH:mm:ss"))
    return (F.unix_micros(F.lit(now).cast("timestamp")) - F.unix_micros(at)) / F.lit(86_400_000_000.0)


def read(log: DataFrame, space: str, now: str, max_age_days: float | None = None) -> DataFrame:
    """``symbol, data, age_days`` of entries that may be used: well-formed, and not older than the limit where there is one.

    An entry exactly as old as the limit is used, one whose time cannot be read never expires.
    Corrupt entries are as if not there (see ``corrupt``).
    """
    found = entries(log, space).withColumn("age_days", age_days(F.col("t_ingest"), now)).where(F.try_parse_json("data").isNotNull())
    if max_age_days is not None:
        found = found.where(F.coalesce(F.col("age_days") <= max_age_days, F.lit(True)))
    return found.select("symbol", "data", "age_days")


def corrupt(log: DataFrame, space: str | None = None) -> DataFrame:
    """``namespace, symbol`` of entries that are no JSON, one row each."""
    return entries(log, space).where(F.try_parse_json("data").isNull()).select("namespace", "symbol")


def freshness_days(log: DataFrame, space: str, now: str) -> DataFrame:
    """``symbol, age_days``; an unreadable time counts as fresh."""
    return entries(log, space).select("symbol", F.coalesce(age_days(F.col("t_ingest"), now), F.lit(0.0)).alias("age_days"))


def symbols(log: DataFrame, space: str) -> DataFrame:
    """The cached symbols of a namespace, corrupt entries and markers among them, each once."""
    return log.where(F.col("namespace") == space).select("symbol").distinct()


def missing(asked: DataFrame, log: DataFrame, space: str) -> DataFrame:
    """Symbols asked for that have no entry."""
    return asked.select("symbol").distinct().join(symbols(log, space), "symbol", "left_anti")


def inventory(log: DataFrame) -> DataFrame:
    """``namespace, n, bytes`` of the current entries."""
    return entries(log).groupBy("namespace").agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("data")), F.lit(0)).alias("bytes"))


def migrate_gzip(spark: SparkSession, folder: str, space: str | None, t_ingest: str) -> DataFrame:
    """Rows to append from a folder of ``<bucket>/<symbol>.json.gz`` files, unreadable ones left out; none if the folder is missing.

    Each file is read whole by the task that has it. Running it twice leaves the same current entries.
    """
    schema = "namespace string, symbol string, data string, t_ingest string, seq long"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], schema)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json.gz").load(folder)

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import gzip
        import zlib

        for pdf in batches:
            texts = []
            for raw in pdf["content"]:
                try:
                    texts.append(gzip.decompress(raw).decode())
                except (OSError, EOFError, ValueError, zlib.error):
                    texts.append(None)
            yield pd.DataFrame({"path": pdf["path"], "data": texts})

    name = F.url_decode(F.regexp_extract("path", r"([^/]+)\.json\.gz$", 1))
    ship(spark)
    rows = files.select("path", "content").mapInPandas(unpack, "path string, data string").where(F.try_parse_json("data").isNotNull())
    return rows.select(F.lit(namespace(space or folder)).alias("namespace"), name.alias("symbol"), "data", F.lit(t_ingest).alias("t_ingest"), F.lit(0).cast("long").alias("seq"))


# --- cache first -------------------------------------------------------------------------------------------


class FetchError(RuntimeError):
    """Too large a share of a batch of requests failed, or a response is not what may be cached."""


def fetch(requests: DataFrame, call: Callable[[str], str], key: str = "symbol", workers: int | None = None, per_minute: float | None = None) -> DataFrame:
    """``key, data, error``: ``call`` on each request, in tasks; an error becomes a row, not a failed job.

    ``call`` gets the key as text and returns a JSON text. Network access, tokens and retries
    are its own matter (see ``readers``), so that tests inject what they like. ``workers`` is the
    number of tasks; ``per_minute`` a limit for all of them together, which needs ``workers``
    (a retry of ``call``'s own is not counted: give ``patiently`` no shorter pause).
    """
    if per_minute is not None and not workers:
        raise ValueError("a rate needs a number of workers")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        from .rate import leased

        paced = leased(call, TaskContext.get().partitionId(), workers or 1, per_minute) if per_minute is not None else call
        for pdf in batches:
            data, errors = [], []
            for k in pdf[key]:
                try:
                    data.append(paced(k))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001  a request that fails is counted
                    data.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pd.DataFrame({key: pdf[key], "data": data, "error": errors})

    ship(requests.sparkSession)
    asked = requests.select(F.col(key).cast("string").alias(key))
    if workers:
        asked = asked.repartition(workers)
    return asked.mapInPandas(run, f"{key} string, data string, error string")


def list_only(fetched: DataFrame) -> DataFrame:
    """Fetched rows in which anything but a list is an error, so that no fault answer is ever cached as bars."""
    ok = F.coalesce(F.schema_of_variant(F.try_parse_json("data")).startswith("ARRAY"), F.lit(False))
    return fetched.select(*[c for c in fetched.columns if c not in ("data", "error")], F.when(ok, F.col("data")).alias("data"), F.when(ok, F.lit(None)).otherwise(F.coalesce("error", F.lit("not a list"))).alias("error"))


def prefetch(asked: DataFrame, log: DataFrame, space: str, call: Callable[[str], str], store: Callable[[DataFrame], None], batch: int = 200, most_errors: float = 0.8, lists: bool = True, progress: Callable[[int, int], None] | None = None, stop: Callable[[], bool] | None = None, workers: int | None = None, per_minute: float | None = None) -> dict[str, int]:
    """Fetch what is not cached, a batch of symbols after another, and ``store`` each batch's rows; an empty list is a success.

    More than ``most_errors`` of a batch failing ends the run with an error, with the batches
    before it stored. ``stop`` is asked before each batch; ``progress`` is told after it. Batches are
    cut by hash, once, so their size is ``batch`` on average and each reads its own files alone.
    ``workers`` and ``per_minute`` as of ``fetch``. Returns counts.
    """
    from ..durable import durable, forget

    total = asked.select("symbol").distinct().count()
    found = durable(missing(asked, log, space), "to-fetch")
    n = found.count()
    parts = max(1, -(-n // batch))
    open_ = durable(found.withColumn("part", F.pmod(F.xxhash64("symbol"), F.lit(parts)).cast("int")).repartition("part"), "to-fetch", by="part")
    forget(found)
    got = {"fetched": 0, "skipped": total - n, "errors": 0, "total": total}
    for i in range(parts if n else 0):
        if stop is not None and stop():
            break
        rows = fetch(open_.where(F.col("part") == i), call, workers=workers, per_minute=per_minute)
        rows = durable(list_only(rows) if lists else rows, "fetched")
        c = rows.agg(F.count("*").alias("n"), F.count("error").alias("e")).first()
        if c["n"] and c["e"] / c["n"] > most_errors:
            raise FetchError(f"{c['e']} of {c['n']} requests of a batch failed")
        store(rows.where("error is null").select("symbol", "data", F.lit(0).cast("long").alias("seq")))
        got["fetched"] += c["n"] - c["e"]
        got["errors"] += c["e"]
        forget(rows)
        if progress is not None:
            progress(i + 1, parts)
    forget(open_)
    return got


def slice_window(bars: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Bars with a day inside the closed window, by the first ten characters of ``date``."""
    d = F.substring("date", 1, 10)
    bars = bars.where(F.coalesce("date", F.lit("")) != "")
    if start:
        bars = bars.where(d >= start)
    return bars.where(d <= end) if end else bars


def incomplete(asked: DataFrame, log: DataFrame, space: str, end: str) -> DataFrame:
    """Cached symbols whose last bar is before ``end``: those to fetch once more."""
    bars = F.from_json("data", "array<struct<date:string>>")
    last = entries(log, space).select("symbol", F.array_max(F.transform(bars, lambda b: F.substring(b["date"], 1, 10))).alias("last"))
    return asked.select("symbol").distinct().join(last.where(F.coalesce(F.col("last") < end, F.lit(True))).select("symbol"), "symbol", "left_semi")


def window_of_bars(log: DataFrame, space: str, asked: DataFrame, now: str, start: str | None = None, end: str | None = None, max_age_days: float | None = None) -> DataFrame:
    """``symbol, date, bar``: bars of the closed window of the symbols asked for, from the cache alone; a symbol without a usable entry has none."""
    have = read(log, space, now, max_age_days).join(asked.select("symbol").distinct(), "symbol", "left_semi")
    each = have.select("symbol", F.explode(F.try_variant_get(F.try_parse_json("data"), "$", "array<variant>")).alias("b"))
    return slice_window(each.select("symbol", F.try_variant_get("b", "$.date", "string").alias("date"), F.to_json("b").alias("bar")), start, end)


def bars_of(log: DataFrame, space: str = BARS_NAMESPACE) -> DataFrame:
    """``symbol, bar, seq``: every bar of the cached lists as a JSON text, for ``writers.bar_rows``."""
    each = entries(log, space).select("symbol", F.posexplode(F.try_variant_get(F.try_parse_json("data"), "$", "array<variant>")).alias("seq", "b"))
    return each.select("symbol", F.to_json("b").alias("bar"), F.col("seq").cast("long").alias("seq"))

