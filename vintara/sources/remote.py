"""From a request to rows: a source's addresses, its transport and its parser put together.

``transport`` names a function as ``module:function`` and ``headers`` are what it is given; with
``readers.replay`` and saved answers everything runs offline.
"""

from __future__ import annotations

import datetime
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.market import priority_union, risk_free_rate
from ..shipping import ship
from . import cache, parsers, readers

CURL = "vintara.sources.readers:curl"


def today(given: str | None = None) -> str:
    """The given day, or the present one in UTC, as ISO text."""
    return given or datetime.datetime.now(datetime.timezone.utc).date().isoformat()


def payloads(spark: SparkSession, requests: dict[str, str], transport: str = CURL, headers: dict[str, str] | None = None) -> DataFrame:
    """``name, payload`` of each request, fetched by a task of its own."""
    ship(spark)
    spark.dataSource.register(readers.PayloadSource)
    return spark.read.format("payloads").option("requests", json.dumps(requests)).option("transport", transport).option("headers", json.dumps(headers or {})).load()


def papers(spark: SparkSession, query: str, most: int = 5, transport: str = CURL, headers: dict[str, str] | None = None) -> DataFrame:
    """The newest papers of a search as documents."""
    got = payloads(spark, {"feed": readers.feed_url(query, most, "submittedDate")}, transport, headers)
    return parsers.atom_documents(got, "payload").drop("pos").withColumn("source_type", F.lit("arxiv"))


def filings(spark: SparkSession, query: str, since: str, until: str | None = None, most: int = 50, transport: str = CURL, headers: dict[str, str] | None = None) -> DataFrame:
    """Filings of a span of days as documents, ``most`` at most, by name and day."""
    got = payloads(spark, {"hits": readers.filing_search_url(query, since, until)}, transport, headers)
    return parsers.filing_documents(parsers.filing_hits(got, "payload")).orderBy("published_at", "title").limit(most)


def filing_amounts(spark: SparkSession, asked: list[tuple[str, str]], transport: str = CURL, headers: dict[str, str] | None = None) -> DataFrame:
    """``name, amount`` of filings given by company number and accession; null where a document says none."""
    return payloads(spark, {a: readers.filing_url(c, a) for c, a in asked}, transport, headers).select("name", parsers.filing_amount(F.col("payload")).alias("amount"))


def patents(spark: SparkSession, refs: list[str], transport: str = CURL, headers: dict[str, str] | None = None) -> DataFrame:
    """Records of patents by reference."""
    return parsers.patent_records(payloads(spark, {r: readers.patent_url(r) for r in refs}, transport, headers), "payload")


def series(spark: SparkSession, ids: list[str], token: str, since: str | None = None, vintage: str | None = None, transport: str = CURL, headers: dict[str, str] | None = None) -> DataFrame:
    """Observations of series; with a vintage, as they were known on that day."""
    return parsers.observations(payloads(spark, {i: readers.series_url(i, token, since, vintage) for i in ids}, transport, headers))


def rates_as_of(spark: SparkSession, days: list[str], tenor: str = "10 Yr", transport: str = CURL, headers: dict[str, str] | None = None) -> DataFrame:
    """``cutoff, rate`` for each day; its year and the year before are read, each once."""
    years = sorted({int(d[:4]) - k for d in days for k in (0, 1)})
    curve = parsers.curve_lines(payloads(spark, {str(y): readers.curve_url(y) for y in years}, transport, headers), [tenor])
    return risk_free_rate(curve, spark.createDataFrame([(d,) for d in days], "cutoff string"), tenor)


def universe(spark: SparkSession, token: str, exchange: str = "US", kind: str | None = None, transport: str = CURL, headers: dict[str, str] | None = None) -> DataFrame:
    """Active and delisted symbols of an exchange, one row each, active before delisted."""
    lists = {flag: payloads(spark, {"list": readers.symbols_url(token, exchange, flag)}, transport, headers) for flag in (False, True)}
    return priority_union(parsers.listed_symbols(lists[False], kind), parsers.listed_symbols(lists[True], kind), "symbol", "seq")


def count_windows(classes: DataFrame, windows: DataFrame, log: DataFrame, call: Callable[[str], str], store: Callable[[DataFrame], None], read: Callable[[], DataFrame], cutoff: str | None = None, space: str = "counts", field: str = "ipc", batch: int = 25, workers: int | None = None, per_minute: float | None = None) -> DataFrame:
    """``cls, since, until, n`` of every class and window; with a cut-off only of windows that had ended by it.

    Counts that ``log`` has are not asked for again; each batch of new ones is stored as it
    comes, so a run that breaks off is resumed. ``call`` gets a window's name
    (``readers.window_of`` gives its search) and returns the answer; ``read`` gives the log as it
    is after storing. A count that cannot be had is an error. ``workers`` and ``per_minute`` (one
    rate for all) as of ``cache.fetch``.
    """
    if cutoff is not None:
        full = F.col("until").rlike(r"^\d{4}-\d{2}-\d{2}$")
        windows = windows.where(full & (F.col("until") <= cutoff))
    name = F.concat_ws(":", F.lit(field), "cls", "since", "until")
    grid = windows.select("since", "until").crossJoin(classes.select("cls")).withColumn("symbol", name)
    got = cache.prefetch(grid.select("symbol"), log, space, call, store, batch=batch, lists=False, workers=workers, per_minute=per_minute)
    if got["errors"]:
        raise cache.FetchError(f"{got['errors']} of {got['total']} counts could not be had")
    counts = cache.entries(read(), space).select("symbol", parsers.search_count(F.col("data")).alias("n"))
    return grid.join(counts, "symbol").select("cls", "since", "until", "n")


def bars(asked: DataFrame, read: Callable[[], DataFrame], now: str, start: str | None = None, end: str | None = None, call: Callable[[str], str] | None = None, store: Callable[[DataFrame], None] | None = None, space: str = cache.BARS_NAMESPACE, max_age_days: float | None = None, renew: bool = False, **how) -> DataFrame:
    """``symbol, date, bar`` of a closed window of days, cache first.

    ``read`` gives the log. Symbols without a usable entry are fetched whole by ``call`` and
    stored by ``store`` (rows ``symbol, data, seq``), a batch after another; with ``renew`` those whose
    last bar is before ``end`` are fetched once more. Without ``call`` only the cache is read. Anything
    but a list is an error and is not stored. ``how`` as of ``cache.prefetch``.
    """
    if call is not None:
        log = read()
        none = log.where("false")
        usable = cache.read(log, space, now, max_age_days).select("symbol")
        todo = asked.select("symbol").distinct().join(usable, "symbol", "left_anti")
        if renew and end:
            todo = todo.union(cache.incomplete(asked, log, space, end)).distinct()
        cache.prefetch(todo, none, space, call, store, lists=True, **how)
    return cache.window_of_bars(read(), space, asked, now, start, end, max_age_days)


def market_call(make: Callable[[str, str], str], names: tuple[str, ...], check: Callable[[str], str], transport: str = CURL, headers: dict[str, str] | None = None, file: str | None = None) -> Callable[[str], str]:
    """A ``call`` for ``cache.fetch``: address by ``make(symbol, key)``, the key looked up by the task, the answer through ``check``."""

    def call(symbol: str) -> str:
        import importlib

        module, name = transport.split(":")
        return check(getattr(importlib.import_module(module), name)(make(symbol, readers.key(None, names, file)), headers or {}))

    return call


def fundamentals(asked: DataFrame, read: Callable[[], DataFrame], now: str, call: Callable[[str], str] | None = None, store: Callable[[DataFrame], None] | None = None, space: str = cache.DEFAULT_NAMESPACE, max_age_days: float | None = None, **how) -> DataFrame:
    """``symbol, json`` of the dumps of the symbols asked for, cache first; symbols marked as having none are left out."""
    if call is not None:
        log = read()
        todo = asked.select("symbol").distinct().join(cache.read(log, space, now, max_age_days).select("symbol"), "symbol", "left_anti")
        cache.prefetch(todo, log.where("false"), space, call, store, lists=False, **how)
    got = cache.read(read(), space, now, max_age_days).join(asked.select("symbol").distinct(), "symbol", "left_semi")
    return got.select("symbol", F.col("data").alias("json")).where("data <> '{}'")


def earnings(spark: SparkSession, start: str, end: str, token: str, transport: str = CURL, headers: dict[str, str] | None = None, warn: Callable[[str], None] = print) -> DataFrame:
    """``code, report_date`` of a span of days; where the source fails none, with a warning."""
    import importlib

    module, name = transport.split(":")
    text = readers.soft(lambda: json.dumps(readers.answer(getattr(importlib.import_module(module), name)(readers.calendar_url(start, end, token), headers or {}))), '{"earnings": []}', warn)
    return parsers.earnings_calendar(spark.createDataFrame([(text,)], "json string"))


def patent_search(spark: SparkSession, query: str, first: int = 1, last: int = 25, transport: str = CURL, headers: dict[str, str] | None = None) -> DataFrame:
    """``pos, ref`` of a search's hits in a range; no results are no rows and no error, other faults are errors."""
    import importlib

    module, name = transport.split(":")
    text = readers.no_results_as(lambda: json.dumps(readers.answer(getattr(importlib.import_module(module), name)(readers.patent_search_url(query, first, last), headers or {}))), readers.NO_HITS)
    return parsers.search_references(spark.createDataFrame([(text,)], "payload string"), "payload")


def exchanges(spark: SparkSession, token: str, transport: str = CURL, headers: dict[str, str] | None = None) -> DataFrame:
    """``code, name, country, currency`` of the exchanges that the source has."""
    got = payloads(spark, {"list": readers.exchanges_url(token)}, transport, headers)
    rows = got.select(F.explode(F.from_json("payload", "array<struct<Code:string,Name:string,Country:string,Currency:string>>")).alias("r"))
    return rows.select(F.col("r.Code").alias("code"), F.col("r.Name").alias("name"), F.col("r.Country").alias("country"), F.col("r.Currency").alias("currency")).where("code <> ''")
