"""Building the market tables from cached payloads, and completing stored documents, in steps that can be stopped and resumed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..durable import durable
from ..functions.scalar import patent_ref, strip
from ..operators.temporal import upsert_view
from ..sources import cache, writers

Write = Callable[[str, DataFrame], None]
#: Source types of patents, as delivered and as a rung.
PATENT_TYPES = ("epo", "patent")


def bars_from_cache(log: DataFrame, t_ingest: str | None, space: str = cache.BARS_NAMESPACE) -> DataFrame:
    """Rows of the price table from all cached bar lists, the last of a symbol and day."""
    rows = writers.bar_rows(cache.bars_of(log, space), t_ingest)
    return writers.current_rows(rows, ["symbol", "datum"])


def fundamentals_from_cache(log: DataFrame, t_ingest: str | None, space: str = cache.DEFAULT_NAMESPACE) -> DataFrame:
    """Rows of the fundamentals table from all cached dumps; markers without content and corrupt entries are left out."""
    kind = F.schema_of_variant(F.try_parse_json("data"))
    full = cache.entries(log, space).where(kind.isNotNull() & ~kind.isin("OBJECT<>", "ARRAY<VOID>", "VOID"))
    return writers.fundamental_rows(full.select("symbol", F.col("data").alias("payload"), F.lit(0).alias("seq")), t_ingest)


def sensors_from_cache(log: DataFrame, space: str, source: str, date_field: str, t_ingest: str | None) -> DataFrame:
    """Rows of the series table from cached lists, one entity per entry."""
    each = cache.bars_of(log, space).select(F.lit(source).alias("source"), F.col("symbol").alias("entity"), F.col("bar").alias("row"), "seq")
    return writers.sensor_rows(each, date_field, None, t_ingest)


def meta_for_cached(log: DataFrame, categories: DataFrame, t_ingest: str | None, spaces: tuple[str, ...] = (cache.BARS_NAMESPACE, cache.DEFAULT_NAMESPACE)) -> DataFrame:
    """Meta rows of the categorised symbols that any of the caches has an entry of, a marker included."""
    known = log.where(F.col("namespace").isin(*spaces)).select("symbol").distinct()
    rows = categories.join(known, "symbol", "left_semi").withColumn("t_ingest", F.lit(t_ingest).cast("string")).withColumn("seq", F.lit(0))
    return writers.meta_rows(rows)


def build_market(log: DataFrame, categories: DataFrame | None, t_ingest: str | None, write: Write, progress: Callable[[str, int], None] | None = None, stop: Callable[[], bool] | None = None) -> dict:
    """Prices, then fundamentals, then meta, each written as one batch; ``stop`` is asked before each.

    What was written stays: a stopped build is resumed by building again, as the last row of a
    key counts. Returns the counts of what this build wrote.
    """
    got = {"n_symbols": 0, "n_bars": 0, "n_fundamentals": 0, "n_meta": 0, "stopped": False}
    phases = [("eod_price", lambda: bars_from_cache(log, t_ingest)), ("fundamentals", lambda: fundamentals_from_cache(log, t_ingest))]
    if categories is not None:
        phases.append(("entity_meta", lambda: meta_for_cached(log, categories, t_ingest)))
    for name, make in phases:
        if stop is not None and stop():
            got["stopped"] = True
            break
        rows = durable(make(), name)
        c = rows.agg(F.count("*").alias("n"), F.countDistinct("symbol").alias("s")).first()
        write(name, rows)
        got |= {"eod_price": {"n_bars": c["n"], "n_symbols": c["s"]}, "fundamentals": {"n_fundamentals": c["n"]}, "entity_meta": {"n_meta": c["n"]}}[name]
        if progress is not None:
            progress(name, c["n"])
    return got


def to_complete(documents: DataFrame, done: DataFrame | None, text_max: int = 200, limit: int | None = None) -> DataFrame:
    """``id, url, text`` of patent documents with a short text that have no done marker; with a ``limit`` the smallest ids."""
    out = documents.where(F.col("source_type").isin(*PATENT_TYPES) & (F.length(F.coalesce("text", F.lit(""))) < text_max))
    if done is not None:
        out = out.join(done.select(F.col("doc_id").alias("id")), "id", "left_anti")
    out = out.select("id", "url", "text")
    return out if limit is None else out.orderBy("id").limit(limit)


def complete_texts(open_: DataFrame, abstracts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``id, text`` of completed documents, and done markers ``doc_id, has_abstract``.

    ``abstracts`` has ``ref, abstract, error`` of the requests made. An abstract is put after
    the text; a document without one, or whose id is no reference, is done too; one whose
    request failed, or was not made, stays open. Facts of completed documents are to be read
    anew: take their ids out of the facts' done markers (``reopened``).
    """
    named = open_.withColumn("ref", patent_ref(strip("url")))
    got = named.join(abstracts.select("ref", "abstract", F.coalesce("error", F.lit("")).alias("error"), F.lit(True).alias("asked")), "ref", "left")
    text = strip(F.coalesce("abstract", F.lit("")))
    finished = got.where(F.col("ref").isNull() | (F.col("asked") & (F.col("error") == "")))
    new = finished.where(F.col("ref").isNotNull() & (text != "")).select("id", strip(F.concat(strip(F.coalesce("text", F.lit(""))), F.lit(" "), text)).alias("text"))
    return new, finished.select(F.col("id").alias("doc_id"), (F.col("ref").isNotNull() & (text != "")).alias("has_abstract"))


def reopened(facts_done: DataFrame, completed: DataFrame) -> DataFrame:
    """The facts' done markers without those of documents whose text has changed."""
    return facts_done.join(completed.select(F.col("id").alias("doc_id")), "doc_id", "left_anti")


def backfill(store_read: Callable[[str], DataFrame | None], write: Write, call: Callable[[str], str], parse: Callable[[DataFrame], DataFrame], t_run: str, most: int = 300, batch: int = 100, stop: Callable[[], bool] | None = None) -> dict[str, int]:
    """Complete up to ``most`` documents, a batch after another: fetch, parse, write the texts and the markers of each batch, then go on.

    ``store_read`` gives ``documents`` (current rows) and ``abstract_done`` as they are now;
    ``write`` appends to ``documents_text`` and ``abstract_done``. Markers are written last, so a run
    that breaks off repeats a batch at most. ``parse`` maps ``ref, data`` to ``ref, abstract``.
    """
    got = {"open": 0, "completed": 0, "without": 0, "errors": 0}
    left, failed = most, None
    while left > 0 and not (stop is not None and stop()):
        open_ = to_complete(store_read("documents"), store_read("abstract_done"))
        if failed is not None:
            open_ = open_.join(failed, "id", "left_anti")
        open_ = durable(open_.orderBy("id").limit(min(batch, left)), "open")
        n = open_.count()
        if n == 0:
            break
        refs = open_.select(patent_ref(strip("url")).alias("ref")).where("ref is not null").distinct()
        fetched = durable(cache.fetch(refs, call, "ref"), "fetched")
        texts = parse(fetched.where("error is null").select("ref", "data"))
        answers = fetched.join(texts.select("ref", "abstract"), "ref", "left").select("ref", "abstract", "error")
        new, done = (durable(x, "completed") for x in complete_texts(open_, answers))
        write("documents_text", new.withColumn("t_run", F.lit(t_run)))
        write("abstract_done", done)
        c, k = new.count(), done.count()
        got = {"open": got["open"] + n, "completed": got["completed"] + c, "without": got["without"] + k - c, "errors": got["errors"] + n - k}
        bad = open_.select("id").join(done.select(F.col("doc_id").alias("id")), "id", "left_anti")
        failed = durable(bad if failed is None else failed.union(bad), "failed")
        left -= n
    return got


def current_documents(documents: DataFrame, texts: DataFrame, seq: str = "seq") -> DataFrame:
    """Documents with their latest completed text; ``texts`` is the append-only log of ``id, text, seq``."""
    last = upsert_view(texts, ["id"], seq, ["text"]).select("id", F.col("text").alias("_text"))
    return documents.join(last, "id", "left").withColumn("text", F.coalesce("_text", "text")).drop("_text")
