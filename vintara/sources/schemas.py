"""The tables of the market, collector and recording stores, and their creation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.collect import normalise_source

# Columns and keys of the stored tables, under English names.
MARKET = {
    "eod_price": ("symbol string, datum string, open double, high double, low double, close double, adjusted_close double, volume double, t_ingest string", ("symbol", "datum")),
    "entity_meta": ("symbol string, name string, sector string, category string, currency string, t_ingest string", ("symbol",)),
    "fundamentals": ("symbol string, payload string, t_ingest string", ("symbol",)),
    "sensor_series": ("source string, entity string, datum string, payload string, t_disclosed string, t_ingest string", ("source", "entity", "datum", "t_disclosed")),
}
COLLECTOR = {
    "documents": ("id long, source_id string, source_type string, title string, text string, url string, relevance double, trust double, published_at string, ingested_at string, dup_of long", ("title", "published_at")),
    "facts": ("id long, doc_id long, source_type string, subject string, relation string, object string, mode string, signal string, maturity string, maturity_score double, latency string, pace string, confidence string, published_at string, ingested_at string", ("doc_id", "subject", "relation", "object")),
    "exclusions": ("fact_id long, reason string, actor string, t_disclosed string, active boolean", ("fact_id",)),
    "capital": ("category_id string, version int, kind string, direction string, stage string, amount double, amount_class string, opaque boolean, cik string, sic string, entity string, source string, t_event string, t_disclosed string, t_ingest string", ("category_id", "version", "cik", "entity", "t_disclosed")),
}
RECORDING = {
    "ingest_log": ("run_id string, source string, n_found long, n_new long, t_ingest string", ("run_id",)),
    "findings": ("run_id string, doc_id string", ("run_id", "doc_id")),
    "documents_raw": ("doc_id string, title string, text string, url string, payload string, content_hash string, relevance double, accepted boolean, t_event string, t_disclosed string, t_ingest string", ("doc_id",)),
    "decisions": ("doc_id string, relevance double, accepted boolean, model string", ("doc_id",)),
    "attributes": ("doc_id string, fact_id string, name string, value string, extractor string, computed_at string", ("doc_id", "fact_id", "name", "extractor")),
    "extractors": ("extractor string, version string, prompt_hash string", ("extractor",)),
}
CACHE = {"cache_entry": ("namespace string, symbol string, data binary, t_ingest string", ("namespace", "symbol"))}


def create_tables(spark: SparkSession, tables: dict[str, tuple[str, tuple[str, ...]]], database: str = "default") -> list[str]:
    """Create what is missing of ``tables`` as Parquet tables; those that are there stay as they are. Returns the names made."""
    if not database.replace("_", "").isalnum():
        raise ValueError(f"{database!r} is not a database name")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    made = [n for n in tables if not spark.catalog.tableExists(f"{database}.{n}")]
    for n in made:
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{n}` ({tables[n][0]}) USING parquet")
    return made


def open_collector(spark: SparkSession, database: str = "default") -> dict[str, DataFrame]:
    """The collector's tables by name, made where they are missing; the documents of older stores come with source types as rungs.

    Nothing stored is changed, so opening twice gives the same: normalising is part of the read.
    """
    create_tables(spark, COLLECTOR, database)
    tables = {n: spark.table(f"{database}.{n}") for n in COLLECTOR}
    return tables | {"documents": normalise_source(tables["documents"])}
