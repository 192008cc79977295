"""Documents, facts, capital events, exclusions and themes, read as of a date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import canonical_entity, source_rung, strip
from .temporal import OPEN_END, day

# The categorical vocabularies of a fact; any other value is read as null.
MODES, SIGNALS, LATENCIES = ["ist", "wird"], ["technologie", "ereignis"], ["kurz", "mittel", "lang"]
MAX_TEXT = 2000


def exclusions_in_force(exclusions: DataFrame, cutoff=None) -> DataFrame:
    """Active exclusion markers; with a cut-off only those disclosed by it."""
    out = exclusions.where("active")
    return out if cutoff is None else out.where(F.col("t_disclosed").isNotNull() & (F.col("t_disclosed") <= day(cutoff)))


def _ordered(df: DataFrame, limit: int | None, newest_first: bool, ordered: bool = False) -> DataFrame:
    """The first ``limit`` rows by publication and id; without a limit nothing is sorted unless asked for."""
    if limit is None and not ordered:
        return df
    df = df.orderBy(F.desc("published_at"), F.desc("id")) if newest_first else df.orderBy("published_at", "id")
    return df if limit is None else df.limit(limit)


def facts_as_of(facts: DataFrame, documents: DataFrame | None = None, exclusions: DataFrame | None = None, cutoff=None, published_by=None, since=None, limit: int | None = None, aliases=None, ordered: bool = False) -> DataFrame:
    """Facts knowable at a date, without those of duplicate documents and excluded ones.

    ``cutoff``: ingested before it; ``published_by``: published at or before it; not both. The
    subject must not be blank. A fact without a document stays. Vocabulary columns, where
    present, keep known values only; ``limit`` applies after the order by publication and id.
    Without a limit rows come in no order, unless ``ordered``.
    """
    if cutoff is not None and published_by is not None:
        raise ValueError("either cutoff or published_by, not both")
    out = facts.where(F.trim(F.coalesce("subject", F.lit(""))) != "")
    if since is not None:
        out = out.where(F.col("published_at") >= day(since))
    if cutoff is not None:
        out = out.where(F.col("ingested_at") < day(cutoff))
    if published_by is not None:
        out = out.where(F.col("published_at") <= day(published_by))
    if documents is not None and "dup_of" in documents.columns:
        out = out.join(documents.where("dup_of is not null").select(F.col("id").alias("doc_id")), "doc_id", "left_anti")
    if exclusions is not None:
        gone = exclusions_in_force(exclusions, cutoff if cutoff is not None else published_by)
        out = out.join(gone.select(F.col("fact_id").alias("id")), "id", "left_anti")
    for c, known in (("mode", MODES), ("signal", SIGNALS), ("latency", LATENCIES)):
        if c in out.columns:
            out = out.withColumn(c, F.when(F.col(c).isin(known), F.col(c)))
    out = out.withColumn("subject", canonical_entity(F.col("subject"), aliases))
    return _ordered(out, limit, False, ordered)


def documents_read(documents: DataFrame, limit: int | None = None, since=None, min_relevance: float | None = None, newest_first: bool = False, strip_parts: bool = True) -> DataFrame:
    """Published documents that are no duplicates; text is title, a point and text, cut to 2000 characters.

    White space at the ends of both parts is dropped, unless told otherwise; without a title
    the text stands alone, without a text the point stays. With a ``limit`` the oldest or the
    newest come, in order; without one rows come in no order.
    """
    out = documents.where("published_at is not null and dup_of is null")
    if since is not None:
        out = out.where(F.col("published_at") >= day(since))
    if min_relevance is not None:
        out = out.where(F.col("relevance") >= min_relevance)
    part = lambda c: strip(F.coalesce(c, F.lit(""))) if strip_parts else F.coalesce(c, F.lit(""))
    both = F.concat(part("title"), F.lit(". "), part("text"))
    out = out.withColumn("text", F.substring(F.when(part("title") == "", part("text")).otherwise(both), 1, MAX_TEXT))
    return _ordered(out, limit, newest_first)


def capital_as_of(capital: DataFrame, cutoff=None, published_by=None) -> DataFrame:
    """Capital events knowable at a date; event and ingestion fall back to disclosure."""
    out = capital
    if cutoff is not None:
        out = out.where(F.col("t_ingest") < day(cutoff))
    if published_by is not None:
        out = out.where(F.col("t_disclosed") <= day(published_by))
    return out.withColumn("t_event", F.coalesce("t_event", "t_disclosed")).withColumn("t_ingest", F.coalesce("t_ingest", "t_disclosed"))


def exclusion_hash(exclusions: DataFrame) -> DataFrame:
    """One row: first 16 hex digits of SHA-256 over the active markers in id order; 'leer' if there are none.

    The list is one marker per excluded fact, an administrative table of people's decisions.
    """
    line = F.concat_ws(":", F.col("fact_id").cast("string"), F.coalesce(F.col("t_disclosed").cast("string"), F.lit("")))
    lines = F.transform(F.array_sort(F.collect_list(F.struct(F.col("fact_id").alias("k"), line.alias("l")))), lambda x: x["l"])
    got = exclusions.where("active").agg(F.count("*").alias("n"), F.substring(F.sha2(F.array_join(lines, ";"), 256), 1, 16).alias("h"))
    return got.select(F.when(F.col("n") == 0, F.lit("leer")).otherwise(F.col("h")).alias("hash"))


def normalise_source(documents: DataFrame) -> DataFrame:
    """Source types as rungs; a duplicate whose original lies on another rung is one no more. A missing original changes nothing."""
    rung = documents.withColumn("source_type", source_rung(F.col("source_type")))
    parent = rung.select(F.col("id").alias("dup_of"), F.col("source_type").alias("_other"), F.lit(True).alias("_there"))
    out = rung.join(parent, "dup_of", "left")
    cross = F.coalesce(F.col("_there"), F.lit(False)) & ~F.col("source_type").eqNullSafe(F.col("_other"))
    return out.withColumn("dup_of", F.when(~cross, F.col("dup_of"))).drop("_other", "_there").select(*documents.columns)


def table_if_there(spark: SparkSession, name: str) -> DataFrame | None:
    """A table of the catalog, or None; the readers here take None for a table that a store doesn't have."""
    return spark.table(name) if spark.catalog.tableExists(name) else None


def themes_with_evidence(themes: DataFrame, links: DataFrame, documents: DataFrame | None = None) -> DataFrame:
    """Themes that are not excluded, with the number of linked documents that are no duplicates, zero included.

    Without ``documents``, or where they have no ``dup_of``, all linked documents count.
    """
    if documents is not None and "dup_of" in documents.columns:
        links = links.join(documents.where("dup_of is not null").select(F.col("id").alias("doc_id")), "doc_id", "left_anti")
    n = links.groupBy("theme_id").agg(F.count("*").alias("evidence"))
    return themes.where("not excluded").join(n, themes["id"] == n["theme_id"], "left").drop("theme_id").withColumn("evidence", F.coalesce("evidence", F.lit(0)))


def theme_keywords(keywords: Column | str) -> Column:
    """The keywords of a JSON text that are not blank; null, broken JSON and anything but a list have none."""
    found = F.try_variant_get(F.try_parse_json(keywords), "$", "array<string>")
    return F.filter(F.coalesce(found, F.array().cast("array<string>")), lambda k: F.coalesce(F.trim(k), F.lit("")) != "")


def theme_rows(themes: DataFrame, links: DataFrame, documents: DataFrame | None = None) -> DataFrame:
    """``name, keywords, created_by, created_at, evidence`` of the themes, by name: keywords read from JSON, no origin counts as seed."""
    out = themes_with_evidence(themes, links, documents)
    origin = F.coalesce(F.nullif(F.col("created_by"), F.lit("")), F.lit("seed"))
    return out.select("name", theme_keywords("keywords").alias("keywords"), origin.alias("created_by"), "created_at", "evidence").orderBy("name")


def is_graduated(min_evidence: int = 5, min_labels: int = 0):
    """Whether a theme has the evidence, and the labels where any are asked for; missing counts are zero."""
    ok = F.coalesce("evidence", F.lit(0)) >= min_evidence
    return ok & (F.coalesce("labels", F.lit(0)) >= min_labels) if min_labels else ok


def category_versions(themes: DataFrame, rollup: DataFrame, cutoff=None, version: int = 1, level: str = "technologie") -> DataFrame:
    """Category rows from themes: maturity, validity from creation (else the cut-off; neither: no row), open end, rollup or null."""
    at = F.coalesce("created_at", day(cutoff)) if cutoff is not None else F.col("created_at")
    name = F.trim("name")
    ripe = F.when(is_graduated(), "established").when(F.col("created_by") == "seed", "emerging").otherwise("growing")
    rows = themes.where(F.coalesce(name, F.lit("")) != "").select(name.alias("category_id"), F.lit(version).alias("version"), F.lit(level).alias("level"), F.lit("aktiv").alias("status"), ripe.alias("maturity"), at.alias("t_valid_from"), F.lit(OPEN_END).cast("date").alias("t_valid_to"), at.alias("t_ingest")).where("t_valid_from is not null")
    return rows.join(rollup.select(F.col("name").alias("category_id"), "rollup"), "category_id", "left")


def anchors(themes: DataFrame) -> DataFrame:
    """``name, anchors``: the trimmed name and the keywords that are not blank; themes without a name have none."""
    name = F.trim("name")
    some = F.filter("keywords", lambda k: F.coalesce(F.trim(k), F.lit("")) != "")
    return themes.where(F.coalesce(name, F.lit("")) != "").select(name.alias("name"), F.concat(F.array(name), F.coalesce(some, F.array().cast("array<string>"))).alias("anchors"))
