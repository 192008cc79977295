"""What is written to the stores: normalised rows of bars, series, documents, facts, capital, exclusions.

Each function turns raw rows into the rows of a table; logs stay append-only. The current row
of a key is ``temporal.upsert_view``, the first one ``temporal.first_wins``. ``seq`` orders
the rows of a batch where a later or an earlier row of one key wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import content_hash, fact_number, first_of, number, source_rung, strip
from ..operators.recording import ATTRIBUTES
from ..operators.temporal import first_wins

BAR_FIELDS = ("open", "high", "low", "close", "adjusted_close", "volume")


def _text(key: str, v: str = "v") -> Column:
    return F.try_variant_get(v, f"$['{key}']", "string")


def _has(key: str, v: str = "v") -> Column:
    return F.try_variant_get(v, f"$['{key}']", "variant").isNotNull()


def bar_rows(bars: DataFrame, t_ingest: str | None, col: str = "bar") -> DataFrame:
    """Bars given as JSON objects beside ``symbol`` (and ``seq``): day, prices, volume. A bar without a day is left out.

    The day is ``date`` or else ``datum``, cut to ten characters; ``adjClose`` is read only
    where ``adjusted_close`` is no key at all, so a null under that key stays null.
    """
    keep = [c for c in bars.columns if c != col]
    v = bars.select(*keep, F.explode(F.array(F.try_parse_json(col))).alias("v"))
    day = first_of(_text("date"), _text("datum"))
    price = {f: number(_text(f)) for f in BAR_FIELDS}
    price["adjusted_close"] = F.when(_has("adjusted_close"), price["adjusted_close"]).otherwise(number(_text("adjClose")))
    return v.select(*keep, F.substring(day, 1, 10).alias("datum"), *[x.alias(f) for f, x in price.items()], F.lit(t_ingest).cast("string").alias("t_ingest")).where("datum is not null")


def current_rows(log: DataFrame, key: list[str], seq: str = "seq") -> DataFrame:
    """The last row of each key, with all its columns, nulls among them."""
    rest = [c for c in log.columns if c not in (*key, seq)]
    return log.groupBy(*key).agg(*[F.max_by(c, seq).alias(c) for c in rest])


def meta_rows(meta: DataFrame, fields: tuple[str, ...] = ("name", "sector", "category", "currency", "t_ingest")) -> DataFrame:
    """Meta rows with all fields, those that are not given null; the last row of a symbol wins by ``seq``, whole."""
    full = meta.select(F.col("symbol").cast("string").alias("symbol"), *[F.col(f) if f in meta.columns else F.lit(None).cast("string").alias(f) for f in fields], "seq")
    return current_rows(full, ["symbol"])


def canonical_json(col: str | Column) -> Column:
    """A JSON text with sorted keys and no blanks between; null where it is no JSON."""
    return F.to_json(F.try_parse_json(col))


def fundamental_rows(payloads: DataFrame, t_ingest: str | None) -> DataFrame:
    """``symbol, payload, t_ingest``: the last payload of each symbol by ``seq``, in canonical JSON."""
    rows = payloads.select(F.col("symbol").cast("string").alias("symbol"), canonical_json("payload").alias("payload"), F.lit(t_ingest).cast("string").alias("t_ingest"), "seq")
    return current_rows(rows, ["symbol"])


def read_fundamentals(table: DataFrame, symbol: str) -> DataFrame:
    """The payload of one symbol; no row where it is missing or empty."""
    return table.where((F.col("symbol") == symbol) & (F.coalesce("payload", F.lit("")) != "")).select("payload")


def sensor_rows(rows: DataFrame, date_field: str, disclosed_field: str | None, t_ingest: str | None, col: str = "row") -> DataFrame:
    """``source, entity, datum, payload, t_disclosed, t_ingest``: the last row of each vintage by ``seq``.

    ``rows`` has ``source, entity, seq`` and a JSON object. Disclosed at the first of: the
    named field, ``t_disclosed``, the ingestion, the day; texts that are empty count as
    missing. Rows without a day are left out.
    """
    v = rows.select("source", "entity", "seq", F.explode(F.array(F.try_parse_json(col))).alias("v"))
    day = first_of(_text(date_field))
    told = first_of(_text(disclosed_field or "t_disclosed"), _text("t_disclosed"), F.lit(t_ingest).cast("string"), day)
    out = v.select(F.col("source").cast("string").alias("source"), F.col("entity").cast("string").alias("entity"), F.substring(day, 1, 10).alias("datum"), F.to_json("v").alias("payload"), F.substring(told, 1, 10).alias("t_disclosed"), F.lit(t_ingest).cast("string").alias("t_ingest"), "seq")
    return current_rows(out.where("datum is not null"), ["source", "entity", "datum", "t_disclosed"])


def document_rows(documents: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Documents to insert: title and day stripped, both needed; source types as rungs; the first of a title and day wins, unless it is stored."""
    both = [strip(F.coalesce(c, F.lit(""))).alias(c) for c in ("title", "published_at")]
    rest = [c for c in documents.columns if c not in ("title", "published_at", "source_type")]
    rows = documents.select(*both, source_rung(strip(F.col("source_type"))).alias("source_type"), *rest).where("title <> '' and published_at <> ''")
    return first_wins(rows, existing, ["title", "published_at"], "seq")


def unknown_sources(documents: DataFrame, known: list[str]) -> DataFrame:
    """``source_type, n`` of documents whose source is neither empty nor known, which are stored as news; for a warning."""
    s = F.lower(strip(F.coalesce("source_type", F.lit(""))))
    return documents.where((s != "") & ~s.isin(known)).groupBy(s.alias("source_type")).agg(F.count("*").alias("n"))


def fact_rows(facts: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Facts to insert: stripped, a subject needed; the first of document, subject, relation and object wins. A fact without a document is like no other."""
    clean = [strip(F.coalesce(c, F.lit(""))).alias(c) for c in ("subject", "relation", "object")]
    rest = [c for c in facts.columns if c not in ("subject", "relation", "object")]
    return first_wins(facts.select(*clean, *rest).where("subject <> ''"), existing, ["doc_id", "subject", "relation", "object"], "seq")


def capital_rows(events: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Capital events to insert: category, version and disclosure needed; what is missing of kind, direction, stage and source is filled in.

    Company number and entity are empty rather than null, so that the key of five holds; the
    entity falls back to the text. The first of a key wins.
    """
    have = set(events.columns)
    col = lambda c, kind="string": (F.col(c) if c in have else F.lit(None)).cast(kind)
    rows = events.where((F.coalesce("category_id", F.lit("")) != "") & F.col("version").isNotNull() & (F.coalesce("t_disclosed", F.lit("")) != "")).select(
        "category_id", F.col("version").cast("int").alias("version"), F.coalesce(col("kind"), F.lit("funding")).alias("kind"), F.coalesce(col("direction"), F.lit("zufluss")).alias("direction"),
        F.coalesce(col("stage"), F.lit("committed")).alias("stage"), col("amount", "double").alias("amount"), F.coalesce(col("opaque", "boolean"), F.lit(False)).alias("opaque"),
        F.coalesce(col("cik"), F.lit("")).alias("cik"), F.coalesce(first_of(col("entity"), col("text")), F.lit("")).alias("entity"), F.coalesce(col("source"), F.lit("edgar_form_d")).alias("source"),
        col("t_event").alias("t_event"), "t_disclosed", "seq",
    )
    return first_wins(rows, existing, ["category_id", "version", "cik", "entity", "t_disclosed"], "seq")


def exclusion_rows(markers: DataFrame) -> DataFrame:
    """``fact_id, reason, actor, t_disclosed, active``: the last marker of each fact by ``seq``; a later inactive one takes an exclusion back.

    Facts are named by number or as ``fakt`` and number. A blank reason is an error.
    """
    reason = strip(F.coalesce("reason", F.lit("")))
    checked = F.when(reason != "", reason).otherwise(F.raise_error(F.lit("an exclusion needs a reason")).cast("string"))
    rows = markers.select(fact_number(F.col("fact")).alias("fact_id"), checked.alias("reason"), "actor", "t_disclosed", "active", "seq")
    return current_rows(rows, ["fact_id"])


def raw_document_rows(documents: DataFrame, run_id: str, t_ingest: str, threshold: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """Rows of the raw documents, rejected ones too, and of the findings that link them to a run, one per document."""
    rest = [c for c in documents.columns if c != "seq"]
    rows = documents.select(
        F.col("doc_id").cast("string").alias("doc_id"), "title", "text", "url", F.to_json(F.struct(*rest)).alias("payload"), content_hash(F.col("title"), F.col("text")).alias("content_hash"), "relevance",
        (F.coalesce("relevance", F.lit(0.0)) >= threshold).alias("accepted"), F.lit(None).cast("string").alias("t_event"), F.col("published_at").alias("t_disclosed"), F.lit(t_ingest).alias("t_ingest"), "seq",
    )
    return current_rows(rows, ["doc_id"]), rows.select(F.lit(run_id).alias("run_id"), "doc_id").distinct()


def attribute_rows(facts: DataFrame, extractor: str, computed_at: str) -> DataFrame:
    """A row per recorded field of a fact that is not null: ids, ``name``, ``value`` as text, extractor and time."""
    fields = [f for f in ATTRIBUTES if f in facts.columns]
    long = facts.select("doc_id", "fact_id", *[F.col(f).cast("string").alias(f) for f in fields]).unpivot(["doc_id", "fact_id"], fields, "name", "value")
    return long.where("value is not null").select("*", F.lit(extractor).alias("extractor"), F.lit(computed_at).alias("computed_at"))


def merge_documents(target: DataFrame, other: DataFrame) -> DataFrame:
    """``target`` with the documents of another store whose title and day it lacks. Ids are each store's own, so facts are never merged this way."""
    cols = target.columns
    new = other.select(*cols).withColumn("seq", F.col("id"))
    return target.unionByName(first_wins(new, target, ["title", "published_at"], "seq").select(*cols))
