"""Lossless recording: documents with the decision on them, attributes of facts, conservation of counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import content_hash

# The fields of a fact that are recorded one by one.
ATTRIBUTES = ["subjekt", "beziehung", "objekt", "modus", "signalart", "reife_score", "latenz", "erwartungstempo", "konfidenz"]


class RecordingError(RuntimeError):
    """Counts of a run do not add up."""


def record_documents(documents: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Every document, rejected ones too, with ``accepted`` (relevance at the threshold is accepted, null is not) and a content hash."""
    return documents.withColumn("accepted", F.coalesce("relevance", F.lit(0.0)) >= threshold).withColumn("content_hash", content_hash(F.col("title"), F.col("text")))


def unpivot_attributes(facts: DataFrame, ids: list[str], fields: list[str] | None = None) -> DataFrame:
    """A row per field that is not null: ids, ``name``, ``value`` as text."""
    fields = fields or [f for f in ATTRIBUTES if f in facts.columns]
    return facts.select(*ids, *[F.col(f).cast("string").alias(f) for f in fields]).unpivot(ids, fields, "name", "value").where("value is not null")


def conservation(log: DataFrame, decisions: DataFrame, documents: DataFrame) -> DataFrame:
    """``run_id, n_found, n_new, n_decisions, n_documents, breach`` per logged run; a missing counter is a breach.

    Found must equal the relevance decisions of the run, new must equal its documents.
    """
    d = decisions.groupBy("run_id").agg(F.count("*").alias("n_decisions"))
    w = documents.groupBy("run_id").agg(F.count("*").alias("n_documents"))
    out = log.join(d, "run_id", "left").join(w, "run_id", "left").fillna(0, ["n_decisions", "n_documents"])
    return out.withColumn("breach", ~(F.col("n_found").eqNullSafe(F.col("n_decisions")) & F.col("n_new").eqNullSafe(F.col("n_documents"))))


def check_run(log: DataFrame, decisions: DataFrame, documents: DataFrame) -> None:
    """Raise, naming both counters, if a run breaks the conservation of counts."""
    bad = conservation(log, decisions, documents).where("breach").limit(1).collect()
    if bad:
        r = bad[0]
        raise RecordingError(f"run {r['run_id']}: found {r['n_found']} but {r['n_decisions']} decisions; new {r['n_new']} but {r['n_documents']} documents")
