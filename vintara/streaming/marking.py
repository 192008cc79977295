"""Near-duplicate marking of a stream of embedded documents, batch by batch, with bounded state.

State is two tables below a folder, a file set per batch: ``vectors`` of documents in reach of new
ones, and ``done`` markers, which stay. A batch that is run again after a failure writes the
same files over, so every document is decided once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.near_dup import DAYS, mark_greedy

VECTORS = "id long, block string, day date, vec array<double>, dup_of long"
DONE = "id long, dup_of long"


class Marker:
    """Marks documents (``id, block, day, vec``) as they come; ids rise from batch to batch.

    A document is the duplicate of the best earlier original of its block within ``days``.
    Vectors more than twice as many days older than the newest day seen are evicted, as no
    later document of the window can meet them.
    """

    def __init__(self, spark: SparkSession, folder: str, threshold: float, days: int = DAYS):
        self.spark, self.folder, self.threshold, self.days = spark, folder.rstrip("/"), threshold, days

    def _path(self, what: str, batch: int) -> str:
        return f"{self.folder}/{what}/batch={batch}"

    def _exists(self, path: str) -> bool:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def done(self, before: int | None = None) -> DataFrame:
        """``id, dup_of`` of every document decided, in batches before the given one."""
        if not self._exists(f"{self.folder}/done"):
            return self.spark.createDataFrame([], DONE)
        rows = self.spark.read.schema(DONE + ", batch long").parquet(f"{self.folder}/done")
        return (rows if before is None else rows.where(F.col("batch") < before)).select("id", "dup_of")

    def vectors(self, before: int) -> DataFrame:
        """The vectors kept by the last batch before the given one."""
        at = self._path("vectors", before - 1)
        return self.spark.read.schema(VECTORS).parquet(at) if self._exists(at) else self.spark.createDataFrame([], VECTORS)

    def __call__(self, batch_df: DataFrame, batch: int) -> None:
        """For ``foreachBatch``."""
        own = batch_df.select(F.col("id").cast("long").alias("id"), F.col("block").cast("string").alias("block"), "day", F.col("vec").cast("array<double>").alias("vec"))
        new = own.dropDuplicates(["id"]).join(self.done(batch).select("id"), "id", "left_anti").persist()
        try:
            known = self.vectors(batch)
            marks = mark_greedy(new, self.threshold, self.days, known)
            marks.write.mode("overwrite").parquet(self._path("done", batch))
            marks = self.spark.read.schema(DONE).parquet(self._path("done", batch))
            both = known.unionByName(new.join(marks, "id").select("id", "block", "day", "vec", "dup_of"))
            newest = both.agg(F.max("day").alias("newest")).first()["newest"]
            kept = both if newest is None else both.where(F.datediff(F.lit(newest), "day") <= 2 * self.days)
            kept.write.mode("overwrite").parquet(self._path("vectors", batch))
        finally:
            new.unpersist()
