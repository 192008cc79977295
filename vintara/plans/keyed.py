"""Current rows by key over an append-only log: key-sorted files with bounds, merged bit by bit.

The log (a table of ``Store``) takes upserts. ``compact`` folds what came since the last time into a
level of files that each hold one range of keys, no two of them crossing, rewriting only those
files whose range, up to where the next begins, a new key falls into; a file of the level's log names the files, their bounds and the log's last row
in them, and is made by one of several writers, as an append is. ``lookup`` reads only the
files whose bounds hold a key that is asked for, and the rows that came since.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..durable import durable, forget
from .pipeline import Conflict, Store

#: Rows of a file of the level, about.
FILE_ROWS = 1_000_000
_FILES = "file string, low string, high string, rows long, mark long"


class KeyedLog:
    """Upserts by ``key``, a text column; of equal keys the row appended last counts, whole, nulls among it."""

    def __init__(self, spark: SparkSession, folder: str, key: str, file_rows: int = FILE_ROWS):
        self.spark, self.key, self.file_rows, self.folder = spark, key, file_rows, folder.rstrip("/")
        self.store = Store(spark, folder)

    def append(self, rows: DataFrame) -> int:
        """Upsert rows; a null key is an error, as no read could find it."""
        k = F.col(self.key).cast("string")
        return self.store.append("log", rows.withColumn(self.key, F.when(k.isNotNull(), k).otherwise(F.raise_error(F.lit("a row without a key")).cast("string"))))

    def level(self) -> DataFrame:
        """``file, low, high, rows, mark`` of the files in force; ``mark`` is the first row of the log that they don't hold."""
        versions = self.store._versions("level")
        if not versions:
            return self.spark.createDataFrame([], _FILES)
        return self.spark.read.schema(_FILES).json(f"{self.folder}/level/_log/{versions[-1]:020d}.json")

    def _mark(self) -> int:
        return self.level().agg(F.coalesce(F.max("mark"), F.lit(0)).alias("m")).first()["m"]

    def _since(self, mark: int) -> DataFrame:
        return self.store.get("log").where(F.col("seq") >= mark)

    def _last(self, rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in (self.key, "seq")]
        return rows.groupBy(self.key).agg(F.max("seq").alias("seq"), *[F.max_by(c, "seq").alias(c) for c in rest])

    def _read(self, files: list[str]) -> DataFrame:
        return self.spark.read.option("mergeSchema", "true").parquet(*files).drop("_range")

    def compact(self) -> dict[str, int]:
        """Fold the new rows into the level; returns the numbers of files rewritten, kept and made."""
        versions = self.store._versions("level")
        held = self.level().collect()  # a row per file
        mark = max((f["mark"] for f in held), default=0)
        new = durable(self._last(self._since(mark)), "keyed-new") if self.store.has("log") else None
        if new is None or new.isEmpty():
            return {"rewritten": 0, "kept": len(held), "made": 0}
        held.sort(key=lambda f: f["low"].encode())
        # a key belongs to the last file that begins at or before it, or else to the first
        lows = F.array(*[F.lit(f["low"]) for f in held]).cast("array<string>")
        place = F.greatest(F.size(F.filter(lows, lambda low: low <= F.col(self.key))) - 1, F.lit(0))
        hit = sorted(r["_range"] for r in new.select(place.alias("_range")).distinct().collect()) if held else []
        rows = new
        if hit:
            rows = self._last(self._read([held[i]["file"] for i in hit]).unionByName(new, allowMissingColumns=True))
        merged = durable(rows.withColumn("_range", place), "keyed-merged")
        path = f"{self.folder}/level/data/{uuid.uuid4().hex}"
        # folders by range, so that no file reaches over a file that stays
        merged.repartitionByRange(max(1, -(-merged.count() // self.file_rows)), "_range", self.key).sortWithinPartitions("_range", self.key).write.partitionBy("_range").parquet(path)
        made = self.spark.read.parquet(path).groupBy(F.input_file_name().alias("file")).agg(F.min(self.key).alias("low"), F.max(self.key).alias("high"), F.count("*").alias("rows")).collect()
        hit = {held[i]["file"] for i in hit}
        mark = new.agg(F.max("seq")).first()[0] + 1
        files = [f.asDict() | {"mark": mark} for f in held if f["file"] not in hit] + [f.asDict() | {"mark": mark} for f in made]
        forget(new)
        forget(merged)
        if not self.store._make("level", versions[-1] + 1 if versions else 0, "".join(json.dumps(f) + "\n" for f in files)):
            raise Conflict("another writer compacted at the same time; nothing of this one is in force")
        return {"rewritten": len(hit), "kept": len(held) - len(hit), "made": len(made)}

    def lookup(self, keys: list[str] | None = None) -> DataFrame:
        """The current rows, with their ``seq``, of the keys asked for, or of all."""
        level = self.level()
        wanted = F.lit(True)
        if keys is not None:
            wanted = F.col(self.key).isin(keys)
            level = level.where(F.exists(F.array(*[F.lit(k) for k in keys]).cast("array<string>"), lambda k: (k >= F.col("low")) & (k <= F.col("high"))))
        files, mark = [f["file"] for f in level.select("file").collect()], self._mark()
        fresh = self._since(mark)
        if not self.store.has("log"):
            return fresh
        rows = fresh if not files else fresh.unionByName(self._read(files), allowMissingColumns=True)
        return self._last(rows.where(wanted))
