"""Near-duplicate marking of a stream with keyed state: originals by block and day, evicted by timers.

State is in the state store: an entry per block and day with the originals of that day, so a
document reads the days of its window alone and a micro-batch writes only the days that it
adds to. Documents seen already are told by ``dropDuplicatesWithinWatermark``, and a day's entry
goes by a timer once no document within the watermark can reach it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.near_dup import DAYS
from ..shipping import ship

_DAY_MS = 86_400_000
_EPOCH = dt.date(1970, 1, 1)


class NearDuplicates(StatefulProcessor):
    """Per block: each document the duplicate of the best earlier original within ``days``, or an original itself.

    A day is kept until the watermark is past the last day whose documents can reach it.
    """

    def __init__(self, threshold: float, days: int = DAYS):
        self.threshold, self.days, self.keep = threshold, days, days + 1

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.originals = handle.getMapState("originals", "day int", "ids array<long>, size int, flat array<double>")

    def _day(self, day: int, held: dict) -> list:
        """``ids, unit vectors, whether new ones came`` of a day, by vector size."""
        if day not in held:
            got = self.originals.getValue((day,)) if self.originals.containsKey((day,)) else None
            ids = list(got[0]) if got else []
            held[day] = [ids, [np.asarray(v) for v in np.reshape(got[2], (len(ids), got[1]))] if ids else [], False]
        return held[day]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows)).sort_values("id")
        held: dict[int, list] = {}
        marks = []
        for r in new.itertuples(index=False):
            v = np.asarray(r.vec, np.float64)
            norm = np.sqrt((v * v).sum()) if len(v) else 0.0
            if not norm > 0:
                marks.append(None)
                continue
            v, day = v / norm, (r.day - _EPOCH).days
            best = None
            for d in range(day - self.days, day + self.days + 1):
                ids, vectors, _ = self._day(d, held)
                if ids and len(vectors[0]) == len(v):
                    sim = np.asarray(vectors) @ v
                    for i in np.flatnonzero((sim >= self.threshold) & (sim > 0)):
                        if ids[i] < r.id:
                            best = max(best or (-1.0, -1), (round(float(sim[i]), 12), ids[i]))
            marks.append(None if best is None else best[1])
            own = self._day(day, held)
            if best is None and (not own[1] or len(own[1][0]) == len(v)):
                own[0].append(int(r.id))
                own[1].append(v)
                own[2] = True
        for day, (ids, vectors, changed) in held.items():
            if changed:
                if not self.originals.containsKey((day,)):
                    self.handle.registerTimer((day + self.keep) * _DAY_MS)
                self.originals.updateValue((day,), (ids, len(vectors[0]), np.concatenate(vectors).tolist()))
        yield pd.DataFrame({"id": new["id"].to_numpy(), "dup_of": pd.array(marks, "Int64")})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.originals.removeKey((expiredTimerInfo.getExpiryTimeInMs() // _DAY_MS - self.keep,))
        return iter([])

    def close(self) -> None:
        pass


def use_state(spark: SparkSession) -> None:
    """The state store that keyed state with timers needs; to be set before a query starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def mark_stream(docs: DataFrame, threshold: float, days: int = DAYS, late: str | None = None) -> DataFrame:
    """``id, dup_of`` of a stream of ``id, block, day, vec``, to be written in append mode.

    Ids rise from batch to batch. ``late`` is how far documents may come behind the newest
    day, ``days`` if not given; later ones are dropped by the watermark, as are repeats of an id
    within it. Documents without an id, block, day or vector are left out; vectors of no length
    or of another size than their day's others are no originals. A block's rows of a batch are
    decided in one task, in id order; what that task reads and holds are the days around them.
    """
    spark = docs.sparkSession
    ship(spark)
    use_state(spark)
    own = docs.select(F.col("id").cast("long").alias("id"), F.col("block").cast("string").alias("block"), F.col("day").cast("date").alias("day"), F.col("vec").cast("array<double>").alias("vec"))
    whole = own.where("id is not null and block is not null and day is not null and vec is not null").withColumn("ts", F.col("day").cast("timestamp"))
    once = whole.withWatermark("ts", late or f"{days} days").dropDuplicatesWithinWatermark(["id"])
    return once.groupBy("block").transformWithStateInPandas(NearDuplicates(threshold, days), "id long, dup_of long", "append", "eventTime")
