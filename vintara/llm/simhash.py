"""64-bit SimHash with DataFrame expressions only.

The 64 vote counters of a document are kept as 32 longs of two 32-bit lanes, so that one
shift, one mask and one SUM serve two bits; the sums combine map-side, and as all terms of
a document come from one task, the shuffle moves one row per document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lowest bit of each 32-bit lane.
LANES = 0x0000000100000001
LOW = 0xFFFFFFFF


def votes(terms: DataFrame, keys: list[str], hash_col: str, weight_col: str | None = None) -> DataFrame:
    """Sum weighted bit votes per key.

    ``terms``: a row per term; a null hash gives a key without votes. Returns the keys,
    ``total`` (sum of weights) and ``s0``..``s31``.
    """
    h = F.coalesce(F.col(hash_col), F.lit(0))
    w = F.when(F.col(hash_col).isNull(), F.lit(0)).otherwise(F.col(weight_col).cast("long") if weight_col else F.lit(1)).cast("long")
    lane = [F.shiftrightunsigned(h, j).bitwiseAND(F.lit(LANES)) for j in range(32)]
    return terms.groupBy(*keys).agg(F.sum(w).alias("total"), *[F.sum(x * w if weight_col else x).alias(f"s{j}") for j, x in enumerate(lane)])


def fingerprint(total: str = "total"):
    """The long whose bit j is 1 if the votes of bit j are over half of ``total``; zero without votes."""
    out = F.lit(0).cast("long")
    for j in range(32):
        low = F.col(f"s{j}").bitwiseAND(F.lit(LOW))
        high = F.shiftrightunsigned(F.col(f"s{j}"), 32)
        out = out.bitwiseOR(F.when(low * 2 > F.col(total), F.lit(1 << j).cast("long")).otherwise(F.lit(0).cast("long")))
        bit = 1 << (j + 32)
        out = out.bitwiseOR(F.when(high * 2 > F.col(total), F.lit(bit - (1 << 64) if bit >> 63 else bit).cast("long")).otherwise(F.lit(0).cast("long")))
    return out


def to_hex(fp):
    """A fingerprint as 16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def likeness(a, b):
    """Share of equal bits of two fingerprints, 0 to 1."""
    return (F.lit(64) - F.bit_count(a.bitwiseXOR(b))).cast("double") / F.lit(64.0)
