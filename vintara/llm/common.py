"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..durable import durable, forget, new_dir, shared_dir  # noqa: F401  the operators take them from here
from ..shipping import ship

#: The six ASCII characters that separate words for shingles.
ASCII_SPACE = r"[\x20\x09-\x0D]+"
#: The same characters as a literal set, for trim().
ASCII_SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table as a DataFrame, read by Spark alone (any file system)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_pandas(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInPandas`` with the package present on the executors."""
    ship(df.sparkSession)
    return df.mapInPandas(fn, schema)


#: Most bytes of an Arrow batch of whole texts.
BATCH_BYTES = 64 << 20


def map_arrow(df: DataFrame, fn, schema: str, rows: int = 256) -> DataFrame:
    """``mapInArrow`` over batches of whole texts: at most ``rows`` rows and about ``BATCH_BYTES`` each, so that long texts fit a worker.

    Both settings are the session's; they are lowered only from Spark's defaults, and stay so.
    """
    spark = df.sparkSession
    ship(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) >= 10000:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    most = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None)
    if most is None or not most.isdigit() or int(most) > BATCH_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(fn, schema)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator needs, under names that no other column can clash with."""
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


def lower_ascii(text):
    """``text`` with A-Z lower-cased and every other character as it is."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, upper, lower))


def ascii_words(text):
    """Array of the words between ASCII white space; empty where there are none."""
    bare = F.trim(text, F.lit(ASCII_SPACE_CHARS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, ASCII_SPACE))


def shingle_structs(words, k: int):
    """Array of structs ``w1..wk`` with each run of ``k`` words; one struct of the whole sequence where there are fewer.

    ``concat_ws(' ', ...)`` over a struct's fields gives the shingle; a text without words gives an empty array.
    """
    n = F.size(words)
    full = F.arrays_zip(*[F.slice(words, i + 1, n - (k - 1)).alias(f"w{i + 1}") for i in range(k)])
    whole = F.array(F.struct(F.concat_ws(" ", words).alias("w1"), *[F.lit(None).cast("string").alias(f"w{i + 1}") for i in range(1, k)]))
    none = F.array().cast("array<struct<" + ",".join(f"w{i + 1}:string" for i in range(k)) + ">>")
    return F.when(n >= k, full).when(n > 0, whole).otherwise(none)
