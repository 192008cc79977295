"""Written tables that cut the lineage, below the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


#: Whether Spark deletes the shuffle files of a query as it ends, and not when the driver collects its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where it is unset and the master is local (tests, a single machine) a local folder is
    chosen and set; on a cluster that would lose tables without a word, so it is an error there.
    """
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not at:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir is not set: driver and executors need a folder that they share")
        import tempfile

        at = "file://" + tempfile.mkdtemp(prefix="vintara-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def new_dir(spark: SparkSession, what: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/vintara/{what}-{uuid.uuid4().hex}"


def durable(df: DataFrame, what: str, by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and return it read back; ``by`` a column whose values get folders of their own.

    Cuts the lineage: a lost executor re-reads the files instead of recomputing. What the write
    itself has shuffled is deleted as it ends, since nothing else reads it.
    """
    spark = df.sparkSession
    path = new_dir(spark, what)
    write = df.write.option("compression", "zstd")
    was = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        (write if by is None else write.partitionBy(by)).parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if was is None else spark.conf.set(_CLEANUP, was)
    out = spark.read.schema(df.schema).parquet(path)
    out._vintara_path = path
    return out


def forget(df: DataFrame) -> None:
    """Delete the files behind a ``durable`` table that nothing will read again."""
    path = getattr(df, "_vintara_path", None)
    if path:
        sc = df.sparkSession.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
