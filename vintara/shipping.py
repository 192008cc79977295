"""Sends the package to the executors, where Python functions of it run."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, as ``--py-files`` would."""
    sc = spark.sparkContext
    if getattr(sc, "_vintara_shipped", False):
        return
    top = Path(__file__).resolve().parent
    to = Path(tempfile.mkdtemp(prefix="vintara-")) / "vintara_code.zip"
    with zipfile.ZipFile(to, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, Path(top.name) / p.relative_to(top))
    sc.addPyFile(str(to))
    sc._vintara_shipped = True
