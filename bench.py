"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

HEADLINE = ["asof_cross_section", "asof_cross_section_by_category", "asof_price_last_non_null", "vintage_asof_inclusive", "return_by_category", "turnover_90d", "pit_quarter_window", "coverage_summary", "facts_asof_excluded", "conservation_law", "contract_violations", "near_dup_best_match", "event_session"]


def duckdb_seconds(sql: dict[str, str], sf: str, cpus: str) -> dict[str, float]:
    """Median seconds of the same queries in DuckDB on the same files."""
    from pathlib import Path

    import duckdb

    con = duckdb.connect(config={"threads": int(cpus)})
    for p in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}{'/*.parquet' if p.is_dir() else ''}')")
    took = {}
    for name in HEADLINE:
        runs = []
        for _ in range(3):
            began = time.perf_counter()
            con.execute(sql[name]).fetchall()
            runs.append(time.perf_counter() - began)
        took[name] = round(statistics.median(runs), 4)
    return took


def main() -> None:
    from vintara.catalog import ORACLE_SQL, QUERIES

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in HEADLINE:
        runs = []
        for _ in range(3):
            began = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - began)
        took[name] = round(statistics.median(runs), 4)
    print(json.dumps({"duckdb": duckdb_seconds(ORACLE_SQL, sf, cpus), "metric": "sum of median seconds of 13 headline queries", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf.rstrip("/").rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
