"""Append-only tables and a fail-closed runner of named steps."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.contracts import TableContract, broken_rules, contract_violations


class ContractError(RuntimeError):
    """A step made rows that break the contract of its table."""

    def __init__(self, step: str, violations: list):
        super().__init__(f"step {step}: {len(violations)} violations, first {violations[0]}")
        self.step, self.violations = step, violations


class Conflict(RuntimeError):
    """Other writers were faster, again and again."""


class Store:
    """Append-only tables below one folder, with a log of commits; there is no update and no delete.

    ``<table>/data/append=<id>`` has the Parquet files of an append, ``<table>/_log/<version>.json``
    what it added: per partition of the append the first sequence number and the number of rows.
    Rows are written first, once; an append then becomes visible, whole, by one new file of the
    log, which only one of several writers can make. The others number their rows anew behind
    it and try again, without writing the rows anew. What was broken off before its commit is
    never read.
    """

    TRIES = 50

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, table: str) -> str:
        if not table.replace("_", "").isalnum():
            raise ValueError(f"{table!r} is not a table name")
        return f"{self.folder}/{table}"

    def _files(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _versions(self, table: str) -> list[int]:
        p, fs = self._files(f"{self._path(table)}/_log")
        return sorted(int(s.getPath().getName()[:-5]) for s in fs.listStatus(p) if s.getPath().getName()[:-5].isdigit()) if fs.exists(p) else []

    def _log(self, table: str) -> DataFrame:
        """``append, p, start, rows`` of every commit, a row per partition."""
        return self.spark.read.schema("append string, p long, start long, rows long").json(f"{self._path(table)}/_log/[0-9]*.json")

    def has(self, table: str) -> bool:
        return bool(self._versions(table))

    def _make(self, table: str, version: int, text: str) -> bool:
        """Make the file of a version of the log, unless it is there; one of several writers succeeds."""
        path = f"{self._path(table)}/_log/{version:020d}.json"
        p, fs = self._files(path)
        fs.mkdirs(p.getParent())
        jvm = self.spark.sparkContext._jvm
        draft = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}")
        out = fs.create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            if fs.getUri().getScheme() == "file":  # its renames replace what is there
                os.link(draft.toUri().getPath(), p.toUri().getPath())
                return True
            none = jvm.org.apache.hadoop.fs.Options.Rename.NONE
            rename = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            rename[0] = none
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration()).rename(draft, p, rename)
            return True
        except Exception:  # noqa: BLE001  Java's and Python's errors alike: another writer was first, or the store failed
            if not fs.exists(p):
                raise
            return False
        finally:
            if fs.exists(draft):
                fs.delete(draft, False)

    def append(self, table: str, rows: DataFrame, contract: TableContract | None = None) -> int:
        """Append rows with ``seq`` counted on from the rows that are there, without gaps; returns their number.

        Any number of writers may append at once. With a contract the rows are checked in the
        same pass that writes them: if one breaks it none becomes visible, what was written
        stays below ``_quarantine`` with the rules that each row breaks, and ``ContractError``
        names the first hundred. Rows are numbered by their partitions' sizes, so nothing is
        sorted into one task. A column ``seq`` of the rows is left out.
        """
        rows = rows.drop("seq")
        taken = {"append", "_m", "_broken"} & set(rows.columns)
        if taken:
            raise ValueError(f"names that a table keeps for itself: {sorted(taken)}")
        name, seen = f"a{uuid.uuid4().hex}", Observation()
        broken = F.array().cast("array<struct<field:string,rule:string>>") if contract is None else broken_rules(rows, contract)
        marked = rows.withColumn("_broken", broken).withColumn("_m", F.monotonically_increasing_id()).observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(F.size("_broken") > 0).alias("bad"))
        path = f"{self._path(table)}/data/append={name}"
        (marked if contract is not None else marked.drop("_broken")).write.parquet(path)
        if seen.get["bad"]:
            bad = f"{self._path(table)}/_quarantine/{name}"
            p, fs = self._files(path)
            to, _ = self._files(bad)
            fs.mkdirs(to.getParent())
            fs.rename(p, to)
            first = self.spark.read.parquet(bad).where("size(_broken) > 0").orderBy("_m").limit(100).select("_m", F.explode("_broken").alias("x")).select("_m", "x.field", "x.rule").limit(100).collect()
            raise ContractError(table, first)
        shift = F.shiftright("_m", 33)
        sizes = sorted((r["p"], r["n"]) for r in self.spark.read.parquet(path).groupBy(shift.alias("p")).agg(F.count("*").alias("n")).collect())
        for _ in range(self.TRIES):
            versions = self._versions(table)
            at = self._log(table).agg(F.coalesce(F.max(F.col("start") + F.col("rows")), F.lit(0)).alias("n")).first()["n"] if versions else 0
            lines = []
            for p, n in sizes or [(-1, 0)]:
                lines.append(json.dumps({"append": name, "p": p, "start": at, "rows": n}))
                at += n
            if self._make(table, versions[-1] + 1 if versions else 0, "\n".join(lines) + "\n"):
                return sum(n for _, n in sizes)
        raise Conflict(f"{table}: {self.TRIES} tries")

    def get(self, table: str) -> DataFrame:
        """All committed rows of a table with their ``seq``; an unknown table has none."""
        if not self.has(table):
            return self.spark.createDataFrame([], "seq long")
        log = self._log(table).select("append", "p", "start").where("p >= 0")
        data = f"{self._path(table)}/data"
        rows = self.spark.read.option("mergeSchema", "true").option("basePath", data).parquet(data).drop("_broken")
        numbered = rows.withColumn("p", F.shiftright("_m", 33)) if "p" not in rows.columns else rows.withColumnRenamed("p", "_own_p").withColumn("p", F.shiftright("_m", 33))
        out = numbered.join(log, ["append", "p"]).withColumn("seq", F.col("start") + F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))).drop("append", "p", "start", "_m")
        return out.withColumnRenamed("_own_p", "p") if "_own_p" in out.columns else out

    def tables(self) -> list[str]:
        p, fs = self._files(self.folder)
        names = sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []
        return [n for n in names if n.replace("_", "").isalnum() and self.has(n)]


@dataclass
class Step:
    """Reads ``inputs``, makes ``output``; rows are checked against ``contract`` where there is one."""

    name: str
    inputs: list[str]
    output: str
    fn: Callable[[dict[str, DataFrame], dict], DataFrame]
    contract: TableContract | None = None


def order(steps: list[Step]) -> list[Step]:
    """Steps after those that make their inputs; a cycle is an error, an input that no step makes is none."""
    maker = {s.output: s.name for s in steps}
    by_name = {s.name: s for s in steps}
    graph = TopologicalSorter()
    for s in steps:
        graph.add(s.name, *[maker[i] for i in s.inputs if i in maker])
    try:
        return [by_name[n] for n in graph.static_order()]
    except CycleError as e:
        raise ValueError(f"cycle among steps: {e.args[1]}") from e


class Pipeline:
    """Runs steps in order; a step's rows are stored only if none breaks its contract."""

    def __init__(self, steps: list[Step]):
        self.steps = order(steps)

    def run(self, store: Store, ctx: dict | None = None) -> None:
        for s in self.steps:
            rows = s.fn({t: store.get(t) for t in s.inputs}, ctx or {})
            own = contract_violations(s.contract) if s.contract is not None else []
            if own:
                raise ContractError(s.name, own)
            try:
                store.append(s.output, rows, s.contract)
            except ContractError as e:
                raise ContractError(s.name, e.violations) from None
