"""Remote sources as tables: filters on key, day, vintage and window become part of the requests.

``spark.read.format("source_table").option("table", "bars")...``; with ``enable_pushdown`` a query
asks a source only for what its filters admit: keys and windows that no filter admits cost no
request, and days and vintages stand in the address. Keys of access are looked up by the tasks
(``secret``), so no option, plan or partition holds one.
"""

from __future__ import annotations

import datetime as dt
import importlib
import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual

from ..shipping import ship
from . import readers
from .rate import Lease

#: Per table: schema, the column of the keys, the column of days.
TABLES = {
    "bars": ("symbol string, date date, open double, high double, low double, close double, adjusted_close double, volume double", "symbol", "date"),
    "series": ("series_id string, date date, value double, vintage date", "series_id", "date"),
    "curve": ("date date, tenor string, rate double", None, "date"),
    "counts": ("cls string, since date, until date, n long", "cls", None),
}
_DAY = dt.timedelta(days=1)


class _Ask(InputPartition):
    """Requests of one task: its place among the tasks, and what each asks for."""

    def __init__(self, number: int, of: int, wanted: list[tuple]):
        self.number, self.of, self.wanted = number, of, wanted


def _number(x) -> float | None:
    try:
        return float(x)
    except (TypeError, ValueError):
        return None


def _date(x) -> dt.date | None:
    try:
        return dt.date.fromisoformat(str(x)[:10])
    except ValueError:
        return None


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.table = options["table"]
        self.keys = json.loads(options.get("keys", "[]"))
        self.windows = [tuple(map(dt.date.fromisoformat, w)) for w in json.loads(options.get("windows", "[]"))]
        self.since, self.until = (None if options.get(k) is None else dt.date.fromisoformat(options[k]) for k in ("since", "until"))
        self.secret = json.loads(options.get("secret", "{}"))
        self.transport, self.headers = options.get("transport", f"{readers.__name__}:curl"), json.loads(options.get("headers", "{}"))
        self.per_minute = float(options["per_minute"]) if "per_minute" in options else None
        self.tasks, self.vintage, self.nothing = int(options.get("tasks", "8")), None, False

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes over what requests can express exactly, and gives the rest back."""
        _, key, day = TABLES[self.table]
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if isinstance(f, IsNotNull) and name in (key, day, *(("since", "until", "n") if self.table == "counts" else ())):
                continue
            if name == key and key and isinstance(f, (EqualTo, In)):
                admitted = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.keys = [k for k in self.keys if k in admitted]
            elif name == day and day and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    low = f.value + _DAY if isinstance(f, GreaterThan) else f.value
                    self.since = low if self.since is None else max(self.since, low)
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    high = f.value - _DAY if isinstance(f, LessThan) else f.value
                    self.until = high if self.until is None else min(self.until, high)
            elif self.table == "series" and name == "vintage" and isinstance(f, EqualTo):
                self.nothing |= self.vintage not in (None, f.value)
                self.vintage = f.value
            elif self.table == "counts" and name in ("since", "until") and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                at, v = ("since", "until").index(name), f.value
                holds = {EqualTo: lambda x: x == v, GreaterThan: lambda x: x > v, GreaterThanOrEqual: lambda x: x >= v, LessThan: lambda x: x < v, LessThanOrEqual: lambda x: x <= v}[type(f)]
                self.windows = [w for w in self.windows if holds(w[at])]
            elif self.table == "series" and isinstance(f, IsNotNull) and name == "vintage":
                yield f
            else:
                yield f

    def wanted(self) -> list[tuple]:
        """What is asked for, a tuple a request."""
        if self.nothing or (self.since and self.until and self.since > self.until):
            return []
        if self.table == "curve":
            first, last = self.since or dt.date(1990, 1, 1), self.until or dt.datetime.now(dt.timezone.utc).date()
            return [(y,) for y in range(first.year, last.year + 1)]
        if self.table == "counts":
            return [(k, s, u) for k in self.keys for s, u in self.windows]
        return [(k,) for k in self.keys]

    def partitions(self) -> list[InputPartition]:
        asked = self.wanted()
        of = max(1, min(self.tasks, len(asked)))
        return [_Ask(i, of, asked[i::of]) for i in range(of)]

    def url(self, ask: tuple, token: str) -> str:
        iso = lambda d: None if d is None else d.isoformat()
        if self.table == "bars":
            return readers.bars_url(ask[0], token, iso(self.since), iso(self.until))
        if self.table == "series":
            return readers.series_url(ask[0], token, iso(self.since), iso(self.vintage))
        if self.table == "curve":
            return readers.curve_url(ask[0])
        return readers.patent_search_url(readers.class_query(ask[0], iso(ask[1]), iso(ask[2])))

    def rows(self, ask: tuple, text: str) -> Iterator[tuple]:
        if self.table == "bars":
            for b in json.loads(readers.full_list(text)):
                yield (ask[0], _date(b.get("date")), *[_number(b.get(c)) for c in ("open", "high", "low", "close", "adjusted_close", "volume")])
        elif self.table == "series":
            for o in readers.answer(text).get("observations", []):
                yield ask[0], _date(o.get("date")), _number(o.get("value")), self.vintage
        elif self.table == "curve":
            head, *lines = [[x.strip().strip('"') for x in line.split(",")] for line in readers.curve_text(text).splitlines() if line.strip()]
            for line in lines:
                m, d, y = (line[0].split("/") + ["", "", ""])[:3]
                for tenor, rate in zip(head[1:], line[1:]):
                    if _number(rate) is not None:
                        yield _date(f"{y}-{m:>02}-{d:>02}"), tenor, _number(rate) / 100
        else:
            found = readers.no_results_as(lambda: json.dumps(readers.answer(text)), readers.NO_HITS)
            yield (*ask, int(json.loads(found)["ops:world-patent-data"]["ops:biblio-search"]["@total-result-count"]))

    def read(self, partition: _Ask) -> Iterator[tuple]:
        module, name = self.transport.split(":")
        fetch = getattr(importlib.import_module(module), name)
        token = readers.key(None, tuple(self.secret["names"]), self.secret.get("file")) if self.secret and partition.wanted else ""
        lease = Lease(partition.number, partition.of, self.per_minute) if self.per_minute else None
        day = [c.split()[0] for c in TABLES[self.table][0].split(", ")].index(TABLES[self.table][2]) if TABLES[self.table][2] else None
        for ask in partition.wanted:
            if lease:
                lease.wait()
            try:
                text = fetch(self.url(ask, token), self.headers)
            except readers.SourceError as e:
                if self.table != "counts" or not any(s in str(e) for s in readers.NO_RESULTS):
                    raise
                text = readers.NO_HITS
            for row in self.rows(ask, text):
                if day is None or row[day] is not None and (self.since is None or row[day] >= self.since) and (self.until is None or row[day] <= self.until):
                    yield row


class SourceTable(DataSource):
    """``source_table``: a table of a remote source.

    Options: ``table``, one of ``TABLES``; ``keys``, a JSON list of symbols, series or classes;
    ``windows``, a JSON list of pairs of days (counts); ``since``, ``until``; ``secret``, a JSON object
    with the ``names`` of environment variables, or a ``file``, that hold the key of access in
    the tasks; ``transport`` and ``headers`` as of ``payloads``; ``tasks``, and ``per_minute`` for all of
    them together. Rows without a readable day are left out; an error of the source fails the job.
    """

    @classmethod
    def name(cls):
        return "source_table"

    def schema(self):
        return TABLES[self.options["table"]][0]

    def reader(self, schema):
        return _Reader(self.options)


def enable_pushdown(spark: SparkSession) -> None:
    """Filters reach Python data sources only where the session says so."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def source_table(spark: SparkSession, table: str, **options) -> DataFrame:
    """A table of ``SourceTable``, with pushdown; lists and objects among the options are written as JSON."""
    ship(spark)
    enable_pushdown(spark)
    spark.dataSource.register(SourceTable)
    read = spark.read.format("source_table").option("table", table)
    for k, v in options.items():
        read = read.option(k, v if isinstance(v, str) else json.dumps(v))
    return read.load()
