"""Readers of remote sources: addresses, keys, retries, and a Spark data source over an injected transport.

A transport is a function from an address and headers to the text of the answer; ``curl`` is
one, tests and offline runs inject another. Filters that a source can apply itself (days,
classes, vintages) are part of the address.
"""

from __future__ import annotations

import base64
import hashlib
import importlib
import json
import os
import re
import subprocess
import time
from collections.abc import Callable, Iterator
from urllib.parse import quote, urlencode

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

Transport = Callable[[str, dict[str, str]], str]

# The public addresses of the sources.
ARXIV = "https://export.arxiv.org/api/query"
FILING_SEARCH = "https://efts.sec.gov/LATEST/search-index"
FILING = "https://www.sec.gov/Archives/edgar/data"
PATENTS = "https://ops.epo.org/3.2"
SERIES = "https://api.stlouisfed.org/fred/series/observations"
CURVE = "https://home.treasury.gov/resource-center/data-chart-center/interest-rates/daily-treasury-rates.csv"
MARKET = "https://eodhd.com/api"
# What answers of the patent source say when there is nothing, and when to try again.
NO_RESULTS = ("EntityNotFound", "No results found")
TRANSIENT = ("robotdetected", "429", "throttl", "domainaccess", "try again later", "serverbusy", "service unavailable", "timed out", "not reachable", "connection", "reset by peer")
MAX_TEXT = 2000


class SourceError(RuntimeError):
    """A source did not answer as it should."""


def curl(url: str, headers: dict[str, str] | None = None, timeout: int = 30, data: str | None = None) -> str:
    """The text of an answer; the address is never logged, as it may hold a key."""
    cmd = ["curl", "-sS", "--max-time", str(timeout), url, *[x for k, v in (headers or {}).items() for x in ("-H", f"{k}: {v}")]]
    out = subprocess.run(cmd + (["--data", "@-"] if data is not None else []), input=data, capture_output=True, text=True, timeout=timeout + 10)
    if out.returncode != 0:
        raise SourceError(f"not reachable: rc={out.returncode} {out.stderr[:200]}")
    return out.stdout


def from_file(url: str, headers: dict[str, str] | None = None) -> str:
    """A transport that reads saved answers: the text of the file that ``url`` names in any store that Arrow knows."""
    from pyarrow import fs

    at, path = fs.FileSystem.from_uri(url)
    with at.open_input_stream(path) as f:
        return f.read().decode()


def saved_name(url: str) -> str:
    """Name under which the answer of an address is saved for ``replay``; keys in the address are part of it."""
    return hashlib.md5(url.encode()).hexdigest() + ".txt"


def replay(url: str, headers: dict[str, str]) -> str:
    """A transport that reads saved answers below the folder in the header ``folder``, by ``saved_name``."""
    return from_file(f"{headers['folder'].rstrip('/')}/{saved_name(url)}")


def answer(text: str) -> dict | list:
    """The JSON of an answer; refusals, faults and anything else are errors."""
    body = text.strip()
    if body.startswith(("Forbidden", "Unauthorized")):
        raise SourceError(f"refused: {body[:120]}")
    try:
        data = json.loads(body)
    except json.JSONDecodeError:
        raise SourceError(f"no JSON: {body[:200]}") from None
    if isinstance(data, dict) and data.get("error"):
        raise SourceError(f"the source says: {str(data['error'])[:200]}")
    return data


def key(given: str | None, names: tuple[str, ...], file: str | None = None) -> str:
    """A key: given, from the environment, or from a file; angle brackets of a paste are dropped, an empty key is an error."""
    raw = given or next((os.environ[n] for n in names if os.environ.get(n)), None)
    if raw is None and file and os.path.exists(file):
        with open(file, encoding="utf-8") as f:
            raw = f.read()
    token = (raw or "").strip().strip("<>").strip()
    if not token:
        raise SourceError(f"no key: none given, none in {', '.join(names)}")
    return token


def basic_auth(user: str, secret: str) -> dict[str, str]:
    """Header of the request for a token."""
    return {"Authorization": "Basic " + base64.b64encode(f"{user}:{secret}".encode()).decode()}


#: Address and body of the request for a token of the patent source.
TOKEN_URL, TOKEN_BODY = f"{PATENTS}/auth/accesstoken", "grant_type=client_credentials"


def access_token(text: str) -> str:
    """The token in the answer to a request for one; an answer without it is an error."""
    data = answer(text)
    token = data.get("access_token") if isinstance(data, dict) else None
    if not token:
        raise SourceError(f"no token in the answer: {text[:120]}")
    return token


def patent_token(user: str, secret: str, timeout: int = 30) -> Token:
    """Token of the patent source, renewed before it runs out."""
    return Token(lambda: access_token(curl(TOKEN_URL, basic_auth(user, secret), timeout, TOKEN_BODY)))


# --- addresses ---------------------------------------------------------------------------------------------


def feed_url(query: str, most: int = 5, sort_by: str | None = None, order: str = "descending") -> str:
    return f"{ARXIV}?search_query={quote(query)}&start=0&max_results={int(most)}" + (f"&sortBy={quote(sort_by)}&sortOrder={quote(order)}" if sort_by else "")


def filing_search_url(query: str, since: str, until: str | None = None, forms: str = "D") -> str:
    return f"{FILING_SEARCH}?{urlencode({'q': query, 'forms': forms, 'startdt': since} | ({'enddt': until} if until else {}))}"


def filing_url(cik: str | int, accession: str) -> str:
    return f"{FILING}/{int(cik)}/{str(accession).replace('-', '')}/primary_doc.xml"


def class_query(cls: str, since: str, until: str | None = None, field: str = "ipc") -> str:
    """Search for a class and a span of publication days, which the source filters itself."""
    days = " ".join(str(d).replace("-", "") for d in (since, until) if d)
    return f'{field}={cls} and pd within "{days}"'


def patent_search_url(query: str, first: int = 1, last: int = 1) -> str:
    return f"{PATENTS}/rest-services/published-data/search?q={quote(query)}&Range={int(first)}-{int(last)}"


def patent_url(ref: str, part: str = "biblio") -> str:
    if part not in ("biblio", "abstract"):
        raise ValueError(f"{part!r} is neither biblio nor abstract")
    return f"{PATENTS}/rest-services/published-data/publication/docdb/{ref}/{part}"


def series_url(series_id: str, token: str, since: str | None = None, vintage: str | None = None) -> str:
    """A series; with a vintage, as it was known on that day."""
    return f"{SERIES}?series_id={series_id}&api_key={token}&file_type=json" + (f"&observation_start={since}" if since else "") + (f"&realtime_start={vintage}&realtime_end={vintage}" if vintage else "")


def curve_url(year: int) -> str:
    return f"{CURVE}/{year}/all?type=daily_treasury_yield_curve&field_tdr_date_value={year}"


def bars_url(symbol: str, token: str, start: str | None = None, end: str | None = None, period: str = "d") -> str:
    return f"{MARKET}/eod/{symbol}?api_token={token}&fmt=json&period={period}" + (f"&from={start}" if start else "") + (f"&to={end}" if end else "")


def fundamentals_url(symbol: str, token: str) -> str:
    return f"{MARKET}/fundamentals/{symbol}?api_token={token}&fmt=json"


def calendar_url(start: str, end: str, token: str) -> str:
    return f"{MARKET}/calendar/earnings?from={start}&to={end}&api_token={token}&fmt=json"


def symbols_url(token: str, exchange: str = "US", delisted: bool = False, kind: str | None = None) -> str:
    return f"{MARKET}/exchange-symbol-list/{exchange}?api_token={token}&fmt=json" + ("&delisted=1" if delisted else "") + (f"&type={kind}" if kind else "")


def exchanges_url(token: str) -> str:
    return f"{MARKET}/exchanges-list/?api_token={token}&fmt=json"


# --- answers -----------------------------------------------------------------------------------------------


def curve_text(text: str) -> str:
    """A yield curve file; anything that doesn't begin with the header is an error."""
    if not text.strip().lower().startswith("date"):
        raise SourceError(f"no curve file: {text.strip()[:80]}")
    return text.strip()


def list_or_none(text: str) -> str:
    """A list as it is; any other answer counts as an empty list."""
    data = answer(text)
    return json.dumps(data if isinstance(data, list) else [])


def full_list(text: str) -> str:
    """A list as it is; any other answer is an error, so that it is not cached."""
    data = answer(text)
    if not isinstance(data, list):
        raise SourceError(f"no list: {str(data)[:120]}")
    return json.dumps(data)


def fundamentals_or_marker(text: str) -> str:
    """A dump with a general block as it is; any other JSON is the empty object, which marks that there is nothing."""
    data = answer(text)
    return json.dumps(data if isinstance(data, dict) and isinstance(data.get("General"), dict) else {})


def soft(call: Callable[[], str], empty: str = "[]", warn: Callable[[str], None] = print) -> str:
    """What ``call`` gives; where the source fails ``empty``, with a warning."""
    try:
        return call()
    except SourceError as e:
        warn(f"calendar not available: {e}")
        return empty


def no_results_as(call: Callable[[], str], empty: str) -> str:
    """What ``call`` gives; the fault that stands for no results is ``empty``, other faults stay errors."""
    try:
        return call()
    except SourceError as e:
        if any(s in str(e) for s in NO_RESULTS):
            return empty
        raise


#: What a search without results counts as.
NO_HITS = json.dumps({"ops:world-patent-data": {"ops:biblio-search": {"@total-result-count": "0"}}})


def is_transient(message: str | None) -> bool:
    """Whether an error is worth another try."""
    m = (message or "").lower()
    return any(s in m for s in TRANSIENT)


class Token:
    """A token fetched when first asked for, and again once it is older than ``ttl`` seconds or has been dropped."""

    def __init__(self, fetch: Callable[[], str], ttl: float = 1000.0, clock: Callable[[], float] = time.time):
        self.fetch, self.ttl, self.clock, self.value, self.at = fetch, ttl, clock, None, 0.0

    def __call__(self) -> str:
        if self.value is None or self.clock() - self.at > self.ttl:
            self.value, self.at = self.fetch(), self.clock()
        return self.value

    def drop(self) -> None:
        self.value = None


def patiently(call: Callable[[str], str], pause: float = 4.5, waits: tuple[float, ...] = (30, 60, 120), sleep: Callable[[float], None] = time.sleep, renew: Callable[[], None] | None = None) -> Callable[[str], str]:
    """``call`` with a pause before each try and, after errors that pass, with longer ones; other errors and the last one stay errors.

    For ``cache.fetch``. The pause is each task's own; for one rate of all tasks give ``cache.fetch``
    or ``cache.prefetch`` ``workers`` and ``per_minute``. What was fetched is kept by ``cache.prefetch``.
    """

    def run(k: str) -> str:
        for i in range(len(waits) + 1):
            sleep(pause)
            try:
                return call(k)
            except RuntimeError as e:
                if i == len(waits) or not is_transient(str(e)):
                    raise
                sleep(waits[i])
                if renew is not None:
                    renew()
        raise AssertionError("not reached")

    return run


def window_key(cls: str, since: str, until: str, field: str = "ipc") -> str:
    """Name under which the count of a class in a window is cached; ``window_of`` reads it."""
    return f"{field}:{cls}:{since}:{until}"


def window_of(name: str) -> str:
    """The search that a window's name stands for."""
    field, cls, since, until = re.fullmatch(r"([^:]*):(.*):([^:]*):([^:]*)", name).groups()
    return class_query(cls, since, until or None, field)


# --- embeddings --------------------------------------------------------------------------------------------


def embed(docs: DataFrame, call: Callable[[list[str]], list], batch: int = 32) -> DataFrame:
    """``id, vec``: the vector of ``text``, cut to 2000 characters, from ``call`` on batches of texts.

    Flat vectors stay, token matrices are averaged. Another number of vectors than of texts,
    or any other shape, is an error: a wrong vector would mark wrong duplicates.
    """
    from ..shipping import ship

    def flat(v) -> list[float]:
        if isinstance(v, list) and v and all(isinstance(x, (int, float)) for x in v):
            return [float(x) for x in v]
        if isinstance(v, list) and v and all(isinstance(r, list) and r and len(r) == len(v[0]) for r in v):
            return [sum(c) / len(v) for c in zip(*v)]
        raise SourceError(f"not a vector: {str(v)[:120]}")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i in range(0, len(pdf), batch):
                part = pdf.iloc[i : i + batch]
                got = call([(t or "")[:MAX_TEXT] for t in part["text"]])
                if got and isinstance(got[0], (int, float)):
                    got = [got]
                if len(got) != len(part):
                    raise SourceError(f"{len(got)} vectors for {len(part)} texts")
                yield pd.DataFrame({"id": part["id"], "vec": [flat(v) for v in got]})

    ship(docs.sparkSession)
    return docs.select("id", "text").mapInPandas(run, "id long, vec array<double>")


# --- data source -------------------------------------------------------------------------------------------


class _Request(InputPartition):
    def __init__(self, name: str, url: str):
        self.name, self.url = name, url


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.requests = json.loads(options["requests"])
        self.transport = options.get("transport", f"{__name__}:curl")
        self.headers = json.loads(options.get("headers", "{}"))

    def partitions(self):
        return [_Request(n, u) for n, u in sorted(self.requests.items())]

    def read(self, partition):
        module, name = self.transport.split(":")
        yield partition.name, getattr(importlib.import_module(module), name)(partition.url, self.headers)


class PayloadSource(DataSource):
    """``spark.read.format("payloads")``: a row ``name, payload`` per request, each fetched by a task.

    Options: ``requests``, a JSON object from names to addresses; ``transport``, ``module:function``
    of the function that fetches (``curl`` if not given); ``headers``, a JSON object. An error of
    the transport fails the job. Register with ``spark.dataSource.register(PayloadSource)``.
    """

    @classmethod
    def name(cls):
        return "payloads"

    def schema(self):
        return "name string, payload string"

    def reader(self, schema):
        return _Reader(self.options)
