"""Offline transforms of source payloads into rows: feeds, filings, series, curves, patents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import collapse_space, day_of_compact, first_of, iso_day, matches_prefix, number, strip

MAX_TEXT = 2000
# The text of a filing's document and the address that names a company.
FILING_TEXT = "Form D (Kapitalzufluss)"
COMPANY_URL = "https://www.sec.gov/cgi-bin/browse-edgar?action=getcompany&CIK="


def _tag(entry: Column, name: str) -> Column:
    return collapse_space(F.regexp_extract(entry, rf"(?s)<{name}[^>]*>(.*?)</{name}>", 1))


def atom_documents(feeds: DataFrame, xml: str = "xml") -> DataFrame:
    """``pos, title, text, url, published_at`` of each feed entry with a title and a date."""
    e = feeds.select(F.posexplode(F.regexp_extract_all(xml, F.lit(r"(?s)<entry>(.*?)</entry>"), F.lit(1))).alias("pos", "e"))
    out = e.select("pos", _tag(F.col("e"), "title").alias("title"), _tag(F.col("e"), "summary").alias("text"), _tag(F.col("e"), "id").alias("url"), F.substring(_tag(F.col("e"), "published"), 1, 10).alias("published_at"))
    return out.where("title <> '' and published_at <> ''")


def atom_facts(feeds: DataFrame, t_ingest: str, xml: str = "xml") -> DataFrame:
    """``fact_id, text, date`` per entry: title and summary cut to 2000 characters; a missing date is the ingestion date."""
    e = feeds.select(F.posexplode(F.regexp_extract_all(xml, F.lit(r"(?s)<entry>(.*?)</entry>"), F.lit(1))).alias("pos", "e"))
    date = F.coalesce(F.nullif(F.substring(_tag(F.col("e"), "published"), 1, 10), F.lit("")), F.lit(t_ingest))
    return e.select(F.concat(F.lit("arxiv"), F.col("pos").cast("string")).alias("fact_id"), F.substring(F.concat(_tag(F.col("e"), "title"), F.lit(". "), _tag(F.col("e"), "summary")), 1, MAX_TEXT).alias("text"), date.alias("date"))


def filing_hits(payloads: DataFrame, col: str = "json") -> DataFrame:
    """A record per search hit: first company number, accession, first name, first industry code, dates; the amount is not in a hit.

    Fields come as lists or as single values. A payload without hits, or one that is no JSON, gives none.
    """
    hit = F.explode(F.try_variant_get(F.try_parse_json(col), "$.hits.hits", "array<variant>"))
    src = payloads.select(hit.alias("h")).select(F.try_variant_get("h", "$._source", "variant").alias("s"))
    first = lambda *names: first_of(*[F.coalesce(F.try_variant_get("s", f"$.{n}[0]", "string"), F.when(~F.coalesce(F.schema_of_variant(F.try_variant_get("s", f"$.{n}", "variant")).startswith("ARRAY"), F.lit(False)), F.try_variant_get("s", f"$.{n}", "string"))) for n in names])
    text = lambda n: F.try_variant_get("s", f"$.{n}", "string")
    return src.select(
        first("ciks", "cik").alias("cik"), text("adsh").alias("adsh"), F.coalesce(first("display_names"), F.lit("")).alias("entity"), first("sics").alias("industry"),
        text("file_date").alias("filed"), text("file_date").alias("first_sale"), F.lit(None).cast("double").alias("amount"),
    )


def filing_documents(records: DataFrame) -> DataFrame:
    """Filing records as documents; those without a name or a filing date are left out."""
    name = strip(F.coalesce("entity", F.lit("")))
    text = F.concat_ws(" ", F.nullif(name, F.lit("")), F.lit(FILING_TEXT), first_of(F.col("industry").cast("string")))
    url = F.when(F.coalesce(F.col("cik").cast("string"), F.lit("")) != "", F.concat(F.lit(COMPANY_URL), F.col("cik").cast("string")))
    return records.where((name != "") & (F.coalesce("filed", F.lit("")) != "")).select(F.lit("edgar").alias("source_type"), name.alias("title"), text.alias("text"), url.alias("url"), F.col("filed").alias("published_at"))


def filing_amount(xml: Column) -> Column:
    """The amount sold in a filing's own document, else null."""
    return number(F.regexp_extract(xml, r"<totalAmountSold>([^<]+)</totalAmountSold>", 1))


def _capital(df: DataFrame, kind: str, stage: Column, amount: Column, text: Column, event: Column, t_ingest: str, keep: list[str]) -> DataFrame:
    """Rows of the capital table from matched records."""
    return df.select(
        "category_id", "version", F.lit(kind).alias("kind"), F.lit("zufluss").alias("direction"), stage.alias("stage"), amount.alias("amount"), F.lit(None).cast("string").alias("amount_class"),
        F.lit(False).alias("opaque"), text.alias("text"), event.alias("t_event"), F.col("filed").alias("t_disclosed"), F.lit(t_ingest).alias("t_ingest"), *keep,
    )


def capital_from_filings(records: DataFrame, categories: DataFrame, t_ingest: str) -> DataFrame:
    """Capital events of filings whose company number, or industry where there is none, is mapped to a category and version.

    ``categories`` has distinct ``key``. A filing that isn't mapped is left out: a company
    number without a mapping doesn't fall back to its industry.
    """
    keyed = records.withColumn("key", F.coalesce(F.nullif("cik", F.lit("")), F.col("industry")))
    return _capital(keyed.join(categories.select("key", "category_id", "version"), "key"), "funding", F.lit("committed"), F.col("amount").cast("double"), F.coalesce("entity", F.lit("")), first_of(F.col("first_sale"), F.col("filed")), t_ingest, ["cik"])


def capital_from_segments(records: DataFrame, pairs: DataFrame, singles: DataFrame, t_ingest: str, sic_prefixes: list[str] | None = None) -> DataFrame:
    """Capital events of business segments, mapped by company and segment, else by segment alone; others are left out.

    ``pairs`` has distinct ``cik, segment``, ``singles`` distinct ``segment``; both give
    ``category_id, version``. With ``sic_prefixes`` only companies of these industries count.
    A missing stage means money spent.
    """
    if sic_prefixes:
        records = records.where(matches_prefix(F.col("sic").cast("string"), sic_prefixes))
    p = pairs.select("cik", "segment", F.struct("category_id", "version").alias("_p"))
    s = singles.select("segment", F.struct("category_id", "version").alias("_s"))
    found = records.join(p, ["cik", "segment"], "left").join(s, "segment", "left").withColumn("_k", F.coalesce("_p", "_s")).where("_k is not null").select("*", "_k.category_id", "_k.version")
    text = F.concat(F.coalesce("entity", F.lit("")), F.lit(" \u2014 Segment '"), F.coalesce("segment", F.lit("")), F.lit("' CapEx"))
    return _capital(found, "capex", F.coalesce("stage", F.lit("eingesetzt")), F.col("capex").cast("double"), text, first_of(F.col("period_end"), F.col("filed")), t_ingest, ["cik"])


def series_observations(obs: DataFrame, series: DataFrame, t_ingest: str) -> DataFrame:
    """Observations of mapped series that read as numbers; disclosed at the start of their vintage, else at their date.

    ``series`` gives ``category_id, version, signal`` by distinct ``series_id``. A row without
    ``realtime_start`` (null) is disclosed at its date.
    """
    v = number(F.col("value"))
    return obs.join(series.select("series_id", "category_id", "version", "signal"), "series_id").where(v.isNotNull()).select("series_id", "category_id", "version", "signal", F.col("date").alias("t_event"), F.coalesce("realtime_start", "date").alias("t_disclosed"), v.alias("value"), F.lit(t_ingest).alias("t_ingest"))


def yield_curve(rows: DataFrame, tenors: list[str], date: str = "Date", ordered: bool = False) -> DataFrame:
    """``date, rates``: percent columns as a map of fractions; entries that are no numbers are left out, rows without any dropped.

    Dates are month, day, four-digit year; a month over 12 or a day over 31 is no date. The
    days of a month are not counted, so ``date`` is a text. Tenors without a column are absent.
    ``ordered``: by date.
    """
    part = lambda i: F.regexp_extract(strip(F.col(date)), r"^(\d+)/(\d+)/(\d{4})$", i)
    m, d = part(1).try_cast("int"), part(2).try_cast("int")
    iso = F.concat_ws("-", part(3), F.lpad(m.cast("string"), 2, "0"), F.lpad(d.cast("string"), 2, "0"))
    have = [t for t in tenors if t in rows.columns]
    rates = F.map_filter(F.map_from_arrays(F.array(*[F.lit(t) for t in have]), F.array(*[number(F.col(f"`{t}`").cast("string")) / 100 for t in have])), lambda k, v: v.isNotNull())
    out = rows.where(m.between(1, 12) & d.between(1, 31)).select(iso.alias("date"), rates.alias("rates")).where(F.size("rates") > 0)
    return out.orderBy("date") if ordered else out


def curve_lines(payloads: DataFrame, tenors: list[str], col: str = "payload") -> DataFrame:
    """``yield_curve`` of whole files: tenor columns are found by the header of each, in any order, quoted or not; blank lines are passed over."""
    lines = F.filter(F.split(col, r"\r?\n"), lambda x: strip(x) != "")
    fields = lambda x: F.transform(F.split(x, ","), lambda f: strip(F.replace(f, F.lit('"'), F.lit(""))))
    each = payloads.select(fields(F.get(lines, F.lit(0))).alias("_h"), F.explode(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0)))).alias("_l")).select("_h", fields(F.col("_l")).alias("_f"))
    named = each.select(F.get("_f", F.lit(0)).alias("Date"), *[F.when(F.array_contains("_h", t), F.get("_f", F.array_position("_h", t).cast("int") - 1)).alias(t) for t in tenors])
    return yield_curve(named, tenors)


def observations(payloads: DataFrame, col: str = "payload") -> DataFrame:
    """``series_id, date, value, realtime_start`` of each observation in answers named by their series."""
    o = F.explode(F.from_json(col, "observations array<struct<date:string,value:string,realtime_start:string>>")["observations"]).alias("o")
    return payloads.select(F.col("name").alias("series_id"), o).select("series_id", "o.*")


def listed_symbols(payloads: DataFrame, kind: str | None = None, col: str = "payload") -> DataFrame:
    """``symbol, code, exchange, name, kind, isin, seq`` of listed symbols, of one kind or of all; rows without code or exchange are left out."""
    rows = payloads.select(F.posexplode(F.from_json(col, "array<struct<Code:string,Exchange:string,Name:string,Type:string,Isin:string>>")).alias("seq", "r"))
    out = rows.select(symbol_id(F.col("r.Code"), F.col("r.Exchange")).alias("symbol"), F.col("r.Code").alias("code"), F.col("r.Exchange").alias("exchange"), F.col("r.Name").alias("name"), F.col("r.Type").alias("kind"), F.col("r.Isin").alias("isin"), "seq").where("symbol <> ''")
    return out if kind is None else out.where(F.col("kind") == kind)


def price_rows(bars: DataFrame, t_ingest: str, field: str = "adjusted_close") -> DataFrame:
    """``symbol, value, t_event, t_disclosed, t_ingest`` per bar with a date and a price: ``field``, or the close where it is null."""
    value = F.coalesce(F.col(field), F.col("close")).cast("double")
    day = F.substring("date", 1, 10)
    return bars.where(value.isNotNull() & (F.coalesce("date", F.lit("")) != "")).select("symbol", value.alias("value"), day.alias("t_event"), day.alias("t_disclosed"), F.lit(t_ingest).alias("t_ingest"))


def earnings_calendar(payloads: DataFrame, col: str = "json") -> DataFrame:
    """``code, report_date`` alone, where both are there and the date is a full one; no figure of the payload is read."""
    rows = payloads.select(F.explode(F.from_json(col, "earnings array<struct<code:string,report_date:string>>")["earnings"]).alias("e"))
    return rows.select("e.code", iso_day(F.col("e.report_date")).alias("report_date")).where("code <> '' and report_date is not null")


def quarterly_cashflow(payloads: DataFrame, col: str = "json") -> DataFrame:
    """``symbol, fiscal, filing_date, free_cash_flow, capex`` per quarter with a cash flow and a filing date; nested or flat keys."""
    q = "map<string,struct<filing_date:string,freeCashFlow:string,capitalExpenditures:string>>"
    nested = F.get_json_object(col, "$.Financials.Cash_Flow.quarterly")
    flat = F.get_json_object(col, "$['Financials::Cash_Flow::quarterly']")
    rows = payloads.select("symbol", F.explode(F.map_entries(F.from_json(F.coalesce(nested, flat), q))).alias("e"))
    num = lambda c: number(F.col(c))
    return rows.select("symbol", F.col("e.key").alias("fiscal"), F.col("e.value.filing_date").alias("filing_date"), num("e.value.freeCashFlow").alias("free_cash_flow"), num("e.value.capitalExpenditures").alias("capex")).where("free_cash_flow is not null and filing_date <> ''")


def symbol_id(code: Column, exchange: Column) -> Column:
    """``Code.Exchange``, or empty where one is missing."""
    there = (F.coalesce(code, F.lit("")) != "") & (F.coalesce(exchange, F.lit("")) != "")
    return F.when(there, F.concat_ws(".", code, exchange)).otherwise(F.lit(""))


def patent_classes(raw: Column) -> Column:
    """Ordered distinct subclasses: the first four characters of each class without blanks."""
    return F.array_distinct(F.filter(F.transform(raw, lambda c: F.substring(F.regexp_replace(c, r"\s", ""), 1, 4)), lambda c: c != ""))


def patent_facts(records: DataFrame, t_ingest: str) -> DataFrame:
    """Patent records as facts: missing disclosure is the ingestion date, missing event the disclosure; a record without an id is named by ``pos``, where there is one."""
    disclosed = F.coalesce(F.nullif("t_disclosed", F.lit("")), F.lit(t_ingest))
    place = F.concat(F.lit("epo"), F.col("pos").cast("string")) if "pos" in records.columns else F.lit("epo")
    return records.select(
        first_of(F.col("patent_id"), place).alias("fact_id"), F.substring(F.coalesce("title", F.lit("")), 1, MAX_TEXT).alias("subject"), F.lit("patent").alias("source_type"), F.lit("technologie").alias("role"),
        F.coalesce(F.nullif("t_event", F.lit("")), disclosed).alias("t_event"), disclosed.alias("t_disclosed"), F.lit(t_ingest).alias("t_ingest"),
    )


# --- nested payloads ---------------------------------------------------------------------------------------


def shares_outstanding(payloads: DataFrame, col: str = "json") -> DataFrame:
    """``symbol, shares``: nested or flat key, null unless above zero."""
    v = number(F.coalesce(F.get_json_object(col, "$.SharesStats.SharesOutstanding"), F.get_json_object(col, "$['SharesStats::SharesOutstanding']")))
    return payloads.select("symbol", F.when((v > 0) & ~F.isnan(v), v).alias("shares"))


def _get(path: str, of: str = "v") -> Column:
    return F.try_variant_get(of, path, "variant")


def as_list(v: Column) -> Column:
    """A variant as an array of variants: an array as it is, any other value alone, null and JSON null as none."""
    kind = F.schema_of_variant(v)
    return F.when(v.isNull() | (kind == "VOID"), F.array().cast("array<variant>")).when(kind.startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>")).otherwise(F.array(v))


def _name(v: str, path: str) -> Column:
    return F.coalesce(F.try_variant_get(v, path, "string"), F.lit(""))


def exchange_documents(payloads: DataFrame, col: str = "json") -> DataFrame:
    """The columns of ``payloads`` with a row per document of a patent response: ``pos``, its node ``ed`` and ``patent_id``."""
    v = _get("$['ops:world-patent-data']['exchange-documents']['exchange-document']", F.try_parse_json(col))
    each = payloads.select("*", F.posexplode(as_list(v)).alias("pos", "ed"))
    return each.withColumn("patent_id", F.concat(*[_name("ed", f"$['{k}']") for k in ("@country", "@doc-number", "@kind")]))


def _first_date(ref: str) -> Column:
    """First date of a reference's document ids, ISO, else empty."""
    dates = F.transform(as_list(_get(f"$['bibliographic-data']['{ref}']['document-id']", "ed")), lambda d: F.try_variant_get(d, "$.date['$']", "string"))
    return day_of_compact(F.get(F.filter(dates, lambda d: F.coalesce(d, F.lit("")) != ""), F.lit(0)))


def _spoken(items: Column, text) -> Column:
    """Of items with a language and a text that is not empty: the first English one, else the first."""
    some = F.filter(F.transform(items, lambda t: F.struct(F.try_variant_get(t, "$['@lang']", "string").alias("lang"), text(t).alias("text"))), lambda t: t["text"] != "")
    return F.coalesce(F.get(F.filter(some, lambda t: t["lang"] == "en"), F.lit(0))["text"], F.get(some, F.lit(0))["text"], F.lit(""))


def patent_records(payloads: DataFrame, col: str = "json") -> DataFrame:
    """``patent_id, title, main_class, classes, t_event, t_disclosed`` of each document of patent responses.

    The event is the application, disclosed by the publication; a missing date is empty and
    stands for none. Scalars and lists of one are read alike; a document without
    bibliographic data is left out.
    """
    e = exchange_documents(payloads, col).where(_get("$['bibliographic-data']", "ed").isNotNull())
    title = _spoken(as_list(_get("$['bibliographic-data']['invention-title']", "ed")), lambda t: strip(F.coalesce(F.try_variant_get(t, "$['$']", "string"), F.lit(""))))
    raw = F.transform(as_list(_get("$['bibliographic-data']['classifications-ipcr']['classification-ipcr']", "ed")), lambda c: F.coalesce(F.try_variant_get(c, "$.text['$']", "string"), F.lit("")))
    out = e.select("patent_id", title.alias("title"), patent_classes(raw).alias("classes"), _first_date("application-reference").alias("t_event"), _first_date("publication-reference").alias("t_disclosed"))
    return out.select("patent_id", "title", F.coalesce(F.get("classes", F.lit(0)), F.lit("")).alias("main_class"), "classes", "t_event", "t_disclosed")


def patent_abstracts(payloads: DataFrame, key: str, col: str = "json") -> DataFrame:
    """``key, patent_id, abstract``: of each response the first document with an abstract; the first document's id and an empty text where none has one.

    Paragraphs are joined by blanks, English comes first. A response without documents has an empty id.
    """
    para = lambda p: strip(F.array_join(F.transform(as_list(p), lambda x: strip(F.coalesce(F.try_variant_get(x, "$['$']", "string"), F.lit("")))), " "))
    text = _spoken(as_list(_get("$.abstract", "ed")), lambda a: para(_get("$.p", a)))
    found = exchange_documents(payloads, col).select(key, "pos", "patent_id", text.alias("abstract"))
    best = found.groupBy(key).agg(F.min_by(F.struct("patent_id", "abstract"), F.when(F.col("abstract") != "", F.col("pos"))).alias("with_text"), F.min_by("patent_id", "pos").alias("first"))
    known = payloads.select(key).distinct().join(best, key, "left")
    return known.select(key, F.coalesce("with_text.patent_id", "first", F.lit("")).alias("patent_id"), F.coalesce("with_text.abstract", F.lit("")).alias("abstract"))


def patent_documents(records: DataFrame, abstracts: DataFrame | None = None) -> DataFrame:
    """Patent records as documents: title, abstract (by ``patent_id``, where there is one) and classes; those without a title or a publication are left out."""
    title = strip(F.coalesce("title", F.lit("")))
    rows = records.where((title != "") & (F.coalesce("t_disclosed", F.lit("")) != ""))
    rows = rows.join(abstracts.select("patent_id", "abstract"), "patent_id", "left") if abstracts is not None else rows.withColumn("abstract", F.lit(None).cast("string"))
    text = F.concat_ws(" ", title, F.nullif(strip("abstract"), F.lit("")), F.nullif(F.array_join("classes", " "), F.lit("")))
    return rows.select(F.lit("epo").alias("source_type"), title.alias("title"), text.alias("text"), F.col("patent_id").alias("url"), F.col("t_disclosed").alias("published_at"))


def search_references(payloads: DataFrame, col: str = "json") -> DataFrame:
    """``pos, ref`` of each hit of a patent search: country, number and kind of its docdb id, or else of its first id; hits without country or number are left out."""
    v = _get("$['ops:world-patent-data']['ops:biblio-search']['ops:search-result']['ops:publication-reference']", F.try_parse_json(col))
    ids = payloads.select("*", F.posexplode(as_list(v)).alias("pos", "r")).select("pos", as_list(_get("$['document-id']", "r")).alias("ids"))
    docdb = F.filter("ids", lambda d: F.try_variant_get(d, "$['@document-id-type']", "string") == "docdb")
    one = ids.select("pos", F.coalesce(F.get(docdb, F.lit(0)), F.get("ids", F.lit(0))).alias("d"))
    part = lambda k: F.nullif(_name("d", f"$['{k}']['$']"), F.lit(""))
    return one.where(part("country").isNotNull() & part("doc-number").isNotNull()).select("pos", F.concat_ws(".", part("country"), part("doc-number"), part("kind")).alias("ref"))


def search_count(col: Column) -> Column:
    """The number of hits that a patent search says; a response without one is an error, not zero."""
    n = F.try_variant_get(F.try_parse_json(col), "$['ops:world-patent-data']['ops:biblio-search']['@total-result-count']", "string")
    return F.when(n.rlike(r"^\s*\d+\s*$"), strip(n).try_cast("long")).otherwise(F.raise_error(F.lit("a search response without a count")).cast("long"))
