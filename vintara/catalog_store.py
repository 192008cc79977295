"""Queries of the writers, caches, builders and parsers over payloads made of the test tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .catalog import DOCS, OBS, docs, observations, query, t
from .functions.scalar import compact_day, day_of_compact, fact_number
from .operators import collect, market, near_dup, temporal
from .plans import build
from .sources import cache, parsers, writers
from .streaming import events as ev

NOW = "2024-03-01 00:00:00"


def js(template: str, *cols):
    """A JSON text from a template."""
    return F.format_string(template, *[c.cast("string") for c in cols])


def _events(s, sf):
    return t(s, sf, "events").select("event_id", "user_id", "event_type", F.to_date("ts").alias("d"), F.floor(F.col("value") * 100).cast("long").alias("v"))


EV = "ev AS (SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS d, CAST(floor(value * 100) AS BIGINT) AS v FROM events)"


# --- writers -----------------------------------------------------------------------------------------------


def _bars(s, sf):
    k = F.col("event_id") % 3
    adjusted = F.when(k == 0, js('"adjusted_close":%s', F.col("v") + 1)).when(k == 1, js('"adjClose":%s', F.col("v") + 2)).otherwise(js('"adjusted_close":null,"adjClose":%s', F.col("v")))
    day = F.when(F.col("event_id") % 11 == 0, F.lit('"date":""')).when(F.col("event_id") % 2 == 0, js('"date":"%sT00"', F.col("d"))).otherwise(js('"datum":"%s"', F.col("d")))
    return _events(s, sf).select(F.col("user_id").alias("symbol"), F.col("event_id").alias("seq"), js('{%s,"close":%s,%s}', day, F.col("v"), adjusted).alias("bar"))


@query(f"WITH {EV} SELECT user_id AS symbol, CAST(d AS VARCHAR) AS datum, CAST(v AS DOUBLE) AS close, CAST(CASE event_id % 3 WHEN 0 THEN v + 1 WHEN 1 THEN v + 2 END AS DOUBLE) AS adjusted_close FROM ev WHERE event_id % 11 <> 0 QUALIFY row_number() OVER (PARTITION BY user_id, d ORDER BY event_id DESC) = 1")
def eod_upsert(s, sf):
    return writers.current_rows(writers.bar_rows(_bars(s, sf), "2024-03-01"), ["symbol", "datum"]).select("symbol", "datum", "close", "adjusted_close")


@query("SELECT CAST(user_id AS VARCHAR) AS symbol, event_type AS category, CASE WHEN event_id % 2 = 0 THEN 'x' || event_id END AS sector, CAST(NULL AS VARCHAR) AS name FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1")
def meta_upsert(s, sf):
    rows = t(s, sf, "events").select(F.col("user_id").alias("symbol"), F.col("event_type").alias("category"), F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("x"), F.col("event_id").cast("string"))).alias("sector"), F.col("event_id").alias("seq"))
    return writers.meta_rows(rows).select("symbol", "category", "sector", "name")


@query("SELECT CAST(user_id AS VARCHAR) AS symbol, '{\"a\":{\"k\":' || event_id || ',\"z\":[1,2]},\"b\":\"' || event_type || '\"}' AS payload FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1")
def fundamentals_canonical(s, sf):
    e = t(s, sf, "events")
    rows = e.select(F.col("user_id").alias("symbol"), js('{ "b" : "%s", "a" : {"z": [1, 2], "k": %s} }', F.col("event_type"), F.col("event_id")).alias("payload"), F.col("event_id").alias("seq"))
    return writers.fundamental_rows(rows, "2024-03-01").select("symbol", "payload")


@query(f"WITH {EV}, r AS (SELECT event_type AS source, CAST(user_id AS VARCHAR) AS entity, CAST(d AS VARCHAR) AS datum, CASE event_id % 4 WHEN 0 THEN CAST(d + 3 AS VARCHAR) WHEN 1 THEN CAST(d + 1 AS VARCHAR) ELSE '2024-02-20' END AS t_disclosed, event_id, v FROM ev WHERE event_id % 13 <> 0) SELECT source, entity, datum, t_disclosed, v FROM r QUALIFY row_number() OVER (PARTITION BY source, entity, datum, t_disclosed ORDER BY event_id DESC) = 1")
def sensor_upsert(s, sf):
    k = F.col("event_id") % 4
    told = F.when(k == 0, js(',"filed":"%s"', F.date_add("d", 3))).when(k == 1, js(',"filed":"","t_disclosed":"%s"', F.date_add("d", 1))).otherwise(F.lit(',"filed":null'))
    day = F.when(F.col("event_id") % 13 == 0, F.lit("")).otherwise(F.col("d").cast("string"))
    rows = _events(s, sf).select(F.col("event_type").alias("source"), F.col("user_id").alias("entity"), F.col("event_id").alias("seq"), js('{"v":%s,"at":"%s"%s}', F.col("v"), day, told).alias("row"))
    out = writers.sensor_rows(rows, "at", "filed", "2024-02-20")
    return out.select("source", "entity", "datum", "t_disclosed", F.get_json_object("payload", "$.v").cast("long").alias("v"))


@query("WITH e AS (SELECT user_id, event_type, CAST(ts AS DATE) AS d, event_id, value FROM events), n AS (SELECT * FROM e WHERE event_id % 2 = 1 QUALIFY row_number() OVER (PARTITION BY user_id, event_type, d ORDER BY event_id) = 1) SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.event_id % 2 = 0 AND e.user_id = n.user_id AND e.event_type = n.event_type AND e.d = n.d)")
def first_wins_whole(s, sf):
    e = t(s, sf, "events").select("user_id", "event_type", F.to_date("ts").alias("d"), "event_id", "value")
    return temporal.first_wins(e.where("event_id % 2 = 1"), e.where("event_id % 2 = 0"), ["user_id", "event_type", "d"], "event_id")


def _raw_documents(s, sf):
    day = F.when(F.col("doc_id") % 17 == 0, F.lit(" ")).otherwise(F.concat(F.lit(" "), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int")).cast("string"), F.lit("\n")))
    return t(s, sf, "documents").select(F.col("doc_id").alias("seq"), F.concat(F.lit("\t"), F.when(F.col("doc_id") % 19 == 0, F.lit("")).otherwise(F.concat(F.lit("T"), (F.col("doc_id") % 40).cast("string"))), F.lit(" ")).alias("title"), day.alias("published_at"), F.when(F.col("doc_id") % 3 == 0, F.lit(" EPO ")).when(F.col("doc_id") % 3 == 1, F.lit("arxiv")).alias("source_type"), "text")


RAW_DOCS = "raw AS (SELECT doc_id AS seq, 'T' || doc_id % 40 AS title, CAST(DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS VARCHAR) AS published_at, CASE doc_id % 3 WHEN 0 THEN 'patent' WHEN 1 THEN 'paper' ELSE 'news' END AS source_type FROM documents WHERE doc_id % 17 <> 0 AND doc_id % 19 <> 0)"


@query(f"WITH {RAW_DOCS}, old AS (SELECT 'T' || r AS title, '2024-01-0' || d AS published_at FROM range(0, 10) a(r), range(1, 10) b(d)) SELECT seq, title, published_at, source_type FROM raw WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.title = raw.title AND old.published_at = raw.published_at) QUALIFY row_number() OVER (PARTITION BY title, published_at ORDER BY seq) = 1")
def documents_insert(s, sf):
    old = s.range(10).select(F.concat(F.lit("T"), F.col("id").cast("string")).alias("title"), F.explode(F.transform(F.sequence(F.lit(1), F.lit(9)), lambda d: F.concat(F.lit("2024-01-0"), d.cast("string")))).alias("published_at"))
    return writers.document_rows(_raw_documents(s, sf), old).select("seq", "title", "published_at", "source_type")


@query(f"WITH {RAW_DOCS}, f AS (SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY title, published_at ORDER BY seq) = 1), a AS (SELECT * FROM f WHERE seq % 2 = 0) SELECT seq AS id, title, published_at FROM a UNION ALL SELECT seq, title, published_at FROM raw b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.title = b.title AND a.published_at = b.published_at) QUALIFY row_number() OVER (PARTITION BY title, published_at ORDER BY seq) = 1")
def documents_merged(s, sf):
    every = writers.document_rows(_raw_documents(s, sf)).select(F.col("seq").alias("id"), "title", "published_at")
    other = _raw_documents(s, sf).select(F.trim("title", F.lit(" \t")).alias("title"), F.trim("published_at", F.lit(" \n")).alias("published_at"), F.col("seq").alias("id")).where("title <> '' and published_at <> ''")
    return writers.merge_documents(every.where("id % 2 = 0"), other.select("id", "title", "published_at"))


@query("WITH f AS (SELECT conv_id * 100 + turn AS seq, CASE WHEN turn % 5 <> 4 THEN conv_id END AS doc_id, CASE WHEN turn % 7 = 6 THEN '' ELSE role END AS subject, 'says' AS relation, substring(text, 1, 1) AS object FROM conversations) SELECT seq, doc_id, subject, relation, trim(regexp_replace(object, '^\\s+|\\s+$', '', 'g')) AS object FROM f WHERE subject <> '' AND doc_id IS NULL UNION ALL (SELECT seq, doc_id, subject, relation, trim(regexp_replace(object, '^\\s+|\\s+$', '', 'g')) AS object FROM f WHERE subject <> '' AND doc_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_id, subject, relation, regexp_replace(object, '^\\s+|\\s+$', '', 'g') ORDER BY seq) = 1)")
def facts_insert(s, sf):
    k = F.col("turn")
    f = t(s, sf, "conversations").select((F.col("conv_id") * 100 + k).alias("seq"), F.when(k % 5 != 4, F.col("conv_id")).alias("doc_id"), F.when(k % 7 == 6, F.lit("  ")).otherwise(F.concat(F.lit(" "), "role", F.lit("\t"))).alias("subject"), F.lit(" says").alias("relation"), F.substring("text", 1, 1).alias("object"))
    return writers.fact_rows(f)


@query(f"WITH {OBS}, k AS (SELECT 'c' || o_orderkey % 7 AS category_id, CASE WHEN o_orderkey % 10 <> 3 THEN 1 END AS version, CAST(t_disclosed AS VARCHAR) AS t_disclosed, CASE WHEN o_orderkey % 2 = 0 THEN 'X' || o_orderkey % 5 ELSE '' END AS cik, CASE WHEN o_orderkey % 3 = 0 THEN 'text' ELSE '' END AS entity, CASE WHEN o_orderkey % 4 = 0 THEN 'capex' ELSE 'funding' END AS kind, o_orderkey AS seq FROM obs) SELECT category_id, version, t_disclosed, cik, entity, kind, 'zufluss' AS direction, 'committed' AS stage, 'edgar_form_d' AS source, seq FROM k WHERE version IS NOT NULL QUALIFY row_number() OVER (PARTITION BY category_id, version, cik, entity, t_disclosed ORDER BY seq) = 1")
def capital_insert(s, sf):
    k = F.col("o_orderkey")
    o = observations(s, sf).select(F.concat(F.lit("c"), (k % 7).cast("string")).alias("category_id"), F.when(k % 10 != 3, F.lit(1)).alias("version"), F.col("t_disclosed").cast("string").alias("t_disclosed"), F.when(k % 2 == 0, F.concat(F.lit("X"), (k % 5).cast("string"))).alias("cik"), F.when(k % 3 == 0, F.lit("text")).alias("text"), F.when(k % 4 == 0, F.lit("capex")).alias("kind"), k.alias("seq"))
    return writers.capital_rows(o).select("category_id", "version", "t_disclosed", "cik", "entity", "kind", "direction", "stage", "source", "seq")


@query("SELECT conv_id AS fact_id, 'why ' || turn AS reason, turn % 3 <> 0 AS active FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, text DESC) = 1")
def exclusion_markers(s, sf):
    k = F.col("turn")
    name = F.when(k % 2 == 0, F.concat(F.lit("Fakt"), F.col("conv_id").cast("string"))).otherwise(F.col("conv_id").cast("string"))
    m = t(s, sf, "conversations").select(name.alias("fact"), F.concat(F.lit(" why "), k.cast("string")).alias("reason"), F.lit("a").alias("actor"), F.lit("2024-01-01").alias("t_disclosed"), (k % 3 != 0).alias("active"), F.struct("turn", "text").alias("seq"))
    return writers.exclusion_rows(m).select("fact_id", "reason", "active")


@query(f"WITH {DOCS} SELECT CAST(id AS VARCHAR) AS doc_id, COALESCE(relevance, 0) >= 0.5 AS accepted, substring(sha256(title || ' ' || text), 1, 16) AS content_hash, CAST(published_at AS VARCHAR) AS t_disclosed, id AS payload_id FROM docs")
def raw_documents(s, sf):
    d = docs(s, sf).select(F.col("id").alias("doc_id"), "title", "text", F.lit("u").alias("url"), "relevance", F.col("published_at").cast("string").alias("published_at"), F.col("id").alias("seq"))
    rows, _ = writers.raw_document_rows(d, "run", "2024-03-01")
    return rows.select("doc_id", "accepted", "content_hash", "t_disclosed", F.get_json_object("payload", "$.doc_id").cast("long").alias("payload_id"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 2 THEN NULL ELSE c_custkey END AS n, '20240105' AS compact, CASE WHEN c_custkey % 2 = 0 THEN '2024-01-05' ELSE '' END AS iso FROM customer")
def id_and_day_forms(s, sf):
    k = F.col("c_custkey")
    c = t(s, sf, "customer").select("c_custkey", F.when(k % 3 == 0, F.concat(F.lit(" FAKT"), k.cast("string"))).when(k % 3 == 1, k.cast("string")).otherwise(F.concat(F.lit("fact"), k.cast("string"))).alias("f"), F.when(k % 2 == 0, F.lit("20240105")).otherwise(F.lit("2024")).alias("d"))
    return c.select("c_custkey", fact_number(F.col("f")).alias("n"), compact_day(F.lit("2024-01-05")).alias("compact"), day_of_compact(F.col("d")).alias("iso"))


# --- cache -------------------------------------------------------------------------------------------------


def _log(s, sf):
    """Cache entries: each event an entry of one of two namespaces; some corrupt, some markers, some of unreadable time."""
    k = F.col("event_id")
    data = F.when(k % 7 == 0, F.lit("{bad")).when(k % 5 == 0, F.lit("[]")).otherwise(js('[{"date":"%s","close":%s}]', F.to_date("ts"), k))
    at = F.when(k % 9 == 0, F.lit("?")).otherwise(F.concat(F.to_date("ts").cast("string"), F.lit(" 00:00:00")))
    space = F.when(F.col("user_id") % 2 == 0, F.lit(cache.BARS_NAMESPACE)).otherwise(F.lit(cache.DEFAULT_NAMESPACE))
    return t(s, sf, "events").select(space.alias("namespace"), F.col("user_id").cast("string").alias("symbol"), data.alias("data"), at.alias("t_ingest"), k.alias("seq"))


LOG = "log AS (SELECT CASE WHEN user_id % 2 = 0 THEN 'eod_cache' ELSE 'fundamentals_cache' END AS namespace, CAST(user_id AS VARCHAR) AS symbol, CASE WHEN event_id % 7 = 0 THEN '{bad' WHEN event_id % 5 = 0 THEN '[]' ELSE '[{\"date\":\"' || CAST(ts AS DATE) || '\",\"close\":' || event_id || '}]' END AS data, CASE WHEN event_id % 9 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS wrote, event_id AS seq, CAST(ts AS DATE) AS d FROM events), cur AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY namespace, symbol ORDER BY seq DESC) = 1)"


@query(f"WITH {LOG} SELECT symbol, data FROM cur WHERE namespace = 'eod_cache' AND data <> '{{bad' AND (wrote IS NULL OR date_diff('day', wrote, DATE '2024-03-01') <= 32)")
def cache_read_ttl(s, sf):
    return cache.read(_log(s, sf), cache.BARS_NAMESPACE, NOW, 32).select("symbol", "data")


@query(f"WITH {LOG} SELECT namespace, symbol FROM cur WHERE data = '{{bad'")
def cache_corrupt(s, sf):
    return cache.corrupt(_log(s, sf))


@query(f"WITH {LOG} SELECT namespace, COUNT(*) AS n, CAST(SUM(strlen(data)) AS BIGINT) AS bytes FROM cur GROUP BY 1")
def cache_inventory(s, sf):
    return cache.inventory(_log(s, sf))


@query(f"WITH {LOG} SELECT symbol, CASE WHEN wrote IS NULL THEN 0.0 ELSE CAST(date_diff('day', wrote, DATE '2024-03-01') AS DOUBLE) END AS age_days FROM cur WHERE namespace = 'fundamentals_cache'")
def cache_freshness(s, sf):
    return cache.freshness_days(_log(s, sf), cache.DEFAULT_NAMESPACE, NOW)


@query(f"WITH {LOG} SELECT CAST(c_custkey AS VARCHAR) AS symbol FROM customer WHERE CAST(c_custkey AS VARCHAR) NOT IN (SELECT symbol FROM log WHERE namespace = 'eod_cache')")
def cache_missing(s, sf):
    asked = t(s, sf, "customer").select(F.col("c_custkey").cast("string").alias("symbol"))
    return cache.missing(asked, _log(s, sf), cache.BARS_NAMESPACE)


@query(f"WITH {LOG} SELECT symbol FROM cur WHERE namespace = 'eod_cache' AND (data IN ('[]', '{{bad') OR d < DATE '2024-01-25')")
def cache_incomplete(s, sf):
    log = _log(s, sf)
    return cache.incomplete(log.select("symbol"), log, cache.BARS_NAMESPACE, "2024-01-25")


@query(f"WITH {LOG} SELECT symbol, CAST(d AS VARCHAR) AS datum, CAST(seq AS DOUBLE) AS close FROM cur WHERE namespace = 'eod_cache' AND data NOT IN ('[]', '{{bad')")
def bars_from_cache(s, sf):
    return build.bars_from_cache(_log(s, sf), "2024-03-01").select("symbol", "datum", "close")


@query(f"WITH {LOG} SELECT symbol, '[{{\"close\":' || seq || ',\"date\":\"' || d || '\"}}]' AS payload FROM cur WHERE namespace = 'fundamentals_cache' AND data NOT IN ('[]', '{{bad')")
def fundamentals_from_cache(s, sf):
    return build.fundamentals_from_cache(_log(s, sf), "2024-03-01").select("symbol", "payload")


@query(f"WITH {LOG} SELECT 'q' AS source, symbol AS entity, CAST(d AS VARCHAR) AS datum, '2024-02-20' AS t_disclosed FROM cur WHERE namespace = 'eod_cache' AND data NOT IN ('[]', '{{bad')")
def sensors_from_cache(s, sf):
    return build.sensors_from_cache(_log(s, sf), cache.BARS_NAMESPACE, "q", "date", "2024-02-20").select("source", "entity", "datum", "t_disclosed")


@query(f"WITH {LOG} SELECT CAST(c_custkey AS VARCHAR) AS symbol, c_mktsegment AS category FROM customer WHERE CAST(c_custkey AS VARCHAR) IN (SELECT symbol FROM log)")
def meta_for_cached(s, sf):
    cats = t(s, sf, "customer").select(F.col("c_custkey").cast("string").alias("symbol"), F.col("c_mktsegment").alias("category"))
    return build.meta_for_cached(_log(s, sf), cats, "2024-03-01").select("symbol", "category")


# --- parsers -----------------------------------------------------------------------------------------------


def _hits(s, sf):
    k = F.col("c_custkey")
    cik = F.when(k % 3 == 0, js('"ciks":["%s","9"]', k)).when(k % 3 == 1, js('"ciks":[],"cik":"%s"', k)).otherwise(F.lit('"adsh":"A"'))
    one = js('{"_source":{%s,"display_names":["%s"],"sics":["%s"],"file_date":"2024-01-%s"}}', cik, F.when(k % 8 == 0, F.lit(" ")).otherwise(F.col("c_name")), F.col("c_nationkey"), F.lpad((k % 28 + 1).cast("string"), 2, "0"))
    return t(s, sf, "customer").select(F.concat(F.lit('{"hits":{"hits":['), one, F.lit("]}}")).alias("json"))


HITS = "hits AS (SELECT CASE c_custkey % 3 WHEN 2 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS cik, CASE WHEN c_custkey % 8 = 0 THEN ' ' ELSE c_name END AS entity, CAST(c_nationkey AS VARCHAR) AS industry, '2024-01-' || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') AS filed FROM customer)"


@query(f"WITH {HITS} SELECT * FROM hits")
def filing_hits(s, sf):
    return parsers.filing_hits(_hits(s, sf)).select("cik", "entity", "industry", "filed")


@query(f"WITH {HITS} SELECT entity AS title, entity || ' Form D (Kapitalzufluss) ' || industry AS text, 'https://www.sec.gov/cgi-bin/browse-edgar?action=getcompany&CIK=' || cik AS url, filed AS published_at FROM hits WHERE entity <> ' '")
def filing_documents(s, sf):
    return parsers.filing_documents(parsers.filing_hits(_hits(s, sf))).select("title", "text", "url", "published_at")


@query(f"WITH {HITS}, m AS (SELECT CAST(c_custkey AS VARCHAR) AS key, 'k' || c_custkey AS category_id FROM customer WHERE c_custkey > 30 UNION ALL SELECT CAST(n_nationkey AS VARCHAR), 'n' || n_nationkey FROM nation WHERE n_nationkey % 2 = 0) SELECT category_id, 1 AS version, cik, entity AS text, filed AS t_event, filed AS t_disclosed, 'funding' AS kind, 'zufluss' AS direction, 'committed' AS stage FROM hits JOIN m ON m.key = COALESCE(cik, industry)")
def filing_capital(s, sf):
    c = t(s, sf, "customer").where("c_custkey > 30").select(F.col("c_custkey").cast("string").alias("key"), F.concat(F.lit("k"), F.col("c_custkey").cast("string")).alias("category_id"))
    n = t(s, sf, "nation").where("n_nationkey % 2 = 0").select(F.col("n_nationkey").cast("string").alias("key"), F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("category_id"))
    rows = parsers.capital_from_filings(parsers.filing_hits(_hits(s, sf)), c.union(n).withColumn("version", F.lit(1)), "2024-03-01")
    return rows.select("category_id", "version", "cik", "text", "t_event", "t_disclosed", "kind", "direction", "stage")


@query("WITH r AS (SELECT CAST(c_custkey AS VARCHAR) AS cik, c_mktsegment AS segment, CAST(c_nationkey AS VARCHAR) AS sic, c_custkey FROM customer), p AS (SELECT cik, segment, 'p' || cik AS category_id FROM r WHERE c_custkey % 5 = 0), o AS (SELECT DISTINCT segment, 's' || segment AS category_id FROM r WHERE segment < 'F') SELECT r.cik, COALESCE(p.category_id, o.category_id) AS category_id, CASE WHEN c_custkey % 4 = 0 THEN 'geplant' ELSE 'eingesetzt' END AS stage, CASE WHEN c_custkey % 3 = 0 THEN '2023-12-31' ELSE '2024-02-01' END AS t_event, 'E — Segment ''' || r.segment || ''' CapEx' AS text FROM r LEFT JOIN p USING (cik, segment) LEFT JOIN o ON o.segment = r.segment WHERE COALESCE(p.category_id, o.category_id) IS NOT NULL AND (sic LIKE '1%' OR sic LIKE '2%')")
def segment_capital(s, sf):
    k = F.col("c_custkey")
    r = t(s, sf, "customer").select(k.cast("string").alias("cik"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").cast("string").alias("sic"), F.lit("E").alias("entity"), F.lit(1.5).alias("capex"), F.when(k % 4 == 0, F.lit("geplant")).alias("stage"), F.when(k % 3 == 0, F.lit("2023-12-31")).otherwise(F.lit("")).alias("period_end"), F.lit("2024-02-01").alias("filed"))
    pairs = r.where("cast(cik as int) % 5 = 0").select("cik", "segment", F.concat(F.lit("p"), "cik").alias("category_id"), F.lit(1).alias("version"))
    singles = r.where("segment < 'F'").select("segment").distinct().select("segment", F.concat(F.lit("s"), "segment").alias("category_id"), F.lit(1).alias("version"))
    return parsers.capital_from_segments(r, pairs, singles, "2024-03-01", ["1", "2"]).select("cik", "category_id", "stage", "t_event", "text")


@query(f"WITH {EV} SELECT event_type AS series_id, 'c' || event_type AS category_id, CAST(v AS DOUBLE) AS value, CAST(d AS VARCHAR) AS t_event, CASE WHEN event_id % 3 = 0 THEN CAST(d AS VARCHAR) ELSE CAST(d + 5 AS VARCHAR) END AS t_disclosed, event_id % 7 AS k FROM ev WHERE event_id % 7 IN (0, 1, 2) AND event_type <> 'click'")
def series_values(s, sf):
    k = F.col("event_id") % 7
    v = F.col("v").cast("string")
    value = F.when(k == 0, v).when(k == 1, F.concat(F.lit(" "), v, F.lit(".0"))).when(k == 2, F.concat(v, F.lit("e0"))).when(k == 3, F.concat(v, F.lit("d"))).when(k == 4, F.lit(".")).when(k == 5, F.lit(""))
    o = _events(s, sf).select(F.col("event_type").alias("series_id"), value.alias("value"), F.col("d").cast("string").alias("date"), F.when(F.col("event_id") % 3 != 0, F.date_add("d", 5).cast("string")).alias("realtime_start"), k.alias("k"))
    m = t(s, sf, "events").select(F.col("event_type").alias("series_id")).distinct().where("series_id <> 'click'").select("series_id", F.concat(F.lit("c"), "series_id").alias("category_id"), F.lit(1).alias("version"), F.lit("preis").alias("signal"))
    got = o.withColumn("series_id", F.concat_ws("|", "series_id", F.col("k").cast("string")))
    each = m.select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(6)), lambda i: F.concat_ws("|", "series_id", i.cast("string")))).alias("series_id"), "category_id", "version", "signal")
    out = parsers.series_observations(got, each, "2024-03-01")
    return out.select(F.split("series_id", r"\|")[0].alias("series_id"), "category_id", "value", "t_event", "t_disclosed", F.split("series_id", r"\|")[1].cast("long").alias("k"))


def _curve(s, sf):
    k = F.col("o_orderkey") % 5
    d = F.to_date("o_orderdate")
    date = F.when(k == 4, F.concat(F.lit("13/45/"), F.year(d).cast("string"))).otherwise(F.concat_ws("/", F.month(d).cast("string"), F.day(d).cast("string"), F.year(d).cast("string")))
    two = F.when(k == 0, F.lit("N/A")).when(k == 1, F.lit("1d")).otherwise((F.col("o_orderkey") % 100).cast("string"))
    ten = F.when(k == 3, F.lit("")).otherwise((F.col("o_orderkey") % 90).cast("string"))
    return t(s, sf, "orders").select(date.alias("Date"), two.alias("2 Yr"), ten.alias("10 Yr"))


CURVE = "curve AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, CASE WHEN o_orderkey % 5 >= 2 THEN (o_orderkey % 100) / 100.0 END AS two, CASE WHEN o_orderkey % 5 <> 3 THEN (o_orderkey % 90) / 100.0 END AS ten FROM orders WHERE o_orderkey % 5 <> 4)"


@query(f"WITH {CURVE} SELECT CAST(date AS VARCHAR) AS date, two, ten FROM curve")
def yield_curve(s, sf):
    got = parsers.yield_curve(_curve(s, sf), ["2 Yr", "5 Yr", "10 Yr"])
    return got.select("date", F.col("rates")["2 Yr"].alias("two"), F.col("rates")["10 Yr"].alias("ten"))


@query(f"WITH {CURVE}, one AS (SELECT date, MAX(ten) AS ten FROM curve WHERE ten IS NOT NULL GROUP BY 1), ask AS (SELECT DATE '1990-06-30' AS cutoff UNION ALL SELECT CAST(y || '-01-01' AS DATE) FROM range(1995, 1999) r(y) UNION ALL SELECT DATE '1997-06-30') SELECT cutoff, (SELECT arg_max(ten, date) FROM one WHERE date <= cutoff AND year(date) >= year(cutoff) - 1) AS rate FROM ask")
def risk_free_asof(s, sf):
    curve = parsers.yield_curve(_curve(s, sf), ["10 Yr"]).where("rates['10 Yr'] is not null").groupBy("date").agg(F.max(F.col("rates")["10 Yr"]).alias("r")).select("date", F.create_map(F.lit("10 Yr"), F.col("r")).alias("rates"))
    asks = s.createDataFrame([("1990-06-30",), ("1995-01-01",), ("1996-01-01",), ("1997-01-01",), ("1998-01-01",), ("1997-06-30",)], "cutoff string")
    return market.risk_free_rate(curve, asks)


@query(f"WITH {EV} SELECT user_id AS symbol, CAST(CASE WHEN event_id % 3 = 0 THEN v + 1 ELSE v END AS DOUBLE) AS value, CAST(d AS VARCHAR) AS t_event, event_id FROM ev WHERE event_id % 5 <> 0")
def price_rows(s, sf):
    b = _events(s, sf).select(F.col("user_id").alias("symbol"), F.when(F.col("event_id") % 3 == 0, F.col("v") + 1).alias("adjusted_close"), F.col("v").alias("close"), F.when(F.col("event_id") % 5 != 0, F.concat(F.col("d").cast("string"), F.lit("T10"))).alias("date"), F.col("event_id"))
    out = parsers.price_rows(b.withColumn("symbol", F.concat_ws("|", "symbol", F.col("event_id").cast("string"))), "2024-03-01")
    return out.select(F.split("symbol", r"\|")[0].cast("long").alias("symbol"), "value", "t_event", F.split("symbol", r"\|")[1].cast("long").alias("event_id"))


@query("SELECT 'S' || c_custkey AS code, DATE '2024-01-05' AS report_date FROM customer WHERE c_custkey % 4 = 0")
def earnings_calendar(s, sf):
    k = F.col("c_custkey")
    day = F.when(k % 4 == 0, F.lit("2024-01-05")).when(k % 4 == 1, F.lit("2024")).otherwise(F.lit("0000-00-00"))
    code = F.when(k % 4 == 3, F.lit("")).otherwise(F.concat(F.lit("S"), k.cast("string")))
    return parsers.earnings_calendar(t(s, sf, "customer").select(js('{"type":"x","earnings":[{"code":"%s","report_date":"%s","actual":3}]}', code, day).alias("json")))


@query("SELECT 'S' || c_custkey AS symbol, '2023-12-31' AS fiscal, '2024-02-01' AS filing_date, CAST(c_custkey AS DOUBLE) AS free_cash_flow, CASE WHEN c_custkey % 2 = 0 THEN 2.5 END AS capex FROM customer WHERE c_custkey % 5 NOT IN (3, 4)")
def quarterly_cashflow(s, sf):
    k = F.col("c_custkey")
    q = js('{"2023-12-31":{"filing_date":"%s","freeCashFlow":"%s"%s}}', F.when(k % 5 == 3, F.lit("")).otherwise(F.lit("2024-02-01")), F.when(k % 5 == 4, F.lit("None")).otherwise(k.cast("string")), F.when(k % 2 == 0, F.lit(',"capitalExpenditures":2.5')).otherwise(F.lit("")))
    whole = F.when(k % 3 == 0, js('{"Financials::Cash_Flow::quarterly":%s}', q)).otherwise(js('{"Financials":{"Cash_Flow":{"quarterly":%s}}}', q))
    return parsers.quarterly_cashflow(t(s, sf, "customer").select(F.concat(F.lit("S"), k.cast("string")).alias("symbol"), whole.alias("json")))


@query("SELECT 'S' || c_custkey AS symbol, CASE WHEN c_custkey % 5 < 3 THEN CAST(c_custkey AS DOUBLE) END AS shares FROM customer WHERE c_custkey > 0")
def shares_outstanding(s, sf):
    k = F.col("c_custkey")
    v = F.when(k % 5 == 3, F.lit('"None"')).when(k % 5 == 4, F.lit("-1")).otherwise(k.cast("string"))
    whole = F.when(k % 2 == 0, js('{"SharesStats::SharesOutstanding":%s}', v)).otherwise(js('{"SharesStats":{"SharesOutstanding":%s}}', v))
    return parsers.shares_outstanding(t(s, sf, "customer").where("c_custkey > 0").select(F.concat(F.lit("S"), k.cast("string")).alias("symbol"), whole.alias("json")))


def _patents(s, sf):
    k = F.col("c_custkey")
    pub = F.when(k % 6 == 5, F.lit('{"document-id":{"doc-number":{"$":"1"}}}')).when(k % 2 == 0, F.lit('{"document-id":[{"doc-number":{"$":"1"}},{"date":{"$":"20240105"}}]}')).otherwise(F.lit('{"document-id":{"date":{"$":"20240105"}}}'))
    title = F.when(k % 4 == 0, js('{"$":" One %s ","@lang":"de"}', k)).when(k % 4 == 1, js('[{"$":"Zwei","@lang":"de"},{"$":"Two %s","@lang":"en"}]', k)).when(k % 4 == 2, js('[{"$":"","@lang":"en"},{"$":"Drei %s","@lang":"de"}]', k)).otherwise(F.lit("null"))
    cls = F.when(k % 3 == 0, F.lit('{"classification-ipcr":{"text":{"$":"H01L  25/ 07  A I"}}}')).when(k % 3 == 1, F.lit('{"classification-ipcr":[{"text":{"$":"G 06F 1"}},{"text":{"$":"H01L 2"}},{"text":{"$":"G06F 9"}}]}')).otherwise(F.lit("null"))
    ed = js('{"@country":"EP","@doc-number":"%s","@kind":"A1","bibliographic-data":{"publication-reference":%s,"application-reference":{"document-id":{"date":{"$":"20220301"}}},"invention-title":%s,"classifications-ipcr":%s}}', k, pub, title, cls)
    body = F.when(k % 2 == 0, ed).otherwise(F.concat(F.lit("["), ed, F.lit("]")))
    return t(s, sf, "customer").select("c_custkey", js('{"ops:world-patent-data":{"exchange-documents":{"exchange-document":%s}}}', body).alias("json"))


PATENTS = "pat AS (SELECT c_custkey, 'EP' || c_custkey || 'A1' AS patent_id, CASE c_custkey % 4 WHEN 0 THEN 'One ' || c_custkey WHEN 1 THEN 'Two ' || c_custkey WHEN 2 THEN 'Drei ' || c_custkey ELSE '' END AS title, CASE c_custkey % 3 WHEN 0 THEN 'H01L' WHEN 1 THEN 'G06F H01L' ELSE '' END AS classes, '2022-03-01' AS t_event, CASE WHEN c_custkey % 6 = 5 THEN '' ELSE '2024-01-05' END AS t_disclosed FROM customer)"


@query(f"WITH {PATENTS} SELECT patent_id, title, classes, substring(classes, 1, 4) AS main_class, t_event, t_disclosed FROM pat")
def patent_records(s, sf):
    return parsers.patent_records(_patents(s, sf)).select("patent_id", "title", F.array_join("classes", " ").alias("classes"), "main_class", "t_event", "t_disclosed")


@query(f"WITH {PATENTS} SELECT patent_id AS fact_id, title AS subject, t_event, CASE WHEN t_disclosed = '' THEN '2024-03-01' ELSE t_disclosed END AS t_disclosed FROM pat")
def patent_facts(s, sf):
    return parsers.patent_facts(parsers.patent_records(_patents(s, sf)), "2024-03-01").select("fact_id", "subject", "t_event", "t_disclosed")


def _abstracts(s, sf):
    k = F.col("c_custkey")
    one = F.when(k % 3 == 0, F.lit('{"@lang":"en","p":{"$":" E "}}')).when(k % 3 == 1, F.lit('[{"@lang":"de","p":{"$":"D"}},{"@lang":"en","p":[{"$":"E1 "},{"$":"E2"}]}]')).otherwise(F.lit("null"))
    first = js('{"@country":"EP","@doc-number":"%s","@kind":"A1","abstract":%s}', k, one)
    other = js('{"@country":"EP","@doc-number":"%s","@kind":"B1","abstract":{"@lang":"fr","p":{"$":"F"}}}', k)
    body = F.when(k % 2 == 0, F.concat(F.lit("["), first, F.lit(","), other, F.lit("]"))).otherwise(first)
    return t(s, sf, "customer").select("c_custkey", F.when(k % 11 == 0, F.lit("{}")).otherwise(js('{"ops:world-patent-data":{"exchange-documents":{"exchange-document":%s}}}', body)).alias("json"))


ABSTRACTS = "abs AS (SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN '' WHEN c_custkey % 3 = 2 AND c_custkey % 2 = 0 THEN 'EP' || c_custkey || 'B1' ELSE 'EP' || c_custkey || 'A1' END AS patent_id, CASE WHEN c_custkey % 11 = 0 THEN '' WHEN c_custkey % 3 = 0 THEN 'E' WHEN c_custkey % 3 = 1 THEN 'E1 E2' WHEN c_custkey % 2 = 0 THEN 'F' ELSE '' END AS abstract FROM customer)"


@query(f"WITH {ABSTRACTS} SELECT * FROM abs")
def patent_abstracts(s, sf):
    return parsers.patent_abstracts(_abstracts(s, sf), "c_custkey")


@query(f"WITH {PATENTS}, {ABSTRACTS} SELECT title, concat_ws(' ', title, NULLIF(abstract, ''), NULLIF(classes, '')) AS text, patent_id AS url, t_disclosed AS published_at FROM pat LEFT JOIN abs USING (patent_id) WHERE title <> '' AND t_disclosed <> ''")
def patent_documents(s, sf):
    a = parsers.patent_abstracts(_abstracts(s, sf), "c_custkey").where("patent_id <> ''")
    return parsers.patent_documents(parsers.patent_records(_patents(s, sf)), a).select("title", "text", "url", "published_at")


@query("SELECT 'EP.' || c_custkey || CASE c_custkey % 3 WHEN 0 THEN '.A1' WHEN 1 THEN '' ELSE '.B2' END AS ref FROM customer WHERE c_custkey % 5 <> 0")
def search_references(s, sf):
    k = F.col("c_custkey")
    kind = F.when(k % 3 == 0, F.lit(',"kind":{"$":"A1"}')).when(k % 3 == 2, F.lit(',"kind":{"$":"B2"}')).otherwise(F.lit(""))
    did = js('{"@document-id-type":"docdb","country":{"$":"EP"},"doc-number":{"$":"%s"}%s}', F.when(k % 5 == 0, F.lit("")).otherwise(k.cast("string")), kind)
    ids = F.when(k % 2 == 0, did).otherwise(F.concat(F.lit('[{"@document-id-type":"epodoc","country":{"$":"XX"},"doc-number":{"$":"0"}},'), did, F.lit("]")))
    j = js('{"ops:world-patent-data":{"ops:biblio-search":{"@total-result-count":"1","ops:search-result":{"ops:publication-reference":{"document-id":%s}}}}}', ids)
    return parsers.search_references(t(s, sf, "customer").select(j.alias("json"))).select("ref")


@query("SELECT c_custkey, c_custkey % 7 AS n FROM customer")
def search_counts(s, sf):
    k = F.col("c_custkey") % 7
    count = F.when(k % 2 == 0, js('"%s"', k)).otherwise(k.cast("string"))
    c = t(s, sf, "customer").select("c_custkey", js('{"ops:world-patent-data":{"ops:biblio-search":{"@total-result-count":%s}}}', count).alias("json"))
    return c.select("c_custkey", parsers.search_count(F.col("json")).alias("n"))


def _feed(s, sf):
    k = F.col("c_custkey")
    return t(s, sf, "customer").select(js("<feed><entry><id>u%s</id><title>  %s\n x</title><summary>s  %s</summary><published>%s</published></entry></feed>", k, F.when(k % 4 == 0, F.lit("")).otherwise(F.col("c_name")), F.col("c_mktsegment"), F.when(k % 3 == 0, F.lit("")).otherwise(F.lit("2024-01-05T10"))).alias("xml"))


@query("SELECT CASE WHEN c_custkey % 4 = 0 THEN 'x' ELSE c_name || ' x' END AS title, 's ' || c_mktsegment AS text, 'u' || c_custkey AS url, '2024-01-05' AS published_at FROM customer WHERE c_custkey % 3 <> 0")
def feed_documents(s, sf):
    return parsers.atom_documents(_feed(s, sf)).select("title", "text", "url", "published_at")


@query("SELECT CASE WHEN c_custkey % 4 = 0 THEN 'x' ELSE c_name || ' x' END || '. s ' || c_mktsegment AS text, CASE WHEN c_custkey % 3 = 0 THEN '2024-03-01' ELSE '2024-01-05' END AS date, 'arxiv0' AS fact_id FROM customer")
def feed_facts(s, sf):
    return parsers.atom_facts(_feed(s, sf), "2024-03-01").select("text", "date", "fact_id")


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_name || '.US' END AS id FROM customer")
def symbol_ids(s, sf):
    return t(s, sf, "customer").select("c_custkey", parsers.symbol_id(F.col("c_name"), F.when(F.col("c_custkey") % 3 != 0, F.lit("US"))).alias("id"))


@query("SELECT vec_id AS id, round((CAST(embedding[1] AS DOUBLE) + CAST(embedding[2] AS DOUBLE)) / 2, 9) AS first, round((CAST(embedding[2] AS DOUBLE) + CAST(embedding[1] AS DOUBLE)) / 2, 9) AS second FROM embeddings")
def mean_vectors(s, sf):
    a, b = F.col("embedding")[0].cast("double"), F.col("embedding")[1].cast("double")
    m = t(s, sf, "embeddings").select(F.col("vec_id").alias("id"), near_dup.mean_vector(F.array(F.array(a, b), F.array(b, a))).alias("v"))
    return m.select("id", F.round(F.col("v")[0], 9).alias("first"), F.round(F.col("v")[1], 9).alias("second"))


# --- completing documents, done markers, marking -----------------------------------------------------------


def _stubs(s, sf):
    k = F.col("doc_id")
    return t(s, sf, "documents").select(k.alias("id"), F.when(k % 4 == 0, F.lit("epo")).when(k % 4 == 1, F.lit("patent")).otherwise(F.lit("paper")).alias("source_type"), F.when(k % 5 == 0, F.lit("bad")).otherwise(F.concat(F.lit("EP"), k.cast("string"), F.lit("A1"))).alias("url"), F.when(k % 3 == 0, F.repeat(F.lit("x"), 200)).when(k % 3 == 1, F.lit(" stub ")).alias("text"))


OPEN = "open AS (SELECT doc_id AS id, CASE WHEN doc_id % 3 = 1 THEN 'stub' ELSE '' END AS text FROM documents WHERE doc_id % 4 IN (0, 1) AND doc_id % 3 <> 0 AND doc_id % 8 <> 0)"


@query(f"WITH {OPEN} SELECT id FROM open")
def backfill_open(s, sf):
    done = t(s, sf, "documents").where("doc_id % 8 = 0").select("doc_id")
    return build.to_complete(_stubs(s, sf), done).select("id")


@query(f"WITH {OPEN} SELECT id AS doc_id, id % 5 <> 0 AND id % 7 <> 0 AS has_abstract, CASE WHEN id % 5 <> 0 AND id % 7 <> 0 THEN trim(text || ' abstract ' || id) END AS text FROM open WHERE id % 5 = 0 OR id % 11 <> 0")
def backfill_completed(s, sf):
    k = F.col("doc_id")
    done = t(s, sf, "documents").where("doc_id % 8 = 0").select("doc_id")
    answers = t(s, sf, "documents").select(F.concat(F.lit("EP."), k.cast("string"), F.lit(".A1")).alias("ref"), F.when(k % 7 != 0, F.concat(F.lit("abstract "), k.cast("string"))).alias("abstract"), F.when(k % 11 == 0, F.lit("RuntimeError: 429")).alias("error"))
    new, marks = build.complete_texts(build.to_complete(_stubs(s, sf), done), answers)
    return marks.join(new.withColumnRenamed("id", "doc_id"), "doc_id", "left")


@query("SELECT doc_id AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def pending_items(s, sf):
    return ev.pending(t(s, sf, "documents").select(F.col("doc_id").alias("id")), t(s, sf, "labels").select(F.col("doc_id").alias("id")))


@query(f"WITH {DOCS} SELECT id, substring(CASE WHEN title = '' THEN text ELSE title || '. ' || text END, 1, 2000) AS text FROM (SELECT id, regexp_replace(title, '^\\s+|\\s+$', '', 'g') AS title, CASE WHEN id % 5 = 0 THEN '' ELSE regexp_replace(text, '^\\s+|\\s+$', '', 'g') END AS text FROM docs WHERE dup_of IS NULL)")
def documents_whole(s, sf):
    d = docs(s, sf).withColumn("text", F.when(F.col("id") % 5 != 0, F.col("text")))
    return collect.documents_read(d).select("id", "text")


@query("SELECT CAST(user_id AS VARCHAR) AS symbol, arg_max(event_id, (event_id % 3, event_id)) AS event_id, arg_max(value, (event_id % 3, event_id)) AS value FROM events GROUP BY 1")
def compacted_log(s, sf):
    from .durable import new_dir
    from .plans.keyed import KeyedLog

    log = KeyedLog(s, new_dir(s, "keyed"), "symbol", file_rows=200)
    e = t(s, sf, "events")
    for k in range(3):  # three batches of upserts, the first two folded into the level, the last read from the log
        log.append(e.where(F.col("event_id") % 3 == k).select(F.col("user_id").cast("string").alias("symbol"), "event_id", "value").repartitionByRange(4, "event_id").sortWithinPartitions("event_id"))
        if k < 2:
            log.compact()
    return log.lookup().select("symbol", "event_id", "value")
