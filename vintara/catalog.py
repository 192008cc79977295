"""The queries of the engine over the test tables, and their SQL.

Bindings: bars from lineitem and part, observations from orders, vintaged sensor series from
events, documents from documents and labels, facts from conversations, vectors from embeddings.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.scalar import canonical_entity, content_hash, cosine, iso_day, matches_prefix, patent_ref, source_rung
from .operators import collect, contracts, market, near_dup, recording, temporal
from .streaming import events as ev

CUT = "1998-06-30"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function as a query under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- bindings -----------------------------------------------------------------------------------------------


def bars(s, sf, where=None):
    li = t(s, sf, "lineitem")
    if where is not None:
        li = li.where(where)
    return li.groupBy(F.col("l_partkey").alias("symbol"), F.to_date("l_shipdate").alias("datum")).agg(F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("close"), F.max(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("adjusted_close"), F.sum("l_quantity").alias("volume"), F.max("l_shipdate").alias("t_ingest"))


BARS = "bars AS (SELECT l_partkey AS symbol, CAST(l_shipdate AS DATE) AS datum, MIN(l_extendedprice) AS low, MAX(l_extendedprice) AS close, MAX(l_extendedprice * (1 - l_discount)) AS adjusted_close, SUM(l_quantity) AS volume, MAX(l_shipdate) AS t_ingest FROM lineitem GROUP BY 1, 2)"


def meta(s, sf):
    return t(s, sf, "part").where("p_partkey % 11 <> 0").select(F.col("p_partkey").alias("symbol"), F.col("p_brand").alias("category"), F.col("p_type").alias("sector"))


META = "meta AS (SELECT p_partkey AS symbol, p_brand AS category, p_type AS sector FROM part WHERE p_partkey % 11 <> 0)"


def observations(s, sf):
    d = F.to_date("o_orderdate")
    return t(s, sf, "orders").select("o_orderkey", d.alias("t_event"), F.date_add(d, (F.col("o_orderkey") % 30).cast("int")).alias("t_disclosed"), F.date_add(d, (F.col("o_orderkey") % 45).cast("int")).alias("t_ingest"))


OBS = "obs AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS t_event, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 AS INTEGER) AS t_disclosed, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 45 AS INTEGER) AS t_ingest FROM orders)"


def sensor(s, sf):
    d = F.to_date("ts")
    return t(s, sf, "events").select(F.col("event_type").alias("source"), F.col("user_id").alias("entity"), d.alias("datum"), F.date_add(d, (F.col("event_id") % 5).cast("int")).alias("t_disclosed"), "event_id", F.col("value").alias("v"), "props")


SENSOR = "sensor AS (SELECT event_type AS source, user_id AS entity, CAST(ts AS DATE) AS datum, CAST(ts AS DATE) + CAST(event_id % 5 AS INTEGER) AS t_disclosed, event_id, value AS v, props FROM events)"


def docs(s, sf):
    d, lab = t(s, sf, "documents"), t(s, sf, "labels")
    rung = F.element_at(F.array(*[F.lit(x) for x in ("arxiv", " EPO ", "Form_D", "rss")]), (F.regexp_extract("source", r"(\d+)", 1).cast("int") % 4 + 1))
    return d.join(lab, "doc_id", "left").select(F.col("doc_id").alias("id"), rung.alias("source_type"), F.substring("text", 1, 40).alias("title"), "text", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 365).cast("int")).alias("published_at"), F.col("quality").cast("double").alias("relevance"), F.when(F.col("doc_id") % 13 == 5, F.col("doc_id") - 1).alias("dup_of"))


DOCS = "docs AS (SELECT doc_id AS id, list_extract(['arxiv', ' EPO ', 'Form_D', 'rss'], CAST(regexp_extract(source, '(\\d+)', 1) AS INTEGER) % 4 + 1) AS source_type, substring(text, 1, 40) AS title, text, DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER) AS published_at, CAST(quality AS DOUBLE) AS relevance, CASE WHEN doc_id % 13 = 5 THEN doc_id - 1 END AS dup_of FROM documents LEFT JOIN labels USING (doc_id))"
RUNG = "CASE lower(trim(source_type)) WHEN 'arxiv' THEN 'paper' WHEN 'epo' THEN 'patent' WHEN 'form_d' THEN 'funding' ELSE 'news' END"


def facts(s, sf):
    c = t(s, sf, "conversations")
    p = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("conv_id") % 365).cast("int"))
    return c.select((F.col("conv_id") * 100 + F.col("turn")).alias("id"), F.when(F.col("turn") % 5 != 4, F.col("conv_id")).alias("doc_id"), F.concat_ws(" ", "role", F.lit("Holdings Inc.")).alias("subject"), F.substring("text", 1, 20).alias("object"), F.when(F.col("turn") % 2 == 0, "ist").otherwise("0.7").alias("mode"), p.alias("published_at"), F.when(F.col("turn") % 7 != 6, F.date_add(p, (F.col("turn") % 9).cast("int"))).alias("ingested_at"))


FACTS = "facts AS (SELECT conv_id * 100 + turn AS id, CASE WHEN turn % 5 <> 4 THEN conv_id END AS doc_id, role AS subject, substring(text, 1, 20) AS object, CASE WHEN turn % 2 = 0 THEN 'ist' END AS mode, DATE '2024-01-01' + CAST(conv_id % 365 AS INTEGER) AS published_at, CASE WHEN turn % 7 <> 6 THEN DATE '2024-01-01' + CAST(conv_id % 365 AS INTEGER) + CAST(turn % 9 AS INTEGER) END AS ingested_at FROM conversations)"


def exclusions(s, sf):
    c = t(s, sf, "conversations").where("(conv_id * 31 + turn) % 17 = 0")
    return c.select((F.col("conv_id") * 100 + F.col("turn")).alias("fact_id"), (F.col("turn") % 3 != 0).alias("active"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("conv_id") % 200).cast("int")).alias("t_disclosed"))


EXCL = "excl AS (SELECT conv_id * 100 + turn AS fact_id, turn % 3 <> 0 AS active, DATE '2024-01-01' + CAST(conv_id % 200 AS INTEGER) AS t_disclosed FROM conversations WHERE (conv_id * 31 + turn) % 17 = 0)"


def vectors(s, sf):
    return t(s, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("block"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("vec_id") % 365).cast("int")).alias("day"), F.col("embedding").alias("vec"))


# --- as-of and vintages -------------------------------------------------------------------------------------


@query(f"WITH {BARS} SELECT symbol, MAX(datum) AS datum, arg_max(close, datum) AS value FROM bars WHERE datum <= DATE '{CUT}' GROUP BY symbol")
def asof_cross_section(s, sf):
    return market.cross_section(bars(s, sf), CUT)


@query(f"WITH {BARS}, x AS (SELECT symbol, MAX(datum) AS datum, arg_max(close, datum) AS value FROM bars WHERE datum <= DATE '{CUT}' GROUP BY symbol) SELECT * FROM x WHERE datum >= DATE '{CUT}' - 90")
def asof_cross_section_stale(s, sf):
    return market.cross_section(bars(s, sf), CUT, max_stale_days=90)


def _by(level):
    return f"WITH {BARS}, {META}, x AS (SELECT symbol, MAX(datum) AS datum, arg_max(close, datum) AS value FROM bars WHERE datum <= DATE '{CUT}' GROUP BY symbol) SELECT {level} AS grp, COUNT(*) AS n, round(AVG(value), 4) AS mean_value FROM x LEFT JOIN meta USING (symbol) WHERE datum >= DATE '{CUT}' - 90 GROUP BY 1"


def _grouped(s, sf, level):
    x = market.cross_section_by(market.cross_section(bars(s, sf), CUT, max_stale_days=90), meta(s, sf), level)
    return x.groupBy("grp").agg(F.count("*").alias("n"), F.round(F.avg("value"), 4).alias("mean_value"))


@query(_by("category"))
def asof_cross_section_by_category(s, sf):
    return _grouped(s, sf, "category")


@query(_by("sector"))
def asof_cross_section_by_sector(s, sf):
    return _grouped(s, sf, "sector")


@query(f"WITH {BARS}, b AS (SELECT symbol, datum, CASE WHEN symbol % 3 <> 0 OR volume > 25 THEN close END AS close FROM bars) SELECT symbol, MAX(datum) AS datum, arg_max(close, datum) AS value FROM b WHERE datum <= DATE '{CUT}' AND close IS NOT NULL GROUP BY symbol")
def asof_price_last_non_null(s, sf):
    b = bars(s, sf).withColumn("close", F.when((F.col("symbol") % 3 != 0) | (F.col("volume") > 25), F.col("close")))
    return market.price_as_of(b, CUT)


@query(f"WITH {BARS} SELECT symbol, datum, close, volume FROM bars WHERE datum BETWEEN DATE '1998-01-01' AND DATE '1998-03-31'")
def bar_window(s, sf):
    return market.bar_window(bars(s, sf), "1998-01-01", "1998-03-31").select("symbol", "datum", "close", "volume")


def _vint(cond):
    return f"WITH {SENSOR} SELECT source, entity, datum, t_disclosed, v FROM sensor {cond} QUALIFY row_number() OVER (PARTITION BY source, entity, datum ORDER BY t_disclosed DESC, event_id DESC) = 1"


def _vintage(s, sf, **k):
    return temporal.latest_vintage(sensor(s, sf), ["source", "entity", "datum"], "t_disclosed", ["v"], tie="event_id", **k)


@query(_vint(""))
def vintage_latest(s, sf):
    return _vintage(s, sf)


@query(_vint("WHERE t_disclosed <= DATE '2024-01-15'"))
def vintage_asof_inclusive(s, sf):
    return _vintage(s, sf, cutoff="2024-01-15")


@query(_vint("WHERE t_disclosed < DATE '2024-01-15'"))
def vintage_asof_exclusive(s, sf):
    return _vintage(s, sf, cutoff="2024-01-15", inclusive=False)


@query(f"WITH {SENSOR} SELECT source, entity, datum, COUNT(*) AS n, MIN(t_disclosed) AS first_disclosed, MAX(t_disclosed) AS last_disclosed FROM sensor GROUP BY ALL HAVING COUNT(*) > 1")
def restatement_history(s, sf):
    return sensor(s, sf).groupBy("source", "entity", "datum").agg(F.count("*").alias("n"), F.min("t_disclosed").alias("first_disclosed"), F.max("t_disclosed").alias("last_disclosed")).where("n > 1")


for _mode, _cond in (("information", "t_disclosed <= DATE '1997-06-30'"), ("operational", "t_ingest < DATE '1997-06-30'"), ("strict", "t_disclosed <= DATE '1997-06-30' AND t_ingest <= DATE '1997-06-30'")):
    QUERIES[f"asof_{_mode}"] = lambda s, sf, m=_mode: temporal.as_of(observations(s, sf), "1997-06-30", m)
    ORACLE_SQL[f"asof_{_mode}"] = f"WITH {OBS} SELECT * FROM obs WHERE {_cond}"


@query("SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '1997-06-30' AND CASE WHEN o_orderkey % 5 = 0 THEN DATE '9999-12-31' ELSE CAST(o_orderdate AS DATE) + 90 END > DATE '1997-06-30'")
def valid_at(s, sf):
    d = F.to_date("o_orderdate")
    o = t(s, sf, "orders").select("o_orderkey", d.alias("t_valid_from"), F.when(F.col("o_orderkey") % 5 == 0, F.lit(temporal.OPEN_END).cast("date")).otherwise(F.date_add(d, 90)).alias("t_valid_to"))
    return temporal.valid_at(o, "1997-06-30").select("o_orderkey")


# --- returns, turnover, coverage ----------------------------------------------------------------------------

RETURNS = f"{BARS}, ret AS (SELECT symbol, arg_max(adjusted_close, datum) / arg_min(adjusted_close, datum) - 1 AS ret FROM bars WHERE adjusted_close IS NOT NULL GROUP BY symbol HAVING COUNT(*) >= 2 AND arg_min(adjusted_close, datum) <> 0)"


@query(f"WITH {RETURNS} SELECT symbol, round(ret, 8) AS ret FROM ret")
def return_total(s, sf):
    return market.total_return(bars(s, sf)).select("symbol", F.round("ret", 8).alias("ret"))


@query(f"WITH {RETURNS}, {META} SELECT COALESCE(category, CAST(symbol AS VARCHAR)) AS category, round(AVG(ret), 8) AS ret, bool_or(symbol % 7 = 0) AS delisted, COUNT(*) AS n FROM ret LEFT JOIN meta USING (symbol) GROUP BY 1")
def return_by_category(s, sf):
    uni = t(s, sf, "part").select(F.col("p_partkey").alias("symbol"), (F.col("p_partkey") % 7 == 0).alias("delisted")).join(meta(s, sf), "symbol", "left").select("symbol", "category", "delisted")
    return market.category_return(market.total_return(bars(s, sf)), uni).withColumn("ret", F.round("ret", 8))


@query(f"WITH {BARS}, v AS (SELECT symbol, AVG(volume) AS v FROM bars WHERE datum BETWEEN DATE '{CUT}' - 90 AND DATE '{CUT}' GROUP BY symbol) SELECT symbol, round(v / p_size, 8) AS turnover FROM v JOIN part ON p_partkey = symbol WHERE p_size > 0")
def turnover_90d(s, sf):
    shares = t(s, sf, "part").select(F.col("p_partkey").alias("symbol"), F.col("p_size").alias("shares"))
    return market.turnover(bars(s, sf), shares, CUT).withColumn("turnover", F.round("turnover", 8))


QUARTERS = "q AS (SELECT o_custkey AS cust, date_trunc('quarter', CAST(o_orderdate AS DATE))::DATE AS fiscal, MAX(CAST(o_orderdate AS DATE)) AS filed, SUM(o_totalprice) AS amount FROM orders GROUP BY 1, 2)"
WINDOW4 = f"WITH {QUARTERS}, r AS (SELECT *, row_number() OVER (PARTITION BY cust ORDER BY fiscal DESC) AS rn, date_diff('day', fiscal, lag(fiscal) OVER (PARTITION BY cust ORDER BY fiscal DESC)) AS gap FROM q WHERE filed <= DATE '1998-06-30'), l AS (SELECT * FROM r WHERE rn <= 4), ok AS (SELECT cust FROM l GROUP BY cust HAVING COUNT(*) = 4 AND bool_and(rn = 1 OR gap BETWEEN 60 AND 130))"


def quarters(s, sf):
    d = F.to_date("o_orderdate")
    return t(s, sf, "orders").groupBy(F.col("o_custkey").alias("cust"), F.trunc(d, "quarter").alias("fiscal")).agg(F.max(d).alias("filed"), F.sum("o_totalprice").alias("amount"))


@query(f"{WINDOW4} SELECT cust, fiscal, filed, rn FROM l SEMI JOIN ok USING (cust)")
def pit_quarter_window(s, sf):
    return market.quarter_window(quarters(s, sf), CUT, "cust").select("cust", "fiscal", "filed", F.col("rn").cast("long").alias("rn"))


@query(f"{WINDOW4} SELECT cust, CASE WHEN bool_or(cust % 10 = 0 AND rn = 2) THEN NULL ELSE round(SUM(amount), 2) END AS total FROM l SEMI JOIN ok USING (cust) GROUP BY cust")
def ttm_sum(s, sf):
    w = market.quarter_window(quarters(s, sf), CUT, "cust").withColumn("amount", F.when((F.col("cust") % 10 == 0) & (F.col("rn") == 2), F.lit("None")).otherwise(F.col("amount").cast("string")))
    return market.strict_sum(w, "cust", "amount", "total").withColumn("total", F.round("total", 2))


COVER = f"WITH {BARS}, {META}, f AS (SELECT DISTINCT ps AS symbol FROM (SELECT p_partkey AS ps FROM part WHERE p_partkey % 4 = 0)), m AS (SELECT symbol, CASE WHEN symbol % 5 = 0 THEN NULL ELSE category END AS category FROM meta), k AS (SELECT symbol FROM bars UNION SELECT symbol FROM f UNION SELECT symbol FROM m), c AS (SELECT k.symbol, b.last_date, f.symbol IS NOT NULL AS has_fundamentals, m.category FROM k LEFT JOIN (SELECT symbol, MAX(datum) AS last_date FROM bars GROUP BY 1) b USING (symbol) LEFT JOIN f USING (symbol) LEFT JOIN m USING (symbol))"


def _coverage(s, sf):
    fund = t(s, sf, "part").where("p_partkey % 4 = 0").select(F.col("p_partkey").alias("symbol"))
    return market.coverage(bars(s, sf), fund, meta(s, sf).withColumn("category", F.when(F.col("symbol") % 5 == 0, F.lit("  ")).otherwise(F.col("category"))))


@query(f"{COVER} SELECT * FROM c")
def coverage_rows(s, sf):
    return _coverage(s, sf)


@query(f"{COVER}, n AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (last_date IS NOT NULL AND has_fundamentals AND category IS NOT NULL) AS n_complete, COUNT(last_date) AS n_prices, COUNT(*) FILTER (has_fundamentals) AS n_fundamentals, COUNT(category) AS n_category FROM c) SELECT *, round(100.0 * n_complete / n, 1)::DOUBLE AS percent FROM n")
def coverage_summary(s, sf):
    return market.coverage_summary(_coverage(s, sf))


@query(f"{COVER}, h AS (SELECT * FROM c ORDER BY symbol LIMIT 150), n AS (SELECT COUNT(*) AS n, COUNT(last_date) AS n_prices, COUNT(*) FILTER (has_fundamentals) AS n_fundamentals, COUNT(category) AS n_category FROM c), w AS (SELECT COUNT(*) AS n_counted, COUNT(*) FILTER (last_date IS NOT NULL AND has_fundamentals AND category IS NOT NULL) AS n_complete FROM h) SELECT n.*, w.*, round(100.0 * n_complete / n_counted, 1)::DOUBLE AS percent FROM n, w")
def coverage_first_rows(s, sf):
    return market.coverage_summary(_coverage(s, sf), 150)


@query(f"WITH {BARS} SELECT MAX(datum) AS last_date, MAX(t_ingest) AS last_ingest FROM bars")
def freshness(s, sf):
    return market.freshness(bars(s, sf))


@query(f"WITH {BARS}, {META} SELECT (SELECT COUNT(DISTINCT symbol) FROM bars) AS n_symbols, (SELECT COUNT(*) FROM part WHERE p_partkey % 4 = 0) AS n_fundamentals, (SELECT COUNT(*) FROM meta) AS n_meta")
def inventory(s, sf):
    return market.inventory(t(s, sf, "lineitem").select(F.col("l_partkey").alias("symbol")), t(s, sf, "part").where("p_partkey % 4 = 0"), meta(s, sf))


@query("WITH a AS (SELECT p_partkey // 2 AS k, p_partkey AS seq, p_name FROM part WHERE p_partkey % 7 <> 0), d AS (SELECT p_partkey // 2 AS k, p_partkey AS seq, p_name FROM part WHERE p_partkey % 7 = 0), u AS (SELECT *, false AS delisted, 0 AS o, -seq AS p FROM a UNION ALL SELECT *, true, 1, seq FROM d) SELECT k, seq, p_name, delisted FROM u QUALIFY row_number() OVER (PARTITION BY k ORDER BY o, p) = 1")
def universe_priority_union(s, sf):
    p = t(s, sf, "part").select(F.floor(F.col("p_partkey") / 2).alias("k"), F.col("p_partkey").alias("seq"), "p_name")
    return market.priority_union(p.where("seq % 7 <> 0"), p.where("seq % 7 = 0"), "k", "seq")


@query("WITH w AS (SELECT CAST(range AS DATE) AS since, CAST(range AS DATE) + 14 AS until FROM range(DATE '2024-01-01', DATE '2024-02-01', INTERVAL 7 DAY)), c AS (SELECT DISTINCT event_type AS cls FROM events) SELECT c.cls, w.since, w.until, COUNT(e.event_id) AS n FROM w CROSS JOIN c LEFT JOIN events e ON e.event_type = c.cls AND CAST(e.ts AS DATE) >= w.since AND CAST(e.ts AS DATE) < w.until WHERE w.until <= DATE '2024-01-31' GROUP BY ALL")
def window_counts(s, sf):
    w = s.createDataFrame([(f"2024-01-{d:02d}",) for d in (1, 8, 15, 22, 29)], "since string").select(F.col("since").cast("date").alias("since")).withColumn("until", F.date_add("since", 14))
    e = t(s, sf, "events").select(F.col("event_type").alias("cls"), F.to_date("ts").alias("datum"))
    return market.window_counts(e, w, e.select("cls").distinct(), "2024-01-31")


@query("SELECT p_partkey, p_brand FROM part WHERE p_brand LIKE 'Brand#1%' OR p_brand LIKE 'Brand#3%'")
def prefix_filter(s, sf):
    return t(s, sf, "part").where(matches_prefix(F.col("p_brand"), ["Brand#1", "Brand#3"])).select("p_partkey", "p_brand")


@query("WITH p AS (SELECT c_nationkey AS a, c_mktsegment AS b, 'pair-' || c_nationkey || c_mktsegment AS cat FROM customer WHERE c_nationkey < 10 GROUP BY ALL), g AS (SELECT c_mktsegment AS b, 'one-' || c_mktsegment AS cat FROM customer WHERE c_mktsegment < 'F' GROUP BY ALL) SELECT c_custkey, COALESCE(p.cat, g.cat) AS cat FROM customer LEFT JOIN p ON p.a = c_nationkey AND p.b = c_mktsegment LEFT JOIN g ON g.b = c_mktsegment WHERE COALESCE(p.cat, g.cat) IS NOT NULL")
def fallback_lookup(s, sf):
    c = t(s, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("a"), F.col("c_mktsegment").alias("b"))
    pairs = c.where("a < 10").select("a", "b").distinct().withColumn("cat", F.concat(F.lit("pair-"), F.col("a").cast("string"), "b"))
    singles = c.where("b < 'F'").select("b").distinct().withColumn("cat", F.concat(F.lit("one-"), "b"))
    return market.fallback_lookup(c, pairs, singles, "a", "b", "cat").select("c_custkey", "cat")


# --- documents, facts, exclusions, capital, themes ----------------------------------------------------------

ASOF_FACTS = f"WITH {FACTS}, {DOCS}, {EXCL} SELECT id, doc_id, subject, mode, published_at FROM facts f WHERE ingested_at < DATE '2024-06-30' AND published_at >= DATE '2024-01-10' AND NOT EXISTS (SELECT 1 FROM docs d WHERE d.id = f.doc_id AND d.dup_of IS NOT NULL) AND NOT EXISTS (SELECT 1 FROM excl e WHERE e.fact_id = f.id AND e.active AND e.t_disclosed <= DATE '2024-06-30')"


@query(ASOF_FACTS)
def facts_asof_excluded(s, sf):
    return collect.facts_as_of(facts(s, sf), docs(s, sf), exclusions(s, sf), cutoff="2024-06-30", since="2024-01-10").select("id", "doc_id", "subject", "mode", "published_at")


@query(f"WITH {EXCL} SELECT fact_id, t_disclosed FROM excl WHERE active")
def exclusion_list(s, sf):
    return collect.exclusions_in_force(exclusions(s, sf)).select("fact_id", "t_disclosed")


@query(f"WITH {EXCL} SELECT substring(sha256(string_agg(fact_id || ':' || t_disclosed, ';' ORDER BY fact_id)), 1, 16) AS hash FROM excl WHERE active")
def exclusion_hash(s, sf):
    return collect.exclusion_hash(exclusions(s, sf))


def _top(order):
    return f"WITH {DOCS} SELECT id, published_at, substring(title || '. ' || text, 1, 2000) AS text FROM docs WHERE dup_of IS NULL ORDER BY {order} LIMIT 50"


@query(_top("published_at DESC, id DESC"))
def documents_topk_newest(s, sf):
    return collect.documents_read(docs(s, sf), limit=50, newest_first=True, strip_parts=False).select("id", "published_at", "text")


@query(_top("published_at, id"))
def documents_topk_oldest(s, sf):
    return collect.documents_read(docs(s, sf), limit=50, strip_parts=False).select("id", "published_at", "text")


@query(f"WITH {DOCS} SELECT id, relevance FROM docs WHERE dup_of IS NULL AND relevance >= 0.5")
def documents_min_relevance(s, sf):
    return collect.documents_read(docs(s, sf), min_relevance=0.5).select("id", "relevance")


@query(f"WITH {OBS} SELECT o_orderkey, COALESCE(CASE WHEN o_orderkey % 3 <> 0 THEN t_event END, t_disclosed) AS t_event, t_disclosed FROM obs WHERE t_disclosed <= DATE '1997-06-30'")
def capital_asof(s, sf):
    o = observations(s, sf).withColumn("t_event", F.when(F.col("o_orderkey") % 3 != 0, F.col("t_event")))
    return collect.capital_as_of(o, published_by="1997-06-30").select("o_orderkey", "t_event", "t_disclosed")


@query("SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1")
def upsert_last_wins(s, sf):
    return temporal.upsert_view(t(s, sf, "events").select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], "event_id", ["value"])


@query(f"WITH {DOCS}, r AS (SELECT id, {RUNG} AS source_type, dup_of FROM docs) SELECT a.id, a.source_type, CASE WHEN b.id IS NOT NULL AND a.source_type <> b.source_type THEN NULL ELSE a.dup_of END AS dup_of FROM r a LEFT JOIN r b ON b.id = a.dup_of")
def normalise_source(s, sf):
    return collect.normalise_source(docs(s, sf).select("id", "source_type", "dup_of"))


def _themes(s, sf):
    return t(s, sf, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"), (F.col("n_nationkey") % 6 == 5).alias("excluded"), F.when(F.col("n_nationkey") % 4 != 0, F.lit("2024-02-01").cast("date")).alias("created_at"), F.when(F.col("n_nationkey") % 2 == 0, F.lit("seed")).otherwise(F.lit("llm")).alias("created_by"))


def _evidence(s, sf):
    links = t(s, sf, "documents").select((F.col("doc_id") % 40).alias("theme_id"), "doc_id")
    return collect.themes_with_evidence(_themes(s, sf), links, docs(s, sf))


THEMES = "th AS (SELECT n_nationkey AS id, n_name AS name, CASE WHEN n_nationkey % 4 <> 0 THEN DATE '2024-02-01' END AS created_at, CASE WHEN n_nationkey % 2 = 0 THEN 'seed' ELSE 'llm' END AS created_by, (SELECT COUNT(*) FROM documents WHERE doc_id % 40 = n_nationkey AND doc_id % 13 <> 5) AS evidence FROM nation WHERE n_nationkey % 6 <> 5)"


@query(f"WITH {THEMES} SELECT id, name, evidence FROM th")
def theme_evidence(s, sf):
    return _evidence(s, sf).select("id", "name", "evidence")


@query(f"WITH {THEMES} SELECT id, name FROM th WHERE evidence >= 24")
def graduated_themes(s, sf):
    return _evidence(s, sf).where(collect.is_graduated(24)).select("id", "name")


KEYWORDS = "CASE n_nationkey % 5 WHEN 0 THEN 'no json' WHEN 1 THEN NULL WHEN 2 THEN '{\"a\": 1}' ELSE '[\"kw ' || n_nationkey || '\", \"\", \"  \", null, \"x\"]' END"
WORDS = "CASE WHEN n_nationkey % 5 > 2 THEN ['kw ' || n_nationkey, 'x'] ELSE CAST([] AS VARCHAR[]) END"


def _worded(s, sf):
    k = F.col("n_nationkey")
    words = F.when(k % 5 == 0, F.lit("no json")).when(k % 5 == 1, F.lit(None)).when(k % 5 == 2, F.lit('{"a": 1}')).otherwise(F.concat(F.lit('["kw '), k.cast("string"), F.lit('", "", "  ", null, "x"]')))
    keys = t(s, sf, "nation").select(k.cast("long").alias("id"), words.alias("keywords"))
    links = t(s, sf, "documents").select((F.col("doc_id") % 40).alias("theme_id"), "doc_id")
    return collect.theme_rows(_themes(s, sf).join(keys, "id"), links, docs(s, sf))


@query(f"WITH {THEMES} SELECT name, array_to_string({WORDS}, '|') AS keywords, created_by, created_at, evidence FROM th JOIN nation ON n_nationkey = id")
def theme_rows(s, sf):
    return _worded(s, sf).withColumn("keywords", F.array_join("keywords", "|"))


@query(f"WITH {THEMES} SELECT name, array_to_string(list_concat([name], {WORDS}), '|') AS anchors FROM th JOIN nation ON n_nationkey = id")
def theme_anchors(s, sf):
    return collect.anchors(_worded(s, sf)).withColumn("anchors", F.array_join("anchors", "|"))


@query(f"WITH {THEMES}, l AS (SELECT c_nationkey AS k, COUNT(*) AS labels FROM customer WHERE c_nationkey % 3 <> 1 GROUP BY 1) SELECT id, name, COALESCE(labels, 0) AS labels FROM th LEFT JOIN l ON k = id WHERE evidence >= 4 AND COALESCE(labels, 0) >= 3")
def graduated_with_labels(s, sf):
    labels = t(s, sf, "customer").where("c_nationkey % 3 <> 1").groupBy(F.col("c_nationkey").cast("long").alias("id")).agg(F.count("*").alias("labels"))
    return _evidence(s, sf).join(labels, "id", "left").where(collect.is_graduated(4, 3)).select("id", "name", F.coalesce("labels", F.lit(0)).alias("labels"))


@query(f"WITH {THEMES} SELECT name AS category_id, CASE WHEN evidence >= 5 THEN 'established' WHEN created_by = 'seed' THEN 'emerging' ELSE 'growing' END AS maturity, COALESCE(created_at, DATE '2024-06-30') AS t_valid_from, DATE '9999-12-31' AS t_valid_to, r_name AS rollup FROM th LEFT JOIN (SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_regionkey <> 2) ON n_name = name")
def category_version(s, sf):
    roll = t(s, sf, "nation").where("n_regionkey <> 2").join(t(s, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("name"), F.col("r_name").alias("rollup"))
    return collect.category_versions(_evidence(s, sf), roll, "2024-06-30").select("category_id", "maturity", "t_valid_from", "t_valid_to", "rollup")


# --- recording, contracts -----------------------------------------------------------------------------------


@query(f"WITH {DOCS} SELECT id, COALESCE(relevance, 0) >= 0.5 AS accepted, substring(sha256(title || ' ' || text), 1, 16) AS content_hash FROM docs")
def record_documents(s, sf):
    return recording.record_documents(docs(s, sf)).select("id", "accepted", "content_hash")


@query(f"WITH {FACTS}, f AS (SELECT id, subject AS subjekt, object AS objekt, mode AS modus FROM facts) SELECT id, name, value FROM f UNPIVOT (value FOR name IN (subjekt, objekt, modus))")
def attribute_unpivot(s, sf):
    f = collect.facts_as_of(facts(s, sf)).select("id", F.col("subject").alias("subjekt"), F.col("object").alias("objekt"), F.col("mode").alias("modus"))
    return recording.unpivot_attributes(f, ["id"])


@query("WITH l AS (SELECT o_custkey AS run_id, COUNT(*) AS n_found, CASE WHEN o_custkey % 50 = 0 THEN NULL ELSE COUNT(*) FILTER (o_orderkey % 2 = 0) END AS n_new FROM orders GROUP BY 1), d AS (SELECT o_custkey AS run_id, COUNT(*) AS n_decisions FROM orders WHERE o_orderkey % 97 <> 0 GROUP BY 1), w AS (SELECT o_custkey AS run_id, COUNT(*) AS n_documents FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1) SELECT run_id, n_found, n_new, COALESCE(n_decisions, 0) AS n_decisions, COALESCE(n_documents, 0) AS n_documents, n_found IS DISTINCT FROM COALESCE(n_decisions, 0) OR n_new IS DISTINCT FROM COALESCE(n_documents, 0) AS breach FROM l LEFT JOIN d USING (run_id) LEFT JOIN w USING (run_id)")
def conservation_law(s, sf):
    o = t(s, sf, "orders").select(F.col("o_custkey").alias("run_id"), "o_orderkey")
    log = o.groupBy("run_id").agg(F.count("*").alias("n_found"), F.count_if(F.col("o_orderkey") % 2 == 0).alias("n_new")).withColumn("n_new", F.when(F.col("run_id") % 50 != 0, F.col("n_new")))
    return recording.conservation(log, o.where("o_orderkey % 97 <> 0"), o.where("o_orderkey % 2 = 0"))


CONTRACT = contracts.TableContract("obs", "beobachtung", [
    contracts.Field("t_event", "time"), contracts.Field("t_disclosed", "time"), contracts.Field("t_ingest", "time"), contracts.Field("wert", "gemessen"),
    contracts.Field("status", "status"), contracts.Field("note", "text", nullable=True),
])


def _json_rows(s, sf):
    e = t(s, sf, "events")
    k = F.col("event_id")
    wert = F.when(k % 10 == 1, '"x"').when(k % 10 == 2, "null").otherwise(F.col("user_id").cast("string"))
    status = F.when(k % 6 == 1, '"vermutet"').when(k % 6 == 2, '"falsch"').when(k % 6 == 3, "3").otherwise('"erwiesen"')
    ingest = F.when(k % 9 == 4, "").otherwise(F.lit("2024-02-01"))
    extra = F.when(k % 8 == 0, ',"knoten_id":1').when(k % 8 == 1, ',"kat_id":"a"').otherwise("")
    return e.select(k.alias("row_index"), F.concat(F.lit('{"t_event":"2024-01-01","t_disclosed":"2024-01-02","t_ingest":"'), ingest, F.lit('","wert":'), wert, F.lit(',"status":'), status, extra, F.lit("}")).alias("row"))


RULES_SQL = "v AS (SELECT event_id AS row_index, 't_ingest' AS field, 'zeit-spalte-fehlt' AS rule FROM events WHERE event_id % 9 = 4 UNION ALL SELECT event_id, 'wert', 'gemessen-nicht-numerisch' FROM events WHERE event_id % 10 = 1 UNION ALL SELECT event_id, 'wert', 'pflichtfeld-fehlt-oder-null' FROM events WHERE event_id % 10 = 2 UNION ALL SELECT event_id, 'status', 'wert-nicht-im-vokabular' FROM events WHERE event_id % 6 = 2 UNION ALL SELECT event_id, 'status', 'ordinal-als-zahl' FROM events WHERE event_id % 6 = 3 UNION ALL SELECT event_id, 'knoten_id', 'verbotenes-feld' FROM events WHERE event_id % 8 = 0 UNION ALL SELECT event_id, 'version', 'id-version-paarung' FROM events WHERE event_id % 8 = 1)"


@query(f"WITH {RULES_SQL} SELECT * FROM v")
def contract_violations(s, sf):
    return contracts.validate(_json_rows(s, sf), CONTRACT)


@query(f"WITH {RULES_SQL} SELECT rule, COUNT(*) AS n FROM v GROUP BY 1")
def violation_summary(s, sf):
    return contracts.validate(_json_rows(s, sf), CONTRACT).groupBy("rule").agg(F.count("*").alias("n"))


# --- a cut-off for each row ---------------------------------------------------------------------------------

ASKS = "asks AS (SELECT o_orderkey, o_custkey AS symbol, CAST(o_orderdate AS DATE) AS cutoff FROM orders)"


def _asks(s, sf):
    return t(s, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("symbol"), F.to_date("o_orderdate").alias("cutoff"))


@query(f"WITH {BARS}, {ASKS}, b AS (SELECT symbol, datum, close AS value FROM bars WHERE close IS NOT NULL) SELECT o_orderkey, datum, value FROM asks ASOF LEFT JOIN b ON asks.symbol = b.symbol AND asks.cutoff >= b.datum")
def price_asof_each(s, sf):
    return market.price_as_of_each(_asks(s, sf), bars(s, sf)).select("o_orderkey", "datum", "value")


@query(f"WITH {ASKS}, curve AS (SELECT CAST(o_orderdate AS DATE) AS date, MAX(o_totalprice) AS rate FROM orders WHERE o_orderkey % 7 = 0 GROUP BY 1) SELECT o_orderkey, date, rate FROM asks ASOF LEFT JOIN curve ON asks.cutoff >= curve.date")
def rate_asof_each(s, sf):
    curve = t(s, sf, "orders").where("o_orderkey % 7 = 0").groupBy(F.to_date("o_orderdate").alias("date")).agg(F.create_map(F.lit("10 Yr"), F.max("o_totalprice")).alias("rates"))
    return market.rate_as_of_each(_asks(s, sf), curve).select("o_orderkey", "date", "rate")


@query(f"WITH {BARS}, {ASKS}, u AS (SELECT symbol, datum, volume, NULL AS k FROM bars UNION ALL SELECT symbol, cutoff, NULL, o_orderkey FROM asks), w AS (SELECT symbol, k, AVG(volume) OVER (PARTITION BY symbol ORDER BY datum RANGE BETWEEN INTERVAL 90 DAYS PRECEDING AND CURRENT ROW) AS v FROM u) SELECT k AS o_orderkey, round(v / CASE WHEN p_size > 0 THEN p_size END, 8) AS turnover FROM w LEFT JOIN part ON p_partkey = symbol WHERE k IS NOT NULL")
def turnover_each(s, sf):
    shares = t(s, sf, "part").select(F.col("p_partkey").alias("symbol"), F.col("p_size").alias("shares"))
    return market.turnover_each(_asks(s, sf), bars(s, sf), shares).select("o_orderkey", F.round("turnover", 8).alias("turnover"))


@query(f"WITH {BARS} SELECT symbol, datum, CAST(SUM(volume) OVER (PARTITION BY symbol ORDER BY datum) AS DOUBLE) AS total FROM bars")
def volume_running_total(s, sf):
    return temporal.running_total(bars(s, sf), ["symbol"], "datum", "volume", "total").select("symbol", "datum", "total")


# --- vectors, scalars, JSON ---------------------------------------------------------------------------------

VEC = "v AS (SELECT vec_id AS id, label AS block, DATE '2024-01-01' + CAST(vec_id % 365 AS INTEGER) AS day, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings)"
NEAR = f"WITH {VEC}, p AS (SELECT a.id, b.id AS match, list_cosine_similarity(a.vec, b.vec) AS sim FROM v a JOIN v b ON a.block = b.block AND b.id < a.id AND abs(date_diff('day', a.day, b.day)) <= 21)"


@query(f"WITH {VEC} SELECT a.id, b.id AS next, round(list_cosine_similarity(a.vec, b.vec), 8) AS sim FROM v a JOIN v b ON b.id = a.id + 1")
def cosine_pairs(s, sf):
    v = vectors(s, sf)
    return v.alias("a").join(v.select((F.col("id") - 1).alias("id"), F.col("id").alias("next"), F.col("vec").alias("w")), "id").select("id", "next", F.round(cosine(F.col("vec"), F.col("w")), 8).alias("sim"))


@query(f"{NEAR} SELECT id, arg_max(match, (round(sim, 12), match)) AS match, round(MAX(sim), 8) AS sim FROM p WHERE sim >= 0.25 GROUP BY id")
def near_dup_best_match(s, sf):
    return near_dup.best_match(vectors(s, sf), 0.25).withColumn("sim", F.round("sim", 8))


GREEDY = f"WITH RECURSIVE {VEC}, p AS (SELECT a.id, b.id AS match, round(list_cosine_similarity(a.vec, b.vec), 12) AS sim FROM v a JOIN v b ON a.block = b.block AND b.id < a.id AND abs(date_diff('day', a.day, b.day)) <= 21), near AS (SELECT * FROM p WHERE sim >= 0.25), n AS (SELECT v.id, v.block, row_number() OVER (PARTITION BY v.block ORDER BY v.id) AS rn, COALESCE((SELECT list(match) FROM near WHERE near.id = v.id), []) AS nbrs FROM v), walk AS (SELECT block, CAST(0 AS BIGINT) AS rn, CAST([] AS BIGINT[]) AS roots FROM (SELECT DISTINCT block FROM v) UNION ALL SELECT w.block, n.rn, CASE WHEN list_has_any(w.roots, n.nbrs) THEN w.roots ELSE list_append(w.roots, n.id) END FROM walk w JOIN n ON n.block = w.block AND n.rn = w.rn + 1), last AS (SELECT unnest(arg_max(roots, rn)) AS id FROM walk GROUP BY block) SELECT v.id, CASE WHEN v.id NOT IN (SELECT id FROM last) THEN (SELECT arg_max(match, (sim, match)) FROM near WHERE near.id = v.id AND match IN (SELECT id FROM last)) END AS dup_of FROM v"


@query(GREEDY)
def near_dup_greedy(s, sf):
    return near_dup.mark_greedy(vectors(s, sf), 0.25)


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_extract(s, sf):
    return t(s, sf, "events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k"))


@query("SELECT page_id, trim(regexp_replace(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '\\s+', ' ', 'g')) AS title FROM pages")
def xml_titles(s, sf):
    return t(s, sf, "pages").select("page_id", F.trim(F.regexp_replace(F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1), r"\s+", " ")).alias("title"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN 'KR.' || c_custkey || '.A1' END AS ref FROM customer")
def patent_refs(s, sf):
    k = F.col("c_custkey").cast("string")
    return t(s, sf, "customer").select("c_custkey", patent_ref(F.when(F.col("c_custkey") % 4 != 0, F.concat(F.lit("KR"), k, F.lit("A1"))).otherwise(F.concat(F.lit("bad"), k))).alias("ref"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 IN (0, 1) THEN CAST(o_orderdate AS DATE) END AS d FROM orders")
def iso_guard(s, sf):
    iso = F.date_format("o_orderdate", "yyyy-MM-dd")
    k = F.col("o_orderkey") % 4
    return t(s, sf, "orders").select("o_orderkey", iso_day(F.when(k == 0, iso).when(k == 1, F.concat(iso, F.lit("T10:00:00"))).when(k == 2, F.substring(iso, 1, 7)).otherwise(F.lit("0000-00-00"))).alias("d"))


@query("SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN c_name WHEN 1 THEN c_name WHEN 2 THEN c_name WHEN 3 THEN 'Group Inc' ELSE 'Alias' END AS entity FROM customer")
def canonical_entities(s, sf):
    n, k = F.col("c_name"), F.col("c_custkey") % 5
    raw = F.when(k == 0, F.concat(n, F.lit(" Holdings  Inc."))).when(k == 1, F.concat(F.lit("  "), n, F.lit(", LTD"))).when(k == 2, n).when(k == 3, F.lit("Group Inc")).otherwise(F.lit("tsmc corp"))
    return t(s, sf, "customer").select("c_custkey", canonical_entity(raw, F.create_map(F.lit("tsmc"), F.lit("Alias"))).alias("entity"))


@query("SELECT doc_id, substring(sha256(lang || ' ' || text), 1, 16) AS h FROM documents")
def content_hashes(s, sf):
    return t(s, sf, "documents").select("doc_id", content_hash(F.col("lang"), F.col("text")).alias("h"))


@query(f"WITH {DOCS} SELECT id, {RUNG} AS rung FROM docs")
def source_rungs(s, sf):
    return docs(s, sf).select("id", source_rung(F.col("source_type")).alias("rung"))


# --- event windows ------------------------------------------------------------------------------------------


@query("SELECT date_trunc('day', ts)::TIMESTAMP AS start, event_type, COUNT(*) AS n, round(SUM(value), 6) AS total FROM events GROUP BY 1, 2")
def event_tumbling(s, sf):
    return ev.tumbling(t(s, sf, "events")).withColumn("total", F.round("total", 6))


@query("WITH e AS (SELECT date_trunc('day', ts)::TIMESTAMP AS d FROM events) SELECT start, COUNT(*) AS n FROM (SELECT d AS start FROM e UNION ALL SELECT d - INTERVAL 1 DAY FROM e) GROUP BY 1")
def event_sliding(s, sf):
    return ev.sliding(t(s, sf, "events"))


@query("WITH e AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 1 HOUR THEN 0 ELSE 1 END AS new FROM events), g AS (SELECT *, SUM(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sess FROM e) SELECT user_id, MIN(ts) AS start, COUNT(*) AS n FROM g GROUP BY user_id, sess")
def event_session(s, sf):
    return ev.sessions(t(s, sf, "events"))
