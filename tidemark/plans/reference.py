"""A query for each operator of the point-in-time lake, and the SQL to hold it against.

Times come out as microseconds since 1970 (`us`), measures rounded, so both engines can be compared by value.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import envelope
from tidemark.functions.scalar import html_text, ratio, slug
from tidemark.lake import Lake, merge_rows
from tidemark.operators import asof, channels, graph, tasks, windows
from tidemark.plans.views import BARS, QUOTES, VINTAGES, bars, quotes, vintages
from tidemark.provenance import registry
from tidemark.session import scratch
from tidemark.sources.parsers import SOURCES, index_changes
from tidemark.tables import table

T = "2022-01-01 00:00:00"
TV = "2024-01-15 00:00:00"
TB = "1998-01-01 00:00:00"
Q: dict = {}
S: dict = {}


def us(name: str) -> Column:
    return F.unix_micros(F.col(name).cast("timestamp")).alias(name)


def r(name: str, digits: int = 4) -> Column:
    """Rounded, and never a negative zero."""
    return (F.round(F.col(name), digits) + F.lit(0.0)).alias(name)


def query(sql: str | None = None):
    """Registers a query under its function's name; $T, $TV and $TB stand for the moments above."""

    def register(f):
        name = f.__name__
        Q[name] = f
        if sql:
            S[name] = sql.replace("$TV", f"TIMESTAMP '{TV}'").replace("$TB", f"TIMESTAMP '{TB}'").replace("$T", f"TIMESTAMPTZ '{T}+00'")
        return f

    return register


# Point-in-time operators


@query("SELECT row_id, entity, epoch_us(knowledge_time) AS knowledge_time FROM insider_form4 WHERE knowledge_time <= $T")
def asof_filter(s: SparkSession, d: str) -> DataFrame:
    return asof.as_of(table(s, d, "insider_form4"), T).select("row_id", "entity", us("knowledge_time"))


@query(f"SELECT entity, epoch_us(event_time) AS event_time, round(close, 4) AS close, volume FROM {BARS} WHERE knowledge_time <= $TB")
def asof_prices(s, d):
    return asof.as_of_prices(bars(s, d), TB).select("entity", us("event_time"), r("close"), "volume")


@query(f"SELECT entity, epoch_us(event_time) AS event_time, vintage_id, round(value, 4) AS value FROM (SELECT *, row_number() OVER (PARTITION BY entity, event_time ORDER BY knowledge_time DESC, vintage_id DESC) AS rn FROM {VINTAGES} WHERE knowledge_time <= $TV) WHERE rn = 1")
def latest_vintage(s, d):
    return asof.latest_vintage(vintages(s, d), TV).select("entity", us("event_time"), "vintage_id", r("value"))


@query("SELECT entity, concept, unit, epoch_us(event_time) AS event_time, arg_max(vintage_id, (knowledge_time, vintage_id)) AS vintage_id FROM fundamentals_sec WHERE knowledge_time <= $T GROUP BY ALL")
def fundamentals_vintage(s, d):
    df = asof.latest_vintage(table(s, d, "fundamentals_sec"), T, ("entity", "concept", "unit", "event_time"))
    return df.select("entity", "concept", "unit", us("event_time"), "vintage_id")


@query(f"SELECT entity, round(value, 4) AS value FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY knowledge_time DESC, event_time DESC, vintage_id DESC) AS rn FROM {VINTAGES} WHERE knowledge_time <= $TV) WHERE rn = 1")
def latest_per_entity(s, d):
    return channels.levels(vintages(s, d), TV).select("entity", r("value"))


@query("SELECT entity, epoch_us(event_time) AS event_time, round(close, 4) AS close FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY event_time DESC,"
    " knowledge_time DESC, close DESC) AS rn FROM (SELECT DISTINCT entity, event_time, knowledge_time, close FROM features) WHERE knowledge_time <= $T) WHERE rn = 1")
def latest_by_event(s, d):
    df = table(s, d, "features").select("entity", "event_time", "knowledge_time", "close").distinct().withColumn("vintage_id", F.col("close"))
    return asof.latest_by_event(df, T).select("entity", us("event_time"), r("close"))


@query(f"SELECT entity, epoch_us(event_time) AS event_time, vintage_id, round(value, 4) AS value FROM (SELECT *, row_number() OVER (PARTITION BY entity, event_time ORDER BY knowledge_time, vintage_id) AS rn FROM {VINTAGES}) WHERE rn = 1")
def first_release(s, d):
    return asof.first_release(vintages(s, d)).select("entity", us("event_time"), "vintage_id", r("value"))


@query("SELECT url, epoch_us(knowledge_time) AS knowledge_time FROM news_gkg WHERE knowledge_time <= $T AND knowledge_time > $T - INTERVAL 14 DAY")
def trailing_window(s, d):
    return asof.trailing(table(s, d, "news_gkg"), T, 14).select("url", us("knowledge_time"))


@query(f"SELECT m.entity, epoch_us(m.ts) AS at, (SELECT round(arg_min(b.close, b.event_time), 4) FROM {BARS} b WHERE b.entity = m.entity AND b.event_time >= date_trunc('day',"
    f" m.ts)) AS close FROM (SELECT p.entity, x.ts FROM (SELECT DISTINCT o_orderpriority AS entity FROM orders) p, (SELECT TIMESTAMP '1995-06-03' + INTERVAL (i * 211) HOUR"
    f" AS ts FROM range(300) t(i)) x) m")
def forward_asof(s, d):
    b = bars(s, d)
    times = F.expr("transform(sequence(0, 299), i -> timestamp'1995-06-03' + make_dt_interval(0, i * 211))")
    moments = b.select("entity").distinct().select("entity", F.explode(times).alias("at"))
    return asof.forward_value(b, moments).select("entity", us("at"), r("close"))


@query("SELECT entity FROM (SELECT entity, arg_max(action, (event_time, knowledge_time, action)) AS a FROM security_master WHERE record_type = 'change' AND knowledge_time <= $T AND event_time <= $T GROUP BY 1) WHERE a = 'added'")
def membership_asof(s, d):
    return asof.members(table(s, d, "security_master").where("record_type = 'change'"), T)


@query(f"WITH a AS (SELECT entity, value, 0 AS p FROM {VINTAGES} WHERE event_type = 'signup'), b AS (SELECT entity, value, 1 AS p FROM {VINTAGES} WHERE event_type"
    f" = 'purchase'), u AS (SELECT * FROM a UNION ALL SELECT * FROM b) SELECT entity, round(value, 4) AS value FROM u WHERE p = (SELECT min(p) FROM u v WHERE v.entity ="
    f" u.entity)")
def source_fallback(s, d):
    v = vintages(s, d)
    return asof.fallback([v.where(F.col("event_type") == e).select("entity", "value") for e in ("signup", "purchase")], ["entity"]).select("entity", r("value"))


@query("SELECT epoch_us(g) AS cursor FROM generate_series(TIMESTAMP '2021-01-04', TIMESTAMP '2024-12-31', INTERVAL 7 DAY) t(g)")
def sim_clock(s, d):
    return asof.cursor_grid(s, "2021-01-04", "2024-12-31", "7 days").select(us("cursor"))


@query(f"WITH g AS (SELECT g AS cursor FROM generate_series(TIMESTAMP '2024-01-02', TIMESTAMP '2024-01-29', INTERVAL 1 DAY) t(g)) SELECT entity, epoch_us(cursor)"
    f" AS cursor, round(value, 4) AS value FROM (SELECT v.entity, g.cursor, v.value, row_number() OVER (PARTITION BY v.entity, g.cursor ORDER BY v.knowledge_time DESC,"
    f" v.event_time DESC, v.vintage_id DESC) AS rn FROM {VINTAGES} v JOIN g ON v.knowledge_time <= g.cursor) WHERE rn = 1")
def cursor_grid_observation(s, d):
    grid = asof.cursor_grid(s, "2024-01-02", "2024-01-29", "1 day")
    return asof.observed_on_grid(vintages(s, d), grid, ["value"]).select("entity", us("cursor"), r("value"))


# Derived features

_B = f"SELECT *, close / lag(close) OVER w - 1 AS ret_1d FROM {BARS} WINDOW w AS (PARTITION BY entity ORDER BY event_time)"


def _tech(columns: str) -> str:
    frames = ", ".join(f"w{n} AS (PARTITION BY entity ORDER BY event_time ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for n in (14, 21, 50, 200, 252))
    return f"WITH b AS ({_B}) SELECT entity, epoch_us(event_time) AS event_time, {columns} FROM b WINDOW w AS (PARTITION BY entity ORDER BY event_time), {frames}"


@query(_tech("round(ret_1d, 6) + 0.0 AS ret_1d, round(close / lag(close, 21) OVER w - 1, 6) + 0.0 AS ret_1m, round(close / lag(close, 252) OVER w - 1, 6) + 0.0 AS ret_12m"))
def tech_returns(s, d):
    return windows.technical(bars(s, d)).select("entity", us("event_time"), r("ret_1d", 6), r("ret_1m", 6), r("ret_12m", 6))


@query(_tech("round(avg(close) OVER w50, 9) AS sma50, round(avg(close) OVER w200, 9) AS sma200"))
def tech_sma(s, d):
    return windows.technical(bars(s, d)).select("entity", us("event_time"), r("sma50", 9), r("sma200", 9))


@query(_tech("round(stddev_samp(ret_1d) OVER w21 * sqrt(252), 6) AS vol_21d"))
def tech_vol(s, d):
    return windows.technical(bars(s, d)).select("entity", us("event_time"), r("vol_21d", 6))


@query(_tech("round(close / max(close) OVER w252 - 1, 6) + 0.0 AS dist_52w_high"))
def tech_drawdown(s, d):
    return windows.technical(bars(s, d)).select("entity", us("event_time"), r("dist_52w_high", 6))


_UP, _DOWN = "avg(greatest(ret_1d, 0)) OVER w14", "avg(greatest(-ret_1d, 0)) OVER w14"


@query(_tech(f"round(100 - 100 / (1 + ({_UP}) / nullif({_DOWN}, 0)), 4) AS rsi14"))
def tech_rsi(s, d):
    return windows.technical(bars(s, d)).select("entity", us("event_time"), r("rsi14"))


def _three(s, d):
    b = bars(s, d)
    one = lambda e, k: b.where(F.col("entity") == e).select("event_time", "knowledge_time", (F.col("close") / k - 2).alias("value"))
    return windows.regime(one("1-URGENT", 10_000.0), one("2-HIGH", 100_000.0), one("3-MEDIUM", 100_000.0))


_THREE = f"""WITH v AS (SELECT event_time, knowledge_time, close / 10000.0 - 2 AS vix FROM {BARS} WHERE entity = '1-URGENT'),
c AS (SELECT event_time, close / 100000.0 - 2 AS curve FROM {BARS} WHERE entity = '2-HIGH'),
h AS (SELECT event_time, close / 100000.0 - 2 AS hy FROM {BARS} WHERE entity = '3-MEDIUM'),
j AS (SELECT v.event_time, v.vix, c.curve, h.hy FROM v JOIN c USING (event_time) JOIN h USING (event_time)),
n AS (SELECT *, row_number() OVER (ORDER BY event_time) AS i FROM j),
p AS (SELECT a.i, sum(CASE WHEN b.vix < a.vix THEN 1.0 WHEN b.vix = a.vix THEN 0.5 ELSE 0 END) + 0.5 AS k, count(*) AS m FROM n a JOIN n b ON b.i BETWEEN a.i - 251 AND a.i GROUP BY a.i),
f AS (SELECT n.event_time, n.vix, n.curve, n.hy, CASE WHEN m >= 30 THEN k / m END AS pct, hy - lag(hy, 21) OVER o AS chg,
 CASE WHEN count(vix) OVER w >= 30 THEN -(vix - avg(vix) OVER w) / stddev_samp(vix) OVER w - (hy - avg(hy) OVER w) / stddev_samp(hy) OVER w END AS ra
 FROM n JOIN p USING (i) WINDOW o AS (ORDER BY event_time), w AS (ORDER BY event_time ROWS BETWEEN 251 PRECEDING AND CURRENT ROW))
"""


@query(_THREE + "SELECT epoch_us(event_time) AS event_time, round(vix, 6) AS vix, CASE WHEN curve < 0 THEN 1 ELSE 0 END AS curve_inverted, round(chg, 8) + 0.0 AS"
    " hy_chg_21, round(ra, 3) + 0.0 AS risk_appetite, CASE WHEN pct < 0.4 AND chg < 0 THEN 'risk_on' WHEN pct > 0.8 OR chg > 0.5 THEN 'risk_off' ELSE 'neutral' END AS"
    " regime FROM f")
def regime_label(s, d):
    return _three(s, d).select(us("event_time"), r("vix", 6), F.col("curve_inverted").cast("int").alias("curve_inverted"), r("hy_chg_21", 8), r("risk_appetite", 3), "regime")


@query(_THREE + "SELECT epoch_us(event_time) AS event_time, round(pct, 6) AS vix_pct_252 FROM f")
def regime_pctrank(s, d):
    return _three(s, d).select(us("event_time"), r("vix_pct_252", 6))


_FLOW = "acq_disp = 'A' AND shares IS NOT NULL", "acq_disp = 'D' AND shares IS NOT NULL"


@query(f"SELECT entity, strftime(date_trunc('month', event_time AT TIME ZONE 'UTC'), '%Y-%m') AS month, round(sum(CASE acq_disp WHEN 'A' THEN shares WHEN 'D' THEN"
    f" -shares END), 2) + 0.0 AS net_shares, count(CASE WHEN {_FLOW[0]} THEN 1 END) AS n_buys, count(CASE WHEN {_FLOW[1]} THEN 1 END) AS n_sells, round((count(CASE WHEN"
    f" {_FLOW[0]} THEN 1 END) - count(CASE WHEN {_FLOW[1]} THEN 1 END)) / nullif(count(CASE WHEN shares IS NOT NULL AND acq_disp IN ('A', 'D') THEN 1 END), 0), 6) + 0.0"
    f" AS net_score FROM insider_form4 WHERE txn_code IN ('P', 'S') GROUP BY 1, 2")
def insider_flow(s, d):
    return windows.insider_flow(table(s, d, "insider_form4")).select("entity", F.date_format("month", "yyyy-MM").alias("month"), r("net_shares", 2), "n_buys", "n_sells", r("net_score", 6))


@query(f"SELECT entity, epoch_us(date_trunc('day', event_time)) AS event_time, round(arg_max(probability, (event_time, vintage_id)), 6) AS probability FROM {QUOTES} GROUP BY ALL")
def prediction_last_daily(s, d):
    return windows.last_daily(quotes(s, d), "probability", ["event_time", "vintage_id"]).select("entity", us("event_time"), r("probability", 6))


@query(f"SELECT entity, epoch_us(event_time) AS event_time, round(probability, 6) AS probability, round(probability - lag(probability, 30) OVER (PARTITION BY entity"
    f" ORDER BY event_time), 6) + 0.0 AS prob_chg_30d FROM (SELECT entity, event_time, knowledge_time, avg(probability) AS probability FROM {QUOTES} GROUP BY ALL)")
def prediction_momentum(s, d):
    return windows.prediction_momentum(quotes(s, d)).select("entity", us("event_time"), r("probability", 6), r("prob_chg_30d", 6))


_NAMED = "SELECT trim(unnest(string_split(organizations, ', '))) AS org, url, event_time AT TIME ZONE 'UTC' AS et, tone FROM news_gkg WHERE organizations IS NOT NULL"


@query(f"WITH n AS (SELECT * FROM ({_NAMED}) WHERE length(org) > 2 AND tone IS NOT NULL), k AS (SELECT org FROM n GROUP BY org HAVING count(*) >= 20) SELECT org AS"
    f" entity, strftime(date_trunc('week', et), '%Y-%m-%d') AS week, round(avg(tone), 4) + 0.0 AS tone, count(*) AS n_articles FROM n WHERE org IN (SELECT org FROM k) GROUP"
    f" BY 1, 2")
def sentiment_weekly(s, d):
    return windows.news_sentiment(table(s, d, "news_gkg"), 20, None).select("entity", F.date_format("week", "yyyy-MM-dd").alias("week"), r("tone"), "n_articles")


@query(
    "WITH f AS (SELECT entity, concept, unit, event_time, arg_min(value, (knowledge_time, vintage_id)) AS value FROM fundamentals_sec WHERE form = '10-K' AND value IS NOT NULL"
    " AND concept IN ('Revenues', 'NetIncomeLoss', 'Assets', 'StockholdersEquity') GROUP BY ALL)"
    " SELECT entity, concept, unit, epoch_us(event_time) AS event_time, round(value / nullif(lag(value) OVER (PARTITION BY entity, concept, unit ORDER BY event_time), 0) - 1, 6) + 0.0 AS yoy FROM f"
)
def growth_yoy(s, d):
    """Each unit is a series of its own."""
    facts = table(s, d, "fundamentals_sec")
    grown = windows.fundamentals_growth(facts, ["Revenues", "NetIncomeLoss", "Assets", "StockholdersEquity"], keys=("entity", "concept", "unit"))
    return grown.select("entity", "concept", "unit", us("event_time"), r("yoy", 6))


_WIDE = f"WITH b AS ({_B}), w AS (SELECT event_time, max(CASE entity WHEN '1-URGENT' THEN ret_1d END) AS a, max(CASE entity WHEN '2-HIGH' THEN ret_1d END) AS b, max(CASE entity WHEN '3-MEDIUM' THEN ret_1d END) AS c FROM b GROUP BY 1 HAVING a IS NOT NULL) "
_TRIO = ["1-URGENT", "2-HIGH", "3-MEDIUM"]


@query(_WIDE + "SELECT epoch_us(event_time) AS event_time, round(a, 6) + 0.0 AS ret_0, round(b, 6) + 0.0 AS ret_1, round(c, 6) + 0.0 AS ret_2 FROM w")
def pivot_returns(s, d):
    return windows.pivot_returns(bars(s, d), _TRIO).select(us("event_time"), *(r(f"ret_{i}", 6) for i in range(3)))


def _corr(x: str, y: str) -> str:
    return f"CASE WHEN count(CASE WHEN {y} IS NOT NULL THEN 1 END) OVER f > 1 THEN round(nullif(corr({x}, {y}) OVER f, 'nan'::DOUBLE), 4) + 0.0 END"


@query(_WIDE + f"SELECT epoch_us(event_time) AS event_time, {_corr('a', 'b')} AS corr_1, {_corr('a', 'c')} AS corr_2 FROM w WINDOW f AS (ORDER BY event_time ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)")
def cross_corr(s, d):
    return windows.cross_asset(bars(s, d), _TRIO).select(us("event_time"), r("corr_1"), r("corr_2"))


@query(f"SELECT entity, epoch_us(event_time) AS event_time, round(close / nullif(lag(close, 30) OVER (PARTITION BY entity ORDER BY event_time), 0) - 1, 6) + 0.0 AS chg_30d FROM {BARS}")
def momentum_30(s, d):
    return windows.series_momentum(bars(s, d).withColumnRenamed("close", "value")).select("entity", us("event_time"), r("chg_30d", 6))


@query("SELECT e AS entity, strftime(event_time AT TIME ZONE 'UTC', '%Y-%m-%d') AS day, cast(sum(weight) AS BIGINT) AS degree, count(*) AS n_edges FROM (SELECT entity"
    " AS e, event_time, weight FROM entity_graph WHERE kind = 'co_mention' UNION ALL SELECT dst, event_time, weight FROM entity_graph WHERE kind = 'co_mention') GROUP"
    " BY ALL")
def graph_centrality(s, d):
    edges = table(s, d, "entity_graph").where("kind = 'co_mention'")
    return windows.centrality(edges).select("entity", F.date_format("event_time", "yyyy-MM-dd").alias("day"), "degree", "n_edges")


_SUR = f"WITH f AS (SELECT entity, event_time, arg_min(value, (knowledge_time, vintage_id)) AS actual FROM {VINTAGES} GROUP BY 1, 2), d AS (SELECT *, actual - lag(actual) OVER (PARTITION BY entity ORDER BY event_time) AS surprise FROM f)"


@query(_SUR + " SELECT * FROM (SELECT entity, epoch_us(event_time) AS event_time, round(surprise, 4) + 0.0 AS surprise, CASE WHEN count(surprise) OVER w >= 5 THEN"
    " round((surprise - avg(surprise) OVER w) / nullif(stddev_samp(surprise) OVER w, 0), 4) + 0.0 END AS surprise_z FROM d WINDOW w AS (PARTITION BY entity ORDER BY event_time"
    " ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)) WHERE surprise IS NOT NULL")
def surprise_z(s, d):
    return windows.surprise(vintages(s, d)).select("entity", us("event_time"), r("surprise"), r("surprise_z"))


# Graph


@query("SELECT entity, cik, name, exchange, 'company' AS node_type FROM security_master WHERE record_type = 'identity'")
def graph_nodes(s, d):
    return graph.nodes(table(s, d, "security_master"))


@query("SELECT entity, 'owns' AS rel, issuer AS dst, round(value_usd_thousands, 2) AS value, round(shares, 2) AS shares FROM holdings_13f WHERE issuer IS NOT NULL AND issuer <> ''")
def graph_ownership(s, d):
    return graph.ownership(table(s, d, "holdings_13f")).select("entity", "rel", "dst", r("value", 2), r("shares", 2))


@query("SELECT owner_name AS entity, 'insider_of' AS rel, entity AS dst, txn_code, acq_disp FROM insider_form4 WHERE owner_name IS NOT NULL AND owner_name <> ''")
def graph_insider(s, d):
    return graph.insider(table(s, d, "insider_form4")).select("entity", "rel", "dst", "txn_code", "acq_disp")


@query(f"WITH n AS (SELECT DISTINCT url, date_trunc('quarter', et) AS q, org FROM ({_NAMED}) WHERE length(org) > 2 AND url IS NOT NULL), k AS (SELECT org FROM (SELECT"
    f" org FROM ({_NAMED}) WHERE length(org) > 2 AND url IS NOT NULL) GROUP BY 1 HAVING count(*) >= 20) SELECT strftime(a.q, '%Y-%m-%d') AS quarter, a.org AS entity, b.org"
    f" AS dst, count(*) AS weight FROM n a JOIN n b ON a.url = b.url AND a.q = b.q AND a.org < b.org WHERE a.org IN (SELECT org FROM k) AND b.org IN (SELECT org FROM k)"
    f" GROUP BY ALL HAVING count(*) >= 3")
def graph_comention(s, d):
    return graph.co_mention(table(s, d, "news_gkg"), 20, None, 3).select(F.date_format("quarter", "yyyy-MM-dd").alias("quarter"), "entity", "dst", "weight")


@query("SELECT kind, entity, dst, epoch_us(knowledge_time) AS knowledge_time FROM entity_graph WHERE kind <> 'nodes' AND knowledge_time <= $T AND (contains(lower(entity),"
    " 'bank') OR contains(lower(dst), 'bank')) ORDER BY entity_graph.knowledge_time DESC, entity, dst, event_time DESC, content_hash LIMIT 20")
def graph_neighbours(s, d):
    return graph.neighbours(table(s, d, "entity_graph"), "bank", T).select("kind", "entity", "dst", us("knowledge_time"))


# Channels and tools


class _Tables:
    """The driver's tables under the names of a lake; `own` gives frames for further names, or instead."""

    NAMES = {("fundamentals", "sec_xbrl"): "fundamentals_sec", ("features", "derived"): "features", ("news", "gdelt_gkg"): "news_gkg", ("graph", "derived"): "entity_graph"}

    def __init__(self, s: SparkSession, d: str, own: dict | None = None):
        self.s, self.d, self.own = s, d, own or {}

    def scan(self, domain: str, source: str, kind: str | None = None) -> DataFrame:
        if (domain, source) in self.own:
            return self.own[(domain, source)]
        df = bars(self.s, self.d) if (domain, source) == ("market", "yahoo") else table(self.s, self.d, self.NAMES[(domain, source)])
        return df.where(F.col("kind") == kind) if kind else df


def _series(s: SparkSession, d: str, event: str) -> DataFrame:
    return vintages(s, d).where(F.col("event_type") == event)


@query(f"SELECT epoch_us(event_time) AS event_time, round(close, 4) AS close, volume FROM {BARS} WHERE knowledge_time <= $TB AND entity = '2-HIGH' ORDER BY event_time DESC LIMIT 10")
def price_history(s, d):
    return channels.price_history(_Tables(s, d), TB, "2-HIGH").select(us("event_time"), r("close"), "volume")


@query(
    "SELECT entity, concept, unit, epoch_us(event_time) AS event_time, round(value, 4) AS value FROM (SELECT *, row_number() OVER (PARTITION BY entity, concept ORDER BY knowledge_time DESC, event_time DESC, vintage_id DESC, unit DESC) AS rn"
    " FROM (SELECT DISTINCT entity, concept, unit, event_time, knowledge_time, vintage_id, value FROM fundamentals_sec) WHERE knowledge_time <= $T AND concept IN ('Revenues', 'NetIncomeLoss', 'Assets', 'StockholdersEquity', 'EarningsPerShareDiluted')) WHERE rn = 1"
)
def concept_latest(s, d):
    """The tool's rows for every entity; of rows of one release the greatest unit."""
    return channels.fundamentals(_Tables(s, d), T, None).select("entity", "concept", "unit", us("event_time"), r("value"))


@query("SELECT entity, substr(text, 1, 500) AS excerpt FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY knowledge_time DESC, event_time DESC, doc_id DESC) AS rn FROM documents WHERE knowledge_time <= $T AND entity IS NOT NULL AND doc_type IN ('8-K', '10-K', '10-Q')) WHERE rn = 1")
def text_snippet(s, d):
    """The three types of the documents that are filings; articles, rules and others are none."""
    filings = table(s, d, "documents").where("entity is not null and doc_type in ('8-K', '10-K', '10-Q')")
    filings = filings.select("entity", F.col("doc_type").alias("form"), "event_time", "knowledge_time", F.col("doc_id").alias("vintage_id"), "text")
    return channels.filing_texts(filings, T).select("entity", "excerpt")


@query("SELECT url, title, site_domain AS outlet FROM news_gkg WHERE knowledge_time <= $T AND (contains(lower(title), 'energy') OR contains(lower(organizations), 'energy')) ORDER BY knowledge_time DESC, url, content_hash LIMIT 10")
def keyword_search(s, d):
    return channels.news_search(_Tables(s, d), T, "Energy").select("url", "title", "outlet")


@query(f"SELECT question, entity, round(volume, 4) AS volume FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY event_time DESC, knowledge_time DESC,"
    f" vintage_id DESC) AS rn FROM {QUOTES} WHERE contains(lower(question), 'purchase') AND knowledge_time <= $TV) WHERE rn = 1 ORDER BY volume DESC NULLS LAST, entity"
    f" LIMIT 6")
def venue_topk(s, d):
    df = quotes(s, d).where(F.contains(F.lower("question"), F.lit("purchase")))
    return channels.markets(df, TV, 6).select("question", "entity", r("volume"))


@query("SELECT event, round(magnitude, 4) AS magnitude FROM (SELECT 'quake M' || format('{:.1f}', round(value / 30, 1)) || ' ' || event_type || ' ' || event_id AS"
    " event, round(value / 30, 1) AS magnitude, ts, event_type || ' ' || event_id AS place FROM events WHERE ts <= $TV AND ts > $TV - INTERVAL 30 DAY) WHERE magnitude"
    " >= 6 ORDER BY magnitude DESC, ts DESC, place LIMIT 5")
def shocks_topk(s, d):
    """The tool of recent shocks over events as quakes."""
    at = F.col("ts").cast("timestamp")
    quakes = table(s, d, "events").select(at.alias("knowledge_time"), at.alias("event_time"), F.round(F.col("value") / 30, 1).alias("magnitude"), F.concat_ws(" ", "event_type", F.col("event_id").cast("string")).alias("place"))
    return channels.recent_shocks(_Tables(s, d, {("events", "usgs"): quakes}), TV).select("event", r("magnitude"))


@query("SELECT title, outlet, round(strength, 4) AS strength FROM (SELECT title, site_domain AS outlet, abs(tone) AS strength FROM news_gkg WHERE knowledge_time <= $T AND knowledge_time > $T - INTERVAL 2 DAY AND length(title) > 20) ORDER BY strength DESC NULLS LAST, title LIMIT 8")
def news_topk(s, d):
    return channels.news(table(s, d, "news_gkg"), None, T).select("title", "outlet", r("strength"))


@query(f"SELECT title, outlet, round(strength, 4) AS strength FROM (SELECT event_type || ' ' || vintage_id AS title, 'hackernews' AS outlet, value AS strength FROM {VINTAGES} WHERE knowledge_time <= $TV AND knowledge_time > $TV - INTERVAL 7 DAY) ORDER BY strength DESC, title LIMIT 8")
def news_fallback(s, d):
    """No article of two days, so posts of seven days take their place."""
    posts = vintages(s, d).select("knowledge_time", F.concat_ws(" ", "event_type", "vintage_id").alias("title"), F.col("value").alias("points"))
    return channels.news(table(s, d, "news_gkg").where("false"), posts, TV).select("title", "outlet", r("strength"))


@query("SELECT epoch_us(event_time) AS event_time, round(close, 4) AS close, round(rsi14, 4) AS rsi14 FROM features WHERE knowledge_time <= $T AND kind = 'technical' AND entity = (SELECT min(entity) FROM features) ORDER BY features.event_time DESC, knowledge_time DESC LIMIT 1")
def feature_row(s, d):
    first = table(s, d, "features").agg(F.min("entity")).first()[0]
    return channels.get_features(_Tables(s, d), T, first).select(us("event_time"), r("close"), r("rsi14"))


@query(f"SELECT entity, round(close, 2) AS close FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY event_time DESC) AS rn FROM {BARS} WHERE knowledge_time <= $TB AND entity IN ('1-URGENT', '2-HIGH')) WHERE rn = 1")
def watchlist_prices(s, d):
    b = bars(s, d)
    return channels.prices(b, TB, ["1-URGENT", "2-HIGH"]).select("entity", r("close", 2))


_LAST = "row_number() OVER (PARTITION BY entity ORDER BY knowledge_time DESC, event_time DESC, vintage_id DESC) AS rn"


@query(
    f"SELECT entity, value FROM (SELECT entity, round(close, 1) AS value, row_number() OVER (PARTITION BY entity ORDER BY knowledge_time DESC, event_time DESC) AS rn FROM {BARS} WHERE knowledge_time <= $TV) WHERE rn = 1"
    f" UNION ALL SELECT entity, round(value) FROM (SELECT *, {_LAST} FROM {VINTAGES} WHERE event_type = 'view' AND knowledge_time <= $TV) WHERE rn = 1"
    f" UNION ALL SELECT entity, round(value, 1) FROM (SELECT *, {_LAST} FROM {VINTAGES} WHERE event_type = 'click' AND knowledge_time <= $TV) WHERE rn = 1"
)
def crypto_levels(s, d):
    """Rounded last values of coins, fear and greed, and volatility in one column."""
    fear, vol = _series(s, d, "view").withColumnRenamed("value", "fng_value"), _series(s, d, "click").withColumnRenamed("value", "dvol_close")
    return channels.crypto(bars(s, d), fear, vol, TV, (1, 0, 1))


@query(f"SELECT entity, round(value, 4) AS score FROM (SELECT *, {_LAST} FROM {VINTAGES} WHERE event_type = 'view' AND knowledge_time <= $TV) WHERE rn = 1")
def market_fng_levels(s, d):
    return channels.levels(_series(s, d, "view").withColumnRenamed("value", "score"), TV, value="score").select("entity", r("score"))


_NEWEST = "ORDER BY event_time DESC, knowledge_time DESC, vintage_id DESC LIMIT 1"


@query(f"SELECT entity, epoch_us(event_time) AS event_time, round(value, 4) AS short_ratio FROM (SELECT * FROM {VINTAGES} WHERE event_type = 'click' AND entity = '7' AND knowledge_time <= $TV {_NEWEST})")
def positioning_tool(s, d):
    lake = _Tables(s, d, {("positioning", "finra_short"): _series(s, d, "click").withColumnRenamed("value", "short_ratio")})
    return channels.positioning(lake, TV, "7").select("entity", us("event_time"), r("short_ratio"))


@query(f"SELECT metric, epoch_us(event_time) AS event_time, round(value, 4) AS value FROM (SELECT *, event_type AS metric FROM {VINTAGES} WHERE event_type = 'signup' AND knowledge_time <= $TV {_NEWEST})")
def onchain_tool(s, d):
    return channels.onchain(_Tables(s, d, {("onchain", "blockchain"): vintages(s, d).withColumn("metric", F.col("event_type"))}), TV, "signup").select("metric", us("event_time"), r("value"))


@query(f"SELECT entity, epoch_us(event_time) AS event_time, round(value, 4) AS value FROM (SELECT * FROM {VINTAGES} WHERE entity = '5' AND knowledge_time <= $TV {_NEWEST})")
def defi_tool(s, d):
    return channels.defi_tvl(_Tables(s, d, {("crypto_defi", "defillama"): vintages(s, d)}), TV, "5").select("entity", us("event_time"), r("value"))


@query(_THREE + f"SELECT epoch_us(event_time) AS event_time, CASE WHEN pct < 0.4 AND chg < 0 THEN 'risk_on' WHEN pct > 0.8 OR chg > 0.5 THEN 'risk_off' ELSE 'neutral' END AS regime FROM f WHERE event_time + INTERVAL 21 HOUR <= $TB ORDER BY f.event_time DESC LIMIT 1")
def regime_latest(s, d):
    lake = _Tables(s, d, {("features", "derived"): _three(s, d).withColumn("kind", F.lit("regime"))})
    return channels.market_regime(lake, TB).select(us("event_time"), "regime")


def _venue(name: str, word: str, volume: str = "volume") -> str:
    return f"(SELECT '{name}' AS venue, question, probability, {volume} AS volume FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY event_time DESC, knowledge_time DESC, vintage_id DESC) AS rn FROM {QUOTES} WHERE question = 'Will {word} rise?' AND knowledge_time <= $TV) WHERE rn = 1 ORDER BY {'volume DESC, ' if volume == 'volume' else ''}question, probability DESC LIMIT 6)"


@query(f"SELECT venue, question, round(probability, 6) AS probability, round(volume, 4) AS volume FROM ({_venue('manifold', 'view')} UNION ALL {_venue('polymarket', 'click')} UNION ALL {_venue('kalshi', 'signup', '0.0')})")
def venue_union(s, d):
    """The best markets of each venue by the tool, one under the other; the third venue has no volume."""
    of = lambda word: quotes(s, d).where(F.col("question") == f"Will {word} rise?")
    lake = _Tables(s, d, {("predictions", "manifold"): of("view"), ("predictions", "polymarket"): of("click"), ("predictions", "kalshi"): of("signup").withColumnRenamed("question", "title").drop("volume")})
    return channels.prediction_market(lake, TV, "RISE?").select("venue", "question", r("probability", 6), r("volume"))


def _macro(event: str, place: int) -> str:
    return f"SELECT entity, event_time, value, {place} AS place FROM (SELECT *, {_LAST} FROM {VINTAGES} WHERE event_type = '{event}' AND knowledge_time <= $TV) WHERE rn = 1"


@query(f"WITH u AS ({' UNION ALL '.join(_macro(e, i) for i, e in enumerate(('signup', 'purchase', 'click', 'view')))}) SELECT entity, epoch_us(event_time) AS event_time, round(value, 4) AS value FROM (SELECT *, min(place) OVER (PARTITION BY entity) AS first FROM u) WHERE place = first")
def macro_fallback(s, d):
    """The tool's row of every series: of the first of four places that has it."""
    places = (("macro", "alfred"), ("credit", "fred"), ("commodity", "fred"), ("real_estate", "fred"))
    lake = _Tables(s, d, {p: _series(s, d, e) for p, e in zip(places, ("signup", "purchase", "click", "view"))})
    return channels.macro_series(lake, TV, None).select("entity", us("event_time"), r("value"))


@query("SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, cast(user_id AS VARCHAR) AS entity, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def stream_windows(s, d):
    """Daily totals of the events as a stream that reads all there is and ends."""
    from tidemark.session import shared_dir
    from tidemark.streaming.stream import windowed

    src = table(s, d, "events")
    # a pattern, as a stream reads folders or patterns, and the table may be one file
    stream = s.readStream.schema(src.schema).parquet(f"{d}/events.parque[t]").select(F.col("ts").cast("timestamp").alias("event_time"), F.col("user_id").cast("string").alias("entity"), "value")
    name = f"stream_{uuid.uuid4().hex}"
    out = windowed(stream, "value", "1 day").select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "entity", "n", F.round("total", 2).alias("total"))
    path = f"{shared_dir(s)}/{name}"
    save = lambda df, _: df.write.mode("overwrite").parquet(path)
    out.writeStream.outputMode("complete").option("checkpointLocation", path + "-state").foreachBatch(save).trigger(availableNow=True).start().awaitTermination()
    return s.read.parquet(path)


# Merges, joins, functions


@query("SELECT coalesce(a.entity, b.entity) AS entity, epoch_us(coalesce(a.day, b.day)) AS event_time, round(a.v, 4) AS volume_pct, round(b.v, 4) AS avg_tone FROM"
    " (SELECT cast(user_id AS VARCHAR) AS entity, date_trunc('day', ts) AS day, max(value) AS v FROM events WHERE event_type = 'view' GROUP BY 1, 2) a FULL JOIN (SELECT"
    " cast(user_id AS VARCHAR) AS entity, date_trunc('day', ts) AS day, max(value) AS v FROM events WHERE event_type = 'click' GROUP BY 1, 2) b ON a.entity = b.entity"
    " AND a.day = b.day")
def timeline_full_outer(s, d):
    """The news parser's full join of two timelines."""
    one = lambda e: _series(s, d, e).groupBy(F.col("entity").alias("theme"), F.date_format("event_time", "yyyy-MM-dd").alias("date")).agg(F.max("value").alias("value"))
    return SOURCES["news_gdelt"].parse(one("view"), one("click")).select("entity", us("event_time"), r("volume_pct"), r("avg_tone"))


@query("SELECT entity, strftime(event_time AT TIME ZONE 'UTC', '%Y-%m') AS month, round(sum(CASE WHEN acq_disp = 'D' THEN shares END) / nullif(sum(CASE WHEN acq_disp = 'A' THEN shares END), 0), 6) AS sold_per_bought FROM insider_form4 GROUP BY 1, 2")
def ratio_nullif(s, d):
    part = lambda k: F.sum(F.when(F.col("acq_disp") == k, F.col("shares")))
    return table(s, d, "insider_form4").groupBy("entity", F.date_format("event_time", "yyyy-MM").alias("month")).agg(F.round(ratio(part("D"), part("A")), 6).alias("sold_per_bought"))


@query("SELECT content_hash, row_id FROM (SELECT content_hash, row_id, row_number() OVER (PARTITION BY content_hash ORDER BY row_id % 2, knowledge_time, row_id) AS rn FROM insider_form4) WHERE rn = 1")
def merge_dedupe(s, d):
    """Rows with odd ids come into a shard of those with even ids; its own repeats it has lost before."""
    rows = table(s, d, "insider_form4").withColumn("vintage_id", F.lpad("row_id", 12, "0"))
    return merge_rows(merge_rows(None, rows.where("row_id % 2 = 0")), rows.where("row_id % 2 = 1")).select("content_hash", "row_id")


@query(
    r"""SELECT doc_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(text, '<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', ' ', 'gsi'), '<[^>]*>', ' ', 'gs'), '&nbsp;', ' '), '&copy;', '©'), '&#39;', ''''), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '[ \t\n\r\f\v]+', ' ', 'g'), ' ') AS plain FROM documents WHERE text IS NOT NULL"""
)
def html_plain(s, d):
    return table(s, d, "documents").where("text is not null").select("doc_id", html_text(F.col("text")).alias("plain"))


@query("SELECT event_id, cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_extract(s, d):
    return table(s, d, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("long").alias("k"))


@query(
    "SELECT entity, epoch_us(event_time) AS event_time, action, security FROM (SELECT a.ticker AS entity, TIMESTAMP '2021-01-04' AS event_time, a.action, a.security"
    " FROM (SELECT unnest(['added', 'removed']) AS action, unnest([CASE WHEN s_suppkey % 3 > 0 THEN s_name ELSE '' END, CASE WHEN s_suppkey % 3 < 2 THEN 'old ' || s_name END]) AS ticker, unnest(['Acme', 'Beta']) AS security FROM supplier) a) WHERE entity IS NOT NULL AND entity <> ''"
)
def unpivot_changes(s, d):
    """A row for each side of an index change that has a ticker."""
    third = F.col("s_suppkey") % 3
    changes = table(s, d, "supplier").select(
        F.lit("2021-01-04").alias("date"), F.lit("r").alias("reason"), F.when(third > 0, F.col("s_name")).otherwise("").alias("added"), F.when(third < 2, F.concat(F.lit("old "), "s_name")).alias("removed"),
        F.lit("Acme").alias("added_security"), F.lit("Beta").alias("removed_security"),
    )
    return index_changes(changes).select("entity", us("event_time"), "action", "security")


@query(r"SELECT row_id, sha256(coalesce(entity, '\0') || chr(31) || strftime(event_time AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S.%f') || chr(31) || coalesce(owner_name, '\0') || chr(31) || cast(row_id AS VARCHAR)) AS digest FROM insider_form4 WHERE event_time IS NOT NULL".replace("'\\0'", "chr(0)"))
def content_hash(s, d):
    """The envelope's hash of entity, event time and payload."""
    digest = envelope.content_hash(F.col("entity"), F.col("event_time"), [F.col("owner_name"), F.col("row_id")])
    return table(s, d, "insider_form4").where("event_time is not null").select("row_id", digest.alias("digest"))


@query("SELECT DISTINCT entity, regexp_replace(regexp_replace(lower(entity), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') AS slug FROM holdings_13f WHERE entity IS NOT NULL")
def slug_names(s, d):
    return table(s, d, "holdings_13f").where("entity is not null").select("entity", slug(F.col("entity")).alias("slug")).distinct()


# Tasks



def _decisions(s, d):
    v = F.col("volume") % 3
    return bars(s, d).select("entity", F.col("event_time").alias("at"), F.when(v == 0, "up long").when(v == 1, "down short").otherwise("flat").alias("decision"))


_OUT = f"WITH b AS {BARS}, d AS (SELECT entity, event_time AS asked, CASE volume % 3 WHEN 0 THEN 'up long' WHEN 1 THEN 'down short' ELSE 'flat' END AS decision FROM b), o AS (SELECT d.*, n.close AS now, l.close AS later FROM d ASOF LEFT JOIN b n ON n.entity = d.entity AND n.event_time >= d.asked ASOF LEFT JOIN b l ON l.entity = d.entity AND l.event_time >= d.asked + INTERVAL 5 DAY) "


@query(_OUT + "SELECT entity, epoch_us(asked) AS at, CASE WHEN now IS NULL OR later IS NULL THEN 0.0::DOUBLE WHEN contains(decision, 'up') = (later >= now) THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS reward FROM o")
def forecast_reward(s, d):
    df = tasks.outcomes(bars(s, d), _decisions(s, d), 5)
    return df.select("entity", us("at"), tasks.forecast_reward(F.col("decision"), F.col("now"), F.col("later")).alias("reward"))


@query(_OUT + "SELECT entity, epoch_us(asked) AS at, coalesce(round(CASE WHEN contains(decision, 'long') THEN 1.0 WHEN contains(decision, 'short') THEN -1.0 ELSE 0.0 END * (later - now) / nullif(now, 0) * 100, 4), 0.0) + 0.0 AS reward FROM o")
def trading_reward(s, d):
    df = tasks.outcomes(bars(s, d), _decisions(s, d), 5)
    return df.select("entity", us("at"), (tasks.trading_reward(F.col("decision"), F.col("now"), F.col("later")) + F.lit(0.0)).alias("reward"))


@query(_OUT + "SELECT entity, epoch_us(asked) AS at, round(sum(coalesce(round(CASE WHEN contains(decision, 'long') THEN 1.0 WHEN contains(decision, 'short') THEN"
    " -1.0 ELSE 0.0 END * (later - now) / nullif(now, 0) * 100, 4), 0.0)) OVER (PARTITION BY entity ORDER BY asked ROWS UNBOUNDED PRECEDING), 6) + 0.0 AS cum_reward FROM"
    " o")
def cum_reward(s, d):
    df = tasks.outcomes(bars(s, d), _decisions(s, d), 5)
    log = df.select(F.col("entity").alias("episode_id"), F.col("at").alias("step"), tasks.trading_reward(F.col("decision"), F.col("now"), F.col("later")).alias("reward"))
    return tasks.with_cumulative(log).select(F.col("episode_id").alias("entity"), us("step").alias("at"), r("cum_reward", 6))


_DRAWN = "SELECT *, (volume % 10) / 10.0 AS x, (volume % 7) / 7.0 AS y, (volume % 3) / 3.0 AS z FROM " + BARS
_SHOWN = f"SELECT *, x < 0.4 AS is_bad, CASE WHEN x >= 0.4 THEN close WHEN floor(y * 4) = 0 THEN close * (3 + z * 9) WHEN floor(y * 4) = 1 THEN -close WHEN floor(y * 4) = 2 THEN 0 ELSE close END AS shown, x < 0.4 AND floor(y * 4) = 3 AS future FROM ({_DRAWN})"
_JUDGED = f"SELECT *, CASE WHEN shown <= 0 OR future OR shown > 2.5 * close OR shown < 0.4 * close THEN 'reject' ELSE 'approve' END AS decision FROM ({_SHOWN})"


@query(f"SELECT entity, epoch_us(event_time) AS event_time, is_bad, decision, CASE WHEN (decision = 'reject') = is_bad THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS reward FROM ({_JUDGED})")
def approval_anomaly(s, d):
    """Bars corrupted by given draws, judged by the rule policy and scored."""
    draws = [F.col("volume") % n / F.lit(float(n)) for n in (10, 7, 3)]
    bad = tasks.corrupted(bars(s, d), "close", ["entity", "event_time"], draws=draws)
    decision = tasks.approve(F.col("shown"), F.col("close"), F.col("shown_date"))
    return bad.select("entity", us("event_time"), "is_bad", decision.alias("decision"), tasks.approval_reward(decision, F.col("is_bad")).alias("reward"))


@query("SELECT row_id, CASE WHEN is_derivative THEN 'tool' ELSE 'decide' END AS kind, CASE WHEN is_derivative THEN 'onchain' ELSE coalesce(acq_disp, 'none') END AS text FROM insider_form4")
def action_parse(s, d):
    raw = F.when(F.col("is_derivative"), F.lit('{"tool":"onchain"}')).otherwise(F.concat(F.lit('{"action":"'), F.coalesce("acq_disp", F.lit("none")), F.lit('"}')))
    return table(s, d, "insider_form4").select("row_id", F.inline(F.array(tasks.parsed_actions(raw))))


_LAKE = ("insider_form4", "holdings_13f", "news_gkg", "fundamentals_sec", "clinical_trials")
_CLASS = "CASE source WHEN 'sec_xbrl' THEN 'vintage' WHEN 'sec_13f' THEN 'vintage' ELSE 'immutable' END"


@query(f"SELECT domain, source, count(*) AS n_rows, {_CLASS} AS pit_class FROM ({' UNION ALL '.join(f'SELECT domain, source FROM {n}' for n in _LAKE)}) GROUP BY 1, 2")
def inventory_counts(s, d):
    """The inventory of a lake that all five tables were written to."""
    lake = Lake(s, scratch(s, "lake"))
    for n in _LAKE:
        lake.write_many(table(s, d, n), [])
    return lake.inventory().select("domain", "source", F.col("rows").alias("n_rows"), "pit_class")


@query("SELECT source, count(*) AS n_rows FROM (SELECT source FROM insider_form4 UNION ALL SELECT source FROM fundamentals_sec UNION ALL SELECT source FROM features) GROUP BY 1")
def strict_scan(s, d):
    """Four sources, of which the snapshot of the reference master is not safe about the past."""
    from tidemark.provenance import strict

    every = None
    for n in ("insider_form4", "fundamentals_sec", "features", "security_master"):
        df = table(s, d, n).select("domain", "source")
        every = df if every is None else every.unionByName(df)
    return strict(every).groupBy("source").agg(F.count("*").alias("n_rows"))


# Each source's class, those not safe about the past marked with *, those that need a key with $.
_CLASSES = """
market/yahoo immutable, crypto/yahoo immutable, onchain/blockchain immutable, macro/alfred vintage, macro/treasury immutable, events/edgar immutable, filings_text/edgar immutable,
fundamentals/sec_xbrl vintage, positioning/cftc immutable, positioning/finra_short immutable, positioning/sec_form4 immutable, ownership/sec_13f vintage, policy/fomc immutable,
news/gdelt immutable, news/hackernews immutable, attention/wikipedia immutable, research/arxiv immutable, events/usgs immutable, events/nasa_eonet immutable, predictions/manifold immutable,
predictions/polymarket immutable, predictions/kalshi immutable, sentiment/cnn_fng forward_limited, sentiment/alt_fng immutable, crypto_deriv/okx forward_limited, crypto_deriv/deribit forward_limited,
features/derived derived, graph/derived derived, derived/surprise derived, trajectories/env derived, crypto_defi/defillama revised_soft*, crypto_defi/defillama_flows revised_soft*, commodity/eia revised_soft*,
news/gdelt_gkg immutable, research/clinicaltrials immutable, options/polygon immutable$, market/polygon_intraday immutable$, fundamentals/fmp_transcripts immutable$, fundamentals/fmp_estimates immutable$,
news/tiingo immutable$, alt/shipping_ais immutable$, policy/federal_register immutable, events/openfda immutable, sentiment/epu revised_soft*, credit/fred vintage, real_estate/fred vintage,
commodity/fred vintage, reference/master snapshot_forward*
"""


@query(
    f"SELECT split_part(split_part(x, ' ', 1), '/', 1) AS domain, split_part(split_part(x, ' ', 1), '/', 2) AS source, rtrim(split_part(x, ' ', 2), '*$') AS pit_class, NOT contains(x, '*') AS safe, contains(x, '$') AS paid"
    f" FROM (SELECT trim(unnest(string_split(replace('{_CLASSES.strip()}', chr(10), ' '), ','))) AS x)"
)
def provenance_classes(s, d):
    return registry(s)


# Queries over the driver's star tables, for the engine's general operators


@query("SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_discount), 6) AS avg_disc, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2")
def star_pricing(s, d):
    df = table(s, d, "lineitem").where("l_shipdate <= timestamp_ntz'1998-09-02'")
    return df.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.expr("l_extendedprice * (1 - l_discount)")), 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("n"))


@query("SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA' GROUP BY 1")
def star_revenue(s, d):
    t = lambda n: table(s, d, n)
    df = t("lineitem").join(t("orders"), F.expr("l_orderkey = o_orderkey")).join(t("customer"), F.expr("o_custkey = c_custkey")).join(t("nation"), F.expr("c_nationkey = n_nationkey")).join(t("region").where("r_name = 'ASIA'"), F.expr("n_regionkey = r_regionkey"))
    return df.groupBy("n_name").agg(F.round(F.sum(F.expr("l_extendedprice * (1 - l_discount)")), 2).alias("revenue"))


def queries() -> dict:
    return dict(Q)


def sql() -> dict:
    return dict(S)
