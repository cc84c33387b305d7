"""Queries of the environment: the observation of a moment, episodes at once, their log in a lake, and the derived tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.lake import Lake
from tidemark.operators import derived, episodes
from tidemark.operators.observe import Observer
from tidemark.plans.reference import _Tables, _series, _three, us
from tidemark.plans.views import BARS, QUOTES, VINTAGES, bars, quotes, vintages
from tidemark.session import scratch
from tidemark.tables import table

T = "2024-01-15 00:00:00"
TS = f"TIMESTAMP '{T}'"


def _world(s: SparkSession, d: str) -> _Tables:
    """A lake made of the driver's tables, for every channel."""
    at = F.col("ts").cast("timestamp")
    quakes = table(s, d, "events").select(at.alias("knowledge_time"), at.alias("event_time"), F.round(F.col("value") / 30, 1).alias("magnitude"), F.col("event_id").cast("string").alias("place"))
    own = {
        ("features", "derived"): _three(s, d).withColumn("kind", F.lit("regime")), ("macro", "alfred"): _series(s, d, "view"), ("credit", "fred"): _series(s, d, "click"), ("commodity", "fred"): _series(s, d, "signup"),
        ("sentiment", "cnn_fng"): _series(s, d, "view").withColumnRenamed("value", "score"), ("crypto", "yahoo"): vintages(s, d).withColumnRenamed("value", "close"),
        ("predictions", "manifold"): quotes(s, d), ("events", "usgs"): quakes,
    }
    return _Tables(s, d, own)


SERIES = {"rates": ["1", "2", "3"], "macro": ["4", "5"], "credit": ["1", "2", "3"], "commodities": ["7", "8"], "market_fng": ["9"], "coins": ["1", "2"]}


def observation_packet(s: SparkSession, d: str) -> DataFrame:
    """All channels at a moment in one frame; two of them have no source here, the rest come from the driver's tables."""
    seen = Observer(_world(s, d), ["1-URGENT", "2-HIGH"], SERIES).frame(T)
    return seen.where("channel != 'news' and channel != 'regime'").select("channel", F.col("position").cast("long").alias("position"), "name", F.round("value", 4).alias("value"), "text")


def _levels(channel: str, event: str, ids: list[str], digits: int = 4) -> str:
    listed = ", ".join(f"'{i}'" for i in ids)
    which = f"event_type = '{event}' AND" if event else ""
    return f"""SELECT '{channel}' AS channel, row_number() OVER (ORDER BY entity) AS position, entity AS name, round(value, {digits}) AS value, NULL AS text
FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY knowledge_time DESC, event_time DESC, vintage_id DESC) AS rn FROM {VINTAGES} WHERE {which} knowledge_time <= {TS} AND entity IN ({listed})) WHERE rn = 1"""


OBSERVATION_SQL = " UNION ALL ".join(
    [
        f"""SELECT 'prices' AS channel, row_number() OVER (ORDER BY entity) AS position, entity AS name, round(close, 4) AS value, NULL AS text
FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY event_time DESC) AS rn FROM {BARS} WHERE knowledge_time <= {TS} AND entity IN ('1-URGENT', '2-HIGH')) WHERE rn = 1""",
        _levels("rates", "view", SERIES["rates"]), _levels("macro", "view", SERIES["macro"]), _levels("credit", "click", SERIES["credit"]), _levels("commodities", "signup", SERIES["commodities"]),
        _levels("market_fng", "view", SERIES["market_fng"]), _levels("crypto", "", SERIES["coins"], 1),
        f"""SELECT 'predictions', row_number() OVER (ORDER BY volume DESC, entity), entity, round(probability, 4), question FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY event_time DESC, knowledge_time DESC, vintage_id DESC) AS rn
FROM {QUOTES} WHERE knowledge_time <= {TS}) WHERE rn = 1 ORDER BY volume DESC, entity LIMIT 5)""",
        f"""SELECT 'events', row_number() OVER (ORDER BY m DESC, e), 'USGS', round(m, 4), e FROM (SELECT round(value / 30, 1) AS m, 'quake M' || format('{{:.1f}}', round(value / 30, 1)) || ' ' || event_id AS e
FROM events WHERE ts <= {TS} AND ts > {TS} - INTERVAL 14 DAY AND round(value / 30, 1) >= 6 ORDER BY m DESC, ts DESC, cast(event_id AS VARCHAR) LIMIT 3)""",
    ]
)


def _begun(s: SparkSession) -> DataFrame:
    return s.range(40).select(F.format_string("e%03d", "id").alias("episode"), F.expr("timestamp'1995-01-03' + make_dt_interval(cast(id as int) * 29)").alias("start"))


def _log(s: SparkSession, d: str, task: str, action: str) -> DataFrame:
    return episodes.played(bars(s, d), _begun(s), task, "2-HIGH", F.lit(action))


def episode_rewards(s: SparkSession, d: str) -> DataFrame:
    """Forecast and trading episodes, all at once: reward and sum of rewards of each step."""
    both = _log(s, d, "forecast", "up").unionByName(_log(s, d, "trading", "long"))
    return both.select("episode_id", "task", F.col("step").cast("long").alias("step"), "as_of", "action", "done", (F.round("reward", 4) + F.lit(0.0)).alias("reward"), (F.round("cum_reward", 3) + F.lit(0.0)).alias("cum_reward"))


EPISODE_SQL = f"""
WITH b AS {BARS}, g AS (SELECT format('e{{:03d}}', i) AS episode_id, k AS step, TIMESTAMP '1995-01-03' + INTERVAL (i * 29 + k * 5) DAY AS asked FROM range(40) e(i), range(12) s(k)),
own AS (SELECT *, knowledge_time AS kt FROM b WHERE entity = '2-HIGH'),
p AS (SELECT g.*, n.close AS now, l.close AS later FROM g ASOF LEFT JOIN own n ON n.kt <= g.asked ASOF LEFT JOIN own l ON l.event_time >= g.asked + INTERVAL 5 DAY),
r AS (SELECT episode_id, 'forecast' AS task, step, asked, 'up' AS action, CASE WHEN now IS NULL OR later IS NULL THEN 0.0::DOUBLE WHEN later >= now THEN 1.0 ELSE -1.0 END AS reward FROM p
UNION ALL SELECT episode_id, 'trading', step, asked, 'long', coalesce(round((later - now) / nullif(now, 0) * 100, 4), 0.0) FROM p)
SELECT episode_id, task, step, strftime(asked, '%Y-%m-%d %H:%M:%S') AS as_of, action, step = 11 AS done, reward + 0.0 AS reward,
round(sum(reward) OVER (PARTITION BY episode_id, task ORDER BY step), 3) + 0.0 AS cum_reward FROM r"""


def trajectory_sink(s: SparkSession, d: str) -> DataFrame:
    """The log written to a lake by task and episode, and what the lake then holds."""
    lake = Lake(s, scratch(s, "trajectories"))
    episodes.write_trajectories(lake, _log(s, d, "forecast", "down"))
    return lake.scan("trajectories", "env").groupBy("task", "episode", "agent").agg(F.count("*").alias("steps"), F.max("step").cast("long").alias("last"))


SINK_SQL = "SELECT 'forecast' AS task, format('e{:03d}', i) AS episode, 'baseline' AS agent, CAST(12 AS BIGINT) AS steps, CAST(11 AS BIGINT) AS last FROM range(40) t(i)"


def feature_shards(s: SparkSession, d: str) -> DataFrame:
    """Derived kinds written to a lake, what is there already skipped, a kind without its source named by the error; and
    the rows of each shard with their envelope."""
    own = {("positioning", "sec_form4"): table(s, d, "insider_form4"), ("ownership", "sec_13f"): table(s, d, "holdings_13f"), ("reference", "master"): table(s, d, "security_master"), ("macro", "alfred"): vintages(s, d)}
    source, lake = _Tables(s, d, own), Lake(s, scratch(s, "derived"))
    kinds = ["technical", "insider_flow", "nodes", "ownership", "insider", "surprise", "prediction_momentum"]
    first, again = derived.write_derived(source, lake, kinds), derived.write_derived(source, lake, ["technical"])
    told = s.createDataFrame([*first, ("technical again", again[0][1])], "kind string, done string")
    held = None
    for domain, src in (("features", "derived"), ("graph", "derived"), ("derived", "surprise")):
        df = lake.scan(domain, src).where("knowledge_time is not null and content_hash is not null").groupBy("kind").agg(F.count("*").alias("n_rows"), F.max("source_url").alias("url"))
        held = df if held is None else held.unionByName(df)
    return told.join(held, "kind", "left")


_SHARDS = {
    "technical": (f"FROM {BARS}", "features"), "insider_flow": ("FROM (SELECT DISTINCT entity, date_trunc('month', event_time AT TIME ZONE 'UTC') FROM insider_form4 WHERE txn_code IN ('P', 'S'))", "features"),
    "nodes": ("FROM security_master WHERE record_type = 'identity'", "graph"), "ownership": ("FROM holdings_13f WHERE issuer IS NOT NULL AND issuer <> ''", "graph"), "insider": ("FROM insider_form4 WHERE owner_name IS NOT NULL AND owner_name <> ''", "graph"),
    "surprise": (f"FROM (SELECT entity, row_number() OVER (PARTITION BY entity ORDER BY event_time) AS i FROM (SELECT DISTINCT entity, event_time FROM {VINTAGES})) WHERE i > 1", "derived"),
}
SHARDS_SQL = " UNION ALL ".join(f"SELECT '{k}' AS kind, 'written' AS done, count(*) AS n_rows, 'derived:{domain}/{k}' AS url {text}" for k, (text, domain) in _SHARDS.items())
SHARDS_SQL += " UNION ALL SELECT 'prediction_momentum', 'KeyError', NULL, NULL UNION ALL SELECT 'technical again', 'skipped', NULL, NULL"


def known_prices(s: SparkSession, d: str) -> DataFrame:
    """The close known at each of many moments, by one sweep."""
    from tidemark.operators.asof import known_value

    times = F.expr("transform(sequence(0, 299), i -> timestamp'1995-06-03' + make_dt_interval(0, i * 211))")
    b = bars(s, d)
    moments = b.select("entity").distinct().select("entity", F.explode(times).alias("at"))
    return known_value(b, moments).select("entity", us("at"), F.round("close", 4).alias("close"))


KNOWN_SQL = f"""SELECT m.entity, epoch_us(m.at) AS at, round(b.close, 4) AS close FROM (SELECT p.entity, x.at FROM (SELECT DISTINCT o_orderpriority AS entity FROM orders) p, (SELECT TIMESTAMP '1995-06-03' + INTERVAL (i * 211) HOUR AS at FROM range(300) t(i)) x) m
ASOF LEFT JOIN {BARS} b ON b.entity = m.entity AND b.knowledge_time <= m.at"""


def queries() -> dict:
    return {f.__name__: f for f in (observation_packet, episode_rewards, trajectory_sink, feature_shards, known_prices)}


def sql() -> dict:
    return {"observation_packet": OBSERVATION_SQL, "episode_rewards": EPISODE_SQL, "trajectory_sink": SINK_SQL, "feature_shards": SHARDS_SQL, "known_prices": KNOWN_SQL}
