"""Derived features: windows over time series, monthly and weekly aggregates, regimes and surprises.

Frames count rows, as the series are daily; they are not gated by a least number of rows unless said. A ratio whose
divisor is 0 is null, never infinite. Knowledge time of an aggregate is the greatest of its inputs' (`bucket_start=True`
stamps the start of the bucket plus a day, which looks ahead)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import correlation, gated, growth, pct_rank, ratio, zscore
from tidemark.operators.asof import first_release

YEAR = 252


def technical(bars: DataFrame) -> DataFrame:
    """Returns, moving averages, volatility, distance from the high and RSI of `close` by entity."""
    by_time = Window.partitionBy("entity").orderBy("event_time")
    last = lambda n: by_time.rowsBetween(1 - n, 0)
    close = F.col("close")
    df = bars.select("entity", "event_time", "knowledge_time", "close", growth(close, F.lag("close", 1).over(by_time)).alias("ret_1d"))
    up, down = F.avg(F.greatest(F.col("ret_1d"), F.lit(0.0))).over(last(14)), F.avg(F.greatest(-F.col("ret_1d"), F.lit(0.0))).over(last(14))
    sma50, sma200 = F.avg("close").over(last(50)), F.avg("close").over(last(200))
    return df.select(
        "*",
        growth(close, F.lag("close", 21).over(by_time)).alias("ret_1m"),
        growth(close, F.lag("close", YEAR).over(by_time)).alias("ret_12m"),
        sma50.alias("sma50"),
        sma200.alias("sma200"),
        (F.stddev_samp("ret_1d").over(last(21)) * F.sqrt(F.lit(float(YEAR)))).alias("vol_21d"),
        growth(close, F.max("close").over(last(YEAR))).alias("dist_52w_high"),
        (100.0 - ratio(F.lit(100.0), 1.0 + ratio(up, down))).alias("rsi14"),
        (close > sma50).cast("byte").alias("above_sma50"),
        (close > sma200).cast("byte").alias("above_sma200"),
    )


def regime(fear: DataFrame, curve: DataFrame, spread: DataFrame) -> DataFrame:
    """Risk regime from three daily series (event_time, knowledge_time, value), joined by day.

    The series are one market's, a row a day, so a window over all of them is small by nature."""
    one = lambda df, n: df.groupBy("event_time").agg(F.min_by("value", "knowledge_time").alias(n), F.min("knowledge_time").alias(f"kt_{n}"))
    df = one(fear, "vix").join(one(curve, "curve_2s10s"), "event_time").join(one(spread, "hy_spread"), "event_time")
    df = df.withColumn("_market", F.lit("MARKET"))
    order = Window.partitionBy("_market").orderBy("event_time")
    year = order.rowsBetween(1 - YEAR, 0)
    df = df.select(
        "event_time",
        F.greatest("kt_vix", "kt_curve_2s10s", "kt_hy_spread").alias("knowledge_time"),
        "vix",
        pct_rank(F.col("vix"), year, 30).alias("vix_pct_252"),
        "curve_2s10s",
        (F.col("curve_2s10s") < 0).cast("byte").alias("curve_inverted"),
        "hy_spread",
        (F.col("hy_spread") - F.lag("hy_spread", 21).over(order)).alias("hy_chg_21"),
        F.round(-zscore(F.col("vix"), year, 30) - zscore(F.col("hy_spread"), year, 30), 3).alias("risk_appetite"),
    )
    off = (F.col("vix_pct_252") > 0.8) | (F.col("hy_chg_21") > 0.5)
    on = (F.col("vix_pct_252") < 0.4) & (F.col("hy_chg_21") < 0)
    return df.withColumn("regime", F.when(on, "risk_on").when(off, "risk_off").otherwise("neutral"))


def insider_flow(trades: DataFrame) -> DataFrame:
    """Net shares and counts of open-market trades by entity and month."""
    bought, sold = F.col("acq_disp") == "A", F.col("acq_disp") == "D"
    flow = trades.where(F.col("txn_code").isin("P", "S")).groupBy("entity", F.date_trunc("month", "event_time").alias("month"))
    flow = flow.agg(
        F.sum(F.when(bought, F.col("shares")).when(sold, -F.col("shares"))).alias("net_shares"),
        F.count(F.when(bought & F.col("shares").isNotNull(), 1)).alias("n_buys"),
        F.count(F.when(sold & F.col("shares").isNotNull(), 1)).alias("n_sells"),
        F.max("knowledge_time").alias("knowledge_time"),
    )
    return flow.withColumn("net_score", ratio((F.col("n_buys") - F.col("n_sells")).cast("double"), (F.col("n_buys") + F.col("n_sells")).cast("double")))


def last_daily(quotes: DataFrame, value: str, order: list[str]) -> DataFrame:
    """The last value of each entity and day."""
    day = F.date_trunc("day", "event_time")
    return quotes.groupBy("entity", day.alias("event_time")).agg(F.max_by(value, F.struct(*order)).alias(value), F.max("knowledge_time").alias("knowledge_time"))


def row_change(df: DataFrame, value: str, rows: int, relative: bool) -> Column:
    """Change of `value` against `rows` rows before, within the entity."""
    before = F.lag(value, rows).over(Window.partitionBy("entity").orderBy("event_time", "knowledge_time"))
    return growth(F.col(value), before) if relative else F.col(value) - before


def prediction_momentum(quotes: DataFrame, rows: int = 30) -> DataFrame:
    """Mean probability by (entity, event time, knowledge time) and its change over `rows` rows."""
    df = quotes.groupBy("entity", "event_time", "knowledge_time").agg(F.avg("probability").alias("probability"))
    return df.withColumn("prob_chg_30d", row_change(df, "probability", rows, False))


def series_momentum(df: DataFrame, rows: int = 30) -> DataFrame:
    """Relative change of each series over `rows` rows."""
    return df.select("entity", "event_time", "knowledge_time", "value", row_change(df, "value", rows, True).alias("chg_30d"))


def news_sentiment(articles: DataFrame, least_mentions: int = 200, top: int | None = 2500, bucket_start: bool = False) -> DataFrame:
    """Weekly mean tone and count of organisations with at least `least_mentions` mentions, the `top` most named.

    Organisations are the parts of the field between comma and blank, longer than two signs."""
    org = F.explode(F.transform(F.split("organizations", ", "), lambda x: F.trim(x)))
    named = articles.where("tone is not null and organizations is not null").select("event_time", "knowledge_time", "tone", org.alias("entity")).where(F.length("entity") > 2)
    counts = named.groupBy("entity").agg(F.count("*").alias("_n")).where(F.col("_n") >= least_mentions)
    if top:
        counts = counts.orderBy(F.desc("_n"), "entity").limit(top)
    week = F.date_trunc("week", "event_time")
    out = named.join(counts, "entity", "left_semi").groupBy("entity", week.alias("week"))
    out = out.agg(F.avg("tone").alias("tone"), F.count("*").alias("n_articles"), F.max("knowledge_time").alias("knowledge_time"))
    return out.withColumn("knowledge_time", F.col("week") + F.expr("INTERVAL 1 DAY")) if bucket_start else out


def fundamentals_growth(facts: DataFrame, concepts: list[str], form: str = "10-K", keys: tuple[str, ...] = ("entity", "concept")) -> DataFrame:
    """Change against the period before, of values as released first; `keys` tell the series apart."""
    first = first_release(facts.where((F.col("form") == form) & F.col("concept").isin(concepts) & F.col("value").isNotNull()), (*keys, "event_time"))
    before = F.lag("value").over(Window.partitionBy(*keys).orderBy("event_time"))
    return first.select(*keys, "event_time", "knowledge_time", "value", growth(F.col("value"), before).alias("yoy"))


def pivot_returns(bars: DataFrame, entities: list[str]) -> DataFrame:
    """event_time and the daily return of each entity as a column; days without the first one are left out."""
    ret = growth(F.col("close"), F.lag("close").over(Window.partitionBy("entity").orderBy("event_time")))
    daily = bars.where(F.col("entity").isin(entities)).select("entity", "event_time", ret.alias("r"))
    wide = daily.groupBy("event_time").agg(*(F.max(F.when(F.col("entity") == e, F.col("r"))).alias(f"ret_{i}") for i, e in enumerate(entities)))
    return wide.where("ret_0 is not null")


def cross_asset(bars: DataFrame, entities: list[str], rows: int = 60) -> DataFrame:
    """Rolling correlation of the first entity's returns with those of the others; one market, so one window."""
    wide = pivot_returns(bars, entities).withColumn("_market", F.lit("MARKET"))
    w = Window.partitionBy("_market").orderBy("event_time").rowsBetween(1 - rows, 0)
    return wide.select("event_time", *(correlation(F.col("ret_0"), F.col(f"ret_{i}"), w).alias(f"corr_{i}") for i in range(1, len(entities))))


def centrality(edges: DataFrame) -> DataFrame:
    """Weighted degree and number of edges of both ends, by time."""
    ends = edges.select(F.explode(F.array("entity", "dst")).alias("entity"), "event_time", "knowledge_time", "weight")
    return ends.groupBy("entity", "event_time").agg(F.sum("weight").alias("degree"), F.count("*").alias("n_edges"), F.max("knowledge_time").alias("knowledge_time"))


def surprise(releases: DataFrame, rows: int = 20, least: int = 5) -> DataFrame:
    """First release minus the one before, and its score against the last `rows` surprises."""
    w = Window.partitionBy("entity").orderBy("event_time")
    df = first_release(releases).select("entity", "event_time", "knowledge_time", F.col("value").alias("actual"), F.lag("value").over(w).alias("forecast"))
    df = df.withColumn("surprise", F.col("actual") - F.col("forecast"))
    frame = w.rowsBetween(1 - rows, 0)
    z = gated(ratio(F.col("surprise") - F.avg("surprise").over(frame), F.stddev_samp("surprise").over(frame)), F.col("surprise"), frame, least)
    return df.withColumn("surprise_z", z).where("surprise is not null")
