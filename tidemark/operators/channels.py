"""Observation channels and query tools of the environment, as functions of a lake and a moment.

A lake is anything with `scan(domain, source, kind=None)`; each function returns a lazy DataFrame, so one observation is
a set of plans, and the batch form is `asof.observed_on_grid`. A tool has a tier and a cost in budget units.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import text_contains
from tidemark.operators import asof, graph



def _newest(df: DataFrame, n: int, *more: str) -> DataFrame:
    order = [F.col(c).desc_nulls_last() for c in ("event_time", "knowledge_time", *more) if c in df.columns]
    return df.orderBy(*order).limit(n)


def regime(features: DataFrame, t) -> DataFrame:
    return _newest(asof.as_of(features, t).where("kind = 'regime'"), 1)


def prices(bars: DataFrame, t, watchlist: list[str]) -> DataFrame:
    return asof.latest_by_event(bars, t, watchlist).select("entity", "close")


def levels(series: DataFrame, t, ids: list[str] | None = None, value: str = "value") -> DataFrame:
    """Rates, macro, credit, commodities, fear and greed: the last known value of each series."""
    return asof.latest_per_entity(series, t, ids).select("entity", value)


def crypto(bars: DataFrame, fear: DataFrame, vol: DataFrame, t, digits: tuple[int, int, int] = (0, 0, 2)) -> DataFrame:
    """Last values of coins, fear and greed, and implied volatility, rounded to `digits`, in one column; an observation
    shows them with (1, 0, 1)."""
    one = lambda df, c, d: asof.latest_per_entity(df, t).select("entity", F.round(c, d).alias("value"))
    return one(bars, "close", digits[0]).unionByName(one(fear, "fng_value", digits[1])).unionByName(one(vol, "dvol_close", digits[2]))


def news(articles: DataFrame, posts: DataFrame | None, t, n: int = 8) -> DataFrame:
    """Articles of two days with the strongest tone; without any, posts of seven days with the most points."""
    a = asof.trailing(articles, t, 2).where(F.length("title") > 20).select("title", F.col("site_domain").alias("outlet"), F.abs("tone").alias("strength"))
    out = a.withColumn("_k", F.lit(1))
    if posts is not None:
        out = asof.fallback([out, asof.trailing(posts, t, 7).select("title", F.lit("hackernews").alias("outlet"), F.col("points").cast("double").alias("strength"), F.lit(1).alias("_k"))], ["_k"])
    return out.drop("_k").orderBy(F.col("strength").desc_nulls_last(), "title").limit(n)


def markets(quotes: DataFrame, t, n: int = 5) -> DataFrame:
    """The last quote of each market, those with the most volume."""
    return asof.latest_by_event(quotes, t).orderBy(F.col("volume").desc_nulls_last(), "entity").limit(n).select("entity", "question", "probability", "volume")


def shocks(quakes: DataFrame, t, least: float = 6.0, days: int = 14, n: int = 3) -> DataFrame:
    """Strong events of the last days, as text."""
    strong = asof.trailing(quakes, t, days).where(F.col("magnitude") >= least)
    return strong.orderBy(F.col("magnitude").desc(), F.col("event_time").desc(), "place").limit(n).select(F.concat(F.lit("quake M"), F.format_number("magnitude", 1), F.lit(" "), "place").alias("event"), "magnitude")


@dataclass(frozen=True)
class Tool:
    name: str
    tier: str
    cost: int
    run: Callable[..., DataFrame]


TIERS = ("basic", "pro")


def price_history(lake, t, ticker: str, n: int = 10) -> DataFrame:
    return _newest(asof.as_of(lake.scan("market", "yahoo"), t).where(F.col("entity") == ticker), n).select("event_time", "close", "volume")


# Concepts that the tool reports.
CONCEPTS = ("Revenues", "NetIncomeLoss", "Assets", "StockholdersEquity", "EarningsPerShareDiluted")


def fundamentals(lake, t, ticker: str | None, concepts: tuple[str, ...] = CONCEPTS) -> DataFrame:
    """The last known value of each concept, of one ticker or of all; of rows of one release the greatest unit."""
    df = asof.as_of(lake.scan("fundamentals", "sec_xbrl"), t).where(F.col("concept").isin(*concepts))
    df = df.where(F.col("entity") == ticker) if ticker is not None else df
    out = asof.latest(df, ["entity", "concept"], (*asof.TIES, "unit", "value")).select("entity", "concept", "value", "unit", "event_time")
    return out.drop("entity") if ticker is not None else out


def positioning(lake, t, ticker: str) -> DataFrame:
    return _newest(asof.as_of(lake.scan("positioning", "finra_short"), t).where(F.col("entity") == ticker), 1)


def filing_texts(filings: DataFrame, t, most: int = 500) -> DataFrame:
    """The start of the newest filing of each entity, whatever its form."""
    return asof.latest_per_entity(filings, t).select("entity", "form", "event_time", F.substring("text", 1, most).alias("excerpt"))


def filing_text(lake, t, ticker: str, most: int = 500) -> DataFrame:
    return filing_texts(lake.scan("filings_text", "edgar").where(F.col("entity") == ticker), t, most).drop("entity")


def onchain(lake, t, metric: str) -> DataFrame:
    return _newest(asof.as_of(lake.scan("onchain", "blockchain"), t).where(F.col("metric") == metric), 1).select("metric", "event_time", "value")


def prediction_market(lake, t, words: str, n: int = 6) -> DataFrame:
    """Markets of all venues whose question holds the words, n of each venue by volume; a venue without volume has 0."""
    out = None
    for venue, question in (("manifold", "question"), ("polymarket", "question"), ("kalshi", "title")):
        df = lake.scan("predictions", venue)
        volume = F.col("volume") if "volume" in df.columns else F.lit(0.0)
        df = asof.latest_by_event(df.where(text_contains(F.col(question), words)), t).select(F.lit(venue).alias("venue"), F.col(question).alias("question"), "probability", volume.alias("volume"))
        df = df.orderBy(F.col("volume").desc_nulls_last(), "question", F.col("probability").desc()).limit(n)
        out = df if out is None else out.unionByName(df)
    return out


def defi_tvl(lake, t, series: str) -> DataFrame:
    return _newest(asof.as_of(lake.scan("crypto_defi", "defillama"), t).where(F.col("entity") == series), 1).select("entity", "event_time", "value")


def related_entities(lake, t, entity: str) -> DataFrame:
    return graph.neighbours(lake.scan("graph", "derived"), entity, t)


def macro_series(lake, t, series: str | None) -> DataFrame:
    """The last known row of a series, or of all, in the first of the four places that has it."""
    places = (("macro", "alfred"), ("credit", "fred"), ("commodity", "fred"), ("real_estate", "fred"))
    frames = [asof.latest_per_entity(lake.scan(d, s), t, [series] if series is not None else None).select("entity", "event_time", "value", "knowledge_time") for d, s in places]
    return asof.fallback(frames, ["entity"])


def get_features(lake, t, ticker: str) -> DataFrame:
    return _newest(asof.as_of(lake.scan("features", "derived", "technical"), t).where(F.col("entity") == ticker), 1)


def market_regime(lake, t) -> DataFrame:
    return regime(lake.scan("features", "derived", "regime"), t)


def news_search(lake, t, words: str, n: int = 10) -> DataFrame:
    df = asof.as_of(lake.scan("news", "gdelt_gkg"), t).where(text_contains(F.col("title"), words) | text_contains(F.col("organizations"), words))
    return df.orderBy(F.col("knowledge_time").desc(), "url", "content_hash").limit(n).select("title", F.col("site_domain").alias("outlet"), "tone", "url", "knowledge_time")


def recent_shocks(lake, t, least: float = 6.0) -> DataFrame:
    return shocks(lake.scan("events", "usgs"), t, least, 30, 5)


# Names, tiers and costs of the tools.
REGISTRY = {
    t.name: t
    for t in (
        Tool("price_history", "basic", 1, price_history), Tool("fundamentals", "pro", 1, fundamentals), Tool("positioning", "pro", 1, positioning),
        Tool("filing_text", "pro", 2, filing_text), Tool("onchain", "pro", 1, onchain), Tool("prediction_market", "pro", 1, prediction_market),
        Tool("defi_tvl", "pro", 1, defi_tvl), Tool("related_entities", "pro", 1, related_entities), Tool("macro_series", "basic", 1, macro_series),
        Tool("get_features", "basic", 1, get_features), Tool("market_regime", "basic", 1, market_regime), Tool("news_search", "pro", 1, news_search),
        Tool("recent_shocks", "pro", 1, recent_shocks),
    )
}


def available(tier: str) -> list[str]:
    """Names of the tools that a caller of the tier may run."""
    return [n for n, t in REGISTRY.items() if TIERS.index(t.tier) <= TIERS.index(tier)]
