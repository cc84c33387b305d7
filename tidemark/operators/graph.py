"""Entity graph: nodes, ownership, insider and co-mention edges, and neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import text_contains
from tidemark.operators.asof import as_of


def nodes(identities: DataFrame, times: bool = False) -> DataFrame:
    """Company nodes of identity rows, with their times if asked for."""
    return identities.where("record_type = 'identity'").select(*(["event_time", "knowledge_time"] if times else []), "entity", "cik", "name", "exchange", F.lit("company").alias("node_type"))


def ownership(holdings: DataFrame) -> DataFrame:
    """manager -owns-> issuer; lines without issuer have no edge."""
    return holdings.where("issuer is not null and issuer != ''").select("event_time", "knowledge_time", "entity", F.lit("owns").alias("rel"), F.col("issuer").alias("dst"), F.col("value_usd_thousands").alias("value"), "shares")


def insider(trades: DataFrame) -> DataFrame:
    """person -insider_of-> ticker."""
    return trades.where("owner_name is not null and owner_name != ''").select("event_time", "knowledge_time", F.col("owner_name").alias("entity"), F.lit("insider_of").alias("rel"), F.col("entity").alias("dst"), "shares", "txn_code", "acq_disp")


def co_mention(articles: DataFrame, least_mentions: int = 100, top: int | None = 3000, least_weight: int = 3) -> DataFrame:
    """org -co_mention- org by quarter, for organisations named often; org < dst; weight counts articles.

    Names that cannot reach the threshold fall out before pairs are made, and equal sets of names of a quarter are
    collapsed first, so pairs are made once for each different set."""
    org = F.explode(F.transform(F.split("organizations", ", "), lambda x: F.trim(x)))
    quarter = F.date_trunc("quarter", "event_time")
    named = articles.where("organizations is not null and url is not null").select("url", quarter.alias("quarter"), "knowledge_time", org.alias("org")).where(F.length("org") > 2)
    counts = named.groupBy("org").agg(F.count("*").alias("_n")).where(F.col("_n") >= least_mentions)
    if top:
        counts = counts.orderBy(F.desc("_n"), "org").limit(top)
    baskets = named.join(counts, "org", "left_semi").groupBy("url", "quarter").agg(F.sort_array(F.collect_set("org")).alias("orgs"), F.max("knowledge_time").alias("kt")).where(F.size("orgs") > 1)
    sets = baskets.groupBy("quarter", "orgs").agg(F.count("*").alias("w"), F.max("kt").alias("kt"))
    first = sets.select("*", F.posexplode("orgs").alias("i", "entity"))
    pairs = first.select("quarter", "w", "kt", "entity", F.explode(F.expr("slice(orgs, i + 2, size(orgs))")).alias("dst"))
    out = pairs.groupBy("quarter", "entity", "dst").agg(F.sum("w").alias("weight"), F.max("kt").alias("knowledge_time"))
    return out.where(F.col("weight") >= least_weight)


def neighbours(edges: DataFrame, text: str, t, n: int = 20) -> DataFrame:
    """The newest n edges known at t with `text` in either end."""
    near = as_of(edges, t).where("kind != 'nodes'").where(text_contains(F.col("entity"), text) | text_contains(F.col("dst"), text))
    return near.orderBy(F.col("knowledge_time").desc(), "entity", "dst", F.col("event_time").desc(), "content_hash").limit(n)
