"""Queries of the text problems, and SQL for those that it can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.batches import cleared
from tidemark.llm.bpe import token_ids
from tidemark.llm.matching import check_digit_fits, matched
from tidemark.llm.mixing import mixed
from tidemark.llm.pairs import Baskets, associations, gather, numbered, wrong_weights
from tidemark.llm.reading import ENGLISH_FROM, reading_levels
from tidemark.llm.variants import linked, variant_pairs
from tidemark.operators.packed import split_packed
from tidemark.plans.problems import split_sql, tails_sql
from tidemark.session import scratch
from tidemark.tables import table


def co_mentions(spark: SparkSession, root: str) -> Baskets:
    """Articles (urls) as baskets of organisations; parts are quarters."""
    news = table(spark, root, "news_gkg").where("url is not null")
    quarter = F.date_format(F.date_trunc("quarter", "event_time"), "yyyy-MM-dd")
    src = news.select(F.col("url").alias("basket"), quarter.alias("quarter"), "organizations")
    return gather(split_packed(src, "organizations", ["basket", "quarter"], flat=False), "basket", "quarter", "items", keys=src)


def p2_associations(spark: SparkSession, root: str) -> DataFrame:
    """Pairs of organisations with at least 8 articles in common, with counts, lift and conviction."""
    baskets = co_mentions(spark, root)
    return associations(*numbered(baskets, 8), baskets.total)


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    """Pairs far above chance, and co-mention edges whose weight is wrong."""
    edges = table(spark, root, "entity_graph").where("kind = 'co_mention' and entity is not null and dst is not null and entity != dst and event_time is not null")
    edges = edges.select(F.date_format(F.date_trunc("quarter", "event_time"), "yyyy-MM-dd").alias("part"), F.least("entity", "dst").alias("item_a"), F.greatest("entity", "dst").alias("item_b"), "weight").distinct()
    baskets = co_mentions(spark, root)
    rows, words = numbered(baskets, 8, edges.select(F.explode(F.array("item_a", "item_b")).alias("name")))
    strong = associations(rows, words, baskets.total).where("together * total >= 10 * n_a * n_b")
    wrong = wrong_weights(rows, words, edges)
    case = lambda kind, df, quarter: df.select(F.lit(kind).alias("case_kind"), F.col("item_a").alias("org_a"), F.col("item_b").alias("org_b"), quarter.alias("quarter_start"))
    return case("association", strong, F.lit("")).unionByName(case("weight", wrong, F.col("part")))


def p5_spellings(spark: SparkSession, root: str) -> DataFrame:
    """Every spelling of a person or organisation with its group: field_name, scope_key, name, cluster."""
    names = lambda df, field, column, scope: df.select(F.lit(field).alias("field_name"), scope.alias("scope_key"), F.col(column).alias("name")).distinct()
    persons = names(table(spark, root, "insider_form4"), "insider_form4.owner_name", "owner_name", F.coalesce("entity", F.lit("")))
    news = table(spark, root, "news_gkg").where("url is not null")
    orgs = split_packed(news.select("organizations"), "organizations", [])
    firms = (
        names(table(spark, root, "holdings_13f"), "holdings_13f.issuer", "issuer", F.lit(""))
        .unionByName(names(table(spark, root, "clinical_trials"), "clinical_trials.sponsor", "sponsor", F.lit("")))
        .unionByName(names(orgs, "news_gkg.organizations", "item_value", F.lit("")))
    )
    return linked(persons, True, (2, 3), 0.2).unionByName(linked(firms, False, (3,), 0.3))


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    """All pairs of spellings that mean the same person or organisation."""
    return variant_pairs(p5_spellings(spark, root))


def p6_matches(spark: SparkSession, root: str) -> DataFrame:
    """Issuers of 13F (the first six signs of their CUSIPs) and companies (CIK), with the confidence of each match."""
    lines = table(spark, root, "holdings_13f").where("cusip is not null")
    lines = lines.select(F.substring(F.upper(F.regexp_replace("cusip", r"\s", "")), 1, 9).alias("cusip"), "issuer", "event_time", (F.col("value_usd_thousands") * 1000 / F.nullif("shares", F.lit(0.0))).alias("price"))
    lines = lines.where(check_digit_fits(F.col("cusip"))).withColumn("l", F.substring("cusip", 1, 6))
    left = lines.where("issuer is not null and trim(issuer) != ''").groupBy(F.col("l").alias("entity"), F.col("issuer").alias("name")).agg(F.count("*").alias("n"))
    day = lambda c: F.col(c).cast("date")
    implied = lines.where("price > 0").groupBy("l", day("event_time").alias("day")).agg(F.percentile_approx("price", 0.5, 1000).alias("price"))
    master = table(spark, root, "security_master").where("cik is not null and record_type = 'identity'").select("entity", F.regexp_replace(F.trim("cik"), "^0+", "").alias("r"), "name").where("r != ''")
    right = master.where("name is not null and trim(name) != ''").groupBy(F.col("r").alias("entity"), "name").agg(F.count("*").alias("n"))
    days = implied.select("day").distinct()
    bars = table(spark, root, "features").where("close > 0").select("entity", day("event_time").alias("day"), "close")
    closes = bars.join(days, "day", "left_semi").join(master.select("entity", "r").distinct(), "entity").groupBy("r", "day").agg(F.percentile_approx("close", 0.5, 1000).alias("close"))
    return matched(left, right, implied, closes).select(F.col("r").alias("cik"), F.col("l").alias("issuer_number"), "confidence", "support")


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    """Each full CUSIP of a company that has a CIK."""
    cusips = table(spark, root, "holdings_13f").where(check_digit_fits(F.col("cusip"))).select("cusip").distinct()
    matches = p6_matches(spark, root).select("cik", "issuer_number")
    return cusips.withColumn("issuer_number", F.substring("cusip", 1, 6)).join(matches, "issuer_number").select("cik", "cusip")


def p7_found(spark: SparkSession, root: str) -> DataFrame:
    """Rows of Form 4 that report a transaction again, with its first row: batches of days through a history that begins empty."""
    return cleared(table(spark, root, "insider_form4"), scratch(spark, "history"))


def p8_ids(spark: SparkSession, root: str) -> DataFrame:
    """Ids of each document's text; null and empty texts have none."""
    return table(spark, root, "documents").select("doc_id", token_ids(F.col("text")).alias("ids"))


def p9_mix(spark: SparkSession, root: str) -> DataFrame:
    """The mixture's report: what each source was to contribute, and what it does."""
    return mixed(table(spark, root, "documents"), table(spark, root, "mix_targets"))[1]


def p9_selection(spark: SparkSession, root: str) -> DataFrame:
    """The mixture itself: each document used, for which source, and how often."""
    return mixed(table(spark, root, "documents"), table(spark, root, "mix_targets"))[0]


def p10_levels(spark: SparkSession, root: str) -> DataFrame:
    """Reading level of each document with a word, with the measures behind it."""
    return reading_levels(table(spark, root, "documents"), table(spark, root, "reading_labels"))


def p10_found(spark: SparkSession, root: str) -> DataFrame:
    """English documents of at least 60 words at level 4 or 5."""
    return p10_levels(spark, root).where(f"english > {ENGLISH_FROM} and pieces >= 60 and level >= 4").select("doc_id")


def p10_profile(spark: SparkSession, root: str) -> DataFrame:
    """Number of English documents of each source and level."""
    docs = table(spark, root, "documents").select("doc_id", "source")
    levels = p10_levels(spark, root).where(f"english > {ENGLISH_FROM} and pieces >= 60").select("doc_id", "level")
    return docs.join(levels, "doc_id").groupBy("source", "level").agg(F.count("*").alias("documents"))


def queries() -> dict:
    return {"p2_found": p2_found, "p2_associations": p2_associations, "p5_found": p5_found, "p5_spellings": p5_spellings, "p6_found": p6_found, "p6_matches": p6_matches, "p7_found": p7_found, "p8_ids": p8_ids, "p9_mix": p9_mix, "p9_selection": p9_selection, "p10_found": p10_found, "p10_levels": p10_levels, "p10_profile": p10_profile}


P2_SQL = f"""
WITH {tails_sql("url", "news_gkg", "organizations")},
p AS (SELECT DISTINCT record_key AS url, item_value AS item FROM ({split_sql("f", "news_gkg", "organizations", "url")})),
n AS (SELECT item, count(*) AS n FROM p GROUP BY 1),
pairs AS (SELECT a.item AS org_a, b.item AS org_b, count(*) AS k FROM p a JOIN p b ON a.url = b.url AND a.item < b.item GROUP BY 1, 2),
quarters AS (SELECT DISTINCT url, strftime(date_trunc('quarter', event_time AT TIME ZONE 'UTC'), '%Y-%m-%d') AS q FROM news_gkg),
edges AS (SELECT DISTINCT strftime(date_trunc('quarter', event_time AT TIME ZONE 'UTC'), '%Y-%m-%d') AS q, least(entity, dst) AS org_a, greatest(entity, dst) AS org_b, weight
          FROM entity_graph WHERE kind = 'co_mention' AND entity <> dst),
held AS (SELECT e.q, e.org_a, e.org_b, count(DISTINCT a.url) AS k FROM (SELECT DISTINCT q, org_a, org_b FROM edges) e
         JOIN p a ON a.item = e.org_a JOIN p b ON b.item = e.org_b AND b.url = a.url JOIN quarters u ON u.url = a.url AND u.q = e.q GROUP BY ALL)
SELECT 'association' AS case_kind, org_a, org_b, '' AS quarter_start FROM pairs JOIN n x ON x.item = org_a JOIN n y ON y.item = org_b
WHERE k >= 8 AND k * (SELECT count(DISTINCT url) FROM news_gkg) >= 10 * x.n * y.n
UNION ALL
SELECT DISTINCT 'weight', e.org_a, e.org_b, e.q FROM edges e LEFT JOIN held h ON h.q = e.q AND h.org_a = e.org_a AND h.org_b = e.org_b
WHERE e.weight IS NULL OR e.weight <> coalesce(h.k, 0)
"""


def sql() -> dict:
    return {"p2_found": P2_SQL}
