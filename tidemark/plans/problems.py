"""Queries of the general data problems, and SQL for those that it can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.known import attributes_as_known
from tidemark.operators.late import late_corrected
from tidemark.operators.packed import phase_separators, values_of
from tidemark.tables import table


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    """Every value of the packed fields of the lake: field_name, record_key, item_pos, item_value."""
    news, trials = table(spark, root, "news_gkg"), table(spark, root, "clinical_trials")
    return (
        values_of(news, "organizations", "url", "news_gkg.organizations")
        .unionByName(values_of(trials, "conditions", "nct_id", "clinical_trials.conditions"))
        .unionByName(values_of(trials, "phase", "nct_id", "clinical_trials.phase", phase_separators()))
    )


CONCEPTS = ("Revenues", "NetIncomeLoss")


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    """For each event of `features`: the vintage of each concept, and the index membership, known by then."""
    events = table(spark, root, "features").select("entity", F.col("event_time").alias("at"))
    facts = table(spark, root, "fundamentals_sec").where(F.col("concept").isin(*CONCEPTS) & (F.col("unit") == "USD") & F.col("value").isNotNull())
    facts = facts.select("entity", F.col("concept").alias("series"), F.col("knowledge_time").alias("known"), F.col("event_time").alias("r1"), F.col("knowledge_time").alias("r2"), F.coalesce("vintage_id", F.lit("")).alias("payload"))
    moves = table(spark, root, "security_master").where("record_type = 'change' and event_time is not null and knowledge_time is not null")
    moves = moves.select("entity", F.lit("membership").alias("series"), F.greatest("event_time", "knowledge_time").alias("known"), F.col("event_time").alias("r1"), F.col("knowledge_time").alias("r2"), F.col("action").alias("payload"))
    found = attributes_as_known(events, facts.unionByName(moves), [*CONCEPTS, "membership"])
    return found.select(
        "entity",
        F.date_format("at", "yyyy-MM-dd").alias("event_day"),
        F.inline(F.array(*(F.struct(F.lit(c).alias("concept"), F.coalesce(F.col(c), F.lit("")).alias("vintage_id")) for c in CONCEPTS))),
        F.when(F.col("membership") == "added", "member").otherwise("not_member").alias("membership"),
    ).distinct()


LATE_RULES = {"insider_form4": ("month", 5, 60, "shares"), "holdings_13f": ("quarter", 46, 150, "value_usd_thousands")}


def p4_totals(spark: SparkSession, root: str) -> DataFrame:
    """Totals by entity and period of both tables: final, corrected and dropped."""
    shown = [F.date_format("period_start", "yyyy-MM-dd").alias("period_start"), "outcome", "n_rows", *(F.round(c, 4).alias(c) for c in ("total", "published_total"))]
    parts = [late_corrected(table(spark, root, name), *rule).select(F.lit(name).alias("table_name"), "entity", *shown) for name, rule in LATE_RULES.items()]
    return parts[0].unionByName(parts[1])


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    """The periods that late rows corrected, or from which they were dropped."""
    late = p4_totals(spark, root).where("outcome != 'final'")
    return late.select("table_name", "entity", "period_start", "outcome")


def queries() -> dict:
    return {"p1_found": p1_found, "p3_found": p3_found, "p4_found": p4_found, "p4_totals": p4_totals}


def split_sql(name: str, table: str, field: str, key: str, cls: str = ";|,") -> str:
    """The values of a packed field by regular expressions; needs the tails of `tails_sql` before it."""
    return f"""
SELECT DISTINCT '{name}' AS field_name, k AS record_key, CAST(i AS INTEGER) AS item_pos, v AS item_value FROM (
  SELECT k, unnest(items) AS v, generate_subscripts(items, 1) AS i FROM (
    SELECT k, list_filter(list_transform(parts, lambda p: trim(replace(CASE WHEN p LIKE '"%"' THEN replace(p[2:-2], '""', '"') ELSE p END, chr(1), ','), ' ')), lambda p: p <> '') AS items FROM (
      SELECT k, CASE WHEN t LIKE '[%]' THEN from_json(t, '["VARCHAR"]') ELSE list_transform(regexp_extract_all(regexp_replace(regexp_replace(t, (SELECT ',(' || string_agg(DISTINCT replace(tail, '.', '\\.'), '|' ORDER BY replace(tail, '.', '\\.') DESC) || ')(\\s*(?:[{cls}]|$))' FROM tails_{key}), chr(1) || '\\1\\2', 'g'), (SELECT chr(1) || '(' || coalesce(string_agg(DISTINCT tail[1:strpos(tail, ',') - 1], '|'), 'no such') || '),' FROM tails_{key} WHERE contains(tail, ',')), chr(1) || '\\1' || chr(1), 'g'), '"(?:[^"]|"")*"|N/A|[^{cls}\\s"][^{cls}]*'), lambda p: trim(p, ' ')) END AS parts
      FROM (SELECT {key} AS k, trim({field}, ' ') AS t FROM {table} WHERE {key} IS NOT NULL AND {field} IS NOT NULL))))"""


def tails_sql(key: str, table: str, field: str) -> str:
    """What follows the first comma of quoted values."""
    return f"tails_{key} AS (SELECT rtrim(q[strpos(q, ',') + 1:]) AS tail FROM (SELECT unnest(regexp_extract_all({field}, '\"((?:[^\"]|\"\")*)\"', 1)) AS q FROM {table}) WHERE contains(q, ',') UNION ALL SELECT ' no such tail')"


P1_SQL = (
    "WITH " + tails_sql("url", "news_gkg", "organizations") + ", " + tails_sql("nct_id", "clinical_trials", "conditions")
    + split_sql("news_gkg.organizations", "news_gkg", "organizations", "url") + " UNION ALL "
    + split_sql("clinical_trials.conditions", "clinical_trials", "conditions", "nct_id") + " UNION ALL "
    + split_sql("clinical_trials.phase", "clinical_trials", "phase", "nct_id", ";|,/")
)

P3_SQL = """
WITH e AS (SELECT DISTINCT entity, event_time FROM features WHERE entity IS NOT NULL AND event_time IS NOT NULL),
f AS (SELECT entity, concept, event_time AS r1, knowledge_time AS r2, coalesce(vintage_id, '') AS v FROM fundamentals_sec
      WHERE unit = 'USD' AND value IS NOT NULL AND knowledge_time IS NOT NULL AND concept IN ('Revenues', 'NetIncomeLoss')),
c(concept) AS (VALUES ('Revenues'), ('NetIncomeLoss')),
k AS (SELECT e.entity, e.event_time, f.concept, arg_max(f.v, (f.r1, f.r2, f.v)) AS v
      FROM e JOIN f ON e.entity = f.entity AND f.r2 <= e.event_time GROUP BY ALL),
m AS (SELECT e.entity, e.event_time, arg_max(s.action, (s.event_time, s.knowledge_time, s.action)) AS action
      FROM e JOIN security_master s ON s.entity = e.entity AND s.record_type = 'change'
       AND s.event_time <= e.event_time AND s.knowledge_time <= e.event_time GROUP BY ALL)
SELECT DISTINCT e.entity, strftime(e.event_time AT TIME ZONE 'UTC', '%Y-%m-%d') AS event_day, c.concept,
       coalesce(k.v, '') AS vintage_id, CASE WHEN m.action = 'added' THEN 'member' ELSE 'not_member' END AS membership
FROM e CROSS JOIN c
LEFT JOIN k ON k.entity = e.entity AND k.event_time = e.event_time AND k.concept = c.concept
LEFT JOIN m ON m.entity = e.entity AND m.event_time = e.event_time
"""


def _p4_sql(name: str, period: str, close: int, cutoff: int) -> str:
    return f"""
SELECT DISTINCT '{name}' AS table_name, entity, strftime(s, '%Y-%m-%d') AS period_start,
       CASE WHEN kt < s + INTERVAL 1 {period} + INTERVAL {cutoff} DAY THEN 'corrected' ELSE 'dropped' END AS outcome
FROM (SELECT entity, date_trunc('{period}', event_time AT TIME ZONE 'UTC') AS s, min(knowledge_time) AT TIME ZONE 'UTC' AS kt
      FROM {name} WHERE event_time IS NOT NULL GROUP BY content_hash, entity, event_time HAVING event_time <= min(knowledge_time))
WHERE kt >= s + INTERVAL 1 {period} + INTERVAL {close} DAY"""


def _p4_totals_sql(name: str, period: str, close: int, cutoff: int, measure: str) -> str:
    return f"""
SELECT '{name}' AS table_name, entity, strftime(s, '%Y-%m-%d') AS period_start, outcome,
       CAST(CASE outcome WHEN 'final' THEN n0 + n1 WHEN 'corrected' THEN n1 ELSE n2 END AS BIGINT) AS n_rows,
       round(CASE outcome WHEN 'dropped' THEN v2 ELSE v0 + v1 END, 4) AS total, CASE outcome WHEN 'dropped' THEN NULL ELSE round(v0, 4) END AS published_total
FROM (SELECT entity, s, count_if(ph = 0) AS n0, count_if(ph = 1) AS n1, count_if(ph = 2) AS n2, {", ".join(f"coalesce(sum(m) FILTER (ph = {i}), 0) AS v{i}" for i in range(3))}
  FROM (SELECT *, CASE WHEN kt < s + INTERVAL 1 {period} + INTERVAL {close} DAY THEN 0 WHEN kt < s + INTERVAL 1 {period} + INTERVAL {cutoff} DAY THEN 1 ELSE 2 END AS ph
    FROM (SELECT entity, date_trunc('{period}', event_time AT TIME ZONE 'UTC') AS s, min(knowledge_time) AT TIME ZONE 'UTC' AS kt, {measure} AS m
          FROM {name} WHERE event_time IS NOT NULL GROUP BY content_hash, entity, event_time, {measure} HAVING event_time <= min(knowledge_time))) GROUP BY 1, 2)
CROSS JOIN (VALUES ('final'), ('corrected'), ('dropped')) o(outcome)
WHERE CASE outcome WHEN 'final' THEN n0 + n1 WHEN 'corrected' THEN n1 ELSE n2 END > 0"""


def sql() -> dict:
    return {"p1_found": P1_SQL, "p3_found": P3_SQL, "p4_found": "\nUNION ALL".join(_p4_sql(n, p, a, b) for n, (p, a, b, _) in LATE_RULES.items()), "p4_totals": "\nUNION ALL".join(_p4_totals_sql(n, *r) for n, r in LATE_RULES.items())}
