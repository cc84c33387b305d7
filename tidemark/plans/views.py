"""Views of the driver's tables that carry the lake's meaning where a lake table is missing, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.tables import table


def bars(spark: SparkSession, root: str) -> DataFrame:
    """Daily bars by order priority: the highest order of the day, known 21 hours later."""
    day = F.col("o_orderdate").cast("timestamp")
    return table(spark, root, "orders").groupBy(F.col("o_orderpriority").alias("entity"), day.alias("event_time")).agg(
        F.max("o_totalprice").alias("close"), F.count("*").alias("volume"), F.expr("max(cast(o_orderdate as timestamp) + interval 21 hours)").alias("knowledge_time")
    )


def vintages(spark: SparkSession, root: str) -> DataFrame:
    """A day's value of each user, released anew by each event of that day."""
    at = F.col("ts").cast("timestamp")
    return table(spark, root, "events").select(F.col("user_id").cast("string").alias("entity"), F.date_trunc("day", at).alias("event_time"), at.alias("knowledge_time"), "value", F.lpad(F.col("event_id").cast("string"), 12, "0").alias("vintage_id"), "event_type", "props")


def quotes(spark: SparkSession, root: str) -> DataFrame:
    """Quotes of markets: a user's value as a probability."""
    return vintages(spark, root).select("entity", F.col("knowledge_time").alias("event_time"), "knowledge_time", "vintage_id", F.concat(F.lit("Will "), "event_type", F.lit(" rise?")).alias("question"), (F.col("value") / 1000).alias("probability"), F.col("value").alias("volume"))


BARS = "(SELECT o_orderpriority AS entity, o_orderdate AS event_time, max(o_totalprice) AS close, count(*) AS volume, o_orderdate + INTERVAL 21 HOUR AS knowledge_time FROM orders GROUP BY 1, 2)"
VINTAGES = "(SELECT cast(user_id AS VARCHAR) AS entity, date_trunc('day', ts) AS event_time, ts AS knowledge_time, value, lpad(cast(event_id AS VARCHAR), 12, '0') AS vintage_id, event_type, props FROM events)"
QUOTES = f"(SELECT entity, knowledge_time AS event_time, knowledge_time, vintage_id, 'Will ' || event_type || ' rise?' AS question, value / 1000 AS probability, value AS volume FROM {VINTAGES})"
