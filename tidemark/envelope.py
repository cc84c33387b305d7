"""The envelope: the eight columns that every lake table begins with, and how rows get them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENVELOPE = T.StructType(
    [
        T.StructField("event_time", T.TimestampType()),
        T.StructField("knowledge_time", T.TimestampType()),
        *(T.StructField(c, T.StringType()) for c in ("domain", "source", "entity", "vintage_id", "source_url", "content_hash")),
    ]
)
COLUMNS = ENVELOPE.fieldNames()


def schema_with(payload: T.StructType | str) -> T.StructType:
    """The envelope followed by payload fields."""
    fields = T._parse_datatype_string(payload) if isinstance(payload, str) else payload
    return T.StructType([*ENVELOPE.fields, *fields.fields])


def content_hash(entity: Column, event_time: Column, payload: list[Column], vintage: list[Column] | None = None) -> Column:
    """SHA-256 over entity, event time and payload, joined by the unit separator.

    Null and empty text differ. With `vintage` (vintage_id and knowledge time) two releases of one value differ too."""
    parts = [entity, F.date_format(event_time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), *payload, *(vintage or [])]
    return F.sha2(F.concat_ws("\x1f", *(F.coalesce(p.cast("string"), F.lit("\x00")) for p in parts)), 256)


def stamp(
    df: DataFrame,
    *,
    domain: str,
    source: str,
    entity: Column | str,
    event_time: Column,
    knowledge_time: Column | None = None,
    lag: str | None = None,
    vintage_id: Column | None = None,
    url: Column | str = "",
    payload: dict[str, Column],
) -> DataFrame:
    """`df` as envelope and payload; knowledge time is given, or event time plus the interval `lag`, or event time.

    All is one projection, so a value cannot slip to another row's times. Timestamps are microseconds, payload columns
    keep the types of their expressions."""
    known = knowledge_time if knowledge_time is not None else (event_time + F.expr(f"INTERVAL {lag}") if lag else event_time)
    entity = F.lit(entity) if isinstance(entity, str) else entity
    vintage = F.coalesce(vintage_id.cast("string"), F.lit("")) if vintage_id is not None else F.lit("")
    url = F.lit(url) if isinstance(url, str) else url
    return df.select(
        event_time.cast("timestamp").alias("event_time"),
        known.cast("timestamp").alias("knowledge_time"),
        F.lit(domain).alias("domain"),
        F.lit(source).alias("source"),
        entity.cast("string").alias("entity"),
        vintage.alias("vintage_id"),
        url.cast("string").alias("source_url"),
        content_hash(entity, event_time, list(payload.values()), [vintage, known] if vintage_id is not None else None).alias("content_hash"),
        *(c.alias(n) for n, c in payload.items()),
    )
