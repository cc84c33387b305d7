"""Point-in-time operators: what could be known at a moment, and which version of it.

All of them compare `knowledge_time` inclusively. Ties are settled by event time, then vintage, so results are the same
on each run. Rows without knowledge time are never known.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TIES = ("knowledge_time", "event_time", "vintage_id")


def moment(t: str | datetime | Column) -> Column:
    return t if isinstance(t, Column) else F.lit(t).cast("timestamp")


def as_of(df: DataFrame, t) -> DataFrame:
    """Rows known at t."""
    return df.where(F.col("knowledge_time") <= moment(t))


def ranked(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first n rows of each key; Spark limits groups before the shuffle too."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def latest(df: DataFrame, keys: list[str], by: tuple[str, ...] = TIES, n: int = 1) -> DataFrame:
    """The n rows of each key that are greatest by `by`, nulls last."""
    return ranked(df, keys, [F.col(c).desc_nulls_last() for c in by if c in df.columns], n)


def as_of_prices(df: DataFrame, t) -> DataFrame:
    """entity, event_time, close, volume known at t."""
    return as_of(df, t).select("entity", "event_time", "close", "volume")


def latest_vintage(df: DataFrame, t, keys: tuple[str, ...] = ("entity", "event_time")) -> DataFrame:
    """The last release known at t of each (entity, event time)."""
    return latest(as_of(df, t), list(keys))


def latest_per_entity(df: DataFrame, t, entities: list[str] | None = None) -> DataFrame:
    """The last known row of each entity, by knowledge time, then event time."""
    known = as_of(df, t)
    return latest(known.where(F.col("entity").isin(entities)) if entities else known, ["entity"])


def latest_by_event(df: DataFrame, t, entities: list[str] | None = None) -> DataFrame:
    """The row of each entity with the last event time among the known ones."""
    known = as_of(df, t)
    return latest(known.where(F.col("entity").isin(entities)) if entities else known, ["entity"], ("event_time", "knowledge_time", "vintage_id"))


def first_release(df: DataFrame, keys: tuple[str, ...] = ("entity", "event_time")) -> DataFrame:
    """The release of each (entity, event time) that was known first."""
    order = [F.col(c).asc_nulls_last() for c in ("knowledge_time", "vintage_id") if c in df.columns]
    return ranked(df.where("knowledge_time is not null"), list(keys), order)


def trailing(df: DataFrame, t, days: int) -> DataFrame:
    """Rows with t - days < knowledge_time <= t."""
    return as_of(df, t).where(F.col("knowledge_time") > moment(t) - F.expr(f"INTERVAL {days} DAYS"))


def forward_value(bars: DataFrame, moments: DataFrame, value: str = "close") -> DataFrame:
    """moments (entity, at, ...) with the first `value` at or after the day of `at`; looks ahead, for scoring only.

    One sweep over both sides from the latest time back, which keeps the last value seen: no join on ranges, and no frame
    that is computed anew for each row. Of values at the same time the least counts."""
    rest = F.struct("*")
    asked = moments.select("entity", F.to_timestamp(F.date_trunc("day", "at")).alias("_t"), F.lit(1).alias("_asked"), F.lit(None).cast("double").alias("_v"), rest.alias("_row"))
    facts = bars.where(F.col(value).isNotNull()).select("entity", F.col("event_time").cast("timestamp").alias("_t"), F.lit(0).alias("_asked"), F.col(value).cast("double").alias("_v"), F.lit(None).cast(asked.schema["_row"].dataType).alias("_row"))
    w = Window.partitionBy("entity").orderBy(F.col("_t").desc(), "_asked", F.col("_v").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return asked.unionByName(facts).withColumn("_v", F.last("_v", ignorenulls=True).over(w)).where("_asked = 1").select("_row.*", F.col("_v").alias(value))


def known_value(bars: DataFrame, moments: DataFrame, value: str = "close") -> DataFrame:
    """moments (entity, at, ...) with the `value` of the greatest event time known at `at`; null if none is.

    One sweep over both sides by time of knowledge, which keeps the best fact so far."""
    best = F.struct(F.col("event_time").cast("timestamp").alias("e"), F.col("knowledge_time").cast("timestamp").alias("k"), F.col(value).cast("double").alias("v"))
    asked = moments.select("entity", F.col("at").alias("_t"), F.lit(1).alias("_asked"), F.struct("*").alias("_row"))
    facts = bars.where(F.col(value).isNotNull() & F.col("knowledge_time").isNotNull()).select("entity", F.col("knowledge_time").cast("timestamp").alias("_t"), F.lit(0).alias("_asked"), best.alias("_best"))
    w = Window.partitionBy("entity").orderBy("_t", "_asked").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = asked.unionByName(facts, allowMissingColumns=True).withColumn("_best", F.max("_best").over(w))
    return swept.where("_asked = 1").select("_row.*", F.col("_best.v").alias(value))


def members(changes: DataFrame, t) -> DataFrame:
    """Entities whose last change, effective and known at t, is `added`."""
    return latest(as_of(changes, t).where(F.col("event_time") <= moment(t)), ["entity"], ("event_time", "knowledge_time", "action")).where("action = 'added'").select("entity")


def fallback(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """For each key the rows of the first frame that has any."""
    union = None
    for i, df in enumerate(frames):
        df = df.withColumn("_priority", F.lit(i))
        union = df if union is None else union.unionByName(df, allowMissingColumns=True)
    w = Window.partitionBy(*keys)
    return union.withColumn("_first", F.min("_priority").over(w)).where("_priority = _first").drop("_priority", "_first")


class Clock:
    """A cursor that moves from start to end by steps of days."""

    def __init__(self, start: datetime, end: datetime, step_days: float = 1):
        self.now, self.end, self.step = start, end, timedelta(days=step_days)

    def advance(self) -> datetime:
        self.now += self.step
        return self.now

    @property
    def done(self) -> bool:
        return self.now >= self.end

    def iso(self) -> str:
        return self.now.isoformat(timespec="seconds")


def cursor_grid(spark: SparkSession, start: str, end: str, step: str) -> DataFrame:
    """`cursor`: all positions of a clock, both ends included."""
    return spark.range(1).select(F.explode(F.expr(f"sequence(timestamp'{start}', timestamp'{end}', interval {step})")).alias("cursor"))


def observed_on_grid(df: DataFrame, grid: DataFrame, values: list[str]) -> DataFrame:
    """entity, cursor and the entity's last known `values` at each cursor, as latest_per_entity gives them one by one.

    Facts reach a cursor through one sweep by knowledge time. Facts of the same knowledge time are settled first. The grid is
    that of a clock, so its positions are held by the driver."""
    facts = latest(df.where("knowledge_time is not null"), ["entity", "knowledge_time"], ("event_time", "vintage_id"))
    payload = F.struct(*(F.col(v) for v in values))
    facts = facts.select("entity", F.col("knowledge_time").cast("timestamp").alias("cursor"), F.lit(0).alias("_grid"), payload.alias("_v"))
    cursors = F.array(*(F.lit(r.cursor) for r in grid.select("cursor").distinct().collect())).cast("array<timestamp>")
    entities = df.where("knowledge_time is not null").select("entity").distinct()
    asked = entities.select("entity", F.explode(cursors).alias("cursor")).select("entity", "cursor", F.lit(1).alias("_grid"), F.lit(None).cast(facts.schema["_v"].dataType).alias("_v"))
    w = Window.partitionBy("entity").orderBy("cursor", "_grid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = facts.unionByName(asked).withColumn("_v", F.last("_v", ignorenulls=True).over(w))
    return swept.where("_grid = 1 and _v is not null").select("entity", "cursor", "_v.*")
