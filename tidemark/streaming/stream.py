"""Structured Streaming: deduplicated ingestion, latest vintages, and late-corrected totals with kept state."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.operators.late import LateTotals


def read_lake(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def deduplicated(stream: DataFrame, overlap: str = "2 days") -> DataFrame:
    """Rows whose content_hash did not come within the overlap before."""
    return stream.withWatermark("knowledge_time", overlap).dropDuplicatesWithinWatermark(["content_hash"])


def ingest(stream: DataFrame, path: str, checkpoint: str, parts: tuple[str, ...] = ("domain", "source")):
    """Writes all that is there now to the lake, then ends; run again, it goes on where it ended."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).partitionBy(*parts).trigger(availableNow=True).start()


def windowed(stream: DataFrame, value: str, size: str = "1 day", slide: str | None = None, lateness: str = "2 days") -> DataFrame:
    """Count and sum by event-time window and entity, closed `lateness` after the newest event."""
    window = F.window("event_time", size, slide) if slide else F.window("event_time", size)
    return stream.withWatermark("event_time", lateness).groupBy(window, "entity").agg(F.count("*").alias("n"), F.sum(value).alias("total"))


LATE_OUT = "entity string, period_start long, outcome string, n_rows long, total double"
LATE_STATE = "kept binary"


def late_totals(stream: DataFrame, period_days: int, close_days: int, cutoff_days: int, measure: str, disorder: str | None = None) -> DataFrame:
    """Totals by entity and period of `period_days` days since 1970, by the same `late.LateTotals` as a batch, kept in each
    entity's state. A batch gives the periods that it changed: `corrected` with the new totals of a period published
    before, and `dropped` with what the tree refused, as its period was evicted.

    Where the stream has a content_hash, a row sent again counts once while its period is kept; hashes leave the state
    with their period, so what is sent again later than that counts as dropped.

    `disorder`: by how much knowledge times may be out of order from batch to batch (such as `7 days`). With it, an
    entity's state ends once the stream's clock has passed the cut-off of all that it holds; rows more out of order than
    that are not taken. Without it states of idle entities stay."""
    hashed = "content_hash" in stream.columns

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        totals, seen = pickle.loads(state.get[0]) if state.exists else (LateTotals(period_days, close_days, cutoff_days), {})
        pdf = pd.concat(list(batches)).sort_values("known", kind="stable")
        changed = set()
        for day, known, value, digest in zip(pdf["day"].tolist(), pdf["known"].tolist(), pdf["measure"].fillna(0.0).tolist(), pdf["hash"].tolist()):
            for start, *_ in totals.advance(known):
                seen.pop(start, None)
            start = day - day % period_days
            if digest is not None and digest in seen.get(start, ()):
                continue
            if totals.add(day, 1, value):
                if digest is not None:
                    seen.setdefault(start, set()).add(digest)
                if totals.held[start] is not None:
                    changed.add(start)
        rows = [(key[0], s, "corrected", *totals.total(s)) for s in sorted(changed) if s in totals.held]
        rows += [(key[0], s, "dropped", *v) for s, v in sorted(totals.dropped.items())]
        totals.dropped = {}
        state.update((pickle.dumps((totals, seen)),))
        if disorder and totals.held:
            empty_ms = (max(totals.held) + period_days + cutoff_days + 1) * 86_400_000
            state.setTimeoutTimestamp(max(empty_ms, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(rows, columns=["entity", "period_start", "outcome", "n_rows", "total"])

    day = lambda c: F.unix_date(F.col(c).cast("date"))
    digest = F.unhex(F.sha2(F.col("content_hash").cast("string"), 256)) if hashed else F.lit(None).cast("binary")
    src = (stream.withWatermark("knowledge_time", disorder) if disorder else stream).where("event_time <= knowledge_time")
    src = src.select(*(["knowledge_time"] if disorder else []), "entity", day("event_time").alias("day"), day("knowledge_time").alias("known"), F.col(measure).cast("double").alias("measure"), digest.alias("hash"))
    return src.groupBy("entity").applyInPandasWithState(run, LATE_OUT, LATE_STATE, "append", GroupStateTimeout.EventTimeTimeout if disorder else GroupStateTimeout.NoTimeout)
