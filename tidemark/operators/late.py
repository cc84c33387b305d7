"""Per-period aggregates by event time, corrected as late records become known, with a cut-off for lateness.

The clock is knowledge time. A period is published `close_days` after its end; a row known later, but before
`cutoff_days` after its end, corrects the published totals; at the cut-off the period is evicted, and a row known from then
on is dropped. Rows of an entity pass in order of knowledge time through a finger B-tree of partial aggregates
(`finger.FingerTree`), and the tree alone tells what becomes of them: what it holds of a period when the clock passes the
closing is published, what it holds more when the period is evicted was corrected, and what it refuses was dropped.
Both thresholds fall on midnights, so rows are added up by day of event and day of knowledge before they are shuffled; an
entity then has at most one row for each pair of days, however many it had before.

Defined cases: rows without event or knowledge time, or with an event later than its knowledge, are left out; a row sent
again (same content_hash) counts once, at its first knowledge time; a row without content_hash counts by itself; a null
entity is an entity of its own; null measures add nothing.
"""

from __future__ import annotations

import heapq
from datetime import date, timedelta
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.finger import FingerTree
from tidemark.session import buckets_for, cut

OUT = "entity string, period_start date, outcome string, n_rows long, total double, published_total double"
MONTHS = {"month": 1, "quarter": 3, "year": 12}
FOREVER = 2_900_000


def first_reports(df: DataFrame, measure: str) -> DataFrame:
    """`entity, event_time, known, measure`, one row per content_hash, known when it was known first."""
    usable = df.where("event_time is not null and knowledge_time is not null").select(
        "entity", "event_time", F.unix_micros(F.col("knowledge_time").cast("timestamp")).alias("known"),
        F.coalesce(F.unhex("content_hash"), F.encode("content_hash", "utf-8")).alias("hash"), F.col(measure).cast("double").alias("measure"),
    )
    # entity, event_time and the measure follow from the hash; as keys they keep the aggregate in hash maps of fixed buffers
    known = usable.where("hash is not null").groupBy("hash", "entity", "event_time", "measure").agg(F.min("known").alias("known")).drop("hash")
    alone = usable.where("hash is null").select("entity", "event_time", "measure", "known")
    return known.unionByName(alone)


def by_arrival(reports: DataFrame) -> DataFrame:
    """Partial sums by entity, day of event and day of knowledge, as days since 1970."""
    return (
        reports.where(F.unix_micros(F.col("event_time").cast("timestamp")) <= F.col("known"))
        .select("entity", F.unix_date(F.col("event_time").cast("date")).alias("day"), F.floor(F.col("known") / F.lit(86_400_000_000)).cast("int").alias("known_day"), "measure")
        .groupBy("entity", "day", "known_day")
        .agg(F.count("*").alias("n"), F.sum("measure").alias("measure"))
    )


@lru_cache(100_000)
def period_of(day: int, period: str | int) -> tuple[int, int]:
    """(first day, first day after) of the period with this day; a number means periods of so many days since 1970."""
    if isinstance(period, int):
        start = day - day % period
        return start, start + period
    months, origin = MONTHS[period], date(1970, 1, 1)
    at = origin + timedelta(day)
    first = at.year * 12 + (at.month - 1) // months * months
    bounds = [(date(m // 12, m % 12 + 1, 1) - origin).days for m in (first, first + months)]
    return bounds[0], bounds[1]


class LateTotals:
    """The periods of one entity as the clock of knowledge moves on; can be pickled, and so kept in a stream's state."""

    def __init__(self, period: str | int, close_days: int, cutoff_days: int):
        self.period, self.close_days, self.cutoff_days = period, close_days, cutoff_days
        self.tree = FingerTree()
        self.shown = -FOREVER  # periods that start before it are published
        self.held: dict[int, tuple | None] = {}  # what was published of each period in the tree, None before
        self.order: list[int] = []  # heap of the starts of `held`
        self.waiting: list[int] = []  # heap of those not published
        self.dropped: dict[int, tuple] = {}

    def total(self, start: int) -> tuple:
        return self.tree.total(start, period_of(start, self.period)[1]) or (0, 0.0)

    def advance(self, known: int) -> list[tuple]:
        """Moves the clock to a day of knowledge: publishes, then evicts; gives the evicted periods as
        (start, rows, total, rows published, total published)."""
        self.shown = max(self.shown, period_of(known - self.close_days, self.period)[0])
        while self.waiting and self.waiting[0] < self.shown:
            start = heapq.heappop(self.waiting)
            self.held[start] = self.total(start)
        kept, out = period_of(known - self.cutoff_days, self.period)[0], []
        while self.order and self.order[0] < kept:
            start = heapq.heappop(self.order)
            out.append((start, *self.total(start), *self.held.pop(start)))
        if self.tree.floor is None or self.tree.floor < kept:
            self.tree.evict(kept)
        return out

    def add(self, day: int, n: int, measure: float) -> bool:
        """Takes rows of a day of event that became known on the clock's day; whether the tree took them."""
        start = period_of(day, self.period)[0]
        if not self.tree.offer(day, (n, measure)):
            got = self.dropped.get(start, (0, 0.0))
            self.dropped[start] = (got[0] + n, got[1] + measure)
            return False
        if start not in self.held:
            late = start < self.shown
            self.held[start] = (0, 0.0) if late else None
            heapq.heappush(self.order, start)
            if not late:
                heapq.heappush(self.waiting, start)
        return True


def run_entity(rows: list[tuple], period: str | int, close_days: int, cutoff_days: int) -> list[tuple]:
    """Rows (known_day, day, n, measure) of one entity, in order of knowledge.

    Gives (start, outcome, n_rows, total, published_total) by period: `final` with its totals at the cut-off, `corrected`
    if the tree held more rows then than were published, and `dropped` for rows that the tree refused."""
    totals, out, clock = LateTotals(period, close_days, cutoff_days), [], None

    def closed(periods: list[tuple]) -> None:
        for start, n, total, n_first, first in periods:
            out.append((start, "final", n, total, first))
            if n > n_first:
                out.append((start, "corrected", n - n_first, total, first))

    for known, day, n, measure in rows:
        if known != clock:
            closed(totals.advance(known))
            clock = known
        totals.add(day, n, measure)
    closed(totals.advance(FOREVER))
    return out + [(start, "dropped", n, total, float("nan")) for start, (n, total) in totals.dropped.items()]


def late_corrected(df: DataFrame, period: str, close_days: int, cutoff_days: int, measure: str, rows_each: int = 200_000) -> DataFrame:
    """`entity, period_start, outcome, n_rows, total, published_total` of the lake table `df`.

    `final`: the period's rows and total of `measure` at the cut-off, and what was published first. `corrected`: the rows
    that came after publishing. `dropped`: rows and total that came after the cut-off. Entities share groups of about
    `rows_each` rows; only one entity's own days can make a group larger."""
    parts = cut(by_arrival(first_reports(df, measure)), "arrivals")
    parts = parts.withColumn("part", F.pmod(F.xxhash64("entity"), F.lit(buckets_for(parts, rows_each))))

    def run_part(pdf: pd.DataFrame) -> pd.DataFrame:
        code, names = pd.factorize(pdf["entity"], use_na_sentinel=False)
        order = np.lexsort((pdf["day"], pdf["known_day"], code))
        cols = [pdf[c].to_numpy()[order].tolist() for c in ("known_day", "day", "n")]
        rows = list(zip(*cols, pdf["measure"].fillna(0.0).to_numpy()[order].tolist()))
        edges = np.flatnonzero(np.diff(code[order], prepend=-1, append=-1)).tolist()
        out = [(names[code[order[a]]], *r) for a, b in zip(edges, edges[1:]) for r in run_entity(rows[a:b], period, close_days, cutoff_days)]
        got = pd.DataFrame(out, columns=["entity", "period_start", "outcome", "n_rows", "total", "published_total"])
        got["entity"] = got["entity"].astype(object).where(got["entity"].notna(), None)
        got["period_start"] = (np.datetime64("1970-01-01", "D") + got["period_start"].to_numpy(dtype="timedelta64[D]")).astype(object) if len(got) else got["period_start"].astype(object)
        return got

    return parts.groupBy("part").applyInPandas(run_part, OUT)
