"""Attributes as known at event time: each event gets the version that was valid and recorded by then.

Events and versions are co-grouped by entity, and a vectorised binary search over the versions' recording times finds the
best version known at each event. Many entities share a group (a hash bucket), so that the cost per group vanishes; the
number of groups follows the number of rows. An entity with more events and versions than `slice_rows` is split by time
into slices, each with the versions recorded in its span and one carried-in row, the best version of all earlier slices.
Of versions recorded at one moment only the best is kept, and events are distinct, so slices can be cut at any moment and
no task holds an unbounded entity (up to `SLICES` slices are cut; an entity beyond that many times `slice_rows` has larger ones).

Defined cases: events without entity or time get no row; versions without entity, series or recording time are never
known; a version recorded at exactly the event's time is known; ties in recording time are settled by the rank columns,
ties in all of them by the greatest payload; an event with no known version gets null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BEFORE_ALL = -(2**63)
SLICES = 1024


def _codes(*arrays: pa.ChunkedArray) -> list[np.ndarray]:
    """Order-preserving codes of values that several columns share."""
    both = pa.chunked_array([c for a in arrays for c in a.chunks], arrays[0].type)
    ranks = pc.rank(both, sort_keys="ascending", tiebreaker="dense").to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum([len(a) for a in arrays])
    return np.split(ranks, ends[:-1])


def latest_known(events: pa.Table, versions: pa.Table, series: list[str]) -> pa.Table:
    """events (entity, at) and versions (entity, series, known, r1, r2, payload): events with a column per series.

    Distinct events come out once. r1 and r2 rank the versions that are known, the payload settles ties."""
    events = events.group_by(["entity", "at"]).aggregate([]) if events.num_rows else events.select(["entity", "at"])
    out = {"entity": events.column("entity"), "at": events.column("at")}
    n, m = events.num_rows, versions.num_rows
    if n == 0 or m == 0:
        return pa.table(out | {s: pa.nulls(n, pa.string()) for s in series})
    e_code, v_code = _codes(events.column("entity"), versions.column("entity"))
    e_time, v_time = _codes(events.column("at"), versions.column("known"))
    order_keys = [pc.rank(versions.column(c), sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy(zero_copy_only=False).astype(np.int64) for c in ("payload", "r2", "r1")]
    rank = np.empty(m, np.int64)
    rank[np.lexsort(order_keys)] = np.arange(m)
    width = int(max(e_time.max(), v_time.max())) + 2
    e_key, v_key = e_code * width + e_time, v_code * width + v_time
    v_series = versions.column("series")
    payload = versions.column("payload").combine_chunks()
    for s in series:
        own = np.flatnonzero(pc.fill_null(pc.equal(v_series, s), False).to_numpy(zero_copy_only=False))
        if own.size == 0:
            out[s] = pa.nulls(n, pa.string())
            continue
        own = own[np.lexsort((rank[own], v_key[own]))]
        keys, code = v_key[own], v_code[own]
        best = np.maximum.accumulate(code * m + rank[own]) - code * m
        at_rank = np.empty(m, np.int64)
        at_rank[rank[own]] = own
        found = np.searchsorted(keys, e_key, side="right") - 1
        safe = np.maximum(found, 0)
        hit = (found >= 0) & (code[safe] == e_code)
        out[s] = payload.take(pa.array(at_rank[best[safe]], mask=~hit))
    return pa.table(out)


def attributes_as_known(events: DataFrame, versions: DataFrame, series: list[str], slice_rows: int = 200_000, rows_each: int = 500_000, buckets: int | None = None) -> DataFrame:
    """Distinct `entity, at` of `events`, with a string column for each name in `series`.

    events: `entity string, at timestamp`. versions: `entity, series string, known timestamp` (from when it may be
    used), `r1, r2 timestamp` (greatest wins among the known), `payload string`. Extra columns are ignored."""
    if buckets is None:
        least = 2 * int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        buckets = max(least, -(-(events.count() + versions.count()) // rows_each))
    ev = events.where("entity is not null and at is not null").select("entity", F.unix_micros("at").alias("at")).distinct()
    ve = versions.where("entity is not null and series is not null and known is not null").select("entity", "series", *(F.unix_micros(c).alias(c) for c in ("known", "r1", "r2")), "payload")
    # of what is recorded at one moment the best wins at any later one too
    ve = ve.groupBy("entity", "series", "known").agg(F.max(F.struct("r1", "r2", "payload")).alias("best")).select("entity", "series", "known", "best.*")
    bounds = _slice_bounds(ev.select("entity", F.col("at").alias("t")).unionByName(ve.select("entity", F.col("known").alias("t"))), slice_rows)
    slice_of = lambda t: F.coalesce(F.size(F.filter("starts", lambda s: s <= t)), F.lit(0))
    ev = ev.join(bounds, "entity", "left").select("entity", "at", slice_of(F.col("at")).alias("slice"))
    ve_all = ve.join(bounds, "entity", "left").select("*", slice_of(F.col("known")).alias("slice"))
    ve = ve_all.drop("starts").unionByName(_carried(ve_all.where("starts is not null")))
    part = lambda df: df.withColumn("part", F.pmod(F.xxhash64("entity", "slice"), F.lit(buckets)))
    fields = [T.StructField("entity", T.StringType()), T.StructField("at", T.LongType()), *(T.StructField(s, T.StringType()) for s in series)]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        # slices of an entity stay apart: the slice is a part of the entity's name here
        tag = lambda t: t.set_column(t.schema.get_field_index("entity"), "entity", pc.binary_join_element_wise(pc.cast(t.column("slice"), pa.string()), t.column("entity"), ":"))
        done = latest_known(tag(left), tag(right), series)
        plain = pc.replace_substring_regex(done.column("entity"), r"\A\d+:", "")
        return done.set_column(0, "entity", plain).select(["entity", "at", *series])

    joined = part(ev).groupBy("part").cogroup(part(ve).groupBy("part")).applyInArrow(run, T.StructType(fields))
    return joined.withColumn("at", F.timestamp_micros("at"))


def _slice_bounds(times: DataFrame, slice_rows: int) -> DataFrame:
    """`entity, starts`: first moments of the slices after the first, for entities with more rows than a slice holds.

    They are quantiles of the entity's times, sketched before the shuffle, so a hot entity costs as little as any other."""
    share = [(i + 1) / SLICES for i in range(SLICES - 1)]
    hot = times.groupBy("entity").agg(F.count("*").alias("total"), F.percentile_approx("t", share, 10 * SLICES).alias("q")).where(F.col("total") > slice_rows)
    slices = F.least(F.lit(SLICES), F.ceil(F.col("total") / slice_rows)).cast("int")
    picked = F.transform(F.sequence(F.lit(1), slices - 1), lambda i: F.element_at("q", F.greatest(F.lit(1), F.floor(i * SLICES / slices).cast("int"))))
    return hot.select("entity", F.array_sort(F.array_distinct(picked)).alias("starts"))


def _carried(hot: DataFrame) -> DataFrame:
    """For each slice after the first, the best version of the slices before, known since ever."""
    rank = F.struct("r1", "r2", "payload")
    best = hot.groupBy("entity", "series", "slice").agg(F.max(rank).alias("best"), F.max(F.size("starts")).alias("last"))
    grid = best.groupBy("entity", "series").agg(F.max("last").alias("last")).select("entity", "series", F.explode(F.sequence(F.lit(0), "last")).alias("slice"))
    before = Window.partitionBy("entity", "series").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = grid.join(best.drop("last"), ["entity", "series", "slice"], "left").withColumn("best", F.max("best").over(before)).where("best is not null")
    return carried.select("entity", "series", F.lit(BEFORE_ALL).cast("long").alias("known"), F.col("best.r1").alias("r1"), F.col("best.r2").alias("r2"), F.col("best.payload").alias("payload"), "slice")
