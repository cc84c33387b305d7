"""Mixing sources to target weights, with capped repetition and overlapping sources.

Documents of several sources with the same text are one unit; the sources that hold it are its membership pattern. Further
copies of a text within a source are units of their own, so each document counts once. Token capacities are added
up by pattern, and a min-cost flow routes them to the sources' quotas: a pattern supplies its tokens once for free, a
second time at cost 1, a third time at cost 2 and so on, up to the greatest number of repeats of its sources, and a source
takes at most its own number of repeats from each pattern. The greatest total for which all quotas can be met is found by
maximum flow. The flow's amounts are then cut from each pattern's units in a seeded order, so each document knows how
often it is used and for which source.

The graph has a node for each pattern, at most two to the number of targets, whatever the size of the corpus; prefix sums
over a pattern's units run in hash ranges. Defined cases: documents without source, of a source without target, or
without tokens take no part; a source whose share cannot be met at any size is left out of the total's bound only if its
target is 0; targets must add up to more than 0, and are scaled to 1.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import TOKENIZERS, token_count
from tidemark.session import cut


class Flow:
    """Min-cost flow by shortest augmenting paths; small graphs only."""

    def __init__(self, nodes: int):
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def arc(self, a: int, b: int, room: int, cost: int = 0) -> int:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.room.append(r)
            self.cost.append(c)
        return len(self.to) - 2

    def run(self, source: int, sink: int) -> int:
        """Sends as much as possible at the least cost; returns the amount."""
        sent = 0
        while True:
            far, via, queued = {source: 0}, {}, {source}
            queue = deque([source])
            while queue:
                a = queue.popleft()
                queued.discard(a)
                for e in self.out[a]:
                    b = self.to[e]
                    if self.room[e] > 0 and far[a] + self.cost[e] < far.get(b, 1 << 60):
                        far[b], via[b] = far[a] + self.cost[e], e
                        if b not in queued:
                            queued.add(b)
                            queue.append(b)
            if sink not in far:
                return sent
            path, b = [], sink
            while b != source:
                path.append(via[b])
                b = self.to[via[b] ^ 1]
            step = min(self.room[e] for e in path)
            for e in path:
                self.room[e] -= step
                self.room[e ^ 1] += step
            sent += step


def route(capacity: dict[tuple[str, ...], int], shares: dict[str, float], repeats: dict[str, int], total: int | None = None) -> tuple[int, dict[tuple[tuple[str, ...], str], int]]:
    """(total, tokens by (pattern, source)): the flow of the given total, or of the greatest that meets all shares."""
    names = [s for s in shares if shares[s] > 0]
    scale = sum(shares[s] for s in names)
    patterns = [p for p, c in capacity.items() if c > 0 and any(s in names for s in p)]

    def solve(size: int):
        g = Flow(2 + len(patterns) + len(names))
        place = {s: 2 + len(patterns) + i for i, s in enumerate(names)}
        quota = {s: int(size * shares[s] / scale) for s in names}
        arcs = {}
        for i, p in enumerate(patterns):
            for r in range(max(repeats[s] for s in p if s in place)):
                g.arc(0, 2 + i, capacity[p], r)
            for s in p:
                if s in place:
                    arcs[(p, s)] = g.arc(2 + i, place[s], capacity[p] * repeats[s])
        for s in names:
            g.arc(place[s], 1, quota[s])
        sent = g.run(0, 1)
        return sent == sum(quota.values()), {k: g.room[e ^ 1] for k, e in arcs.items()}

    if total is None:
        low, high = 0, sum(capacity[p] * max(repeats[s] for s in p if s in repeats) for p in patterns)
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if solve(mid)[0] else (low, mid - 1)
        total = low
    return total, {k: v for k, v in solve(total)[1].items() if v}


def units(docs: DataFrame, targets: list[str], tokenizer: str, folder: str) -> DataFrame:
    """`unit, tokens, ids`: each distinct text of the target sources, with the first document of each source that has it;
    every further copy of a text within a source is a unit of that source alone."""
    sized = docs.where(F.col("source").isin(targets) & F.col("text").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "source", F.unhex(F.sha2("text", 256)).alias("unit"), token_count(F.col("text"), tokenizer, folder).alias("tokens"))
    sized = cut(sized.where("tokens > 0"), "sized")
    first = [F.min(F.when(F.col("source") == s, F.col("doc_id"))).alias(f"d{i}") for i, s in enumerate(targets)]
    ids = F.array(*(F.col(f"d{i}") for i in range(len(targets))))
    one = cut(sized.groupBy("unit", "tokens").agg(*first).select("unit", "tokens", ids.alias("ids")), "firsts")
    # by doc_id, which is unique, so copies of one text don't meet in a task
    taken = one.select(F.explode("ids").alias("doc_id")).where("doc_id is not null")
    own = F.array(*(F.when(F.col("source") == s, F.col("doc_id")) for s in targets))
    copies = sized.join(taken, "doc_id", "left_anti").select(F.unhex(F.sha2(F.concat_ws(":", F.hex("unit"), "doc_id"), 256)).alias("unit"), "tokens", own.alias("ids"))
    return one.unionByName(copies)


def mixed(docs: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = 0, tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS, ranges: int = 256) -> tuple[DataFrame, DataFrame]:
    """(selection, report).

    docs: `doc_id, text, source`. targets: `source, target_share, max_repeats`, a small table by nature.
    selection: `doc_id, source, times, tokens` (of one use). report: `source, target_share, max_repeats, available_tokens,
    documents, tokens, actual_share, mean_repeats, most_repeats`, a row for each target."""
    goal = {r.source: (float(r.target_share or 0), int(r.max_repeats or 1)) for r in targets.where("source is not null").collect()}
    names = sorted(goal)
    table = cut(units(docs, names, tokenizer, folder), "units")
    pattern = F.transform(F.col("ids"), lambda d: d.isNotNull().cast("int"))
    table = table.select("*", F.array_join(pattern, "").alias("pattern"), F.pmod(F.xxhash64("unit", F.lit(seed)), F.lit(ranges)).alias("range"))
    capacity = {r.pattern: r.c for r in table.groupBy("pattern").agg(F.sum("tokens").alias("c")).collect()}
    members = {p: tuple(n for n, x in zip(names, p) if x == "1") for p in capacity}
    size, flow = route({members[p]: c for p, c in capacity.items()}, {n: goal[n][0] for n in names}, {n: goal[n][1] for n in names}, total_tokens)

    # each pattern's units lie on a line of tokens; every pass over the line is a repeat, and sources take consecutive parts
    parts = []
    for p, c in capacity.items():
        at = 0
        for s in members[p]:
            got = flow.get((members[p], s), 0)
            if got:
                parts.append((p, names.index(s), s, float(at), float(at + got), float(c)))
            at += got
    spark = docs.sparkSession
    taken = spark.createDataFrame(parts, "pattern string, place int, source string, lo double, hi double, size double")
    sums = table.groupBy("pattern", "range").agg(F.sum("tokens").alias("t"))
    offset = sums.select("pattern", "range", F.coalesce(F.sum("t").over(Window.partitionBy("pattern").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("pattern", "range").orderBy("unit")
    lined = table.withColumn("upto", F.sum("tokens").over(inside)).join(F.broadcast(offset), ["pattern", "range"])
    middle = F.col("offset") + F.col("upto") - F.col("tokens") / 2
    # passes whose copy of the unit's middle lies in [lo, hi)
    passes = lambda x: F.greatest(F.lit(0), F.ceil((F.col(x) - middle) / F.col("size")))
    chosen = lined.join(F.broadcast(taken), "pattern").withColumn("times", (passes("hi") - passes("lo")).cast("int")).where("times > 0")
    selection = cut(chosen.select(F.element_at("ids", F.col("place") + 1).alias("doc_id"), "source", "times", "tokens"), "selection")

    got = selection.groupBy("source").agg(F.count("*").alias("documents"), F.sum(F.col("tokens") * F.col("times")).alias("tokens"), (F.sum(F.col("tokens") * F.col("times")) / F.sum("tokens")).alias("mean_repeats"), F.max("times").alias("most_repeats"))
    have = [(n, goal[n][0], goal[n][1], sum(c for p, c in capacity.items() if n in members[p])) for n in names]
    report = spark.createDataFrame(have, "source string, target_share double, max_repeats int, available_tokens long").join(F.broadcast(got), "source", "left").fillna(0)
    everything = selection.agg(F.sum(F.col("tokens") * F.col("times"))).first()[0] or 1
    return selection, report.withColumn("actual_share", F.col("tokens") / F.lit(float(everything)))
