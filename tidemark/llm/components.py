"""Connected components of edges, by joins alone: no task and no driver ever holds a component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut, release


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """`id, component` of all ends of `edges` (a, b: long); component is the least id that is connected.

    Each round gives a node the least label of its neighbours, then that label's own label, so chains shorten by more
    than half; it ends when no label changes. Self loops are fine, null ends are left out."""
    both = edges.where("a is not null and b is not null").select("a", "b")
    both = cut(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = cut(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("component")).withColumnRenamed("a", "id"), "labels")
    kept = labels
    for _ in range(rounds):
        near = both.join(labels.withColumnsRenamed({"id": "b"}), "b").groupBy("a").agg(F.min("component").alias("near"))
        step = labels.join(near.withColumnRenamed("a", "id"), "id", "left").select("id", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        jump = labels.select(F.col("id").alias("component"), F.col("component").alias("further"))
        new = cut(step.join(jump, "component", "left").select("id", "old", F.least("component", "further").alias("component")), "labels")
        changed = new.where("old != component").limit(1).count()
        release(kept)
        labels, kept = new.drop("old"), new
        if not changed:
            release(both)
            return labels
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def roots(links: DataFrame, rounds: int = 50) -> DataFrame:
    """`id, root`: where the links id -> parent (parent < id, one for each id) end."""
    table = cut(links.select("id", F.col("parent").alias("root")), "roots")
    kept = table
    for _ in range(rounds):
        up = table.select(F.col("id").alias("root"), F.col("root").alias("above"))
        new = cut(table.join(up, "root", "left").select("id", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")), "roots")
        moved = new.where("moved").limit(1).count()
        release(kept)
        table, kept = new.drop("moved"), new
        if not moved:
            return table
    raise RuntimeError(f"roots did not settle in {rounds} rounds")
