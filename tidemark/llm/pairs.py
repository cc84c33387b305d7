"""Items that appear together: how often each pair shares a basket, and how far above chance.

Rows of a basket are gathered into one; items get numbers from a dictionary of those that can matter (n(a,b) <= n(a), so an
item under the threshold has no pair and loses none), and from there on only numbers are shuffled. Equal deduplicated
item arrays are collapsed into one weighted basket, pairs are made once for each different basket, and their weights are
added up. Baskets over `wide` items, and baskets of more than `wide` rows, are not held as arrays: their items stay rows,
and their pairs come from a join, one side of it in chunks, so no task makes all pairs of a wide basket.

Defined cases: rows without basket or item count for nothing; repeated items of a basket count once; a basket with one
item has no pair; names are compared as they are written; item_a < item_b by code points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut

#: Dictionaries of up to so many bytes of names and numbers are sent to all tasks; larger ones are joined.
BROADCAST_BYTES = 32_000_000


@dataclass
class Baskets:
    """rows: distinct `basket long, part string, item string, several boolean` (several: of more than one row), lazily; total: the number of all baskets, empty ones too."""

    rows: DataFrame
    total: int


def _sent(words: DataFrame) -> DataFrame:
    """A dictionary, marked for broadcast if its size as counted allows it."""
    size = words.agg(F.sum(F.octet_length("name") + 24)).first()[0] or 0
    return F.broadcast(words) if size <= BROADCAST_BYTES else words


def gather(df: DataFrame, key: str, part: str, items: str, wide: int = 1000, keys: DataFrame | None = None) -> Baskets:
    """Baskets by `key` of rows with an array of items; `part` tells apart rows of a basket by which counts are kept apart.

    `keys`: the column `key` of the same rows, where it can be had without making the arrays."""
    src = df.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.coalesce(F.col(part), F.lit("")).alias("part"), F.array_sort(F.array_distinct(F.array_compact(items))).alias("items"))
    per_key = (df if keys is None else keys).where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n"))
    total, over = per_key.agg(F.count("*"), F.count_if(F.col("n") > wide)).first()
    src = src.where("size(items) > 0")
    many = None
    if over:
        hot = cut(per_key.where(F.col("n") > wide).select("key", (F.lit(-1) - F.monotonically_increasing_id()).alias("basket")), "hot")
        many = src.join(hot, "key").select("basket", "part", F.explode("items").alias("item"), F.lit(True).alias("several")).distinct()
        src = src.join(hot, "key", "left_anti")
    sets = src.groupBy("key").agg(F.collect_set(F.struct("part", "items")).alias("sets"))
    sets = cut(sets.select(F.monotonically_increasing_id().alias("basket"), "sets"), "baskets")
    rows = sets.select("basket", F.explode("sets").alias("s"), (F.size("sets") > 1).alias("several"))
    rows = rows.select("basket", "s.part", F.explode("s.items").alias("item"), "several")
    rows = rows.where("not several").unionByName(rows.where("several").distinct())
    return Baskets(rows.unionByName(many) if many is not None else rows, total)


def numbered(baskets: Baskets, least: int, also: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows with numbers for items, `item, name, n`): items in at least `least` baskets, and those named in `also`."""
    counts = _once(baskets.rows).groupBy("item").agg(F.count("*").alias("n"))
    if also is not None:
        named = also.select(F.col("name").alias("item")).where("item is not null").distinct().withColumn("asked", F.lit(True))
        counts = counts.join(named, "item", "left").where((F.col("n") >= least) | F.col("asked"))
    else:
        counts = counts.where(F.col("n") >= least)
    words = cut(counts.select(F.monotonically_increasing_id().alias("number"), F.col("item").alias("name"), "n"), "items")
    known = _sent(words.select("name", "number")).withColumnRenamed("name", "item")
    rows = baskets.rows.join(known, "item").select("basket", "part", F.col("number").alias("item"), "several")
    return cut(rows, "numbers"), words.withColumnRenamed("number", "item")


def _once(rows: DataFrame) -> DataFrame:
    """`basket, item` of rows, once for each basket; only baskets of several rows can name an item twice."""
    return rows.where("not several").select("basket", "item").unionByName(rows.where("several").select("basket", "item").distinct())


def pair_counts(rows: DataFrame, within: list[str], wide: int = 1000) -> DataFrame:
    """`within, item_a, item_b, together` (item_a < item_b) of distinct rows `basket, within, item`."""
    group = ["basket", *within]
    sized = rows.groupBy(*group).agg(F.count("*").alias("n"))
    over = sized.where(F.col("n") > wide).limit(1).count() > 0
    kept = rows.join(sized.where(F.col("n") > wide).select(*group), group, "left_anti") if over else rows
    arrays = kept.groupBy(*group).agg(F.sort_array(F.collect_list("item")).alias("items")).where("size(items) > 1")
    collapsed = arrays.groupBy(*within, "items").agg(F.count("*").alias("w"))
    first = collapsed.select(*within, "w", "items", F.posexplode("items").alias("i", "item_a"))
    pairs = first.select(*within, "w", "item_a", F.explode(F.expr("slice(items, i + 2, size(items))")).alias("item_b"))
    if over:
        # one side of a wide basket in chunks of about `wide` items, each with a copy of the other side
        chunks = sized.where(F.col("n") > wide).select(*group, F.ceil(F.col("n") / wide).cast("int").alias("chunks"))
        big = rows.join(chunks, group)
        left = big.select(*group, F.pmod(F.xxhash64("item"), F.col("chunks")).cast("int").alias("chunk"), F.col("item").alias("item_a"))
        right = big.select(*group, F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.col("item").alias("item_b"))
        pairs = pairs.unionByName(left.join(right, [*group, "chunk"]).where("item_a < item_b").select(*within, F.lit(1).cast("long").alias("w"), "item_a", "item_b"))
    return pairs.groupBy(*within, "item_a", "item_b").agg(F.sum("w").alias("together"))


def lift(together: Column, n_a: Column, n_b: Column, total: Column) -> Column:
    return together * total / (n_a * n_b)


def conviction(together: Column, n_a: Column, n_b: Column, total: Column) -> Column:
    """Of a -> b; null where a never comes without b."""
    missed = F.lit(1.0) - together / n_a
    return F.try_divide(F.lit(1.0) - n_b / total, F.nullif(missed, F.lit(0.0)))


def associations(rows: DataFrame, words: DataFrame, total: int, least: int = 8) -> DataFrame:
    """`item_a, item_b, together, n_a, n_b, total, lift, conviction` of pairs with `least` baskets in common, by name."""
    frequent = _sent(words.where(F.col("n") >= least).select("item", "name")).select("item")
    pairs = pair_counts(_once(rows.join(frequent, "item", "left_semi")), []).where(F.col("together") >= least)
    out = _named(pairs, words).withColumn("total", F.lit(total).cast("long"))
    four = [F.col(c) for c in ("together", "n_a", "n_b", "total")]
    return out.withColumns({"lift": lift(*four), "conviction": conviction(*four)})


def _named(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """Pairs of numbers as pairs of names in code point order, with the counts of both."""
    side = lambda s: words.select(F.col("item").alias(f"item_{s}"), F.struct("name", "n").alias(s))
    rest = [c for c in pairs.columns if c not in ("item_a", "item_b")]
    named = pairs.join(side("a"), "item_a").join(side("b"), "item_b").select(*rest, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return named.select(*rest, F.col("a.name").alias("item_a"), F.col("b.name").alias("item_b"), F.col("a.n").alias("n_a"), F.col("b.n").alias("n_b"))


def wrong_weights(rows: DataFrame, words: DataFrame, edges: DataFrame) -> DataFrame:
    """`part, item_a, item_b` of edges whose weight is null or not the number of the part's baskets with both.

    edges: `part, item_a, item_b, weight` by name, item_a < item_b."""
    number = words.select("name", "item")
    by_number = edges.join(number.withColumnsRenamed({"name": "item_a", "item": "x"}), "item_a", "left").join(number.withColumnsRenamed({"name": "item_b", "item": "y"}), "item_b", "left")
    by_number = cut(by_number.select("part", "item_a", "item_b", "weight", F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"), (F.col("x").isNull() | F.col("y").isNull()).alias("unseen")), "edges")
    asked = by_number.where("not unseen").select("part", F.explode(F.array("x", "y")).alias("item")).distinct()
    counts = pair_counts(rows.join(asked, ["part", "item"], "left_semi"), ["part"]).withColumnsRenamed({"item_a": "x", "item_b": "y"})
    held = by_number.where("not unseen").join(counts, ["part", "x", "y"], "left").select("part", "item_a", "item_b", "weight", F.coalesce("together", F.lit(0)).alias("together"))
    held = held.unionByName(by_number.where("unseen").select("part", "item_a", "item_b", "weight", F.lit(0).cast("long").alias("together")))
    return held.where("weight is null or weight != together").select("part", "item_a", "item_b").distinct()
