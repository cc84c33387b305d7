"""Deduplication of new batches against all history, by a table of distances to fixed pivots.

Every report is a point with up to four coordinates, each scaled so that two reports of one transaction differ by at most 1
in it: time of the transaction, price, shares, and shares held after. The distance of two points is the greatest
difference over the coordinates that both have. There is a pivot far out on each axis, at -FAR; as it lies farther out than
any other coordinate can reach, a point's distance to it is the same whichever further coordinates are compared, so the
triangle inequality |d(x, P) - d(y, P)| <= d(x, y) holds for each pattern of missing values too. A missing price and a price
of 0 are places of their own, far from all prices.

The history keeps each row with its distances to the four pivots, in files by range of the distance to the first pivot. A
batch reads the ranges that lie within 1 of its own rows and nothing else of the history; within them, rows meet in cells of
the distances to the first two pivots, in crowded cells to the third or fourth as well. The true distance is then computed,
and an exact check of the other fields follows. A report without date carries the moment at which the first was known as
its time, so the history keeps each row a second time, by that moment. Appending a batch adds its rows to the table; nothing
of the history is computed again or moved. Rows repeated letter by letter are found by their hash, within the same
ranges, as rows of one hash have one time.

Cells that hold more than `crowd` rows are split further by shares or holdings after the trade, for each pattern of
missing values that a pair can have, so that no group of alike rows is compared with itself as a whole.

Defined cases: rows without row_id repeat nothing; rows without entity or event time repeat nothing unless their hash
does; a null never contradicts, but at least two measures or one unrounded price must agree; an owner's name may be
spelled in any way that `names.same_person` accepts, a null owner fits all.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.components import roots
from tidemark.llm.names import edits, person_words, same_person
from tidemark.session import cut, release

HOURS, PRICE = 18.0, 0.0051
#: Where the pivots lie; coordinates are kept within a tenth of it.
FAR = 1e10
#: Distances are near if they differ by so much: 1, and what rounding at FAR may add.
REACH = 1.0 + 1e-4
CELL_T, CELL_P = 96.0 / HOURS, 0.1 / PRICE
#: The history's files hold so much of the distance to the first pivot each: 60 days.
RANGE = 60 * 24 / HOURS
NO_RANGE = -1
ROWS_A_FILE = 1_000_000
NO_PRICE, ZERO_PRICE = -2000.0 / PRICE, -1000.0 / PRICE
FIELDS = ("row_id", "entity", "owner", "t", "k", "code", "acq", "deriv", "kind", "shares", "price", "after", "d1", "d2", "d3", "d4", "dk")


def _code(name: str) -> Column:
    return F.nullif(F.upper(F.trim(name)), F.lit(""))


def security_kind(title: Column) -> Column:
    """Option, unit, class A or common stock, however it is written; null and other titles stay apart."""
    t = F.lower(title)
    return F.when(t.contains("option"), "option").when(t.contains("unit") | (F.trim(t) == "rsu"), "unit").when(t.rlike(r"\bcl(ass|\.)? ?a\b"), "class a").when(t.rlike(r"\b(common|com|ordinary|shares|stock)\b"), "common").otherwise(F.trim(t))


def _coordinates(t: str) -> dict[str, Column]:
    """The four coordinates of a row, null where missing; t names the column with the time."""
    price = F.when(F.col("price").isNull(), NO_PRICE).when(F.col("price") == 0, ZERO_PRICE).otherwise(F.col("price") / PRICE)
    # of shares a rounding to 1.01 %, or less than one share; of holdings a change of 2 %
    shares, after = F.expr("ln(greatest(shares, 0D) + 100) / 0.0103D"), F.expr("ln(greatest(after, 1D)) / 0.0204D")
    found = {"d1": (t, F.col(t) / F.lit(HOURS * 3.6e9)), "d2": (None, price), "d3": ("shares", shares), "d4": ("after", after)}
    within = lambda c: F.greatest(F.least(c, F.lit(FAR / 10)), F.lit(-FAR / 10))
    return {n: F.when(F.col(there).isNotNull(), within(c)) if there else within(c) for n, (there, c) in found.items()}


def _distances(t: str) -> dict[str, Column]:
    """Distances to the pivots, each the greatest difference over the row's coordinates from (0, .., -FAR, .., 0)."""
    own = _coordinates(t)
    return {n: F.when(c.isNotNull(), F.greatest(c + F.lit(FAR), *(F.abs(o) for m, o in own.items() if m != n))) for n, c in own.items()}


def pivot_rows(df: DataFrame) -> DataFrame:
    """All rows with a row_id as the history keeps them: identity, hash, measures, and the distances to the pivots (dk: of the
    moment of knowledge to the first). Rows without entity or event time have no distances."""
    known = lambda c: F.when(F.isnan(c), None).otherwise(F.col(c).cast("double"))
    rows = df.where("row_id is not null").select(
        "row_id", "entity", F.col("owner_name").alias("owner"), F.unix_micros(F.col("event_time").cast("timestamp")).alias("t"), F.unix_micros(F.col("knowledge_time").cast("timestamp")).alias("k"),
        _code("txn_code").alias("code"), _code("acq_disp").alias("acq"), F.coalesce("is_derivative", F.lit(False)).alias("deriv"), F.coalesce(security_kind(F.col("security_title")), F.lit("")).alias("kind"),
        known("shares").alias("shares"), known("price").alias("price"), known("shares_after").alias("after"), F.coalesce(F.unhex("content_hash"), F.encode("content_hash", "utf-8")).alias("hash"),
    )
    told = F.col("entity").isNotNull() & F.col("t").isNotNull()
    return rows.withColumns({n: F.when(told, c) for n, c in (_distances("t") | {"dk": _distances("k")["d1"]}).items()}).select(*FIELDS, "hash")


def pivot_table(df: DataFrame) -> DataFrame:
    """The rows that can be compared by distance."""
    return pivot_rows(df).where("d1 is not null").drop("hash")


def _span(x: Column, width: float, reach: float = REACH) -> Column:
    """The cells that hold what is within `reach` of x."""
    return F.sequence(F.floor((x - reach) / width), F.floor((x + reach) / width))


def _keyed_history(table: DataFrame) -> DataFrame:
    cell = F.struct(F.lit(0).alias("view"), F.floor(F.col("d1") / CELL_T).alias("c1"), F.floor(F.col("d2") / CELL_P).alias("c2"))
    known = F.struct(F.lit(1).alias("view"), F.col("k").alias("c1"), F.floor(F.col("d2") / CELL_P).alias("c2"))
    views = F.array(cell, known)
    if "seen_by" in table.columns:  # rows as the history keeps them, one for each view
        views = F.when(F.col("seen_by") == 0, F.array(cell)).otherwise(F.array(known))
    return table.select(*FIELDS, F.inline(views)).where("c1 is not null").select(*FIELDS, "c2", _key("c1").alias("key"))


def _keyed_batch(table: DataFrame) -> DataFrame:
    near = F.transform(_span(F.col("d1"), CELL_T), lambda c: F.struct(F.lit(0).alias("view"), c.alias("c1")))
    exact = F.array(F.struct(F.lit(1).alias("view"), F.col("t").alias("c1")))
    both = table.select(*FIELDS, F.inline(F.concat(near, exact))).select(*FIELDS, "view", "c1", F.explode(_span(F.col("d2"), CELL_P)).alias("c2"))
    return both.select(*FIELDS, "c2", _key("c1").alias("key"))


def _key(c1: str) -> Column:
    return F.xxhash64("entity", "view", c1, "c2", "deriv", "kind")


#: Patterns of missing values: what a row of the history, and of the batch, must have for the view, and the pivot whose
#: distance splits it. Where neither shares nor holdings can be compared only a price above 0 tells.
VIEWS = (
    ("d3", "shares is not null", "shares is not null"),
    ("d4", "after is not null", "shares is null and after is not null"),
    ("d4", "shares is null and after is not null", "after is not null"),
    ("d2", "price > 0", "shares is null and after is null and price > 0"),
    ("d2", "shares is null and after is null and price > 0", "price > 0"),
    ("d2", "after is null and price > 0", "shares is null and price > 0"),
    ("d2", "shares is null and price > 0", "after is null and price > 0"),
)
SPLIT = {"d3": 5.0, "d4": 5.0, "d2": 2.0}


def _of_view(i: int):
    return lambda c: F.struct(F.lit(i).alias("v"), c.alias("c"))


def _refined(keyed: DataFrame, batch: bool) -> DataFrame:
    views = []
    for i, (by, here, there) in enumerate(VIEWS):
        cells = _span(F.col(by), SPLIT[by]) if batch else F.array(F.floor(F.col(by) / SPLIT[by]))
        named = F.transform(cells, _of_view(i))
        views.append(F.when(F.expr(there if batch else here), named).otherwise(F.array().cast("array<struct<v:int,c:bigint>>")))
    out = keyed.select(*keyed.columns, F.inline(F.concat(*views)))
    return out.withColumn("key", F.xxhash64("key", "v", "c")).drop("v", "c")


def _fits() -> Column:
    """The true distance of a pair (a of the history, b of the batch), and the exact check of the other fields but the owner."""
    hour = 3_600_000_000
    either = lambda n: f"(a.{n} is null or b.{n} is null)"
    rounded = "(a.shares = b.shares or abs(a.shares - b.shares) < 1 or (abs(a.shares - b.shares) <= 0.0101 * a.shares and (b.shares % 10 = 0 or a.shares % 10 = 0)))"
    return F.expr(
        f"""a.row_id < b.row_id
        and ((b.t - a.t between {-6 * hour} and {18 * hour}) or b.t = a.k)
        and greatest(abs(a.d1 - b.d1) * cast(b.t != a.k as int), abs(a.d2 - b.d2), coalesce(abs(a.d3 - b.d3), 0), coalesce(abs(a.d4 - b.d4), 0)) <= {REACH}
        and ({either("code")} or a.code = b.code) and ({either("acq")} or a.acq = b.acq) and a.deriv = b.deriv and a.kind = b.kind
        and ({either("shares")} or {rounded})
        and ({either("after")} or b.after between 0.98 * a.after and 1.0205 * a.after)
        and (case when not {either("shares")} then true when not {either("after")} then a.after = b.after or a.price > 0
             else a.price > 0 and (a.price = b.price or abs(round(a.price, 2) - b.price) < 1e-9) end)"""
    )


def owners_fit(x: str, y: str, strong: str) -> Column:
    """Whether two owners may be one person; a null owner fits all.

    Where price and holdings agree to the last digit (`strong`), it is enough that a word of the names is alike."""

    @F.pandas_udf("boolean")
    def fit(a: pd.Series, b: pd.Series, s: pd.Series) -> pd.Series:
        return pd.Series([x is None or y is None or same_person(x, y) >= 0.6 or (bool(z) and alike(x, y)) for x, y, z in zip(a, b, s)], dtype=bool)

    return fit(x, y, strong)


def alike(x: str, y: str) -> bool:
    return any(len(v) > 3 and len(w) > 3 and edits(v, w, 2) <= 2 for v in person_words(x) for w in person_words(y))


def near_links(history: DataFrame, batch: DataFrame, crowd: int = 200) -> DataFrame:
    """`id, parent`: rows of `batch` that report again what an earlier row of `history` reports; the earliest such row.

    Both are pivot tables; for a batch's repeats within itself the history holds the batch too."""
    held, asked = _keyed_history(history), _keyed_batch(batch)
    full = held.groupBy("key").count().where(F.col("count") > crowd).select("key")
    crowded = full.limit(1).count() > 0
    names = [c for c in FIELDS]
    pack = lambda df, n: df.select("key", F.struct(*names).alias(n))
    if crowded:
        full = cut(full, "crowded")
        split = lambda df, b: df.join(full, "key", "left_anti").unionByName(_refined(df.join(full, "key", "left_semi"), b))
        held, asked = split(held, False), split(asked, True)
    pairs = pack(held, "a").join(pack(asked, "b"), "key").where(_fits()).select("a.row_id", "b.row_id", "a.owner", "b.owner", F.expr("coalesce(a.after = b.after and a.price > 0, false)")).toDF("parent", "id", "x", "y", "strong")
    return pairs.where((F.col("x") == F.col("y")) | owners_fit("x", "y", "strong")).groupBy("id").agg(F.min("parent").alias("parent"))


def hash_links(df: DataFrame) -> DataFrame:
    """`id, parent`: rows that repeat an earlier one letter by letter, and the first of them."""
    rows = df.where("row_id is not null and content_hash is not null").select("row_id", F.coalesce(F.unhex("content_hash"), F.encode("content_hash", "utf-8")).alias("hash"))
    first = rows.groupBy("hash").agg(F.min("row_id").alias("parent"), F.count("*").alias("n")).where("n > 1").drop("n")
    return rows.join(first, "hash").where("row_id > parent").select(F.col("row_id").alias("id"), "parent")


def repeats(df: DataFrame) -> DataFrame:
    """`kept_row_id, dup_row_id` of all rows in one pass, as if they had come batch by batch in the order of row_id."""
    same = cut(hash_links(df), "hashes")
    first = df.join(same.select(F.col("id").alias("row_id")), "row_id", "left_anti")
    table = cut(pivot_table(first), "pivots")
    links = roots(same.unionByName(near_links(table, table)))
    return links.select(F.col("root").alias("kept_row_id"), F.col("id").alias("dup_row_id"))


def _range(d: Column) -> Column:
    return F.coalesce(F.floor(d / RANGE).cast("long"), F.lit(NO_RANGE))


class PivotHistory:
    """The history of accepted rows at a path; batches are cleared against it and appended, in the order of row_id.

    Its files lie in folders by view (0: by time of the transaction, 1: by moment of knowledge) and range of the distance to
    the first pivot."""

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _exists(self) -> bool:
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(self.path)
        return target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(target)

    def _near(self, asked: DataFrame) -> DataFrame:
        """The history's rows in ranges within reach of the batch, as many as the calendar has; none if it is empty."""
        schema = T.StructType([*asked.schema.fields, T.StructField("root", T.LongType()), T.StructField("seen_by", T.IntegerType()), T.StructField("pivot_range", T.LongType())])
        if not self._exists():
            return self.spark.createDataFrame([], schema).drop("pivot_range")
        none = F.array(F.lit(NO_RANGE).cast("long"))
        spans = asked.select(F.explode(F.when(F.col("d1").isNull(), none).otherwise(_span(F.col("d1"), RANGE))).alias("r")).distinct()
        ranges = [r.r for r in spans.collect()]
        return self.spark.read.schema(schema).parquet(self.path).where(F.col("pivot_range").isin(ranges)).drop("pivot_range")

    def clear(self, batch: DataFrame) -> DataFrame:
        """`kept_row_id, dup_row_id` of the batch. Its rows join the history, those of near repeats with the row they lead
        to; rows repeated letter by letter need not, as their first is there."""
        new = pivot_rows(batch)
        old = self._near(new)
        first_seen = old.where("seen_by = 0 and hash is not null").select("row_id", "hash").join(new.where("hash is not null").select("hash").distinct(), "hash", "left_semi")
        firsts = first_seen.unionByName(new.where("hash is not null").select("row_id", "hash")).groupBy("hash").agg(F.min("row_id").alias("parent"))
        same = cut(new.join(firsts, "hash").where("row_id > parent").select(F.col("row_id").alias("id"), "parent"), "hashes")
        own = cut(new.join(same.select(F.col("id").alias("row_id")), "row_id", "left_anti"), "own")
        fresh = own.where("d1 is not null").drop("hash")
        both = fresh.withColumn("seen_by", F.explode(F.array(F.lit(0), F.lit(1))))
        near = near_links(old.where("d1 is not null").select(*both.columns).unionByName(both), fresh)
        inner = roots(same.unionByName(near))
        before = old.select(F.col("row_id").alias("root"), F.col("root").alias("further")).where("root != further").distinct()
        links = cut(inner.join(before, "root", "left").select("id", F.coalesce("further", "root").alias("root")), "cleared")
        marked = own.join(links.withColumnRenamed("id", "row_id"), "row_id", "left").withColumn("root", F.coalesce("root", "row_id"))
        view = lambda i, d: F.struct(F.lit(i).alias("seen_by"), _range(F.col(d)).alias("pivot_range"))
        stored = marked.select("*", F.inline(F.array(view(0, "d1"), view(1, "dk")))).where("seen_by = 0 or dk is not null")
        # a large batch in several files a range, so that no task writes the whole of one
        stored = stored.repartition("seen_by", "pivot_range", F.pmod(F.xxhash64("row_id"), F.lit(-(-own.count() // ROWS_A_FILE))))
        stored.sortWithinPartitions("seen_by", "pivot_range", "entity", "d1").write.mode("append").partitionBy("seen_by", "pivot_range").parquet(self.path)
        release(same, own)
        return links.select(F.col("root").alias("kept_row_id"), F.col("id").alias("dup_row_id"))


def by_days(df: DataFrame, batches: int) -> list[tuple[int, int]]:
    """Bounds of row_id (from, below) of at most so many batches of about equal numbers of rows, each of whole days of
    knowledge; row_id follows the order of arrival."""
    days = df.where("row_id is not null").groupBy(F.col("knowledge_time").cast("date").alias("day")).agg(F.min("row_id").alias("first"), F.count("*").alias("n")).collect()
    days = sorted((d for d in days if d.day is not None), key=lambda d: d.first)
    total, seen, starts = sum(d.n for d in days), 0, []
    for d in days:
        if seen * batches >= len(starts) * total:
            starts.append(d.first)
        seen += d.n
    starts = [-(2**63), *starts[1:]]
    return list(zip(starts, [*starts[1:], 2**63 - 1]))


def cleared(df: DataFrame, path: str, batches: int = 3) -> DataFrame:
    """`kept_row_id, dup_row_id` of all rows, taken in as so many batches of days by the history at `path`."""
    history, out = PivotHistory(df.sparkSession, path), None
    for low, below in by_days(df, batches):
        links = history.clear(df.where((F.col("row_id") >= low) & (F.col("row_id") < below)))
        out = links if out is None else out.unionByName(links)
    return out
