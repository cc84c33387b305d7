"""The lake: Parquet under domain=/source=/key= folders; scans, idempotent writes, merges and inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.asof import ranked
from tidemark.provenance import registry, strict


class Lake:
    """A lake at `root` (any file system that Spark reads). `strict` leaves out sources unsafe about the past."""

    def __init__(self, spark: SparkSession, root: str, strict: bool = False):
        self.spark, self.root, self.strict = spark, root.rstrip("/"), strict

    def path(self, domain: str, source: str, **keys: str) -> str:
        return "/".join([self.root, f"domain={domain}", f"source={source}", *(f"{k}={v}" for k, v in keys.items())])

    def exists(self, path: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(target)

    def _folders(self, path: str) -> list[str]:
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        files = target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(s.getPath().getName() for s in files.listStatus(target) if s.isDirectory()) if files.exists(target) else []

    def sources(self, domain: str | None = None, source: str | None = None) -> list[tuple[str, str]]:
        """(domain, source) of all that the lake holds."""
        value = lambda name: name.split("=", 1)[1]
        domains = [value(n) for n in self._folders(self.root) if n.startswith("domain=") and domain in (None, value(n))]
        return [(d, value(n)) for d in domains for n in self._folders(f"{self.root}/domain={d}") if n.startswith("source=") and source in (None, value(n))]

    def _one(self, domain: str, source: str) -> DataFrame:
        return self.spark.read.option("mergeSchema", True).option("basePath", self.root).parquet(self.path(domain, source))

    def scan(self, domain: str | None = None, source: str | None = None, kind: str | None = None) -> DataFrame:
        """Rows of a domain, source or kind, pruned to their folders; columns missing from some files are null.

        Sources are partitioned by keys of their own, so several sources are read one by one and put together by name."""
        out = None
        for d, s in self.sources(domain, source):
            df = self._one(d, s)
            out = df if out is None else out.unionByName(df, allowMissingColumns=True)
        if out is None:
            raise FileNotFoundError(f"the lake has no {domain or '*'}/{source or '*'}")
        if kind is not None:
            out = out.where(F.col("kind") == kind)
        return strict(out) if self.strict else out

    def write(self, df: DataFrame, domain: str, source: str, overwrite: bool = False, **keys: str) -> bool:
        """Writes one shard; False, and nothing done, if it is there and must not be overwritten."""
        path = self.path(domain, source, **keys)
        if not overwrite and self.exists(path):
            return False
        df.drop("domain", "source", *keys).write.mode("overwrite").option("compression", "zstd").parquet(path)
        return True

    def write_many(self, df: DataFrame, by: list[str]) -> None:
        """All shards of `df` in one job; only the shards that it holds are replaced."""
        parts = ["domain", "source", *by]
        df.repartition(*parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*parts).parquet(self.root)

    def read(self, domain: str, source: str, **keys: str) -> DataFrame | None:
        path = self.path(domain, source, **keys)
        return self.spark.read.parquet(path) if self.exists(path) else None

    def merge(self, new: DataFrame, domain: str, source: str, **keys: str) -> DataFrame:
        """The shard with new rows, each content_hash once, earlier rows first; written back by the caller."""
        old = self.read(domain, source, **keys)
        return merge_rows(old, new)

    def high_water(self, domain: str, source: str, overlap_days: int = 2):
        """The last knowledge time of a source less an overlap, from where the next batch is asked for."""
        return self.scan(domain, source).agg((F.max("knowledge_time") - F.expr(f"INTERVAL {overlap_days} DAYS")).alias("since")).first().since

    def inventory(self) -> DataFrame:
        """Files, bytes and rows of each source, with its class."""
        per_file = None
        for d, name in self.sources():
            files = self._one(d, name).select("domain", "source", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("b"))
            counted = files.groupBy("domain", "source", "f", "b").agg(F.count("*").alias("n"))
            per_file = counted if per_file is None else per_file.unionByName(counted)
        out = per_file.groupBy("domain", "source").agg(F.count("*").alias("files"), F.sum("b").alias("bytes"), F.sum("n").alias("rows"))
        return out.join(F.broadcast(registry(self.spark)), ["domain", "source"], "left").withColumn("pit_class", F.coalesce("pit_class", F.lit("unknown"))).drop("safe", "paid")

    def healthy(self) -> bool:
        """Whether a row can be read; raises what hinders it."""
        return len(self.scan().limit(1).take(1)) == 1


def merge_rows(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """Rows of old and new, each content_hash once: of old if there, else that known first (then the least vintage, then by
    all its values). Rows without hash all stay. Rows of a task are sorted by event time and entity."""
    order = [F.col(c).asc_nulls_last() for c in ("knowledge_time", "vintage_id") if c in new.columns] + [F.xxhash64(*new.columns)]
    new = new.where("content_hash is null").unionByName(ranked(new.where("content_hash is not null"), ["content_hash"], order))
    if old is not None:
        fresh = new.join(old.where("content_hash is not null").select("content_hash"), "content_hash", "left_anti")
        new = old.unionByName(fresh.select(*new.columns), allowMissingColumns=True)
    return new.sortWithinPartitions(*(c for c in ("event_time", "entity") if c in new.columns))
