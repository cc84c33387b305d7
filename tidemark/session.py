"""Session settings, and cutting of lineage in the folder that the cluster shares."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

#: Settings without which results would differ from what the operators define.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}
SPEED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


#: Paths of what `cut` gave, by identity.
_CUT: dict[int, tuple] = {}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; `conf` takes names with `_` for `.` or a full dict under `conf`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    extra = conf.pop("conf", {})
    for k, v in {**SEMANTIC_CONF, **SPEED_CONF, **{k.replace("_", "."): v for k, v in conf.items()}, **extra}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`. Unset, a local session gets a folder of its own; a cluster raises."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def cut(df: DataFrame, label: str = "cut") -> DataFrame:
    """`df` written as Parquet to the shared folder and read again.

    The plan of the result starts at those files, so it survives the loss of executors and nothing before it runs
    twice. Files are removed when the driver ends, or by `release`."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _CUT[id(out)] = (weakref.ref(out), path)
    return out


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, removed when the driver ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path, os.getpid())
    return path


def release(*frames: DataFrame) -> None:
    """Removes the files of frames that `cut` gave and no plan that is still to run reads."""
    for df in frames:
        held, path = _CUT.pop(id(df), (lambda: None, ""))
        if held() is df:
            _remove(df.sparkSession, path, os.getpid())


def spread(df: DataFrame) -> DataFrame:
    """`df` over all cores, for work whose cost lies in its rows and not in its bytes; adaptive execution leaves it so."""
    spark = df.sparkSession
    return df.repartition(2 * max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def buckets_for(df: DataFrame, rows_each: int) -> int:
    """How many hash buckets hold about `rows_each` rows of `df` each, and at least two for each shuffle partition; `df`
    should be what `cut` gave, whose rows are counted from the files' footers."""
    least = 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-df.count() // rows_each))


def _remove(spark: SparkSession, path: str, pid: int) -> None:
    if os.getpid() != pid:
        return
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # noqa: BLE001 - the session may have ended before
        pass
