"""Readers of landed files whose format Spark does not read itself."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Lines that go on to Spark at once.
LINES = 20_000


def zipped_lines(spark: SparkSession, path: str) -> DataFrame:
    """`value`: the lines of all files within the zip archives at `path` (a pattern may name many), as UTF-8; bytes that are
    none are left out, and so are archives that cannot be opened. An archive is one task's work; its lines are streamed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                try:
                    archive = zipfile.ZipFile(io.BytesIO(content.as_py()))
                except zipfile.BadZipFile:
                    continue
                for name in archive.namelist():
                    lines: list[str] = []
                    for line in io.TextIOWrapper(archive.open(name), "utf-8", errors="ignore", newline="\n"):
                        lines.append(line.rstrip("\r\n"))
                        if len(lines) == LINES:
                            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
                            lines = []
                    yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, "value string")
