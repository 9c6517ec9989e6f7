"""Compaction of appended Parquet files (K5, T13): small files become few of a target size, readers see all or nothing.

Appends leave one file set per batch and partition. ``compact``

1. lists the live files with their sizes (a Spark table; contents are not read) and
   takes the partition folders where at least two files are below ``small`` bytes;
2. reads the small files of those folders only, deals their rows by (partition, sort columns, file,
   row number) over as many ranges as the bytes need, and writes each range sorted: the files have about the
   target size and page indexes with narrow bounds. File and row number split ties, so a
   hot partition or sort value spans tasks and repeated rows are no burden;
3. compares row counts of old and new files, taken from the footers;
4. publishes a manifest that names the replaced files and the new generation. Until then readers see the old
   files; a compaction that dies leaves a folder no manifest names; of two at once one fails with ``Conflict``.

Files stay where they are, so a reader of an earlier version goes on, and appends may go on during a
compaction: a file that is in no manifest is live. What goes to the driver is names of files, as Spark's own listing does.

Layout under ``root``: appended files, ``_compact/manifest/<v>.json``, ``_compact/data/gen-<id>/``.
Defined cases: large files and folders with one small file are left alone; files without rows go
when their folder is rewritten; nothing to do publishes nothing; null partition values, repeated rows and rows
with null sort columns are kept; no file at all: ``read`` gives an empty table.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.sinks import versions
from feedlake.sinks.errors import SinkError

TARGET_BYTES = 128 << 20
#: A file below this share of the target is small; what a compaction writes is mostly above it.
SMALL_SHARE = 0.5
FILE, ROW = "_compact_file", "_compact_row"


def _history(spark: SparkSession, root: str, version: int | None = None) -> tuple[int, list[dict]]:
    known = versions.numbers(spark, f"{root}/_compact/manifest")
    known = [v for v in known if version is None or v <= version]
    return (known[-1] if known else 0), [versions.read(spark, f"{root}/_compact/manifest", v) for v in known]


def _roots(root: str, history: list[dict]) -> list[str]:
    return [root, *[f"{root}/_compact/data/{h['generation']}" for h in history]]


def _listing(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of the Parquet files below a folder; hidden folders are not entered."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return files.load(folder).select("path", "length")


def live_files(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """(path, length, base, folder) of the files that make up the table; ``base`` is the root or a generation's folder."""
    _, history = _history(spark, root, version)
    out = None
    for base in _roots(root, history):
        one = _listing(spark, base).withColumn("base", F.lit(base))
        out = one if out is None else out.unionByName(one)
    gone = [p for h in history for p in h["replaced"]]
    if gone:
        out = out.join(spark.createDataFrame([(p,) for p in gone], "path string"), "path", "left_anti")
    parts = F.split("path", "/")
    named = F.filter(parts, lambda p: F.contains(p, F.lit("=")))  # partition folders, in order
    return out.withColumn("folder", F.array_join(named, "/"))


def _rows(spark: SparkSession, schema: T.StructType, files: list) -> DataFrame:
    """Rows of listed files, with partition columns read from the folders below each base."""
    out = None
    for base in sorted({f.base for f in files}):
        paths = [f.path for f in files if f.base == base]
        one = spark.read.schema(schema).option("basePath", base).parquet(*paths)
        one = one.select(*schema.fieldNames(), F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(ROW))
        out = one if out is None else out.unionByName(one)
    return out


def read(spark: SparkSession, root: str, schema: T.StructType, version: int | None = None) -> DataFrame:
    """The table: appended files that no compaction has replaced, and the generations."""
    files = live_files(spark, root, version).collect()
    if not files:
        return spark.createDataFrame([], schema)
    return _rows(spark, schema, files).select(*schema.fieldNames())


def compact(spark: SparkSession, root: str, schema: T.StructType, partition: list[str], sort: list[str],
            target_bytes: int = TARGET_BYTES) -> dict:
    """Rewrite small files and publish; returns ``version``, ``replaced`` and ``written`` (numbers of files) and ``rows``."""
    if target_bytes < 1:
        raise ValueError("target_bytes must be positive")
    version, _ = _history(spark, root)
    small = live_files(spark, root).filter(F.col("length") < target_bytes * SMALL_SHARE)
    crowded = small.groupBy("folder").agg(F.count("*").alias("n")).filter("n > 1").select("folder")
    files = small.join(crowded, "folder").collect()
    if not files:
        return {"version": version, "replaced": 0, "written": 0, "rows": 0}
    rows = _rows(spark, schema, files)
    pieces = max(1, math.ceil(sum(f.length for f in files) / target_bytes))
    by = [*partition, *sort]
    dealt = rows.repartitionByRange(pieces, *by, FILE, ROW).sortWithinPartitions(*by)
    generation = f"gen-{uuid.uuid4().hex[:12]}"
    base = f"{root}/_compact/data/{generation}"
    out = dealt.drop(FILE, ROW).write
    (out.partitionBy(*partition) if partition else out).parquet(base)
    before = rows.count()  # no column is asked for, so this reads footers
    after = spark.read.schema(schema).parquet(base).count()
    if before != after:
        raise SinkError(f"{before} rows read but {after} written: nothing published")
    versions.publish(spark, f"{root}/_compact/manifest", version + 1,
                     {"generation": generation, "replaced": sorted(f.path for f in files)})
    return {"version": version + 1, "replaced": len(files), "written": _listing(spark, base).count(), "rows": after}
