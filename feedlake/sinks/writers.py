"""Sinks: partitioned Parquet, single dataset, CSV, batching, routing (K1-K7).

Every writer selects the fixed flat schema first (no inference, so an
all-null column keeps its LONG/STRING type) and returns the number of rows
written, counted by an ``Observation`` in the same job as the write (K7).

Layout: one dataset root per entity (T1) - Spark cannot read
``match_date=`` and ``competition_code=`` directories under one root.

Parallel writes: rows are rebalanced on the partition columns with AQE's
``rebalance`` hint, so each output directory gets few, large files; a hot
partition value (one date holding a third of the rows) is split across tasks
by AQE's skew handling instead of landing in one task.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from feedlake.operators.metrics import observed
from feedlake.sinks import csv_rows
from feedlake.sinks.errors import SinkError

DEFAULT_BATCH = 0  # rows per file; 0 leaves the file size to the partitioning
FORMATS = ("parquet", "csv")
# The client's CSV dialect as Spark options (header row, RFC quoting,
# NULL and '' both written as an empty field, no trimming).
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "encoding": "UTF-8",
}


def _fixed(df: DataFrame, schema: T.StructType | None) -> DataFrame:
    if schema is None:
        return df
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])


def _count(df: DataFrame, write, name: str) -> int:
    obs_df, obs = observed(df, name)
    write(obs_df)
    return int(obs.get.get("rows", 0))


def write_partitioned(df: DataFrame, path: str, partition_cols: list[str], schema: T.StructType | None = None,
                      mode: str = "append", batch_size: int = DEFAULT_BATCH) -> int:
    """Hive-partitioned Parquet (K2, K5, K6).

    ``append`` adds files, so writing the same rows twice doubles them, as the
    client does. ``upsert`` replaces only the partitions present in ``df``
    (dynamic partition overwrite), so a re-run is idempotent; a partition is
    replaced as a whole, so ``df`` must hold all rows of each partition it touches.
    Empty input writes no data files and returns 0.
    """
    if mode not in ("append", "upsert"):
        raise ValueError(f"unknown mode {mode!r}")
    out = _fixed(df, schema)
    if partition_cols:
        out = out.hint("rebalance", *partition_cols)

    def write(d: DataFrame) -> None:
        w = d.write.option("maxRecordsPerFile", batch_size if batch_size > 0 else 0)
        if mode == "upsert":
            w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        else:
            w = w.mode("append")
        if partition_cols:
            w = w.partitionBy(*partition_cols)
        w.parquet(path)

    return _count(out, write, "write_partitioned")


def _publish(spark: SparkSession, staged: str, path: str, rows: int, fail_if_empty: bool) -> None:
    """Move a written staging folder to ``path`` (replacing it), or drop it and raise if it holds no rows.

    The rows were counted by the write itself, so an empty input never replaces earlier output.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    source, target = hadoop.Path(staged), hadoop.Path(path)
    fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
    if rows == 0 and fail_if_empty:
        fs.delete(source, True)
        raise SinkError("no records to write")
    fs.delete(target, True)
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise SinkError(f"could not move {staged} to {path}")


def _staging(path: str) -> str:
    return f"{path.rstrip('/')}.staging-{uuid.uuid4().hex[:12]}"


def write_single(df: DataFrame, path: str, schema: T.StructType | None = None, batch_size: int = DEFAULT_BATCH,
                 fail_if_empty: bool = True) -> int:
    """One Parquet dataset with the fixed schema (K3), replaced as a whole; empty input raises, as the client does."""
    staged = _staging(path)

    def write(d: DataFrame) -> None:
        d.write.option("maxRecordsPerFile", max(batch_size, 0)).parquet(staged)

    rows = _count(_fixed(df, schema), write, "write_single")
    _publish(df.sparkSession, staged, path, rows, fail_if_empty)
    return rows


def write_csv(df: DataFrame, path: str, schema: T.StructType | None = None, fail_if_empty: bool = True,
              crlf: bool = False) -> int:
    """CSV with a header, overwritten each run (K4); empty input raises.

    Written as a CSV dataset ``path/data.csv/part-*`` (one file per task; a
    single file would funnel every row through one task). ``crlf`` ends rows
    with CRLF, as the client does: the ``csv_rows`` sink writes them, leaves newlines
    inside values alone and puts one header over all files (read with ``csv_rows.load``).
    """
    target = f"{path.rstrip('/')}/data.csv"
    if crlf:
        return _count(_fixed(df, schema), lambda d: csv_rows.save(d, target, fail_if_empty=fail_if_empty), "write_csv")
    staged = _staging(target)

    def write(d: DataFrame) -> None:
        d.write.options(**CSV_OPTIONS).csv(staged)

    rows = _count(_fixed(df, schema), write, "write_csv")
    _publish(df.sparkSession, staged, target, rows, fail_if_empty)
    return rows


def write_records(df: DataFrame, path: str, fmt: str, partition_cols: list[str] | None = None,
                  schema: T.StructType | None = None, batch_size: int = DEFAULT_BATCH) -> int:
    """Route by format (K1): ``csv`` -> CSV (partitioning ignored), ``parquet`` -> partitioned.

    Unlike the client, an unknown format is an error rather than Parquet.
    """
    if fmt == "csv":
        return write_csv(df, path, schema)
    if fmt == "parquet":
        return write_partitioned(df, path, partition_cols or [], schema, batch_size=batch_size)
    raise ValueError(f"unknown format {fmt!r}; expected one of {FORMATS}")


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read back with the fixed schema: partition values stay STRING/LONG (T2), column order restored."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).options(**CSV_OPTIONS).option("multiLine", "true").csv(
        f"{path.rstrip('/')}/data.csv")
