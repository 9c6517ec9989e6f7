"""Incremental ingest of a landed folder (X1): Structured Streaming, one ledger entry for each batch.

``ingest_new`` reads the files that have come since the last run (checkpoint, ``availableNow``)
and stops. Each micro-batch

* is written to its own folder ``rows/batch=<id>/late=<bool>``, replacing what a killed try has left there;
* then gets its ledger entry ``ledger/<id>.json``: rows, late rows and the latest event time seen so far.

Only batches with an entry are read (``accepted``, ``late``). A batch that Spark
hands over again (it died before the checkpoint was advanced) finds its entry
and writes nothing, so every row is there once.

Late rows. With an ``event_time`` column a row is late if it is older than the latest event time of
earlier batches less ``delay``. Late rows are kept beside the others, not dropped; rows without an
event time are never late. The bound is taken from the ledger, so a repeated batch is split as it was the first time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.sinks import versions

EPOCH = dt.datetime(1970, 1, 1)


def ledger(spark: SparkSession, target: str) -> list[dict]:
    """Entries in batch order: batch, rows, late, latest (microseconds since 1970; null: no event time yet)."""
    folder = f"{target}/ledger"
    return [versions.read(spark, folder, n) for n in versions.numbers(spark, folder)]


def _micros(value: dt.datetime | None) -> int | None:
    return None if value is None else (value.replace(tzinfo=None) - EPOCH) // dt.timedelta(microseconds=1)


def write_batch(df: DataFrame, batch: int, target: str, event_time: str | None = None,
                delay: dt.timedelta = dt.timedelta(0)) -> bool:
    """One micro-batch; False if the ledger has it already."""
    spark = df.sparkSession
    earlier = [e for e in ledger(spark, target) if e["batch"] <= batch]
    if any(e["batch"] == batch for e in earlier):
        return False
    known = max((e["latest"] for e in earlier if e["latest"] is not None), default=None)
    late, latest = F.lit(False), F.lit(None).cast("timestamp_ntz")
    if event_time is not None:
        latest = F.max(F.col(event_time).cast("timestamp_ntz"))
        if known is not None:
            bound = EPOCH + dt.timedelta(microseconds=known) - delay
            late = F.coalesce(F.col(event_time).cast("timestamp_ntz") < F.lit(bound.isoformat()).cast("timestamp_ntz"), F.lit(False))
    seen = Observation(f"ingest-{batch}")
    split = df.withColumn("late", late).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.col("late").cast("bigint")), F.lit(0)).alias("late"),
        (latest if event_time is not None else F.max(latest)).alias("latest"))
    split.write.mode("overwrite").partitionBy("late").parquet(f"{target}/rows/batch={batch}")
    got = seen.get
    mine = _micros(got["latest"])
    entry = {"batch": batch, "rows": got["rows"], "late": got["late"],
             "latest": max((x for x in (known, mine) if x is not None), default=None)}
    versions.publish(spark, f"{target}/ledger", batch, entry)
    return True


def ingest_new(spark: SparkSession, landed: str, schema: T.StructType, target: str, event_time: str | None = None,
               delay: dt.timedelta = dt.timedelta(0), transform: Callable[[DataFrame], DataFrame] | None = None,
               max_files: int | None = None) -> list[dict]:
    """Ingest what is new in ``landed`` (Parquet files) and return the ledger. ``max_files``: files of one micro-batch."""
    source = spark.readStream.schema(schema)
    if max_files:
        source = source.option("maxFilesPerTrigger", max_files)

    def batch(df: DataFrame, number: int) -> None:
        write_batch(transform(df) if transform else df, number, target, event_time, delay)

    query = (source.parquet(landed).writeStream.foreachBatch(batch).trigger(availableNow=True)
             .option("checkpointLocation", f"{target}/checkpoint").start())
    query.awaitTermination()
    return ledger(spark, target)


def _read(spark: SparkSession, schema: T.StructType, target: str, late: bool) -> DataFrame:
    paths = [f"{target}/rows/batch={e['batch']}/late={str(late).lower()}" for e in ledger(spark, target)
             if (e["late"] if late else e["rows"] - e["late"])]
    extra = [T.StructField("batch", T.IntegerType()), T.StructField("late", T.BooleanType())]
    if not paths:
        return spark.createDataFrame([], T.StructType(schema.fields + extra))
    return spark.read.schema(T.StructType(schema.fields + extra)).option("basePath", f"{target}/rows").parquet(*paths)


def accepted(spark: SparkSession, schema: T.StructType, target: str) -> DataFrame:
    """Rows that were in time, with their ``batch``."""
    return _read(spark, schema, target, False)


def late(spark: SparkSession, schema: T.StructType, target: str) -> DataFrame:
    """Rows that came too late, with their ``batch``."""
    return _read(spark, schema, target, True)
