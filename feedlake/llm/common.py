"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: Rows up to which a *measured* table may be hinted for broadcast (a few MB of narrow rows).
#: Larger tables are joined by an ordinary shuffle.
BROADCAST_ROWS = 50_000

#: Spark's setting that removes the shuffle files of a query when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def text_of(name: str = "text") -> Column:
    """The text column with null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; other letters stay. All-ASCII texts take the fast built-in path."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    This cuts the lineage (a lost executor re-reads the files instead of
    recomputing) and lets several consumers read one result. The shuffle files of this write are of no use
    once it is done and go at once; else they would stay until the driver collects its garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def small_arrow_batches(spark, rows: int = 1000, size: str = "8m") -> None:
    """Keep Arrow batches of long texts small: a few MB held by a task instead of tens.

    This sets two session settings (batch sizes only, results never depend on them)
    and leaves smaller values alone.
    """
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20)):
        now = spark.conf.get(key)
        if not now.rstrip("b").isdigit() or not 0 < int(now.rstrip("b")) <= most:
            spark.conf.set(key, str(rows) if most == rows else size)


def bounded_broadcast(df: DataFrame, weight: Column | None = None, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only if the (written, hence cheaply read) table is small.

    Tables of narrow rows are counted; for rows with arrays, ``weight`` is the number of elements of a row and
    the elements are summed, so the bound holds for the bytes sent either way.
    """
    if weight is None:
        small = df.limit(rows + 1).count() <= rows
    else:
        small = (df.agg(F.sum(weight + 1).alias("n")).first().n or 0) <= rows
    return F.broadcast(df) if small else df
