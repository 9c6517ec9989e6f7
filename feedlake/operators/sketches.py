"""Mergeable run metrics (O1): sketches are stored per run and merged over days and functions later.

Quantiles: a value goes to a bucket of geometric width, so counts per bucket
are a sketch that merges by adding; a quantile read from it is off by at most ``accuracy`` of the exact value.
Distinct values: HyperLogLog sketches, merged by Spark's own union. Groups hold at most
one row per bucket (some 1,500 for 1 microsecond to 100 days at 1 %), however many runs they cover.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ACCURACY = 0.01
LG_K = 12  # HyperLogLog registers: 2^12, a standard error of 1.6 %
ZERO = -(1 << 31)  # bucket of the value 0


def _gamma(accuracy: float) -> float:
    return (1 + accuracy) / (1 - accuracy)


def value_bucket(value: Column, accuracy: float = ACCURACY) -> Column:
    """Number of the bucket (gamma^(b-1), gamma^b] that holds the value; negative values raise."""
    log = F.ceil(F.log(value.cast("double")) / math.log(_gamma(accuracy))).cast("int")
    return F.when(value < 0, F.raise_error(F.lit("negative value in a quantile sketch"))).when(value == 0, ZERO).otherwise(log)


def bucket_value(bucket: Column, accuracy: float = ACCURACY) -> Column:
    g = _gamma(accuracy)
    return F.when(bucket == ZERO, 0.0).otherwise(F.pow(F.lit(g), bucket) * (2 / (g + 1)))


def save_run(rows: DataFrame, path: str, run: str, by: list[str], value: str, distinct: str, accuracy: float = ACCURACY) -> None:
    """Write the sketches of one run under ``path/run=<run>``; a repeated run replaces its own.

    One row for each group and bucket (count, sum, largest value) and one for each group with the sketch
    of ``distinct``. Rows with a null value count for the distinct sketch alone; null groups are groups.
    """
    kept = rows.select(*by, F.col(value).alias("v"), F.col(distinct).cast("string").alias("d"))
    hist = kept.filter("v IS NOT NULL").groupBy(*by, value_bucket(F.col("v"), accuracy).alias("bucket")).agg(
        F.count("*").alias("n"), F.sum("v").cast("bigint").alias("total"), F.max("v").cast("bigint").alias("most"),
        F.lit(None).cast("binary").alias("who"))
    who = kept.groupBy(*by).agg(F.hll_sketch_agg("d", LG_K).alias("who")).select(
        *by, F.lit(None).cast("int").alias("bucket"), F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("total"),
        F.lit(None).cast("bigint").alias("most"), "who")
    hist.unionByName(who).withColumn("run", F.lit(run)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path)


def merged(spark: SparkSession, path: str, by: list[str], quantiles: dict[str, float], accuracy: float = ACCURACY) -> DataFrame:
    """The runs under ``path`` merged, rolled up over ``by`` from the right.

    (by..., level, n, total, most, n_distinct, one column per quantile); ``level``: how many of ``by`` a row keeps
    (the others are null). A quantile q is the value of rank ceil(q * n), within ``accuracy``; null where a group has no values.
    """
    store = spark.read.parquet(path)
    sets = [[*by[:i], "bucket"] for i in range(len(by), -1, -1)]
    level = F.lit(len(by))
    for c in by:
        level = level - F.grouping(c)
    parts = store.groupingSets(sets, *by, "bucket").agg(
        level.cast("int").alias("level"), F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("most").alias("most"),
        F.hll_union_agg("who").alias("who"))
    group = ["level", *by]
    so_far = Window.partitionBy(*group).orderBy(F.col("bucket").asc_nulls_first())
    ranked = parts.withColumn("upto", F.sum("n").over(so_far)).withColumn("all", F.sum("n").over(Window.partitionBy(*group)))

    def at(q: float) -> Column:
        reached = F.col("bucket").isNotNull() & (F.col("upto") >= F.ceil(F.lit(q) * F.col("all")))
        return bucket_value(F.min(F.when(reached, F.col("bucket"))), accuracy)

    return ranked.groupBy(*group).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("most").alias("most"),
        F.hll_sketch_estimate(F.max(F.when(F.col("bucket").isNull(), F.col("who")))).alias("n_distinct"),
        *[at(q).alias(name) for name, q in quantiles.items()])
