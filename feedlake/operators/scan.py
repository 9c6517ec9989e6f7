"""Distributed prefix scan: running sum / max per key in a global order.

A SQL window ``PARTITION BY key ORDER BY t`` puts every row of a key in one
task, so a key holding a third of the data means one task holding a third of
the data. This operator never groups by the key alone:

  1. the input is written once to the shared scratch folder; everything below
     reads that table, so the source is computed and read once.
  2. boundaries: the ``32 * n`` rows with the smallest random number (a size
     set by the bucket count, not the data) give ``n - 1`` boundary tuples of
     (key, order); a binary search in that sorted array turns each row's tuple
     into a bucket id, a plain data column. A hot key spans many buckets.
  3. rows are hash-distributed by bucket; a window per (bucket, key) gives the
     running value there. A bucket's size is set by the bucket count, so no
     window holds a whole hot key.
  4. per bucket: first key, last key and the last key's partial aggregate
     (map-side partial aggregation, one row per bucket) -> a window over that
     tiny table gives the carry each bucket's first key needs from earlier
     buckets.
  5. the carry table (at most ``n`` rows, so its broadcast size is bounded by
     the bucket count, not the data) is joined back and combined.

Buckets are data, not partition ids, so the two branches agree however the
data is physically split, recomputed or re-planned after an executor loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlake.session import scratch_path

LOCAL = "_scan_local"
BKT = "_scan_bucket"
SAMPLE_PER_BUCKET = 32
SAMPLE_SEED = 20240601


def boundaries(df: DataFrame, cols: list[str], n: int) -> list[tuple]:
    """Up to ``n - 1`` sorted boundary tuples from a seeded sample of 32 rows per bucket, taken in one pass."""
    if n <= 1:
        return []
    sample = df.select(*cols).orderBy(F.rand(SAMPLE_SEED)).limit(SAMPLE_PER_BUCKET * n).collect()
    rows = sorted(tuple(r) for r in sample)
    if not rows:
        return []
    step = len(rows) / n
    return sorted({rows[min(len(rows) - 1, int(step * i))] for i in range(1, n)})


def bucket_of(df: DataFrame, cols: list[str], bounds: list[tuple]):
    """Number of boundaries <= the row's tuple: a binary search, so the expression does not grow with ``bounds``."""
    if not bounds:
        return F.lit(0)
    row = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(cols)])
    kinds = [df.schema[c].dataType for c in cols]
    table = F.array(*[F.struct(*[F.lit(v).cast(t).alias(f"c{i}") for i, (v, t) in enumerate(zip(b, kinds))]) for b in bounds])

    def halve(at, _):
        mid = F.shiftright(at["lo"] + at["hi"], 1)
        passed = F.get(table, mid) <= row
        return F.when(at["lo"] >= at["hi"], at).otherwise(F.struct(
            F.when(passed, mid + 1).otherwise(at["lo"]).alias("lo"), F.when(passed, at["hi"]).otherwise(mid).alias("hi")))

    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))
    return F.aggregate(F.array_repeat(F.lit(0), len(bounds).bit_length() + 1), start, halve, lambda at: at["lo"])


def _carry_table(bucketed: DataFrame, keys: list[str], value: str, op: str) -> DataFrame:
    """One row per bucket b: (b, key, carry) = what b's first key brings in from earlier buckets.

    The key's earlier rows sit in a contiguous run of buckets ending at b-1:
    the first of them ends with the key, the rest hold only that key. So the
    carry is a running op over bucket summaries, restarted wherever that run
    breaks.
    """
    agg = F.sum if op == "sum" else F.max
    kstruct = F.struct(*[F.col(k) for k in keys])
    per_key = bucketed.groupBy(BKT, kstruct.alias("_k")).agg(agg(value).alias("_v"))
    summary = per_key.groupBy(BKT).agg(F.min("_k").alias("_first_key"), F.max("_k").alias("_last_key"),
                                       F.max_by("_v", "_k").alias("_last_val"))
    by_bucket = Window.orderBy(BKT)
    prev_last = F.lag("_last_key").over(by_bucket)
    prev_bkt = F.lag(BKT).over(by_bucket)
    brk = (prev_last.isNull() | (prev_last != F.col("_first_key")) | (F.col("_first_key") != F.col("_last_key")))
    summ = summary.withColumn("_brk", F.when(brk, 1).otherwise(0)).withColumn("_prev_bkt", prev_bkt)
    summ = summ.withColumn("_chain", F.sum("_brk").over(by_bucket.rowsBetween(Window.unboundedPreceding, 0)))
    in_chain = Window.partitionBy("_chain").orderBy(BKT).rowsBetween(Window.unboundedPreceding, 0)
    summ = summ.withColumn("_upto", agg("_last_val").over(in_chain))
    # The carry goes to the next non-empty bucket.
    nxt = F.lead(BKT).over(by_bucket)
    return summ.select(nxt.alias(BKT), F.col("_last_key").alias("_carry_key"),
                       F.col("_upto").cast("bigint").alias("_carry")).where(F.col(BKT).isNotNull())


def prefix_scan(df: DataFrame, keys: list[str], order: list[str], value: str, op: str, out: str,
                num_partitions: int | None = None) -> DataFrame:
    """Adds ``out`` = running ``op`` (sum | max) of ``value`` per ``keys`` in ``order``.

    ``value`` must be a non-null LONG; keys and order columns non-null. The
    order must be total within a key (add a unique tiebreak column).
    """
    if op not in ("sum", "max"):
        raise ValueError("op must be sum or max")
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = keys + order
    path = scratch_path(spark, "scan")
    df.write.parquet(path)
    df = spark.read.schema(df.schema).parquet(path)
    bucketed = df.withColumn(BKT, bucket_of(df, cols, boundaries(df, cols, n)))
    running = Window.partitionBy(BKT, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # dealt by bucket alone: (bucket, key) is then together too, and the window adds no shuffle
    local = bucketed.repartition(n, BKT).withColumn(LOCAL, (F.sum if op == "sum" else F.max)(value).over(running))
    # At most ``n`` rows: the broadcast is bounded by the bucket count, not by the data.
    carry = F.broadcast(_carry_table(bucketed, keys, value, op))
    joined = local.join(carry, on=BKT, how="left")
    kstruct = F.struct(*[F.col(k) for k in keys])
    hit = F.col("_carry").isNotNull() & (kstruct == F.col("_carry_key"))
    comb = (F.col(LOCAL) + F.col("_carry")) if op == "sum" else F.greatest(F.col(LOCAL), F.col("_carry"))
    return joined.withColumn(out, F.when(hit, comb).otherwise(F.col(LOCAL)).cast("bigint")).drop(
        LOCAL, BKT, "_carry", "_carry_key")
