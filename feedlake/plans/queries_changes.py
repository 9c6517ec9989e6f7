"""Snapshot difference of two landings, and run metrics merged from stored sketches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.operators import sketches
from feedlake.operators.snapshot_diff import snapshot_diff
from feedlake.plans.catalog import register
from feedlake.session import read_table, scratch_path


@register("snapshot_diff", """
WITH a AS (SELECT o_orderkey, o_orderstatus AS status, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, o_orderpriority AS priority FROM orders),
b AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 2 THEN NULL ELSE status END AS status,
    cents + CASE WHEN o_orderkey % 14 = 2 THEN 1 ELSE 0 END AS cents, priority FROM a WHERE o_orderkey % 10 <> 3
  UNION ALL SELECT o_orderkey + 1000000000, status, cents, priority FROM a WHERE o_orderkey % 20 = 1)
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
  CASE WHEN a.o_orderkey IS NULL THEN 'inserted' WHEN b.o_orderkey IS NULL THEN 'deleted' ELSE 'changed' END AS kind,
  CASE WHEN a.o_orderkey IS NULL OR b.o_orderkey IS NULL THEN '' ELSE concat_ws(',',
    CASE WHEN a.status IS DISTINCT FROM b.status THEN 'status' END, CASE WHEN a.cents <> b.cents THEN 'cents' END) END AS changed
FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey
WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.status IS DISTINCT FROM b.status OR a.cents <> b.cents
""")
def q_snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of the orders: a tenth is gone, a seventh has changed, some are new."""
    old = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("status"), F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
        F.col("o_orderpriority").alias("priority"))
    k = F.col("o_orderkey")
    new = old.filter(k % 10 != 3).withColumns({
        "status": F.when(k % 7 != 2, F.col("status")), "cents": F.col("cents") + F.when(k % 14 == 2, 1).otherwise(0)})
    new = new.unionByName(old.filter(k % 20 == 1).withColumn("o_orderkey", k + 1_000_000_000))
    diff = snapshot_diff(old, new, ["o_orderkey"])
    return diff.select("o_orderkey", "kind", F.array_join("changed", ",").alias("changed"))


@register("run_metrics_merged", """
WITH e AS (SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS func_name, CAST(round(value * 1000) AS BIGINT) AS us FROM events),
g AS (SELECT func_name, day, grouping(func_name) + grouping(day) AS up, count(us) AS n, CAST(sum(us) AS BIGINT) AS total_us, max(us) AS max_us
  FROM e GROUP BY ROLLUP (func_name, day))
SELECT func_name, day, CAST(2 - up AS INTEGER) AS level, n, total_us, max_us, true AS median_within, true AS p99_within, true AS users_within FROM g
""")
def q_run_metrics_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: sketches of four runs merged over days and functions; quantiles and users are compared with the exact ones."""
    e = read_table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.col("event_type").alias("func_name"), F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.round(F.col("value") * 1000).cast("bigint").alias("us"))
    path, by = scratch_path(spark, "sketches"), ["func_name", "day"]
    for run in range(4):
        sketches.save_run(e.filter(F.col("event_id") % 4 == run), path, f"r{run}", by, "us", "user_id")
    got = sketches.merged(spark, path, by, {"median": 0.5, "p99": 0.99})
    level = (F.lit(2) - F.grouping("func_name") - F.grouping("day")).cast("int")
    exact = e.rollup(*by).agg(
        level.alias("level"), F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY us)").alias("x50"),
        F.expr("percentile_disc(0.99) WITHIN GROUP (ORDER BY us)").alias("x99"), F.countDistinct("user_id").alias("users"))
    same = got["level"].eqNullSafe(exact["level"])
    for c in by:
        same = same & got[c].eqNullSafe(exact[c])

    def within(estimate: str, true: str, share: float):
        return F.abs(F.col(estimate) - F.col(true)) <= F.col(true) * share + 1e-6

    return got.join(exact, same).select(
        got["func_name"], got["day"], got["level"], "n", F.col("total").alias("total_us"), F.col("most").alias("max_us"),
        within("median", "x50", sketches.ACCURACY).alias("median_within"), within("p99", "x99", sketches.ACCURACY).alias("p99_within"),
        within("n_distinct", "users", 0.08).alias("users_within"))
