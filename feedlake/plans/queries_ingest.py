"""Queries of the ingest side: filters sent to the server, incremental ingest, event-time windows, keyed merge."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.coerce import int_div
from feedlake.plans.catalog import register
from feedlake.session import read_table, scratch_path
from feedlake.sinks import merge
from feedlake.sources import rest_records
from feedlake.sources.fetch import write_store
from feedlake.streaming import ingest, windows

PAGE_ORDERS = 100
ORDER_COLUMNS = "o_orderkey bigint, o_custkey bigint, season bigint, status string, total bigint"
#: What the server filters by, in the order of its parameters.
SERVER_PARAMS = {"season =": "season", "status =": "status"}


def filtered_order_pages(spark: SparkSession, sf_dir: str, base: str) -> DataFrame:
    """Responses of an orders listing that knows the parameters season and status: each combination that occurs, and none."""
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").cast("bigint").alias("season"), F.col("o_orderstatus").alias("status"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("total"))
    record = F.struct(*o.columns)
    none = F.create_map().cast("map<string,string>")
    both = o.select(F.create_map(F.lit("season"), F.col("season").cast("string"), F.lit("status"), F.col("status")).alias("params"),
                    F.concat_ws("|", "season", "status").alias("of"), int_div(F.col("o_orderkey"), PAGE_ORDERS * 20).alias("part"),
                    record.alias("r"))
    plain = o.select(none.alias("params"), F.lit("").alias("of"), int_div(F.col("o_orderkey"), PAGE_ORDERS).alias("part"), record.alias("r"))
    rows = both.unionByName(plain)
    pages = rows.groupBy("of", "part").agg(F.collect_list("r").alias("records"))
    last = rows.groupBy("of").agg(F.max("part").alias("last"), F.first("params").alias("params"))
    planned = last.select("of", "params", (F.col("last") + 1).alias("total_pages"),
                          F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last"))).alias("part"))
    full = planned.join(pages, ["of", "part"], "left")
    empty = F.array().cast(pages.schema["records"].dataType)
    return full.select(
        F.col("part").alias("task_index"), F.lit(base).alias("path"), "params", none.alias("args"),
        (F.col("part") + 1).cast("bigint").alias("page"),
        F.to_json(F.struct("total_pages", F.coalesce("records", empty).alias("records"))).alias("body"))


def order_records(spark: SparkSession, root: str, base: str = "/orders") -> DataFrame:
    rest_records.register(spark)
    return (spark.read.format("rest_records").schema(ORDER_COLUMNS).option("url", base).option("mode", "async")
            .option("transport", json.dumps({"kind": "file", "root": root}))
            .option("params", json.dumps(SERVER_PARAMS)).load())


@register("page_filters_pushed", """
SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS BIGINT) AS season, o_orderstatus AS status,
  CAST(round(o_totalprice * 100) AS BIGINT) AS total
FROM orders WHERE year(o_orderdate) = 1996 AND o_orderstatus = 'F' AND round(o_totalprice * 100) > 10000000
""")
def q_page_filters_pushed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Season and status of the filter become request parameters, the price stays with Spark."""
    root = scratch_path(spark, "store")
    write_store(filtered_order_pages(spark, sf_dir, "/orders"), root)
    return order_records(spark, root).where("season = 1996 AND status = 'F' AND total > 10000000")


@register("ingest_incremental", "SELECT event_id, ts, user_id, event_type, value FROM events")
def q_ingest_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events land in two halves, each half is ingested by a run of its own; a third run finds nothing new."""
    events = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    landed, target = scratch_path(spark, "landed"), scratch_path(spark, "ingested")
    for half in (0, 1):
        events.filter(F.col("event_id") % 2 == half).write.mode("append").parquet(landed)
        ingest.ingest_new(spark, landed, events.schema, target)
    ingest.ingest_new(spark, landed, events.schema, target)
    return ingest.accepted(spark, events.schema, target).select(*events.columns)


DELIVERIES, DELAY = 4, dt.timedelta(hours=1)
DELIVERED_SQL = """
d AS (SELECT event_id, ts, user_id, event_type, CAST(round(value * 100) AS BIGINT) AS cents,
  least(3, event_id * 4 // (SELECT max(event_id) + 1 FROM events) + CASE WHEN event_id % 10 = 3 THEN 1 ELSE 0 END) AS delivery FROM events),
e AS (SELECT d.*, coalesce(ts < (SELECT max(p.ts) FROM d p WHERE p.delivery < d.delivery) - INTERVAL 1 HOUR, false) AS late FROM d)
"""


def delivered(spark: SparkSession, sf_dir: str) -> tuple[str, object]:
    """Events in four deliveries by event_id; every tenth event comes one delivery later. Ingested one by one."""
    events = read_table(spark, sf_dir, "events")
    last = events.agg(F.max("event_id")).first()[0]
    part = int_div(F.col("event_id") * DELIVERIES, (last or 0) + 1) + F.when(F.col("event_id") % 10 == 3, 1).otherwise(0)
    events = events.select("event_id", "ts", "user_id", "event_type", F.round(F.col("value") * 100).cast("bigint").alias("cents"),
                           F.least(F.lit(DELIVERIES - 1), part).cast("bigint").alias("delivery"))
    landed, target = scratch_path(spark, "landed"), scratch_path(spark, "ingested")
    for k in range(DELIVERIES):
        events.filter(F.col("delivery") == k).write.mode("append").parquet(landed)
        ingest.ingest_new(spark, landed, events.schema, target, "ts", DELAY)
    return target, events.schema


@register("event_late_rows", f"""
WITH {DELIVERED_SQL}
SELECT event_id, CAST(delivery AS BIGINT) AS delivery, late FROM e
""")
def q_event_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late rows are kept in their own folders beside the rows in time."""
    target, schema = delivered(spark, sf_dir)
    both = ingest.accepted(spark, schema, target).unionByName(ingest.late(spark, schema, target))
    return both.select("event_id", "delivery", "late")


@register("event_windows_sliding", f"""
WITH {DELIVERED_SQL},
w AS (SELECT event_type, cents, time_bucket(INTERVAL 2 HOUR, ts, TIMESTAMP '1970-01-01') - INTERVAL 2 HOUR * k AS window_start
  FROM e, range(3) r(k) WHERE NOT late)
SELECT event_type, window_start, window_start + INTERVAL 6 HOUR AS window_end, count(*) AS n,
  CAST(sum(cents) AS BIGINT) AS cents FROM w GROUP BY event_type, window_start
""")
def q_event_windows_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of six hours, every two hours, by event type, over the rows that came in time."""
    target, schema = delivered(spark, sf_dir)
    return windows.sliding(ingest.accepted(spark, schema, target), "ts", "6 hours", "2 hours", ["event_type"],
                           [F.count("*").alias("n"), F.sum("cents").alias("cents")])


@register("event_windows_session", f"""
WITH {DELIVERED_SQL},
g AS (SELECT user_id, ts, cents, CASE WHEN ts < lag(ts) OVER w + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens
  FROM e WHERE NOT late WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 6 HOUR AS session_end, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents
FROM s GROUP BY user_id, k
""")
def q_event_windows_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of each user with a gap of six hours, over the rows that came in time."""
    target, schema = delivered(spark, sf_dir)
    return windows.sessions(ingest.accepted(spark, schema, target), "ts", "6 hours", ["user_id"],
                            [F.count("*").alias("n"), F.sum("cents").alias("cents")])


@register("sink_merge", """
WITH b AS (SELECT o_orderkey, o_custkey, o_orderstatus AS status, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
  CAST(year(o_orderdate) AS BIGINT) AS season FROM orders),
c AS (
  SELECT o_orderkey, o_custkey + 2 AS o_custkey, 'X' AS status, cents, season + CASE WHEN o_orderkey % 8 = 0 THEN 1 ELSE 0 END AS season,
    o_orderkey % 10 = 0 AS gone FROM b WHERE o_orderkey % 2 = 0
  UNION ALL SELECT o_orderkey + 100000000, o_custkey, 'N', cents, season, false FROM b WHERE o_orderkey % 3 = 0)
SELECT coalesce(c.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN c.status IS NULL THEN b.o_custkey ELSE c.o_custkey END AS o_custkey,
  coalesce(c.status, b.status) AS status, coalesce(c.cents, b.cents) AS cents, coalesce(c.season, b.season) AS season
FROM b FULL JOIN c ON b.o_orderkey = c.o_orderkey WHERE NOT coalesce(c.gone, false)
""")
def q_sink_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: half of the orders change (some move to another season, some go, each changed twice), others are new."""
    base = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderstatus").alias("status"), F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
        F.year("o_orderdate").cast("bigint").alias("season"))
    root = scratch_path(spark, "merged")
    first = base.withColumns({"seq": F.lit(0), "gone": F.lit(False)})
    merge.merge(spark, root, first, ["o_orderkey"], ["seq"], "season", "gone")
    half = base.filter("o_orderkey % 2 = 0").withColumn("status", F.lit("X"))
    moved = F.col("season") + F.when(F.col("o_orderkey") % 8 == 0, 1).otherwise(0)
    older = half.withColumns({"o_custkey": F.col("o_custkey") + 1, "seq": F.lit(1), "gone": F.lit(True)})
    newer = half.withColumns({"o_custkey": F.col("o_custkey") + 2, "season": moved.cast("bigint"), "seq": F.lit(2),
                              "gone": F.col("o_orderkey") % 10 == 0})
    fresh = base.filter("o_orderkey % 3 = 0").withColumns({
        "o_orderkey": F.col("o_orderkey") + 100_000_000, "status": F.lit("N"), "seq": F.lit(1), "gone": F.lit(False)})
    merge.merge(spark, root, newer.unionByName(older).unionByName(fresh), ["o_orderkey"], ["seq"], "season", "gone")
    return merge.read_table(spark, root)
