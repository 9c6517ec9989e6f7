"""Joins on time: each event's last purchase (as-of), events inside order-to-ship intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.operators.time_joins import asof_join, interval_join
from feedlake.plans.catalog import register
from feedlake.session import read_table


@register("asof_last_purchase", """
WITH p AS (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'purchase' GROUP BY user_id, ts)
SELECT e.event_id, e.user_id, e.event_type, p.event_id AS purchase_id, p.ts AS purchase_ts
FROM events e ASOF LEFT JOIN p ON e.user_id = p.user_id AND e.ts >= p.ts
""")
def q_asof_last_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with its user's last purchase (a purchase is its own)."""
    events = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    purchases = events.filter("event_type = 'purchase'").select("user_id", "ts", "event_id")
    joined = asof_join(events, purchases, ["user_id"], "ts", "ts", keep="purchase")
    return joined.select("event_id", "user_id", "event_type", F.col("purchase.event_id").alias("purchase_id"),
                         F.col("purchase.ts").alias("purchase_ts"))


@register("asof_earlier_error", """
WITH p AS (SELECT ts, max(event_id) AS event_id FROM events WHERE event_type = 'error' GROUP BY ts),
j AS (SELECT e.event_id, e.ts, p.event_id AS error_id, p.ts AS error_ts FROM events e ASOF LEFT JOIN p ON e.ts > p.ts)
SELECT event_id, CASE WHEN ts - error_ts <= INTERVAL 10 MINUTE THEN error_id END AS error_id FROM j
""")
def q_asof_earlier_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with the last earlier error of anybody, at most ten minutes before: one key for all rows."""
    events = read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    errors = events.filter("event_type = 'error'").select("ts", "event_id")
    joined = asof_join(events, errors, [], "ts", "ts", keep="error", strict=True, within=10 * 60 * 1_000_000)
    return joined.select("event_id", F.col("error.event_id").alias("error_id"))


#: Events happen in one month, orders in seven years: an event's clock runs eighty times as fast, from the first order year on.
EVENT_CLOCK_SQL = "(epoch_us(ts) // 1000000 - 1704067200) * 80 + 788918400"


@register("interval_open_orders", f"""
SELECT e.event_id, count(*) AS n_open, CAST(sum(l.l_orderkey * 10 + l.l_linenumber) AS BIGINT) AS lines
FROM (SELECT event_id, user_id, {EVENT_CLOCK_SQL} AS at FROM events) e
JOIN orders o ON o.o_custkey = e.user_id
JOIN lineitem l ON l.l_orderkey = o.o_orderkey
WHERE epoch_us(o.o_orderdate) // 1000000 <= e.at AND e.at < epoch_us(l.l_shipdate) // 1000000
GROUP BY e.event_id
""")
def q_interval_open_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a customer between the order and the shipping of the customer's order lines."""
    events = read_table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("customer"),
        ((F.unix_seconds(F.col("ts").cast("timestamp")) - 1704067200) * 80 + 788918400).alias("at"))
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("customer"), "o_orderdate")
    # a customer without events has no pair: the orders of the others only meet their lines
    orders = orders.join(events.select("customer").distinct(), "customer", "left_semi")
    lines = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    spans = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        "customer", "l_orderkey", "l_linenumber", F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("ordered"),
        F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("shipped"))
    pairs = interval_join(events, spans, "at", "ordered", "shipped", ["customer"], "event", "line", unit=86_400)
    return pairs.groupBy(F.col("event.event_id").alias("event_id")).agg(
        F.count("*").alias("n_open"), F.sum(F.col("line.l_orderkey") * 10 + F.col("line.l_linenumber")).alias("lines"))
