"""Rate, retry, backoff and log queries: R1, R2, S12, O3, O1/O2, K7."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.coerce import int_div
from feedlake.operators import rate
from feedlake.plans.catalog import register
from feedlake.session import read_table

AUDIT_WINDOW_US = 3600 * 1_000_000
ADMIT_WINDOW_US = 60 * 1_000_000


def _micros(col: str):
    return F.unix_micros(F.col(col).cast("timestamp"))


@register("rate_audit", f"""
SELECT event_type, event_id, t,
       CAST(count(*) OVER (PARTITION BY event_type ORDER BY t
            RANGE BETWEEN {AUDIT_WINDOW_US - 1} PRECEDING AND CURRENT ROW) AS BIGINT) AS in_window,
       count(*) OVER (PARTITION BY event_type ORDER BY t
            RANGE BETWEEN {AUDIT_WINDOW_US - 1} PRECEDING AND CURRENT ROW) > 10 AS over_limit
FROM (SELECT event_type, event_id, epoch_us(ts) AS t FROM events)
""")
def q_rate_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls per event type in the trailing hour, flagged above 10."""
    ev = read_table(spark, sf_dir, "events").select("event_type", "event_id", _micros("ts").alias("t"))
    return rate.rate_audit(ev, "event_type", "t", "event_id", limit=10, window_us=AUDIT_WINDOW_US)


@register("rate_admission", f"""
WITH n AS (
  SELECT event_type, event_id, epoch_us(ts) // 100 AS t,
         row_number() OVER (PARTITION BY event_type ORDER BY epoch_us(ts) // 100, event_id) - 1 AS i
  FROM events
), s AS (
  SELECT *, i // 10 AS q, i % 10 AS m FROM n
), a AS (
  SELECT event_type, event_id, t,
         q * {ADMIT_WINDOW_US} + max(t - q * {ADMIT_WINDOW_US}) OVER (PARTITION BY event_type, m ORDER BY i
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS admitted
  FROM s
)
SELECT event_type, event_id, t, CAST(admitted AS BIGINT) AS admitted, CAST(admitted - t AS BIGINT) AS wait FROM a
""")
def q_rate_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2: admission time of each event (time compressed 100x) under 10 calls / 60 s per type."""
    ev = read_table(spark, sf_dir, "events").select(
        "event_type", "event_id", int_div(_micros("ts"), 100).alias("t"))
    return rate.rate_admission(ev, "event_type", "t", "event_id", limit=10, window_us=ADMIT_WINDOW_US)


from feedlake.operators import metrics, retry  # noqa: E402

STATUS_OF_EVENT = """CASE event_type WHEN 'view' THEN 200 WHEN 'signup' THEN 201 WHEN 'click' THEN 429
                 WHEN 'purchase' THEN 404 ELSE 500 + event_id % 4 END"""


@register("retry_classify", f"""
SELECT event_id, http_status, attempt, retry_after,
       CASE WHEN http_status BETWEEN 200 AND 299 THEN 'ok'
            WHEN http_status = 429 THEN 'wait_retry'
            WHEN http_status >= 500 AND attempt < 3 THEN 'retry'
            ELSE 'fail' END AS action,
       CAST(CASE WHEN http_status BETWEEN 200 AND 299 THEN 0
            WHEN http_status = 429 THEN
                 CASE WHEN regexp_full_match(trim(retry_after), '[0-9]+') THEN CAST(trim(retry_after) AS BIGINT) ELSE 5 END
            WHEN http_status >= 500 AND attempt < 3 THEN least(CAST(pow(2, attempt - 1) AS BIGINT), 10)
            ELSE 0 END AS BIGINT) AS wait_s
FROM (
  SELECT event_id, {STATUS_OF_EVENT} AS http_status, CAST(event_id % 3 + 1 AS BIGINT) AS attempt,
         CASE WHEN event_id % 5 = 0 THEN 'Wed, 21 Oct 2026 07:28:00 GMT'
              ELSE CAST(CAST(json_extract(props, '$.k') AS BIGINT) % 90 AS VARCHAR) END AS retry_after
  FROM events
)
""")
def q_retry_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page retry policy for each event read as a response."""
    ev = read_table(spark, sf_dir, "events")
    status = (F.when(F.col("event_type") == "view", 200).when(F.col("event_type") == "signup", 201)
              .when(F.col("event_type") == "click", 429).when(F.col("event_type") == "purchase", 404)
              .otherwise(500 + F.col("event_id") % 4))
    ra = F.when(F.col("event_id") % 5 == 0, F.lit("Wed, 21 Oct 2026 07:28:00 GMT")).otherwise(
        (F.get_json_object("props", "$.k").cast("bigint") % 90).cast("string"))
    resp = ev.select("event_id", status.cast("int").alias("http_status"),
                     (F.col("event_id") % 3 + 1).cast("bigint").alias("attempt"), ra.alias("retry_after"))
    c = retry.classify(F.col("http_status"), F.col("retry_after"), F.col("attempt"), "page")
    return resp.select("event_id", "http_status", "attempt", "retry_after", c["action"].alias("action"),
                       c["wait_s"].alias("wait_s"))


@register("backoff_schedule", """
SELECT event_id, CAST(attempt AS BIGINT) AS attempt, CAST(round(value * 1000) AS BIGINT) * attempt AS wait_ms
FROM events, LATERAL (SELECT unnest(range(1, event_id % 4 + 1)) AS attempt)
""")
def q_backoff_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3: waits of a linear-backoff retry, ``times`` = 1 + id % 4, backoff = value seconds."""
    ev = read_table(spark, sf_dir, "events")
    return retry.backoff_schedule(ev, F.col("event_id") % 4 + 1, F.round(F.col("value") * 1000),
                                  keep=("event_id",))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events rendered as the client's JSON log lines (one per event)."""
    ev = read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    timed = F.struct(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS").alias("time"), F.lit("INFO").alias("level"),
        F.lit("feedlake.observability").alias("logger"), F.lit(metrics.RUN_COMPLETED).alias("msg"),
        F.col("event_type").alias("func_name"), F.col("value").alias("duration_ms"), F.col("event_id"), k.alias("k"))
    failed = F.struct(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS").alias("time"), F.lit("ERROR").alias("level"),
        F.lit("feedlake.fetch").alias("logger"), F.lit("Task failed").alias("msg"),
        F.col("event_id").alias("task_index"), F.concat(F.lit("HTTP "), (500 + k % 4).cast("string")).alias("error"),
        F.col("event_id"), k.alias("k"))
    line = F.when(F.col("event_type") == "error", F.to_json(failed)).otherwise(F.to_json(timed))
    return ev.select(line.alias("value"))


@register("log_parse", """
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S,%g') AS time,
       CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
       CASE WHEN event_type = 'error' THEN 'feedlake.fetch' ELSE 'feedlake.observability' END AS logger,
       CASE WHEN event_type = 'error' THEN 'Task failed' ELSE 'Run completed' END AS msg,
       event_id,
       CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       CASE WHEN event_type = 'error' THEN 'HTTP ' || CAST(500 + CAST(json_extract(props, '$.k') AS BIGINT) % 4 AS VARCHAR) END
         AS error
FROM events
""")
def q_log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: fixed fields + extras of JSON log lines."""
    p = metrics.parse_logs(log_lines(spark, sf_dir))
    return p.select(*metrics.FIXED, metrics.extra("event_id", "bigint").alias("event_id"),
                    metrics.extra("k", "bigint").alias("k"), metrics.extra("error").alias("error"))


@register("run_metrics", """
SELECT event_type AS func_name, count(*) AS runs,
       CAST(sum(CAST(round(value * 1000) AS BIGINT)) AS BIGINT) AS total_us,
       CAST(max(CAST(round(value * 1000) AS BIGINT)) AS BIGINT) AS max_us
FROM events WHERE event_type <> 'error' GROUP BY event_type
""")
def q_run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Durations of timed runs per function, from the log."""
    return metrics.run_metrics(metrics.parse_logs(log_lines(spark, sf_dir)))
