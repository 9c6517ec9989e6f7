"""Run metrics and structured log lines (O1, O2, K7).

Log lines are JSON objects ``{time, level, logger, msg, ...extras}`` with the
extras on the top level. ``parse_logs`` keeps the four fixed fields as
columns and the whole line as VARIANT, so any extra is one ``variant_get``
away without a schema per event kind. ``run_metrics`` aggregates the
``Run completed`` lines per function (partial aggregation per task, then a
shuffle keyed by function name: small, one row per name per task).
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Fixed value: log message of timed runs.
RUN_COMPLETED = "Run completed"
FIXED = ("time", "level", "logger", "msg")


def parse_logs(lines: DataFrame, col: str = "value") -> DataFrame:
    """JSON log lines -> time, level, logger, msg, line (VARIANT); unparseable lines -> ``bad`` = true."""
    v = F.try_parse_json(F.col(col))
    parsed = lines.select(*[c for c in lines.columns if c != col], v.alias("line"))
    return parsed.select(
        *[c for c in lines.columns if c != col],
        *[F.try_variant_get("line", f"$.{k}", "string").alias(k) for k in FIXED],
        "line",
        F.col("line").isNull().alias("bad"),
    )


def extra(name: str, dtype: str = "string"):
    return F.try_variant_get("line", f"$.{name}", dtype)


def run_metrics(parsed: DataFrame) -> DataFrame:
    """Per function: runs, total / max duration in microseconds (from ``duration_ms``)."""
    timed = parsed.where(F.col("msg") == RUN_COMPLETED).select(
        extra("func_name").alias("func_name"),
        F.round(extra("duration_ms", "double") * 1000).cast("bigint").alias("_us"))
    return timed.groupBy("func_name").agg(
        F.count("*").alias("runs"), F.sum("_us").alias("total_us"), F.max("_us").alias("max_us"))


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter that fills when ``df`` is consumed (K7: rows written)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


RUNS = "job string, started_ms bigint, duration_ms bigint, rows_written bigint, ok boolean"


class RunRecord:
    """One metrics row per job run, appended to ``path`` when the run ends, whether it succeeded or not."""

    def __init__(self, spark: SparkSession, path: str | None, job: str):
        self.spark, self.path, self.job, self.start = spark, path, job, time.time()
        self.rows, self.ok = None, False

    def done(self, rows: int | None) -> None:
        self.rows, self.ok = rows, True

    def close(self) -> None:
        if self.path is not None:
            row = (self.job, int(self.start * 1000), int((time.time() - self.start) * 1000), self.rows, self.ok)
            self.spark.createDataFrame([row], RUNS).coalesce(1).write.mode("append").parquet(self.path)
