"""Retry policies as column expressions.

``page`` policy (paged scans):
  2xx                      ok
  429                      wait ``Retry-After`` seconds (default 5) and ask again;
                           the client loops without bound, here ``max_429`` caps it
  >= 500 or no response    retry, at most ``attempts`` tries in all, waiting
                           min(initial * 2^(try-1), max_wait) s (jitter not modelled)
  other 4xx                fail at once
``entity`` policy (entity GETs):
  2xx ok; 429 -> one retry after ``Retry-After`` (default 60); anything else fails.

``Retry-After`` is taken only as whole seconds; an HTTP-date or junk value
falls back to the default instead of failing (T10).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAGE_ATTEMPTS = 3
PAGE_INITIAL_S = 1
PAGE_MAX_WAIT_S = 10
PAGE_429_DEFAULT_S = 5
ENTITY_429_DEFAULT_S = 60


def retry_after_seconds(header: Column, default: int) -> Column:
    secs = F.when(F.trim(header).rlike("^[0-9]+$"), F.trim(header).try_cast("bigint"))
    return F.coalesce(secs, F.lit(default).cast("bigint"))


def classify(status: Column, retry_after: Column, attempt: Column, policy: str = "page",
             attempts: int = PAGE_ATTEMPTS, max_429: int | None = None, n_429: Column | None = None) -> Column:
    """STRUCT<action STRING, wait_s BIGINT>; action is ok | wait_retry | retry | fail."""
    if policy not in ("page", "entity"):
        raise ValueError(f"unknown retry policy {policy!r}")

    def out(action: str, wait: Column | int) -> Column:
        w = wait if isinstance(wait, Column) else F.lit(wait)
        return F.struct(F.lit(action).alias("action"), w.cast("bigint").alias("wait_s"))

    ok = (status >= 200) & (status < 300)
    if policy == "entity":
        return (F.when(ok, out("ok", 0))
                .when((status == 429) & (attempt <= 1), out("wait_retry", retry_after_seconds(retry_after,
                                                                                          ENTITY_429_DEFAULT_S)))
                .otherwise(out("fail", 0)))
    capped = F.lit(False) if max_429 is None or n_429 is None else n_429 >= F.lit(max_429)
    backoff = F.least(F.lit(PAGE_INITIAL_S) * F.pow(F.lit(2), attempt - 1), F.lit(PAGE_MAX_WAIT_S))
    return (F.when(ok, out("ok", 0))
            .when((status == 429) & ~capped, out("wait_retry", retry_after_seconds(retry_after, PAGE_429_DEFAULT_S)))
            .when((status == 429) & capped, out("fail", 0))
            .when((status.isNull() | (status >= 500)) & (attempt < F.lit(attempts)), out("retry", backoff))
            .otherwise(out("fail", 0)))


def backoff_schedule(df: DataFrame, times: Column, backoff_ms: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Linear backoff (O3): after failed try ``a`` (a < times) wait ``backoff * a``.

    One row per wait; ``times`` <= 1 gives no rows.
    """
    tries = F.when(times > 1, F.sequence(F.lit(1).cast("bigint"), (times - 1).cast("bigint")))
    planned = df.select(*keep, backoff_ms.cast("bigint").alias("_b"), F.explode(tries).alias("attempt"))
    return planned.select(*keep, "attempt", (F.col("_b") * F.col("attempt")).alias("wait_ms"))
