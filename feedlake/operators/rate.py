"""Request-rate rules over a call log (R1 audit, R2 admission times).

Rule: at most ``limit`` calls per key in any trailing ``window`` (a call at
``t`` sees calls in ``(t - window, t]``; one exactly ``window`` earlier has
expired). Times are LONG microseconds.

Both are built on ``operators.scan.prefix_scan``, so no key (however hot) is
ever gathered into one task.

R1 ``rate_audit``: calls in the window ending at each call =
  count(calls <= t) - count(calls <= t - window)
Each call emits an *upper* probe at ``t`` and a *lower* probe at
``t - window``; probes sort after calls at the same time, so a running count
read at a probe includes every call at that time (the RANGE-frame peers).

R2 ``rate_admission``: the limiter admits call i at
  a_i = max(t_i, a_{i-1}, a_{i-L} + W)
which, with i numbered from 0 in time order and q_i = i div L, is
  a_i = q_i * W + max{ t_j - q_j * W : j <= i, j = i (mod L) }
a running max per (key, i mod L). i itself is a running count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.functions.coerce import int_div
from feedlake.operators.scan import prefix_scan

DEFAULT_LIMIT = 10
DEFAULT_WINDOW_US = 60 * 1_000_000


def _check(limit: int, window_us: int) -> None:
    if limit < 1:
        raise ValueError("limit must be >= 1")
    if window_us < 1:
        raise ValueError("window must be >= 1 microsecond")


def rate_audit(calls: DataFrame, key: str, t: str, call_id: str, limit: int = DEFAULT_LIMIT,
               window_us: int = DEFAULT_WINDOW_US) -> DataFrame:
    """(key, call_id, t, in_window, over_limit) for every call."""
    _check(limit, window_us)
    base = calls.select(F.col(key).alias("_key"), F.col(call_id).cast("bigint").alias("_id"),
                        F.col(t).cast("bigint").alias("_t"))
    # kind 0 = call (counts 1), 1 = probe (counts 0); sign +1 upper, -1 lower
    rows = base.select("_key", "_id", F.inline(F.array(
        F.struct(F.col("_t").alias("_at"), F.lit(0).alias("_kind"), F.lit(1).cast("bigint").alias("_n"),
                 F.lit(0).alias("_sign"), F.col("_t").alias("_call_t")),
        F.struct(F.col("_t").alias("_at"), F.lit(1).alias("_kind"), F.lit(0).cast("bigint").alias("_n"),
                 F.lit(1).alias("_sign"), F.col("_t").alias("_call_t")),
        F.struct((F.col("_t") - F.lit(window_us)).alias("_at"), F.lit(1).alias("_kind"),
                 F.lit(0).cast("bigint").alias("_n"), F.lit(-1).alias("_sign"), F.col("_t").alias("_call_t")),
    )))
    scanned = prefix_scan(rows, ["_key"], ["_at", "_kind", "_id", "_sign"], "_n", "sum", "_cum")
    probes = scanned.where(F.col("_kind") == 1)
    counted = probes.groupBy("_key", "_id", "_call_t").agg(F.sum(F.col("_sign") * F.col("_cum")).alias("in_window"))
    return counted.select(
        F.col("_key").alias(key), F.col("_id").alias(call_id), F.col("_call_t").alias(t),
        F.col("in_window").cast("bigint").alias("in_window"),
        (F.col("in_window") > F.lit(limit)).alias("over_limit"),
    )


def rate_admission(calls: DataFrame, key: str, t: str, call_id: str, limit: int = DEFAULT_LIMIT,
                   window_us: int = DEFAULT_WINDOW_US) -> DataFrame:
    """(key, call_id, t, admitted, wait) - when a limiter per key would let each call go."""
    _check(limit, window_us)
    base = calls.select(F.col(key).alias("_key"), F.col(call_id).cast("bigint").alias("_id"),
                        F.col(t).cast("bigint").alias("_t"), F.lit(1).cast("bigint").alias("_one"))
    numbered = prefix_scan(base, ["_key"], ["_t", "_id"], "_one", "sum", "_i1")
    i0 = F.col("_i1") - 1
    q = int_div(i0, limit)
    staged = numbered.select("_key", "_id", "_t", i0.alias("_i"), q.alias("_q"), (i0 % F.lit(limit)).alias("_m"),
                             (F.col("_t") - q * F.lit(window_us)).alias("_shifted"))
    runmax = prefix_scan(staged, ["_key", "_m"], ["_i"], "_shifted", "max", "_best")
    admitted = F.col("_q") * F.lit(window_us) + F.col("_best")
    return runmax.select(F.col("_key").alias(key), F.col("_id").alias(call_id), F.col("_t").alias(t),
                         admitted.alias("admitted"), (admitted - F.col("_t")).alias("wait"))
