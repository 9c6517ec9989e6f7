"""Event-time windows (§2.10): sliding windows and sessions, the same on tables and on streams.

Both are declared with Spark's ``window`` and ``session_window``. With ``delay`` a stream drops its state behind a
watermark; a table ignores it. Sliding windows pre-aggregate before the shuffle. Sessions of one key
are merged inside each input partition first (``mergeSessionsInLocalPartition``), so a key with very many rows sends few.
Rows without an event time are in no window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _marked(df: DataFrame, time: str, delay: str | None) -> DataFrame:
    return df.withWatermark(time, delay) if delay else df


def sliding(df: DataFrame, time: str, width: str, slide: str, keys: list[str], aggs: list[Column],
            delay: str | None = None) -> DataFrame:
    """keys, window_start, window_end and the aggregates of every window that has rows."""
    out = _marked(df, time, delay).groupBy(*keys, F.window(time, width, slide).alias("_w")).agg(*aggs)
    return out.select(*keys, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                      *[c for c in out.columns if c not in (*keys, "_w")])


def sessions(df: DataFrame, time: str, gap: str, keys: list[str], aggs: list[Column], delay: str | None = None) -> DataFrame:
    """keys, session_start, session_end (last row plus ``gap``) and the aggregates of every session."""
    df.sparkSession.conf.set("spark.sql.sessionWindow.merge.sessions.in.local.partition", "true")
    out = _marked(df, time, delay).filter(F.col(time).isNotNull()).groupBy(*keys, F.session_window(time, gap).alias("_w")).agg(*aggs)
    return out.select(*keys, F.col("_w.start").alias("session_start"), F.col("_w.end").alias("session_end"),
                      *[c for c in out.columns if c not in (*keys, "_w")])
