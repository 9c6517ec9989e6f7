"""Joins on time: the last earlier row (as-of) and points inside intervals. Built-in expressions only.

Neither groups by the key alone, so a key that holds a third of the rows is
spread over tasks, and neither compares every row of a key with every other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.functions.coerce import int_div
from feedlake.operators.scan import boundaries, bucket_of
from feedlake.session import scratch_path

DAY_MICROS = 86_400_000_000
TIES = 1 << 30  # left rows of one key and time get one of so many places, so that they can be cut apart


def position(df: DataFrame, column: str) -> Column:
    """A time or integer column as a long (timestamps in microseconds, dates in days)."""
    kind, c = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.TimestampNTZType):  # from its parts, so no time zone takes part
        seconds = (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("bigint")
        return (F.unix_date(F.to_date(c)).cast("bigint") * DAY_MICROS
                + (F.hour(c) * 60 + F.minute(c)).cast("bigint") * 60_000_000 + seconds)
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("bigint")
    if isinstance(kind, T.IntegralType):
        return c.cast("bigint")
    raise TypeError(f"{column} is {kind.simpleString()}; times are timestamps, dates or integers")


def _same_kind(a: DataFrame, x: str, b: DataFrame, y: str) -> None:
    kinds = {"integer" if isinstance(k, T.IntegralType) else k.typeName() for k in (a.schema[x].dataType, b.schema[y].dataType)}
    if len(kinds) > 1:
        raise TypeError(f"{x} and {y} are of different kinds: {sorted(kinds)}")


def _written(df: DataFrame, tag: str) -> DataFrame:
    """Written once and read back: what is read several times below is the same each time."""
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _row(df: DataFrame) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def _named(df: DataFrame, on: list[str]) -> list[Column]:
    return [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(on)]


def asof_join(left: DataFrame, right: DataFrame, on: list[str], left_time: str, right_time: str, keep: str = "right",
              strict: bool = False, within: int | None = None, buckets: int | None = None) -> DataFrame:
    """Every left row with the last right row of its key whose time is not later; the right row is the struct ``keep``.

    ``strict``: the right row must be earlier. ``within``: it may be at most
    that much earlier (microseconds, days or units of the integer).

    1. Both sides become one table of (key, time, row), written once.
    2. A bounded sample (32 rows per bucket) cuts (key, time, tie) into buckets, so a hot key spans many,
       and so do very many left rows of one key and time.
    3. In each bucket and key one window by time carries the last right row forward.
    4. A key spans buckets only if a boundary lies inside it, so the keys of the
       boundaries (fewer than buckets) are all that can need a row from an earlier
       bucket: at most one carried row per bucket and boundary key, broadcast.

    Defined results: a left row without a match, with a null key or a null time
    stays, with a null struct; right rows with a null key or time match nothing;
    of right rows of one key and time the largest (all columns compared in
    order) counts; repeated left rows stay repeated. Right columns without an order (maps, variants) are
    refused by Spark. The two sides may have columns of the same names, since the right row is a struct.
    """
    if keep in left.columns:
        raise ValueError(f"{keep} is a column of the left side; name another with keep=")
    _same_kind(left, left_time, right, right_time)
    keys = [f"k{i}" for i in range(len(on))]
    no_left, no_right = F.lit(None).cast(left.schema), F.lit(None).cast(right.schema)

    usable = F.col("at").isNotNull()
    for k in keys:
        usable = usable & F.col(k).isNotNull()
    # at one time the right row goes before the left rows, or after them if it has to be earlier
    tie = F.lit(TIES if strict else -1).cast("bigint")
    # one right row for each key and time: partial aggregation, so very many of them are not gathered
    rights = right.select(*_named(right, on), position(right, right_time).alias("at"), _row(right).alias("r")).filter(usable)
    rights = rights.groupBy(*keys, "at").agg(F.max("r").alias("r")).select(*keys, "at", tie.alias("tie"), no_left.alias("l"), "r")
    lefts = left.select(*_named(left, on), position(left, left_time).alias("at"),
                        F.floor(F.rand() * TIES).cast("bigint").alias("tie"), _row(left).alias("l"), no_right.alias("r"))
    rows = _written(lefts.unionByName(rights), "asof")
    alone, rows = rows.filter(~usable), rows.filter(usable)

    spark = left.sparkSession
    place = [*keys, "at", "tie"]
    bounds = boundaries(rows, place, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.withColumn("b", bucket_of(rows, place, bounds))
    held = F.when(F.col("r").isNotNull(), F.struct("at", "r"))
    so_far = Window.partitionBy("b", *keys).orderBy("at", "tie").rowsBetween(Window.unboundedPreceding, 0)
    seen = rows.withColumn("last", F.last(held, ignorenulls=True).over(so_far)).filter("l IS NOT NULL")

    if bounds:
        cut = rows if not keys else rows.join(F.broadcast(spark.createDataFrame(
            sorted({b[:len(keys)] for b in bounds}), rows.select(*keys).schema)), keys, "left_semi")
        ends = cut.groupBy("b", *keys).agg(F.max_by(held, F.when(F.col("r").isNotNull(), F.col("at"))).alias("end"))
        earlier = Window.partitionBy(*keys).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
        carry = ends.select("b", *keys, F.last("end", ignorenulls=True).over(earlier).alias("carried")).filter("carried IS NOT NULL")
        seen = seen.join(F.broadcast(carry), ["b", *keys], "left").withColumn("last", F.coalesce("last", "carried"))
    match = F.col("last")
    if within is not None:
        match = F.when(F.col("at") - match["at"] <= F.lit(within), match)
    out = seen.select("l.*", match["r"].alias(keep))
    return out.unionByName(alone.select("l.*", no_right.alias(keep)))


def interval_join(points: DataFrame, intervals: DataFrame, point: str, start: str, end: str, on: list[str] | None = None,
                  point_as: str = "point", interval_as: str = "interval", unit: int = 1) -> DataFrame:
    """Pairs of a point and an interval with ``start <= point < end`` (and equal keys ``on``), as two structs.

    Bins of level j are ``unit * 2^j`` wide. An interval goes to the lowest
    level whose bins are as wide as itself, so it touches one or two of them; a point goes to one bin of every level in use.
    A pair thus meets in exactly one bin, is tested once, and long intervals lie in
    coarse bins instead of in many fine ones. The join is an equality on (keys, level, bin), which AQE's skew join
    splits where a bin is hot, and a tested point lies at most two widths from its interval.
    The driver sees the levels in use (at most 64 numbers).

    ``unit``: width of the finest bins in the times' own unit (microseconds, days, integers); a larger one makes fewer levels.
    Defined results: null times or keys pair with nothing; intervals that end where
    they start or before hold nothing; repeated rows pair repeatedly; empty tables give no pairs.
    Both sides may have columns of the same names. Lengths must fit 64 bits.
    """
    on = on or []
    keys = [f"k{i}" for i in range(len(on))]
    if unit < 1:
        raise ValueError("unit must be at least 1")
    if point_as == interval_as:
        raise ValueError("the two structs need different names")
    for c in (start, end):
        _same_kind(points, point, intervals, c)

    def bin_of(at: Column, level: Column) -> Column:
        return F.call_function("shiftright", int_div(at - F.pmod(at, F.lit(unit)), unit), level)

    more = int_div(F.col("e") - F.col("s") - 1, unit)  # fine bins beyond the first that the length needs
    spans = intervals.select(*_named(intervals, on), position(intervals, start).alias("s"), position(intervals, end).alias("e"),
                             _row(intervals).alias("i")).filter("s < e")
    spans = _written(spans.withColumn("level", F.when(more == 0, 0).otherwise(F.length(F.bin(more))).cast("int")), "intervals")
    levels = sorted(r.level for r in spans.select("level").distinct().collect())
    lo, hi = bin_of(F.col("s"), F.col("level")), bin_of(F.col("e") - 1, F.col("level"))
    spans = spans.withColumn("bin", F.explode(F.when(lo == hi, F.array(lo)).otherwise(F.array(lo, hi))))
    dots = points.select(*_named(points, on), position(points, point).alias("p"), _row(points).alias("q")).filter("p IS NOT NULL")
    dots = dots.withColumn("level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>")))
    dots = dots.withColumn("bin", bin_of(F.col("p"), F.col("level")))
    pairs = dots.join(spans, [*keys, "level", "bin"]).filter("s <= p AND p < e")
    return pairs.select(F.col("q").alias(point_as), F.col("i").alias(interval_as))
