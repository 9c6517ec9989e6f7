"""What changed between two landings of one table: inserted, changed (which columns) and deleted rows.

Only keys and 128 bits per row are shuffled to find the rows that differ: both
sides go into one aggregation by key (partial in each task, so a key with very many rows is not gathered; null keys
are keys). Whole rows are read again for changed keys alone, to compare them column by column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.session import scratch_path

SUM = "decimal(20,0)"  # holds any 64-bit number; sums of them do not wrap


def _digests(cols: list[str]) -> list[Column]:
    """Two 64-bit hashes of a row. Spark's hash skips nulls, so which values are null is hashed with them."""
    values = [F.col(f"`{c}`") for c in cols]
    nulls = [v.isNull() for v in values]
    return [F.xxhash64(F.lit(salt), *values, *nulls) for salt in ("a", "b")]


def _same(a: DataFrame, b: DataFrame, key: list[str]) -> Column:
    out = F.lit(True)
    for i in range(len(key)):
        out = out & a[f"k{i}"].eqNullSafe(b[f"k{i}"])
    return out


def snapshot_diff(old: DataFrame, new: DataFrame, key: list[str], compare: list[str] | None = None) -> DataFrame:
    """(key..., kind, n_old, n_new, changed): one row for each key whose rows differ.

    ``kind``: ``inserted``, ``deleted``, ``changed`` (``changed`` names the columns, in order), or ``repeated`` for a key
    that stands more than once on a side and whose rows, taken as a multiset, differ. Null equals null.
    ``compare``: the columns compared (default: all but the key, which both sides must then have alike).
    Two empty tables differ in nothing. Columns of types without a hash (maps, variants) are refused by Spark.
    """
    cols = compare if compare is not None else [c for c in new.columns if c not in key]
    if compare is None and set(old.columns) != set(new.columns):
        raise ValueError(f"columns differ: {sorted(set(old.columns) ^ set(new.columns))}; name those to compare")
    keys = [f"k{i}" for i in range(len(key))]

    def narrow(df: DataFrame, which: int) -> DataFrame:
        d = [x.cast(SUM) for x in _digests(cols)]
        return df.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(key, keys)], F.lit(which).alias("side"),
                         d[0].alias("d0"), d[1].alias("d1"))

    both = narrow(old, 0).unionByName(narrow(new, 1))

    def of(side: int, value: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("side") == side, F.col(value))), F.lit(0))

    found = both.groupBy(*keys).agg(
        F.count_if(F.col("side") == 0).alias("n_old"), F.count_if(F.col("side") == 1).alias("n_new"),
        *[of(side, d).alias(f"{d}_{side}") for side in (0, 1) for d in ("d0", "d1")])
    found = found.filter("n_old <> n_new OR d0_0 <> d0_1 OR d1_0 <> d1_1")
    kind = (F.when(F.col("n_old") == 0, "inserted").when(F.col("n_new") == 0, "deleted")
            .when((F.col("n_old") == 1) & (F.col("n_new") == 1), "changed").otherwise("repeated"))
    found = found.select(*keys, kind.alias("kind"), "n_old", "n_new")
    path = scratch_path(new.sparkSession, "diff")
    found.write.parquet(path)
    found = new.sparkSession.read.schema(found.schema).parquet(path)

    changed = found.filter("kind = 'changed'")

    def whole(df: DataFrame, name: str) -> DataFrame:
        rows = df.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(key, keys)],
                         F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(cols)]).alias(name))
        return rows.join(changed, _same(rows, changed, key), "left_semi")

    a, b = whole(old, "a"), whole(new, "b")
    names = F.array(*[F.when(~F.col(f"a.c{i}").eqNullSafe(F.col(f"b.c{i}")), F.lit(c)) for i, c in enumerate(cols)])
    named = a.join(b, _same(a, b, key)).select(*[a[k] for k in keys], F.array_compact(names.cast("array<string>")).alias("changed"))
    # rows whose hashes differ though the values are equal (0.0 and -0.0) have no changed column
    named = named.filter(F.size("changed") > 0)
    full = changed.join(named, _same(changed, named, key)).select(*[changed[k] for k in keys], "kind", "n_old", "n_new", "changed")
    rest = found.filter("kind <> 'changed'").withColumn("changed", F.array().cast("array<string>"))
    return full.unionByName(rest).select(*[F.col(k).alias(c) for k, c in zip(keys, key)], "kind", "n_old", "n_new", "changed")
