"""Schema drift (V3, K3): which paths and types the records really hold, against the fixed schema.

``leaf_types`` walks every record down to its leaves with built-in VARIANT
functions. A level is one projection and one explode, so several levels make
one plan without a shuffle; what is nested deeper than these is written and
walked on, so the depth is not limited. Counts are aggregated partially by (group, path, type).

``drift_report`` walks only the records that depart from the specs: the type of a whole record, worked
out in one pass, tells them (``plain_shape``). They are written once, for the leaves and for the number of records.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.operators.flatten import REC
from feedlake.schemas import FieldSpec
from feedlake.session import scratch_path

LEVELS = 6  # levels of one plan; deeper values take another pass
PLAIN_KEY = "^[A-Za-z_][A-Za-z0-9_]*$"


def _child_paths(path: Column, key: Column) -> Column:
    quoted = F.concat(path, F.lit('["'), F.replace(key, F.lit('"'), F.lit('\\"')), F.lit('"]'))
    dotted = F.when(path == "", key).otherwise(F.concat(path, F.lit("."), key))
    return F.when(key.rlike(PLAIN_KEY), dotted).otherwise(quoted)


def _step(rows: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """One level down: objects and arrays that are still open give their children, all else stays."""
    path, v = F.col("path"), F.col("v")
    of_object = F.transform(F.map_entries(F.try_variant_get(v, "$", "map<string,variant>")),
                            lambda e: F.struct(_child_paths(path, e["key"]).alias("path"), e["value"].alias("v")))
    of_array = F.transform(F.try_variant_get(v, "$", "array<variant>"),
                           lambda e: F.struct(F.concat(path, F.lit("[]")).alias("path"), e.alias("v")))
    children = F.when(F.col("open"), F.coalesce(of_object, of_array))
    down = rows.select(*by, "path", "v", F.explode_outer(children).alias("kid"))
    return down.select(*by, F.coalesce("kid.path", "path").alias("path"), F.coalesce("kid.v", "v").alias("v"),
                       F.col("kid").isNotNull().alias("open"))


def leaf_types(records: DataFrame, by: tuple[str, ...] = (), column: str = REC) -> DataFrame:
    """(by..., path, type, n): how often each leaf path holds each type in a VARIANT column.

    Paths: ``a.b``, ``a[]`` for the elements of an array, ``a["odd key"]`` for other keys; the record itself is ''.
    Types: STRING, BIGINT, DECIMAL, DOUBLE, BOOLEAN, ..., VOID (JSON null); OBJECT and ARRAY stand
    for empty ones. An SQL null record has no leaves. The result is read from a written table of one row per group.
    """
    spark = records.sparkSession
    rows = records.select(*by, F.lit("").alias("path"), F.col(column).alias("v"), F.lit(True).alias("open")).filter("v IS NOT NULL")
    parts = []
    while True:
        for _ in range(LEVELS):
            rows = _step(rows, by)
        # an open value may be a leaf: only its children would tell, so objects and arrays alone go on
        kind = F.regexp_extract(F.schema_of_variant("v"), "^[A-Z]+", 0)
        rows = rows.select(*by, "path", "v", kind.alias("type")).withColumn(
            "deeper", F.col("type").isin("OBJECT", "ARRAY") & ~F.to_json("v").isin("{}", "[]"))
        path = scratch_path(spark, "drift")
        counts = rows.groupBy(*by, "path", "type", "deeper").agg(F.count("*").alias("n"))
        counts.write.parquet(path)
        counts = spark.read.schema(counts.schema).parquet(path)
        parts.append(counts.filter("NOT deeper").drop("deeper"))
        if counts.filter("deeper").isEmpty():
            break
        rest = scratch_path(spark, "drift-deeper")
        deeper = rows.filter("deeper").select(*by, "path", "v", F.lit(True).alias("open"))
        deeper.write.parquet(rest)
        rows = spark.read.schema(deeper.schema).parquet(rest)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out if len(parts) == 1 else out.groupBy(*by, "path", "type").agg(F.sum("n").alias("n"))


def expected_paths(fields: tuple[FieldSpec, ...]) -> tuple[dict[str, set[str]], set[str], set[str]]:
    """From the field specs of a record: types allowed at each leaf, paths that must be there, parents (objects)."""
    allowed, needed, parents = {}, set(), set()
    for f in fields:
        if f.source != "record":
            continue
        types = {"BIGINT" if f.kind == "long" and f.derive is None else "STRING"}
        if f.presence != "required":
            types.add("VOID")
        # two fields of one path: what one of them refuses is drift
        allowed[f.path] = allowed[f.path] & types if f.path in allowed else types
        if f.presence != "optional":
            needed.add(f.path)
        steps = f.path.split(".")
        parents.update(".".join(steps[:i]) for i in range(1, len(steps)))
    return allowed, needed, parents


def plain_shape(fields: tuple[FieldSpec, ...]) -> str | None:
    """Pattern of the ``schema_of_variant`` of records without drift; None where the specs do not say one shape.

    Keys come in order there, names other than plain ones are quoted, so nothing but the specs' keys can match.
    Records that it misses may still be without drift (an optional parent left out).
    """
    allowed, needed, parents = expected_paths(fields)
    steps = [k for p in allowed for k in p.split(".")]
    if not allowed or parents & set(allowed) or not all(allowed.values()) or not all(re.fullmatch(PLAIN_KEY, k) for k in steps):
        return None

    def shape(at: str) -> str:
        out = ""
        for path in sorted(p for p in parents | set(allowed) if p.rpartition(".")[0] == at):
            kind = shape(path) if path in parents else "(?:" + "|".join(sorted(allowed[path])) + ")"
            out += f"(?:{path.rpartition('.')[2]}: {kind}(?:, )?)" + ("" if path in parents or path in needed else "?")
        return f"OBJECT<{out}>"

    return f"^{shape('')}$"


def drift_report(records: DataFrame, fields: tuple[FieldSpec, ...], by: tuple[str, ...] = (), column: str = REC) -> DataFrame:
    """(by..., path, type, n, drift): only what departs from the specs.

    ``unknown``  a leaf that no spec reads
    ``changed``  a leaf with another type than the spec's (also those that lax coercion
                 accepts), null where a value is required, or a plain value where an object is expected
    ``lost``     a path that every record must have; ``n`` records are without it and ``type`` is null.
                 Null groups are groups; an empty table has no drift.
    """
    allowed, needed, parents = expected_paths(fields)
    shape = plain_shape(fields)
    if shape is not None:
        # a plain record adds nothing: no leaf departs, and each path it must have is found in it once
        odd = records.filter(~F.coalesce(F.schema_of_variant(column).rlike(shape), F.lit(False))).select(*by, column)
        path = scratch_path(records.sparkSession, "drift-records")
        odd.write.parquet(path)
        records = records.sparkSession.read.schema(odd.schema).parquet(path)
    found = leaf_types(records, by, column)
    known = [F.when((F.col("path") == p) & F.col("type").isin(*sorted(t)), F.lit("")) for p, t in allowed.items()]
    changed = F.when(F.col("path").isin(*sorted(set(allowed) | parents | {""})), F.lit("changed")).otherwise(F.lit("unknown"))
    seen = found.withColumn("drift", F.coalesce(*known, changed)).filter("drift <> ''")

    # records a path should be in, less the values found at it; summed in one aggregate, so null groups need no join
    must = F.explode(F.array(*[F.lit(p) for p in sorted(needed)]).cast("array<string>"))
    due = records.filter(F.col(column).isNotNull()).groupBy(*by).agg(F.count("*").alias("n")).select(*by, must.alias("path"), "n")
    had = found.filter(F.col("path").isin(*sorted(needed))).select(*by, "path", (-F.col("n")).alias("n"))
    # an empty object or array at the path counts as found; of one with contents only the children are leaves
    lost = due.unionByName(had).groupBy(*by, "path").agg(F.sum("n").alias("n")).filter("n > 0")
    return seen.unionByName(lost.select(*by, "path", F.lit(None).cast("string").alias("type"), "n", F.lit("lost").alias("drift")))
