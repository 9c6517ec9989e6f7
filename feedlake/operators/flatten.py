"""Nested record -> fixed flat row, with per-field validation.

The flatten is a short chain of native projections over a VARIANT record
column; no Python runs per row and Catalyst prunes what the plan does not
read. Stages:
  1. extract the leaves (VARIANT): those of a record in one pass over it
  2. per extracted value: its type name and its text rendering; a parent is read
     only where no leaf below it is there
  3. per field: coerced value
  4. per absent value: reject reason; the reasons found, listed
Splitting keeps each generated method small and evaluates each path once
(Catalyst does not merge projections that would duplicate non-cheap work).

Each output row carries ``_errors`` (ARRAY<STRUCT<field, reason>>) listing
every failing field in column order, so ``operators.validate`` can fail fast,
quarantine or keep. Reasons:
  missing      a subscripted key (or a parent of it) is absent
  null_parent  a parent object on the path is JSON null
  null         a required value is JSON null
  type         the value (or a parent) has the wrong JSON type
  bad_year     the first four characters of a date are not an integer
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.functions import coerce
from feedlake.schemas import ENTITIES, ERRORS_TYPE, FieldSpec

REC = "_rec"
GRP = "_grp"
PRE = "_pre_errors"
ERRORS = "_errors"
PART = "_part"
LEAVES = "_leaves"
PLAIN_NAME = re.compile("[A-Za-z_][A-Za-z0-9_]*")


def _null_str() -> Column:
    return F.lit(None).cast("string")


def _parents(path: str) -> list[str]:
    parts = path.split(".")
    return [".".join(parts[:k]) for k in range(1, len(parts))]


def _base(f: FieldSpec) -> str:
    return GRP if f.source == "group" else REC


def _direct_long(f: FieldSpec) -> bool:
    return f.kind == "long" and f.derive is None


def _leaf_ddl(paths: list[str]) -> str | None:
    """Nested struct type with a VARIANT at every path; None where the paths are not the leaves of one tree of plain names."""
    tree: dict = {}
    for path in paths:
        *above, last = path.split(".")
        node = tree
        for k in above:
            node = node.setdefault(k, {})
            if node is None:
                return None
        if node.setdefault(last) is not None:
            return None

    def ddl(node: dict) -> str | None:
        below = {k: "variant" if x is None else ddl(x) for k, x in node.items()}
        # (names that differ in case alone may be one name to Spark)
        if None in below.values() or len({k.lower() for k in node}) < len(node) or not all(map(PLAIN_NAME.fullmatch, node)):
            return None
        return "struct<" + ", ".join(f"`{k}`: {t}" for k, t in below.items()) + ">"

    return ddl(tree) if tree else None


def _all(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)


def _field_value(f: FieldSpec, t: Column, s: Column, i: Column | None = None) -> tuple[Column, Column]:
    """(value, conversion reason) for a present, non-null leaf."""
    if f.derive == "year4":
        text, r1 = coerce.lax_string(t, s)
        value, r2 = coerce.year_of(text)
        return value, F.coalesce(r1, r2)
    if f.derive == "slice10":
        text, r = coerce.lax_string(t, s)
        return F.substring(text, 1, 10), r
    if f.kind == "long":
        return coerce.lax_long(t, s, i)
    return coerce.lax_string(t, s)


def flatten_records(records: DataFrame, entity: str | None, keep: tuple[str, ...] = (),
                    fields: tuple[FieldSpec, ...] | None = None) -> DataFrame:
    """Exploded records (``_rec`` [+ ``_grp`` / ``_pre_errors``]) -> flat rows + ``_errors``.

    ``fields`` overrides the entity's specs (ad-hoc record shapes).
    """
    if fields is None:
        _, fields, _ = ENTITIES[entity]
    has_pre = PRE in records.columns
    carry = list(keep) + ([PRE] if has_pre else [])

    # Stage 1: each leaf, once.
    ddl = _leaf_ddl(list(dict.fromkeys(f.path for f in fields if f.source == "record")))
    if ddl is not None:
        records = records.withColumn(LEAVES, F.try_variant_get(F.col(REC), "$", ddl))
    leaves, parents, at = {}, {}, {}
    for i, f in enumerate(fields):
        if f.source == "context":
            continue
        if (_base(f), f.path) in at:  # two fields of one path
            leaves[f.name] = at[_base(f), f.path]
        elif ddl is not None and f.source == "record":
            leaves[f.name] = (f"_l{i}", F.col(f"{LEAVES}.{f.path}"))
        else:
            leaves[f.name] = (f"_l{i}", F.variant_get(F.col(_base(f)), "$." + f.path, "variant"))
        at[_base(f), f.path] = leaves[f.name]
        for p in _parents(f.path):
            _, below = parents.setdefault((_base(f), p), (f"_p{len(parents)}", []))
            below.append(leaves[f.name][0])
    ctx = [F.col(f.path).alias(f"_c{i}") for i, f in enumerate(fields) if f.source == "context"]
    bases = sorted({REC} | {base for base, _ in parents})
    s1 = records.select(*carry, *[F.col(b) for b in bases if b not in carry], *ctx, *[c.alias(n) for n, c in at.values()])

    # Stage 2: type name + text of each leaf (a plain LONG leaf typed BIGINT is read
    # directly and needs no text). A leaf that is there says that its parents and its record are
    # objects: they are read, and their types worked out, only where every leaf below is absent.
    direct = {leaves[f.name][0] for f in fields if f.name in leaves and _direct_long(f)}
    derived = {leaves[f.name][0] for f in fields if f.name in leaves and not _direct_long(f)}

    def text(n: str) -> Column:
        s = F.try_variant_get(F.col(n), "$", "string")
        return s if n in derived else F.when(F.schema_of_variant(F.col(n)) != "BIGINT", s)

    # The lambda keeps a projection out of whole-stage code: its code is then cut into small
    # methods. In one method it is beyond the 8000 bytes up to which the JVM compiles.
    def absent(below: list[str]) -> Column:
        if not below:
            return F.lit(True)
        first = F.forall(F.array(below[0]), lambda v: v.isNull())
        return _all([first, *[F.col(b).isNull() for b in dict.fromkeys(below[1:])]])

    def parent(base: str, path: str, below: list[str]) -> Column:
        t = F.schema_of_variant(F.variant_get(F.col(base), "$." + path, "variant"))
        return F.when(absent(below), coerce.parent_reason(t))

    s2 = s1.select(
        *carry, *[b for b in bases if b not in carry],
        *[f"_c{i}" for i, f in enumerate(fields) if f.source == "context"],
        *[F.schema_of_variant(F.col(n)).alias(n + "t") for n, _ in at.values()],
        *[text(n).alias(n + "s") for n, _ in at.values()],
        *[F.try_variant_get(F.col(n), "$", "bigint").alias(n + "i") for n, _ in at.values() if n in direct],
        *[parent(base, p, below).alias(n + "r") for (base, p), (n, below) in parents.items()],
    )

    # Stage 3: values. A value that is there has no reason to be rejected.
    values, reasons = [], []
    for i, f in enumerate(fields):
        dtype = "bigint" if f.kind == "long" else "string"
        if f.source == "context":
            v = F.col(f"_c{i}")
            r = F.lit("null") if f.presence == "required" else _null_str()
        else:
            n = leaves[f.name][0]
            t, s = F.col(n + "t"), F.col(n + "s")
            v, conv_reason = _field_value(f, t, s, F.col(n + "i") if _direct_long(f) else None)
            missing = _null_str() if f.presence == "optional" else F.lit("missing")
            null = F.lit("null") if f.presence == "required" else _null_str()
            r = F.when(t.isNull(), missing).when(t == "VOID", null).otherwise(conv_reason)
            pr = [F.col(parents[(_base(f), p)][0] + "r") for p in _parents(f.path)]
            r = F.coalesce(*pr, r) if pr else r
        values.append(v.cast(dtype).alias(f"_v{i}"))
        reasons.append(F.when(F.col(f"_v{i}").isNull(), r).alias(f"_r{i}"))
    own = [leaves[f.name][0] + "t" for f in fields if f.name in leaves and _base(f) == REC]
    no = F.when(absent(own), ~F.schema_of_variant(F.col(REC)).startswith("OBJECT"))
    s3 = s2.select("*", *values, no.alias("_no"))

    # Stage 4: reasons, worked out for absent values only; listed for records that have one.
    found = [F.col(f"_v{i}") for i in range(len(fields))]
    own_code = F.forall(F.array("_no"), lambda v: v)  # (see above)
    s4 = s3.select(*carry, *found, own_code.alias("_no"), *reasons)
    checks = [F.when(F.col(f"_r{i}").isNotNull(), F.struct(F.lit(f.name).alias("field"), F.col(f"_r{i}").alias("reason")))
              for i, f in enumerate(fields)]
    not_object = F.when(F.col("_no"), F.array(F.struct(F.lit("_record").alias("field"), F.lit("type").alias("reason"))))
    sound = _all([F.col(f"_r{i}").isNull() for i in range(len(fields))])
    errs = F.when(sound & ~F.coalesce("_no", F.lit(False)), F.array().cast(ERRORS_TYPE)).otherwise(
        F.coalesce(not_object, F.filter(F.array(*checks), lambda x: x.isNotNull())))
    if has_pre:
        errs = F.when(F.size(F.col(PRE)) > 0, F.col(PRE)).otherwise(errs)
    # ``_part`` (the task's partition id, reported by fail-fast errors) is
    # nondeterministic, so a filter on ``_errors`` stays above this projection
    # instead of being pushed below it with every check inlined a second time.
    return s4.select(*keep, *[v.alias(f.name) for v, f in zip(found, fields)], errs.alias(ERRORS),
                     F.spark_partition_id().alias(PART))
