"""Validation modes over flattened rows carrying ``_errors``.

failfast    first bad record aborts the job (``raise_error`` inside the plan,
            so the check runs on executors with the rest of the stage)
quarantine  valid rows and a rejects table (one row per failing field)
permissive  keep every row; bad fields are NULL, ``_errors`` kept for audit
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.operators.flatten import ERRORS, PART, REC
from feedlake.schemas import ENTITIES

MODES = ("failfast", "quarantine", "permissive")


@dataclass
class Validated:
    valid: DataFrame
    rejects: DataFrame | None


def _names(entity: str) -> list[str]:
    return [f.name for f in ENTITIES[entity][1]]


def failfast(flat: DataFrame, entity: str) -> DataFrame:
    first = F.get(F.col(ERRORS), 0)
    msg = F.concat(F.lit(f"invalid {entity} record: field "), first["field"], F.lit(", reason "), first["reason"],
                   F.lit(", task "), F.col("task_index").cast("string"), F.lit(", page "),
                   F.col("page").cast("string"), F.lit(", position "), F.col("_pos").cast("string"),
                   F.lit(", partition "), F.col(PART).cast("string"))
    guard = F.when(F.size(F.col(ERRORS)) > 0, F.raise_error(msg)).isNull()
    return flat.where(guard).select(*_names(entity))


def _kept(cond):
    """``cond`` plus a term that reads ``_part`` and always holds, so the nondeterministic column is not
    pruned and the filter stays above the flatten projection instead of re-running every check
    (``isNotNull`` would not do: the optimizer knows that the column is never NULL)."""
    return cond & (F.col(PART) >= 0)


def rejects(flat: DataFrame) -> DataFrame:
    """(task_index, page, _pos, record, field, reason) for every failing field."""
    bad = flat.where(_kept(F.size(F.col(ERRORS)) > 0))
    record = F.to_json(F.col(REC)) if REC in flat.columns else F.lit(None).cast("string")
    # The generator runs over flat text items: a generator over the struct array itself
    # sends Spark 4.1's nested-field pruning into a very long optimizer run on this plan.
    items = F.transform(F.col(ERRORS), lambda e: F.concat_ws("\t", e["field"], e["reason"]))
    exploded = bad.select("task_index", "page", "_pos", record.alias("record"), F.explode(items).alias("_e"))
    parts = F.split(F.col("_e"), "\t")
    return exploded.select("task_index", "page", "_pos", "record", parts.getItem(0).alias("field"),
                           parts.getItem(1).alias("reason"))


def apply_mode(flat: DataFrame, entity: str, mode: str = "failfast") -> Validated:
    if mode not in MODES:
        raise ValueError(f"unknown validation mode {mode!r}; expected one of {MODES}")
    if mode == "failfast":
        return Validated(failfast(flat, entity), None)
    if mode == "quarantine":
        good = flat.where(_kept(F.size(F.col(ERRORS)) == 0)).select(*_names(entity))
        return Validated(good, rejects(flat))
    return Validated(flat.select(*_names(entity), ERRORS), None)
