"""Landing -> validated flat entity rows (the P1-P4 + V1-V3 path)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from feedlake.operators.flatten import REC, flatten_records
from feedlake.operators.validate import Validated, apply_mode
from feedlake.sources.landing import explode_records

LINEAGE = ("task_index", "page", "_pos")


def flat_with_errors(landing: DataFrame, entity: str) -> DataFrame:
    """Flat columns + ``_errors`` + lineage, record kept for rejects."""
    recs = explode_records(landing, entity)
    return flatten_records(recs, entity, keep=LINEAGE + (REC,))


def flatten_entity(landing: DataFrame, entity: str, mode: str = "failfast") -> Validated:
    return apply_mode(flat_with_errors(landing, entity), entity, mode)


def flatten_matches(landing: DataFrame, mode: str = "failfast") -> DataFrame:
    return flatten_entity(landing, "matches", mode).valid


def flatten_standings(landing: DataFrame, mode: str = "failfast") -> DataFrame:
    return flatten_entity(landing, "standings", mode).valid


def flatten_scorers(landing: DataFrame, mode: str = "failfast") -> DataFrame:
    return flatten_entity(landing, "scorers", mode).valid
