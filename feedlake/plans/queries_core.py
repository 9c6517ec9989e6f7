"""Core entity queries: nested payloads -> validated flat rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedlake.operators.entity import flatten_matches, flatten_scorers, flatten_standings
from feedlake.plans.catalog import MATCH_ROWS_SQL, SCORER_ROWS_SQL, STANDING_ROWS_SQL, register
from feedlake.sources import feeds


@register("flatten_matches", MATCH_ROWS_SQL)
def q_flatten_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_matches(feeds.matches_landing(spark, sf_dir))


@register("explode_standings", STANDING_ROWS_SQL)
def q_explode_standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_standings(feeds.standings_landing(spark, sf_dir))


@register("flatten_scorers", SCORER_ROWS_SQL)
def q_flatten_scorers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_scorers(feeds.scorers_landing(spark, sf_dir))
