"""End-user jobs (J1-J6): request table -> landing -> validated flat rows -> sink.

Modes map the client's fetch strategies onto the fetcher (U1-U3, U6):
  sequential  one task, first error stops the job
  threaded    ``workers`` tasks, a failed request leaves a failed landing row
  async       ``workers`` tasks, first error stops the job
An unknown mode is an error (the client silently fell back to sequential).
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.operators import filters
from feedlake.operators.entity import flatten_entity
from feedlake.operators.metrics import RunRecord, observed
from feedlake.schemas import ENTITIES, SCHEMAS
from feedlake.session import scratch_path
from feedlake.sinks import writers
from feedlake.sources import requests
from feedlake.sources.fetch import FetchError, fetch_requests
from feedlake.sources.landing import DOC, classify, failed_tasks

# Fixed value: calls per minute the API's free tier allows.
DEFAULT_QUOTA = 10
REJECTS = "task_index bigint, page bigint, _pos int, record string, field string, reason string"
MODES = {"sequential": (1, "fail"), "threaded": (None, "null"), "async": (None, "fail")}


def mode_options(mode: str, workers: int = 3) -> tuple[int, str]:
    if mode not in MODES:
        raise ValueError(f"unknown fetch mode {mode!r}; expected one of {tuple(MODES)}")
    par, on_error = MODES[mode]
    return par or workers, on_error


def task_outcomes(reqs: DataFrame, landing: DataFrame, entity: str) -> DataFrame:
    """Requests LEFT JOIN their landing pages: one outcome per request (never a positional zip)."""
    key = ENTITIES[entity][0]
    cl = classify(landing, key)
    n = F.coalesce(F.size(F.try_variant_get(F.col(DOC), "$." + key, "array<variant>")), F.lit(0))
    failed = F.col("status") != "ok"
    per_task = cl.groupBy("task_index").agg(
        F.count("*").alias("pages_fetched"),
        F.max(failed).alias("_any_failed"),
        F.min_by(F.col("http_status"), F.col("page")).alias("http_status"),
        F.min_by(F.when(failed, F.split(F.col("error"), ":").getItem(0)), F.col("page")).alias("error_kind"),
        F.sum(F.when(~failed, n).otherwise(0)).alias("n_records"),
    )
    out = reqs.select("task_index").join(per_task, "task_index", "left")
    status = F.when(F.col("pages_fetched").isNull(), "missing").when(F.col("_any_failed"), "failed").otherwise("ok")
    return out.select("task_index", status.alias("status"), "http_status", "error_kind",
                      F.coalesce("pages_fetched", F.lit(0)).cast("bigint").alias("pages_fetched"),
                      F.coalesce("n_records", F.lit(0)).cast("bigint").alias("n_records"))


@dataclass
class JobResult:
    """What a job leaves: valid rows, rejected fields, requests without a usable payload, and the rows written."""

    rows: DataFrame
    rejects: DataFrame
    failed: DataFrame
    written: int | None


def land(spark: SparkSession, reqs: DataFrame, conf: dict, landing_path: str, mode: str = "threaded", workers: int = 3,
         quota: int | None = DEFAULT_QUOTA, window_s: float = 60.0, policy: str = "entity") -> DataFrame:
    """Fetch requests under a mode; the quota is shared by the tasks, so there are never more tasks than calls."""
    par, on_error = mode_options(mode, workers)
    return fetch_requests(spark, reqs, conf, landing_path, on_error=on_error,
                          parallelism=par if quota is None else min(par, quota), quota=quota, window_s=window_s, policy=policy)


def _checked(landing: DataFrame, entity: str, mode: str) -> DataFrame:
    """Failed requests and unusable bodies; the modes that stop at the first error raise instead."""
    failed = failed_tasks(landing, ENTITIES[entity][0])
    if MODES[mode][1] == "fail":
        first = failed.agg(F.min(F.struct("task_index", "page", "error")).alias("e")).first().e
        if first is not None:
            raise FetchError(f"task {first.task_index} page {first.page}: {first.error}")
    return failed


def ingest(spark: SparkSession, reqs: DataFrame, entity: str, conf: dict, landing_path: str, output: str | None = None,
           fmt: str = "parquet", mode: str = "threaded", validation: str = "quarantine", workers: int = 3,
           quota: int | None = DEFAULT_QUOTA, window_s: float = 60.0, policy: str = "entity",
           metrics_path: str | None = None, team: int | None = None, limit: int | None = None, **filter_args) -> JobResult:
    """Fetch, flatten, re-apply the request's filters on landed rows, write, record.

    ``entity`` endpoints use the entity retry policy and a quota of 10 calls per
    minute unless told otherwise. ``validation``: ``quarantine`` keeps rejects
    beside the valid rows, ``failfast`` stops at the first bad record. With
    ``team`` (J4) only that team's matches stay, the first ``limit`` of them.
    ``metrics_path`` gets one row per run, also when the run fails.
    """
    mode_options(mode)
    run = RunRecord(spark, metrics_path, f"ingest_{entity}")
    try:
        landing = land(spark, reqs, conf, landing_path, mode, workers, quota, window_s, policy)
        failed = _checked(landing, entity, mode)
        checked = flatten_entity(landing, entity, validation)
        rows = checked.valid
        if team is not None:
            rows = filters.team_matches(rows, team, requests.DEFAULT_TEAM_LIMIT if limit is None else limit, **filter_args)
        elif entity == "matches" and filter_args:
            rows = filters.filter_matches(rows, **filter_args)
        written = None
        if output is not None:
            part = ENTITIES[entity][2]
            written = writers.write_records(rows, f"{output.rstrip('/')}/{entity}", fmt, [part] if part else [],
                                            SCHEMAS[entity])
        rejects = checked.rejects if checked.rejects is not None else spark.createDataFrame([], REJECTS)
        run.done(written)
        return JobResult(rows, rejects, failed, written)
    finally:
        run.close()


def _one(spark: SparkSession) -> DataFrame:
    return spark.range(1)


def matches_requests(spark: SparkSession, competition: str, season=None, status=None, date_from=None,
                     date_to=None) -> DataFrame:
    return requests.request_table(_one(spark), "competition_matches", F.lit(0), competition=F.lit(competition),
                                  season=F.lit(season), status=F.lit(status), dateFrom=F.lit(date_from),
                                  dateTo=F.lit(date_to))


def team_requests(spark: SparkSession, team_id: int, season=None, status=None, date_from=None, date_to=None,
                  limit: int = requests.DEFAULT_TEAM_LIMIT) -> DataFrame:
    return requests.request_table(_one(spark), "team_matches", F.lit(0), team=F.lit(team_id), limit=F.lit(limit),
                                  season=F.lit(season), status=F.lit(status), dateFrom=F.lit(date_from),
                                  dateTo=F.lit(date_to))


def entity_requests(spark: SparkSession, endpoint: str, competition: str, season=None) -> DataFrame:
    return requests.request_table(_one(spark), endpoint, F.lit(0), competition=F.lit(competition),
                                  season=F.lit(season))


def season_dump(spark: SparkSession, competition: str, season: int, conf: dict, out_root: str, mode: str = "threaded",
                quota: int | None = DEFAULT_QUOTA, policy: str = "entity", metrics_path: str | None = None,
                workers: int = 3) -> dict[str, str]:
    """Three requests, one landing, three flattens, one dataset root per entity."""
    reqs = (requests.request_table(_one(spark), "competition_matches", F.lit(1), competition=F.lit(competition),
                                   season=F.lit(season))
            .unionByName(requests.request_table(_one(spark), "standings", F.lit(2), competition=F.lit(competition),
                                                season=F.lit(season)))
            .unionByName(requests.request_table(_one(spark), "scorers", F.lit(3), competition=F.lit(competition),
                                                season=F.lit(season))))
    landing = land(spark, reqs, conf, f"{out_root}/_landing", mode, workers, quota=quota, policy=policy)
    paths = {}
    for endpoint, entity in (("competition_matches", "matches"), ("standings", "standings"), ("scorers", "scorers")):
        run = RunRecord(spark, metrics_path, f"season_dump_{entity}")
        try:
            own = landing.where(F.col("endpoint") == endpoint)
            _checked(own, entity, mode)
            rows = flatten_entity(own, entity).valid
            paths[entity] = f"{out_root}/{entity}"
            run.done(writers.write_partitioned(rows, paths[entity], [ENTITIES[entity][2]], SCHEMAS[entity]))
        finally:
            run.close()
    return paths


def bulk_standings(spark: SparkSession, competitions_landing: DataFrame, season: int, conf: dict, landing_path: str,
                   mode: str = "threaded", workers: int = 4, quota: int | None = DEFAULT_QUOTA,
                   policy: str = "entity") -> DataFrame:
    """Competitions -> one standings request each -> skip failed / empty -> one union of rows."""
    comps = flatten_entity(competitions_landing, "competitions").valid
    reqs = requests.request_table(comps, "standings", F.col("competition_id") * 10000 + F.lit(season),
                                  competition=F.col("competition_code"), season=F.lit(season))
    landing = land(spark, reqs, conf, landing_path, mode, workers, quota, policy=policy)
    return flatten_entity(filters.skip_empty(landing), "standings").valid


def run_recorded(spark: SparkSession, metrics_path: str | None, job: str, work: Callable[[], int | None], times: int = 1,
                 backoff_s: float = 0.0, sleep: Callable[[float], None] = time.sleep) -> int | None:
    """Run ``work`` (returns the rows it wrote) up to ``times`` times; every try leaves one row of run metrics.

    After failed try ``a`` the wait is ``a * backoff_s``; the last failure is raised. ``work`` must be repeatable:
    write to a fresh folder or replace one as a whole.
    """
    if times < 1:
        raise ValueError("times must be at least 1")
    for attempt in range(1, times + 1):
        run = RunRecord(spark, metrics_path, job)
        try:
            rows = work()
            run.done(rows)
            return rows
        except Exception:
            if attempt == times:
                raise
        finally:
            run.close()
        sleep(attempt * backoff_s)


def land_pages(pages: DataFrame, tag: str = "pages") -> tuple[str, int]:
    """Write a paged read to a fresh folder; (path, pages landed), counted by the write itself."""
    path = scratch_path(pages.sparkSession, tag)
    rows, seen = observed(pages, f"land_pages_{tag}")
    rows.write.parquet(path)
    return path, int(seen.get.get("rows", 0))
