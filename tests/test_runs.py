"""Recorded runs: every try leaves a row, waits grow linearly, the last failure is raised."""

import pytest

from feedlake.operators.metrics import RUNS
from feedlake.plans import jobs
from feedlake.session import scratch_path
from feedlake.sources import rest_json


def _log(spark, path):
    return sorted((r.started_ms, r.job, r.rows_written, r.ok) for r in spark.read.schema(RUNS).parquet(path).collect())


def test_tries_are_recorded_until_one_succeeds(spark):
    log, waits, tries = scratch_path(spark, "t-runs"), [], []

    def work():
        tries.append(1)
        if len(tries) < 3:
            raise OSError("down")
        return 7

    assert jobs.run_recorded(spark, log, "j", work, times=4, backoff_s=2.0, sleep=waits.append) == 7
    assert waits == [2.0, 4.0]
    assert [r[1:] for r in _log(spark, log)] == [("j", None, False), ("j", None, False), ("j", 7, True)]


def test_last_failure_is_raised(spark):
    log, waits = scratch_path(spark, "t-runs-fail"), []
    with pytest.raises(ZeroDivisionError):
        jobs.run_recorded(spark, log, "j", lambda: 1 // 0, times=2, backoff_s=1.0, sleep=waits.append)
    assert waits == [1.0] and [r[3] for r in _log(spark, log)] == [False, False]
    with pytest.raises(ValueError):
        jobs.run_recorded(spark, log, "j", lambda: 1, times=0)


def test_a_paged_read_without_its_first_page_is_recorded_as_failed(spark):
    log, root = scratch_path(spark, "t-runs-page"), scratch_path(spark, "t-runs-store")
    rest_json.register(spark)

    def work():
        pages = (spark.read.format("rest_json").option("url", "/none")
                 .option("transport", '{"kind": "file", "root": "%s"}' % root).option("mode", "async").load())
        return jobs.land_pages(pages)[1]

    with pytest.raises(Exception):
        jobs.run_recorded(spark, log, "page_async", work, times=2, sleep=lambda s: None)
    assert [r[1:] for r in _log(spark, log)] == [("page_async", None, False)] * 2
