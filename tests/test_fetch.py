import json
import time

import pytest
from pyspark.sql import functions as F

from feedlake.plans import jobs
from feedlake.session import scratch_path
from feedlake.sources import requests, rest_json
from feedlake.sources import transport as tp
from feedlake.sources.fetch import FetchError, fetch_requests, write_store


def _setup(spark):
    reqs = requests.request_table(spark.range(1, 4), "scorers", F.col("id"),
                                  competition=F.concat(F.lit("C"), F.col("id").cast("string")), season=F.lit(2024))
    store = reqs.where(F.col("task_index") != 2).select(
        "task_index", "path", "params", "args", F.lit(1).cast("bigint").alias("page"),
        F.lit('{"scorers": []}').alias("body"))
    root = scratch_path(spark, "t-store")
    write_store(store, root)
    return reqs, {"kind": "file", "root": root}


def test_on_error_modes(spark):
    reqs, conf = _setup(spark)
    kept = fetch_requests(spark, reqs, conf, scratch_path(spark, "t-l1"), on_error="null")
    assert sorted((r.task_index, r.status, r.http_status) for r in kept.collect()) == [
        (1, "ok", 200), (2, "failed", 404), (3, "ok", 200)]
    dropped = fetch_requests(spark, reqs, conf, scratch_path(spark, "t-l2"), on_error="drop")
    assert sorted(r.task_index for r in dropped.collect()) == [1, 3]
    with pytest.raises(Exception, match="HTTP 404"):
        fetch_requests(spark, reqs, conf, scratch_path(spark, "t-l3"), on_error="fail")


def test_falsy_params_not_sent(spark):
    df = spark.range(1).select(requests.query_string(requests.sent_params(
        "team_matches", {"limit": F.lit(100), "season": F.lit(0), "status": F.lit(""), "dateFrom": F.lit(None)}))
        .alias("q"))
    assert df.first().q == "limit=100"


def test_quota_must_cover_tasks(spark):
    reqs, conf = _setup(spark)
    with pytest.raises(ValueError):
        fetch_requests(spark, reqs, conf, scratch_path(spark, "t-l4"), parallelism=4, quota=2)


def _page_doc(total, page):
    return json.dumps({"status": 200, "body": json.dumps({"total_pages": total, "records": [{"p": page}]})})


def _put(root, url, doc):
    (root / f"{tp.request_key(url)}.json").write_text(doc)


def _paged(spark, root, mode, **options):
    rest_json.register(spark)
    r = (spark.read.format("rest_json").option("url", "/x").option("mode", mode)
         .option("transport", json.dumps({"kind": "file", "root": str(root)})))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load()


@pytest.mark.parametrize("mode", ["sequential", "async"])
def test_a_failed_first_page_fails_the_read(spark, tmp_path, mode):
    for page in (2, 3):
        _put(tmp_path, f"/x?page={page}", _page_doc(3, page))
    with pytest.raises(Exception, match="page 1"):
        _paged(spark, tmp_path, mode, on_error="drop").collect()


@pytest.mark.parametrize("mode", ["sequential", "async"])
def test_pages_in_ranges(spark, tmp_path, mode):
    for page in range(1, 12):
        _put(tmp_path, "/x" if page == 1 else f"/x?page={page}", _page_doc(11, page))
    pages = _paged(spark, tmp_path, mode, partitions="3")
    assert sorted(r.page for r in pages.collect()) == list(range(1, 12))
    assert pages.rdd.getNumPartitions() <= 4


def test_throttled_pages_never_vanish(spark, tmp_path):
    slow = json.dumps({"status": 429, "retry_after": "0", "body": None})
    _put(tmp_path, "/x?page=1", _page_doc(3, 1))
    _put(tmp_path, "/x?page=2", json.dumps({"responses": [json.loads(slow)] * 15 + [json.loads(_page_doc(3, 2))]}))
    pages = _paged(spark, tmp_path, "threaded", total_pages="3").collect()  # page 3 is absent: dropped
    assert sorted((r.page, r.attempts) for r in pages) == [(1, 1), (2, 16)]
    _put(tmp_path, "/x?page=3", slow)
    with pytest.raises(Exception, match="page [23]: HTTP 429"):
        _paged(spark, tmp_path, "threaded", total_pages="3", max_429="2").collect()


def test_storage_faults_are_not_404(tmp_path):
    (tmp_path / "file").write_text("x")
    free = tp.Limiter(None)
    for root in (tmp_path / "file", tmp_path / "absent"):
        got = tp.fetch({"kind": "file", "root": str(root)}, "/x", free, sleep=lambda s: None)
        assert (got["status"], got["http_status"], got["attempts"]) == ("failed", None, 3)
    got = tp.fetch({"kind": "file", "root": str(tmp_path)}, "/x", free)
    assert (got["http_status"], got["attempts"]) == (404, 1)
    _put(tmp_path, "/x", "not json")
    assert tp.fetch({"kind": "file", "root": str(tmp_path)}, "/x", free, sleep=lambda s: None)["http_status"] is None


@pytest.mark.parametrize("header,want", [(None, 7), ("3", 3), (" 4 ", 4), ("²", 7), ("Wed, 21 Oct 2026 07:28:00 GMT", 7), (5, 5), ("-1", 7)])
def test_retry_after(header, want):
    assert tp._after(header, 7) == want


def test_entity_policy_asks_once_more(tmp_path):
    slow, good = {"status": 429, "retry_after": "9", "body": None}, {"status": 200, "body": "{}"}
    waits = []
    _put(tmp_path, "/x", json.dumps({"responses": [slow, good]}))
    _put(tmp_path, "/y", json.dumps(slow))
    conf = {"kind": "file", "root": str(tmp_path)}
    ok = tp.fetch(conf, "/x", tp.Limiter(None), policy="entity", sleep=waits.append)
    no = tp.fetch(conf, "/y", tp.Limiter(None), policy="entity", sleep=waits.append)
    assert (ok["status"], ok["attempts"], no["status"], no["attempts"], waits) == ("ok", 2, "failed", 2, [9, 9])


def test_limiter_follows_the_rule():
    now, calls = [0.0], []
    limiter = tp.Limiter(3, 10.0, sleep=lambda s: now.__setitem__(0, now[0] + s), clock=lambda: now[0], not_before=5.0)
    for step in (0, 0, 1, 0, 0, 30, 0, 0, 0, 0):
        now[0] += step
        limiter.acquire()
        calls.append(now[0])
    assert calls[0] == 5.0
    assert all(sum(t - 10 < c <= t for c in calls) <= 3 for t in calls)


def test_pages_of_one_request_use_all_tasks(spark, tmp_path):
    """Phase 2 deals pages, not requests, and returns every page of a long request once."""
    reqs = requests.request_table(spark.range(1), "scorers", F.col("id"), competition=F.lit("C"), season=F.lit(2024))
    pages = reqs.select("task_index", "path", "params", "args", F.explode(F.expr("sequence(1L, 40L)")).alias("page"),
                        F.lit('{"total_pages": 40, "scorers": []}').alias("body"))
    root = scratch_path(spark, "t-store")
    write_store(pages, root)
    got = fetch_requests(spark, reqs, {"kind": "file", "root": root}, scratch_path(spark, "t-l5"), parallelism=4)
    rows = got.select("page", F.input_file_name().alias("f")).collect()
    assert sorted(r.page for r in rows) == list(range(1, 41))
    assert len({r.f for r in rows if r.page > 1}) == 4


def test_quota_holds_over_both_phases(spark, tmp_path):
    """With a quota, phase 2 starts a full window after phase 1."""
    reqs, conf = _setup(spark)
    paged = reqs.where("task_index = 1").select("task_index", "path", "params", "args", F.explode(F.expr("sequence(1L, 2L)")).alias("page"),
                                                F.lit('{"total_pages": 2, "scorers": []}').alias("body"))
    write_store(paged, conf["root"])
    at = time.time()
    got = fetch_requests(spark, reqs, conf, scratch_path(spark, "t-l6"), parallelism=1, quota=3, window_s=3.0)
    assert got.count() == 4 and time.time() - at >= 3.0


def test_landing_folder_must_be_new(spark):
    reqs, conf = _setup(spark)
    path = scratch_path(spark, "t-l7")
    fetch_requests(spark, reqs, conf, path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        fetch_requests(spark, reqs, conf, path)


@pytest.mark.parametrize("mode", ["sequential", "async", "threaded"])
def test_job_modes_and_records(spark, mode):
    """The failing request stops sequential and async jobs; threaded keeps it beside the rows."""
    reqs, conf = _setup(spark)
    metrics = scratch_path(spark, "t-metrics")
    run = dict(entity="scorers", conf=conf, landing_path=scratch_path(spark, "t-l8"), output=scratch_path(spark, "t-out"),
               mode=mode, quota=None, metrics_path=metrics)
    if mode == "threaded":
        done = jobs.ingest(spark, reqs, **run)
        assert [r.http_status for r in done.failed.collect()] == [404] and done.written == 0 and done.rejects.count() == 0
    else:
        with pytest.raises(FetchError, match="HTTP 404"):
            jobs.ingest(spark, reqs, **run)
    record = spark.read.parquet(metrics).collect()
    assert [(r.job, r.ok, r.rows_written) for r in record] == [("ingest_scorers", mode == "threaded", 0 if mode == "threaded" else None)]


def test_unknown_mode(spark):
    with pytest.raises(ValueError, match="unknown fetch mode"):
        jobs.ingest(spark, _setup(spark)[0], "scorers", {}, scratch_path(spark, "t-l9"), mode="other")


def test_unusable_body_fails_a_strict_job(spark):
    reqs, _ = _setup(spark)
    root = scratch_path(spark, "t-store")
    write_store(reqs.select("task_index", "path", "params", "args", F.lit(1).cast("bigint").alias("page"), F.lit('{"x": 1}').alias("body")), root)
    with pytest.raises(FetchError, match="missing_key:scorers"):
        jobs.ingest(spark, reqs, "scorers", {"kind": "file", "root": root}, scratch_path(spark, "t-l10"), mode="async", quota=None)


@pytest.mark.parametrize("team", [1005, 7])  # away in its own competition; at home elsewhere
def test_team_job_takes_matches_of_all_competitions(spark, sf, team):
    from feedlake.plans import queries_fetch
    from oracle_check import duck

    got = sorted((r.match_id, r.home_team_id, r.away_team_id) for r in queries_fetch.team_job(spark, sf, team, 10_000_000).collect())
    want = duck(sf).execute(f"SELECT match_id, home_team_id, away_team_id FROM ({queries_fetch.TEAM_SQL.format(team=team)}) t").fetchall()
    assert got == sorted(want) and got


def test_stored_responses_are_dealt_over_folders_and_found(spark, tmp_path):
    root = tmp_path / "store"
    rows = spark.range(40).selectExpr("id AS task_index", "concat('/r/', id) AS path", "CAST(map() AS map<string,string>) AS params",
                                      "CAST(1 AS bigint) AS page", "concat('body ', id) AS body")
    assert write_store(rows, str(root)) == 40
    assert not list(root.glob("*.json")) and len(list(root.glob("*/*.json"))) == 40
    conf = {"kind": "file", "root": str(root)}
    got = [tp.fetch(conf, f"/r/{i}", tp.Limiter(None)) for i in (0, 39, 40)]
    assert [g["payload"] for g in got[:2]] == ["body 0", "body 39"]
    assert [g["http_status"] for g in got] == [200, 200, 404]
