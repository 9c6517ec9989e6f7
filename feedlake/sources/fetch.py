"""Request table -> landing table, fetched on executors.

Two phases, each a distributed ``mapInPandas`` over request rows:
  1. every request's first page (the bare URL), dealt to tasks by ``task_index``;
  2. for responses that report ``total_pages`` > 1, a page plan
     (``?page=2..N``) dealt by (``task_index``, ``page``), so the pages of one
     request are spread over all tasks.
The phase-1 landing is written to the landing folder before phase 2 is
planned, so no request is sent twice and the lineage is cut (a lost
executor re-reads the written landing, it does not re-call the API). The
landing folder must be new: rows of another run are never returned.

Bodies leave a task in small batches as they arrive; a task never holds all of them.

Quota: it is global, so each task gets ``floor(quota / parallelism)`` calls per
window (``parallelism`` <= quota; 1 is the hard single-client cap). Phase 2
starts a full window after phase 1 has ended, and a repeated task attempt waits
a window first, so calls of neither add up. Speculative execution must stay
off for a rate-limited source. Without a quota (replays), ``parallelism=None``
uses the cluster's default.

``on_error``: ``fail`` stops the task at its first failed request and raises
once on the driver, from an aggregate over the landed rows (U1/U3; no task
failure, hence no retry that calls the API again); ``null`` keeps a failed
landing row (U2); ``drop`` omits it (S9), except requests that were only throttled.
"""

from __future__ import annotations

import json
import time

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.functions.coerce import int_div
from feedlake.schemas import LANDING
from feedlake.sources import transport as tp
from feedlake.sources.requests import query_string

ON_ERROR = ("fail", "null", "drop")

_WIRE = T.StructType([
    T.StructField("task_index", T.LongType()),
    T.StructField("endpoint", T.StringType()),
    T.StructField("params_json", T.StringType()),
    T.StructField("page", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("http_status", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("attempts", T.LongType()),
    T.StructField("error", T.StringType()),
    T.StructField("payload", T.StringType()),
])


class FetchError(RuntimeError):
    pass


BATCH_ROWS, BATCH_CHARS = 200, 1 << 20
PAGES_PER_STEP = 1000


def _fetcher(conf: dict, on_error: str, per_task_quota: int | None, window_s: float, policy: str, max_429: int | None,
             not_before: float | None):
    def run(batches):
        from pyspark import TaskContext

        hold = not_before
        if per_task_quota is not None and TaskContext.get().attemptNumber() > 0:
            hold = max(hold or 0.0, time.time() + window_s)
        limiter = tp.Limiter(per_task_quota, window_s, not_before=hold)
        rows, chars, stopped = [], 0, False
        for pdf in batches:
            for rec in pdf.itertuples(index=False):
                if stopped:
                    break
                got = tp.fetch(conf, rec.url, limiter, policy=policy, max_429=max_429)
                if on_error == "drop" and tp.may_drop(got):
                    continue
                stopped = on_error == "fail" and got["status"] != "ok"
                rows.append(dict(task_index=rec.task_index, endpoint=rec.endpoint, params_json=rec.params_json,
                                 page=rec.page, url=rec.url, **got))
                chars += len(got["payload"] or "")
                if len(rows) >= BATCH_ROWS or chars >= BATCH_CHARS:
                    yield pd.DataFrame(rows, columns=_WIRE.names)
                    rows, chars = [], 0
        yield pd.DataFrame(rows, columns=_WIRE.names)

    return run


def _url(path, params, page):
    q = query_string(params)
    with_page = F.when(page > 1, F.concat_ws("&", F.when(q != "", q), F.concat(F.lit("page="), page.cast("string"))))
    qs = F.coalesce(with_page, q)
    return F.when(qs == "", path).otherwise(F.concat(path, F.lit("?"), qs))


def _stage(reqs: DataFrame, deal: tuple[str, ...], parallelism: int, quota: int | None, conf: dict, on_error: str,
           window_s: float, policy: str, max_429: int | None, not_before: float | None = None) -> DataFrame:
    per_task = None if quota is None else quota // parallelism
    wire = reqs.select(
        "task_index", "endpoint",
        F.to_json(F.map_concat(F.col("args"), F.col("params"))).alias("params_json"),
        F.col("page"), _url(F.col("path"), F.col("params"), F.col("page")).alias("url"),
    ).repartition(parallelism, *deal)
    got = wire.mapInPandas(_fetcher(conf, on_error, per_task, window_s, policy, max_429, not_before), _WIRE)
    return got.select(
        F.col("task_index"), "endpoint", F.from_json("params_json", "map<string,string>").alias("params"),
        "page", "http_status", "status", "attempts", "error", "payload")


def _raise_first(landing: DataFrame) -> None:
    first = landing.where(F.col("status") != "ok").agg(
        F.min(F.struct("task_index", "page", "error")).alias("e"), F.count("*").alias("n")).first()
    if first.n:
        raise FetchError(f"task {first.e.task_index} page {first.e.page}: {first.e.error}")


def further_pages(landed: DataFrame) -> DataFrame:
    """(task_index, page) for pages 2..total_pages of every landed first page, in steps of bounded arrays."""
    total = F.try_variant_get(F.try_parse_json("payload"), "$.total_pages", "bigint")
    steps = landed.where((F.col("status") == "ok") & (total > 1)).select(
        "task_index", total.alias("total"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), int_div(total - 1, PAGES_PER_STEP))).alias("step"))
    low = F.greatest(F.lit(2).cast("bigint"), F.col("step") * PAGES_PER_STEP + 1)
    high = F.least(F.col("total"), (F.col("step") + 1) * PAGES_PER_STEP)
    return steps.where(low <= high).select("task_index", F.explode(F.sequence(low, high)).alias("page"))


def fetch_requests(spark: SparkSession, requests: DataFrame, conf: dict, landing_path: str, on_error: str = "null",
                   parallelism: int | None = 3, quota: int | None = None, window_s: float = 60.0, policy: str = "page",
                   max_429: int | None = None, paged: bool = True) -> DataFrame:
    """Fetch every request (and its further pages) into the new folder ``landing_path``; returns the landing."""
    if on_error not in ON_ERROR:
        raise ValueError(f"unknown on_error {on_error!r}; expected one of {ON_ERROR}")
    if parallelism is None:
        parallelism = spark.sparkContext.defaultParallelism if quota is None else quota
    if parallelism < 1 or (quota is not None and parallelism > quota):
        raise ValueError("need 1 <= parallelism <= quota, so every task keeps at least one call per window")
    args = dict(conf=conf, on_error=on_error, parallelism=parallelism, quota=quota, window_s=window_s,
                policy=policy, max_429=max_429)
    first = requests.withColumn("page", F.lit(1).cast("bigint"))
    _stage(first, ("task_index",), **args).write.mode("error").parquet(landing_path)
    landed = spark.read.schema(LANDING).parquet(landing_path)
    if on_error == "fail":
        _raise_first(landed)
    if paged:
        plan = requests.join(further_pages(landed), "task_index")
        later = None if quota is None else time.time() + window_s
        _stage(plan, ("task_index", "page"), not_before=later, **args).write.mode("append").parquet(landing_path)
        landed = spark.read.schema(LANDING).parquet(landing_path)
        if on_error == "fail":
            _raise_first(landed)
    return landed


def write_store(responses: DataFrame, root: str) -> int:
    """Canned responses for the file transport: one JSON file per request URL.

    ``responses``: task_index, path, params, args, page, body [, status, retry_after, first_status]. A non-null
    ``first_status`` answers the first attempt (Retry-After 0), the rest of the row the later ones.
    Files are written by executor tasks in parallel, dealt over 256 folders; returns the number written.
    """
    cols = responses.columns
    status = F.col("status") if "status" in cols else F.lit(200)
    ra = F.col("retry_after") if "retry_after" in cols else F.lit(None).cast("string")
    first = F.col("first_status") if "first_status" in cols else F.lit(None)
    rows = responses.select(_url(F.col("path"), F.col("params"), F.col("page")).alias("url"),
                            status.cast("bigint").alias("status"), ra.cast("string").alias("retry_after"),
                            F.col("body"), first.cast("bigint").alias("first_status"))

    def put(batches):
        fs, base = tp.open_fs(root)
        fs.create_dir(base, recursive=True)
        n, folders = 0, set()
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                doc = {"status": int(r.status), "retry_after": r.retry_after, "body": r.body}
                if not pd.isna(r.first_status):
                    doc = {"responses": [{"status": int(r.first_status), "retry_after": "0", "body": None}, doc]}
                path = f"{base.rstrip('/')}/{tp.stored_at(r.url)}"
                folder = path.rsplit("/", 1)[0]
                if folder not in folders:
                    fs.create_dir(folder, recursive=True)
                    folders.add(folder)
                with fs.open_output_stream(path) as f:
                    f.write(json.dumps(doc).encode("utf-8"))
                n += 1
        yield pd.DataFrame({"n": [n]})

    out = rows.mapInPandas(put, "n long").agg(F.sum("n").alias("n")).collect()
    return int(out[0]["n"] or 0)
