"""Fetch queries: request tables through the executor-side fetcher.

Each call renders canned responses from the tables into a fresh store (file
transport) and a fresh landing folder under the shared root, then runs the
same request -> landing -> flatten path a live API run would.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.coerce import int_div
from feedlake.operators.metrics import RUNS
from feedlake.plans import jobs
from feedlake.plans.catalog import CODE, MATCH_ROWS_SQL, SCORER_ROWS_SQL, STANDING_ROWS_SQL, register
from feedlake.schemas import SCHEMAS
from feedlake.session import read_table, scratch_path
from feedlake.sinks import writers
from feedlake.sources import feeds, requests, rest_json
from feedlake.sources.fetch import fetch_requests, write_store


def _tasks(spark: SparkSession) -> int:
    """Tasks of a fetch without a quota: pages are dealt over the whole cluster."""
    return spark.sparkContext.defaultParallelism


def _store(spark: SparkSession, rows: DataFrame) -> dict:
    root = scratch_path(spark, "store")
    write_store(rows, root)
    return {"kind": "file", "root": root}


def match_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Competition-match responses, with a few broken on purpose (fixed rule, mirrored in SQL):
    nation % 7 = 3 absent (404); nation % 11 = 5 in 1996 malformed; nation 4 in 1997 answers 429."""
    rows = feeds.store_rows(feeds.matches_landing(spark, sf_dir), "competition_matches")
    nation = int_div(F.col("task_index"), 10000)
    season = F.col("task_index") % 10000
    malformed = (nation % 11 == 5) & (season == 1996)
    throttled = (nation == 4) & (season == 1997)
    return rows.where(nation % 7 != 3).select(
        "task_index", "path", "params", "args", "page",
        F.when(malformed, F.lit('{"matches": [')).when(throttled, F.lit('{"message": "slow down"}'))
        .otherwise(F.col("body")).alias("body"),
        F.when(throttled, 429).otherwise(200).alias("status"),
        F.when(throttled, F.lit("0")).alias("retry_after"))


@register("task_outcomes", f"""
WITH m AS (
  SELECT CAST(n.n_nationkey AS BIGINT) AS nation, CAST(year(o.o_orderdate) AS BIGINT) AS season, o.o_orderkey
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
), r AS (
  SELECT nation, season, count(*) AS n, count(DISTINCT o_orderkey // 1000) AS pages FROM m GROUP BY ALL
)
SELECT nation * 10000 + season AS task_index,
       CASE WHEN nation % 7 = 3 OR (nation % 11 = 5 AND season = 1996) OR (nation = 4 AND season = 1997)
            THEN 'failed' ELSE 'ok' END AS status,
       CAST(CASE WHEN nation % 7 = 3 THEN 404 WHEN nation = 4 AND season = 1997 THEN 429 ELSE 200 END AS BIGINT)
         AS http_status,
       CASE WHEN nation % 7 = 3 THEN 'HTTP 404' WHEN nation % 11 = 5 AND season = 1996 THEN 'malformed_json'
            WHEN nation = 4 AND season = 1997 THEN 'HTTP 429' END AS error_kind,
       CAST(CASE WHEN nation % 7 = 3 OR (nation % 11 = 5 AND season = 1996) OR (nation = 4 AND season = 1997)
            THEN 1 ELSE pages END AS BIGINT) AS pages_fetched,
       CAST(CASE WHEN nation % 7 = 3 OR (nation % 11 = 5 AND season = 1996) OR (nation = 4 AND season = 1997)
            THEN 0 ELSE n END AS BIGINT) AS n_records
FROM r
""")
def q_task_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One outcome row per request (left join of requests to their landing)."""
    conf = _store(spark, match_store(spark, sf_dir))
    o = read_table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("season"))
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    keys = o.join(c, o.o_custkey == c.c_custkey).select(F.col("c_nationkey").cast("bigint").alias("nation"),
                                                        "season").distinct()
    reqs = requests.request_table(keys, "competition_matches", F.col("nation") * 10000 + F.col("season"),
                                  competition=feeds.competition_code(F.col("nation")), season=F.col("season"))
    landing = fetch_requests(spark, reqs, conf, scratch_path(spark, "landing"), on_error="null", parallelism=None,
                             max_429=2)
    return jobs.task_outcomes(reqs, landing, "matches")


@register("bulk_union", f"""
SELECT * FROM ({STANDING_ROWS_SQL}) s
WHERE season_start_year = 1996 AND CAST(substr(competition_code, 2) AS INT) % 7 <> 3
""")
def q_bulk_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every competition's standings for one season; failed / empty requests skipped, rest unioned."""
    rows = feeds.store_rows(feeds.standings_landing(spark, sf_dir), "standings")
    nation = int_div(F.col("task_index"), 10000)
    conf = _store(spark, rows.where(nation % 7 != 3))
    comps = feeds.competitions_landing(spark, sf_dir)
    return jobs.bulk_standings(spark, comps, 1996, conf, scratch_path(spark, "landing"), quota=None)


def _checksums(cols: list[str]) -> str:
    """DuckDB: one text per row over all columns, nulls marked, as md5; summed as the first 7 hex digits."""
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in cols)
    return f"CAST(sum(('0x' || substr(md5(concat_ws('|', {parts})), 1, 7))::BIGINT) AS BIGINT)"


def _checksum(cols: list[str]):
    row = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in cols])
    return F.sum(F.conv(F.substring(F.md5(row.cast("binary")), 1, 7), 16, 10).cast("bigint"))


@register("season_dump", " UNION ALL ".join(f"""
SELECT '{entity}' AS entity, count(*) AS n_rows, {_checksums(SCHEMAS[entity].names)} AS checksum
FROM ({sql}) x WHERE competition_code = 'N05' AND season_start_year = 1996
""" for entity, sql in (("matches", MATCH_ROWS_SQL), ("standings", STANDING_ROWS_SQL),
                        ("scorers", SCORER_ROWS_SQL.replace("CAST(2024 AS BIGINT)", "CAST(1996 AS BIGINT)")))))
def q_season_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches + standings + scorers of one competition and season, one landing, three roots; row checksums."""
    store = (feeds.store_rows(feeds.matches_landing(spark, sf_dir), "competition_matches")
             .unionByName(feeds.store_rows(feeds.standings_landing(spark, sf_dir), "standings"))
             .unionByName(feeds.store_rows(feeds.scorers_landing(spark, sf_dir, season=1996), "scorers")))
    asked = F.col("args").getItem("competition") == "N05"
    conf = _store(spark, store.where(asked & (F.coalesce(F.col("params").getItem("season"), F.lit("")) == "1996")))
    paths = jobs.season_dump(spark, "N05", 1996, conf, scratch_path(spark, "dump"), quota=None,
                             workers=_tasks(spark))
    out = [spark.read.schema(SCHEMAS[e]).parquet(p).agg(
        F.count("*").alias("n_rows"), _checksum(SCHEMAS[e].names).alias("checksum"))
        .select(F.lit(e).alias("entity"), "n_rows", "checksum") for e, p in paths.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


def _store_of(spark: SparkSession, landing: DataFrame, endpoint: str, throttle: bool = False) -> dict:
    """Responses of one endpoint; with ``throttle`` every first page answers 429 once before its body."""
    rows = feeds.store_rows(landing, endpoint)
    if throttle:
        rows = rows.withColumn("first_status", F.when(F.col("page") == 1, 429))
    return _store(spark, rows)


@register("job_matches", f"""
SELECT * FROM ({MATCH_ROWS_SQL}) m
WHERE competition_code = 'N05' AND season_start_year = 1996 AND status = 'FINISHED'
""")
def q_job_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every first page is throttled once; the entity policy asks again. Status is re-applied on landed rows."""
    rows = feeds.matches_landing(spark, sf_dir)
    conf = _store_of(spark, rows, "competition_matches", throttle=True)
    out = scratch_path(spark, "job")
    reqs = jobs.matches_requests(spark, "N05", 1996)
    jobs.ingest(spark, reqs, "matches", conf, f"{out}/landing", out, mode="async", validation="failfast", quota=None,
                workers=_tasks(spark), season=1996, status="FINISHED")
    return writers.read_partitioned(spark, f"{out}/matches", SCHEMAS["matches"])


@register("job_standings", f"""
SELECT * FROM ({STANDING_ROWS_SQL}) s WHERE competition_code = 'N05' AND season_start_year = 1996
""")
def q_job_standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standings of one competition and season, threaded mode (an absent competition gives no rows), partitioned Parquet."""
    conf = _store_of(spark, feeds.standings_landing(spark, sf_dir), "standings")
    out = scratch_path(spark, "job")
    jobs.ingest(spark, jobs.entity_requests(spark, "standings", "N05", 1996), "standings", conf, f"{out}/landing", out,
                workers=_tasks(spark), quota=None)
    return writers.read_partitioned(spark, f"{out}/standings", SCHEMAS["standings"])


@register("job_scorers", f"""
SELECT * FROM ({SCORER_ROWS_SQL}) s WHERE competition_code = 'N05'
""")
def q_job_scorers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scorers of one competition and season, async mode, CSV."""
    conf = _store_of(spark, feeds.scorers_landing(spark, sf_dir), "scorers")
    out = scratch_path(spark, "job")
    jobs.ingest(spark, jobs.entity_requests(spark, "scorers", "N05", feeds.SCORER_SEASON), "scorers", conf, f"{out}/landing",
                out, fmt="csv", mode="async", workers=_tasks(spark), quota=None)
    return writers.read_csv(spark, f"{out}/scorers", SCHEMAS["scorers"])


TEAM, TEAM_LIMIT = 1005, 25


TEAM_SQL = "SELECT * FROM (" + MATCH_ROWS_SQL + ") m WHERE (home_team_id = {team} OR away_team_id = {team}) AND status = 'FINISHED'"


@register("job_team", f"{TEAM_SQL.format(team=TEAM)} ORDER BY utc_date, match_id LIMIT {TEAM_LIMIT}")
def q_job_team(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One team's matches; the canned server ignores team, status and limit, the job applies them again."""
    return team_job(spark, sf_dir, TEAM, TEAM_LIMIT)


def team_job(spark: SparkSession, sf_dir: str, team: int, limit: int) -> DataFrame:
    """The server answers with every match of every competition."""
    landed = feeds.matches_landing(spark, sf_dir)
    reqs = jobs.team_requests(spark, team, status="FINISHED", limit=limit)
    pages = feeds.number_pages(landed.withColumn("page", F.col("task_index") * 1_000_000 + F.col("page"))
                               .withColumn("task_index", F.lit(0).cast("bigint")))
    body = F.concat(F.lit('{"total_pages":'), F.col("total_pages").cast("string"), F.lit(","), F.expr("substring(payload, 2)"))
    rows = pages.select("task_index", F.col("page_no").alias("page"), body.alias("body")).join(
        reqs.select("task_index", "path", "params", "args"), "task_index")
    out = scratch_path(spark, "job")
    jobs.ingest(spark, reqs, "matches", _store(spark, rows), f"{out}/landing", out, quota=None, workers=_tasks(spark), team=team,
                limit=limit, status="FINISHED")
    return writers.read_partitioned(spark, f"{out}/matches", SCHEMAS["matches"])


def _season_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.request_table(
        read_table(spark, sf_dir, "nation"), "competition_matches", F.col("n_nationkey").cast("bigint") * 10000 + 1996,
        competition=feeds.competition_code(F.col("n_nationkey")), season=F.lit(1996))


@register("job_failed_tasks", """
WITH r AS (
  SELECT CAST(c.c_nationkey AS BIGINT) AS nation, count(*) AS n FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE year(o.o_orderdate) = 1996 GROUP BY ALL)
SELECT CAST(n.n_nationkey AS BIGINT) * 10000 + 1996 AS task_index, CAST(1 AS BIGINT) AS page,
       CAST(CASE WHEN r.n IS NULL OR n.n_nationkey % 7 = 3 THEN 404 ELSE 200 END AS BIGINT) AS http_status,
       CASE WHEN r.n IS NULL OR n.n_nationkey % 7 = 3 THEN 'HTTP 404: not found' ELSE 'malformed_json' END AS error
FROM nation n LEFT JOIN r ON r.nation = n.n_nationkey
WHERE r.n IS NULL OR n.n_nationkey % 7 = 3 OR n.n_nationkey % 11 = 5
""")
def q_job_failed_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of one season over all competitions; absent (404) and malformed ones are a job output."""
    conf = _store(spark, match_store(spark, sf_dir))
    done = jobs.ingest(spark, _season_matches(spark, sf_dir), "matches", conf, scratch_path(spark, "landing"),
                       workers=_tasks(spark), quota=None)
    return done.failed.select("task_index", "page", "http_status", "error")


@register("job_rejects", f"""
SELECT match_id, CASE WHEN match_id % 2 = 0 THEN 'matchday' ELSE 'status' END AS field,
       CASE WHEN match_id % 2 = 0 THEN 'type' ELSE 'missing' END AS reason
FROM ({MATCH_ROWS_SQL}) m WHERE match_id % 20 IN (6, 13)
""")
def q_job_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2: a job over all requests keeps the rejected fields beside the valid rows."""
    landed = feeds.matches_landing(spark, sf_dir)
    # fixed defects: a text matchday in every match id ending 6 mod 20, no status in those ending 13 mod 20
    recs = F.from_json("payload", "struct<matches:array<string>>")["matches"]
    one = landed.select("*", F.posexplode(recs).alias("_i", "_r"))
    k = F.get_json_object("_r", "$.id").cast("bigint") % 20
    with_day = F.concat(F.lit('{"matchday":"x",'), F.regexp_replace(F.expr("substring(_r, 2)"), '"matchday":[0-9]+,', ""))
    bad = F.when(k == 6, with_day).when(k == 13, F.regexp_replace("_r", '"status":"[A-Z_]+",', "")).otherwise(F.col("_r"))
    pages = one.groupBy("task_index", "endpoint", "params", "page", "http_status", "status", "attempts", "error").agg(
        F.concat(F.lit('{"matches":['), F.array_join(F.collect_list(bad), ","), F.lit("]}")).alias("payload"))
    conf = _store(spark, feeds.store_rows(pages, "competition_matches"))
    keys = landed.select("task_index", F.col("params").getItem("competition").alias("c"),
                         F.col("params").getItem("season").cast("int").alias("s")).distinct()
    reqs = requests.request_table(keys, "competition_matches", F.col("task_index"), competition=F.col("c"), season=F.col("s"))
    done = jobs.ingest(spark, reqs, "matches", conf, scratch_path(spark, "landing"),
                       workers=_tasks(spark), quota=None)
    return done.rejects.select(F.get_json_object("record", "$.id").cast("bigint").alias("match_id"), "field", "reason")


PAGE_SIZE = 100


def order_pages_store(spark: SparkSession, sf_dir: str, base: str, bare_first: bool, drop_every: int | None):
    """Orders as a generic paged listing: ``{total_pages, records}``, 100 orders a page by key."""
    o = read_table(spark, sf_dir, "orders")
    page = int_div(F.col("o_orderkey"), PAGE_SIZE) + 1
    rec = F.struct("o_orderkey", "o_custkey", "o_orderstatus")
    pages = o.groupBy(page.alias("page")).agg(F.collect_list(rec).alias("records"))
    total = o.agg(F.max(page).alias("n")).first()["n"]  # one scalar
    rows = pages.select("page", F.lit(total).cast("bigint").alias("total_pages"), "records")
    if drop_every:
        rows = rows.where(F.col("page") % drop_every != 0)
    path = F.lit(base) if bare_first else F.concat(F.lit(base), F.lit("?page=1"))
    return rows.select(
        F.col("page").alias("task_index"),
        F.when(F.col("page") == 1, path).otherwise(F.lit(base)).alias("path"),
        F.create_map().cast("map<string,string>").alias("params"),
        F.create_map().cast("map<string,string>").alias("args"),
        F.when(F.col("page") == 1, F.lit(1)).otherwise(F.col("page")).cast("bigint").alias("page"),
        F.to_json(F.struct("total_pages", "records")).alias("body"))


def _read_pages(spark: SparkSession, conf: dict, base: str, mode: str, total: int | None = None) -> DataFrame:
    rest_json.register(spark)
    r = (spark.read.format("rest_json").option("url", base).option("transport", json.dumps(conf))
         .option("mode", mode))
    if total is not None:
        r = r.option("total_pages", str(total))
    return r.load()


@register("page_records", """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderkey // 100 + 1 AS BIGINT) AS page FROM orders
""")
def q_page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequential paged scan (page 1 bare, reports total_pages), pages fetched in parallel."""
    base = "/orders"
    conf = _store(spark, order_pages_store(spark, sf_dir, base, True, None))
    pages = _read_pages(spark, conf, base, "sequential")
    recs = rest_json.explode_page_records(pages, {"o_orderkey": "o_orderkey:bigint", "o_custkey": "o_custkey:bigint",
                                                  "o_orderstatus": "o_orderstatus:string"})
    return recs.select("o_orderkey", "o_custkey", "o_orderstatus", "page")


@register("page_records_async", """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderkey // 100 + 1 AS BIGINT) AS page FROM orders
""")
def q_page_records_async(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bounded-concurrency scheme: the first page tells N, any failed page aborts."""
    base = "/orders"
    conf = _store(spark, order_pages_store(spark, sf_dir, base, True, None))
    recs = rest_json.explode_page_records(_read_pages(spark, conf, base, "async"), {
        "o_orderkey": "o_orderkey:bigint", "o_custkey": "o_custkey:bigint", "o_orderstatus": "o_orderstatus:string"})
    return recs.select("o_orderkey", "o_custkey", "o_orderstatus", "page")


@register("page_drop_failed", """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderkey // 100 + 1 AS BIGINT) AS page FROM orders
WHERE (o_orderkey // 100 + 1) % 7 <> 0
""")
def q_page_drop_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threaded paged scan with caller-given total_pages; missing pages (404) are dropped."""
    base = "/orders"
    conf = _store(spark, order_pages_store(spark, sf_dir, base, False, 7))
    total = read_table(spark, sf_dir, "orders").agg(
        (int_div(F.max("o_orderkey"), PAGE_SIZE) + 1).alias("n")).first()["n"]
    pages = _read_pages(spark, conf, base, "threaded", int(total))
    recs = rest_json.explode_page_records(pages, {"o_orderkey": "o_orderkey:bigint", "o_custkey": "o_custkey:bigint",
                                                  "o_orderstatus": "o_orderstatus:string"})
    return recs.select("o_orderkey", "o_custkey", "o_orderstatus", "page")


@register("page_runs", """
WITH n AS (SELECT CAST(max(o_orderkey) // 100 + 1 AS BIGINT) AS n FROM orders),
p AS (SELECT o_orderkey, o_orderkey // 100 + 1 AS page FROM orders)
SELECT 'page_sequential' AS job, n AS pages, (SELECT count(*) FROM p) AS records, true AS ok, true AS timed FROM n
UNION ALL SELECT 'page_async', n, (SELECT count(*) FROM p), true, true FROM n
UNION ALL SELECT 'page_threaded', n - n // 7, (SELECT count(*) FROM p WHERE page % 7 <> 0), true, true FROM n
""")
def q_page_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timed paged reads of the three schemes, landed; the recorded runs beside the records that landed."""
    log = scratch_path(spark, "page-runs")
    whole = _store(spark, order_pages_store(spark, sf_dir, "/orders", True, None))
    holes = _store(spark, order_pages_store(spark, sf_dir, "/orders", False, 7))
    total = read_table(spark, sf_dir, "orders").agg(
        (int_div(F.max("o_orderkey"), PAGE_SIZE) + 1).alias("n")).first()["n"]
    landed = {}

    def read(scheme: str) -> int:
        conf, n = (holes, int(total)) if scheme == "threaded" else (whole, None)
        landed[scheme], pages = jobs.land_pages(_read_pages(spark, conf, "/orders", scheme, n), f"pages-{scheme}")
        return pages

    for scheme in ("sequential", "async", "threaded"):
        jobs.run_recorded(spark, log, f"page_{scheme}", lambda: read(scheme), times=2, backoff_s=1.0)
    counts = [rest_json.explode_page_records(spark.read.schema(rest_json.SCHEMA).parquet(path)).agg(F.count("*").alias("records"))
              .withColumn("job", F.lit(f"page_{scheme}")) for scheme, path in landed.items()]
    runs = spark.read.schema(RUNS).parquet(log)
    return runs.join(counts[0].unionByName(counts[1]).unionByName(counts[2]), "job").select(
        "job", F.col("rows_written").alias("pages"), "records", "ok", (F.col("duration_ms") > 0).alias("timed"))
