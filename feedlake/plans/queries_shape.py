"""Expression and filter queries: P5-P9, P11, F1-F5, F7, S1, S5, S6, S8-S10."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions import text
from feedlake.operators import filters
from feedlake.operators.entity import flatten_entity, flatten_matches
from feedlake.operators.presence import field_presence
from feedlake.plans.catalog import CODE, MATCH_ROWS_SQL, register
from feedlake.session import read_table
from feedlake.sources import feeds, requests
from feedlake.sources.landing import explode_records


@register("date_slices", """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 11 = 0 THEN strftime(o_orderdate, '%Y-%m')
            ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS utc_date,
       CAST(year(o_orderdate) AS BIGINT) AS season_start_year,
       CASE WHEN o_orderkey % 11 = 0 THEN strftime(o_orderdate, '%Y-%m')
            ELSE strftime(o_orderdate, '%Y-%m-%d') END AS match_date
FROM orders
""")
def q_date_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    utc = F.when(F.col("o_orderkey") % 11 == 0, F.date_format("o_orderdate", "yyyy-MM")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    t = o.select("o_orderkey", utc.alias("utc_date"))
    return t.select("o_orderkey", "utc_date", text.year4(F.col("utc_date")).alias("season_start_year"),
                    text.date10(F.col("utc_date")).alias("match_date"))


@register("label_split", """
SELECT p_partkey,
       p_brand || ' — ' || p_name || CASE WHEN p_size % 10 = 0 THEN ' — ' || p_type ELSE '' END AS label,
       p_brand AS code,
       p_name AS name
FROM part
""")
def q_label_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    lbl = F.when(F.col("p_size") % 10 == 0, text.label(F.col("p_brand"), F.col("p_name"), F.col("p_type"))).otherwise(
        text.label(F.col("p_brand"), F.col("p_name")))
    t = p.select("p_partkey", lbl.alias("label"))
    return t.select("p_partkey", "label", text.label_code(F.col("label")).alias("code"),
                    text.label_name(F.col("label")).alias("name"))


@register("digits_check", """
SELECT p_partkey, kind, candidate, regexp_full_match(candidate, '[0-9]+') AS is_digits
FROM (
  SELECT p_partkey, 'size' AS kind, CAST(p_size AS VARCHAR) AS candidate FROM part
  UNION ALL SELECT p_partkey, 'name', p_name FROM part
  UNION ALL SELECT p_partkey, 'padded', CASE WHEN p_size % 7 = 0 THEN '' ELSE lpad(CAST(p_size AS VARCHAR), 3, '0') END FROM part
  UNION ALL SELECT p_partkey, 'signed', '-' || CAST(p_size AS VARCHAR) FROM part
)
""")
def q_digits_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    size = F.col("p_size").cast("string")
    cands = F.array(
        F.struct(F.lit("size").alias("kind"), size.alias("candidate")),
        F.struct(F.lit("name").alias("kind"), F.col("p_name").alias("candidate")),
        F.struct(F.lit("padded").alias("kind"),
                 F.when(F.col("p_size") % 7 == 0, F.lit("")).otherwise(F.lpad(size, 3, "0")).alias("candidate")),
        F.struct(F.lit("signed").alias("kind"), F.concat(F.lit("-"), size).alias("candidate")),
    )
    t = p.select("p_partkey", F.inline(cands))
    return t.select("p_partkey", "kind", "candidate", text.is_digits(F.col("candidate")).alias("is_digits"))


FILTER_ARGS = dict(season=1996, status="FINISHED", date_from="1996-03-01", date_to="1996-09-30")


@register("filter_matches", f"""
SELECT * FROM ({MATCH_ROWS_SQL}) m
WHERE season_start_year = 1996 AND status = 'FINISHED'
  AND match_date BETWEEN '1996-03-01' AND '1996-09-30'
""")
def q_filter_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Parameters go to the "server" (pushed into the orders scan) and are applied again on landed rows.
    landing = feeds.matches_landing(spark, sf_dir, **FILTER_ARGS)
    return filters.filter_matches(flatten_matches(landing), **FILTER_ARGS)


TEAM_ID = 1007


@register("team_matches_limit", f"""
SELECT * FROM ({MATCH_ROWS_SQL}) m
WHERE home_team_id = {TEAM_ID} OR away_team_id = {TEAM_ID}
ORDER BY utc_date, match_id
LIMIT {requests.DEFAULT_TEAM_LIMIT}
""")
def q_team_matches_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.team_matches(flatten_matches(feeds.matches_landing(spark, sf_dir)), TEAM_ID,
                                requests.DEFAULT_TEAM_LIMIT)


@register("request_params", """
SELECT o_orderkey AS task_index,
       '/teams/' || CAST(o_custkey AS VARCHAR) || '/matches' AS path,
       concat_ws('&', 'limit=100',
         CASE WHEN o_orderkey % 4 <> 0 THEN 'season=' || CAST(year(o_orderdate) AS VARCHAR) END,
         CASE o_orderstatus WHEN 'F' THEN 'status=FINISHED' WHEN 'P' THEN 'status=IN_PLAY' END,
         CASE WHEN o_orderkey % 3 = 0 THEN 'dateFrom=' || strftime(o_orderdate, '%Y-%m-%d') END,
         CASE WHEN o_orderkey % 3 = 0 THEN 'dateTo=' || strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d') END
       ) AS query,
       CAST(2 + (o_orderkey % 4 <> 0)::INT + (o_orderstatus <> 'O')::INT + 2 * (o_orderkey % 3 = 0)::INT - 1 AS BIGINT)
         AS n_params
FROM orders
""")
def q_request_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One team-matches request per order; falsy values are not sent, limit always is."""
    o = read_table(spark, sf_dir, "orders")
    ranged = F.col("o_orderkey") % 3 == 0
    season = F.when(F.col("o_orderkey") % 4 != 0, F.year("o_orderdate")).otherwise(F.lit(0))
    status = F.when(F.col("o_orderstatus") == "F", "FINISHED").when(F.col("o_orderstatus") == "P", "IN_PLAY") \
        .otherwise(F.lit(""))
    reqs = requests.request_table(
        o, "team_matches", F.col("o_orderkey"), team=F.col("o_custkey"),
        limit=F.lit(requests.DEFAULT_TEAM_LIMIT), season=season, status=status,
        dateFrom=F.when(ranged, F.date_format("o_orderdate", "yyyy-MM-dd")),
        dateTo=F.when(ranged, F.date_format(F.date_add("o_orderdate", 30), "yyyy-MM-dd")))
    return reqs.select("task_index", "path", requests.query_string(F.col("params")).alias("query"),
                       F.size("params").cast("bigint").alias("n_params"))


@register("page_plan", """
SELECT o_custkey, page,
       CASE WHEN page = 1 THEN base ELSE base || '?page=' || CAST(page AS VARCHAR) END AS url
FROM (
  SELECT o_custkey, 'https://api.invalid/customers/' || CAST(o_custkey AS VARCHAR) || '/orders' AS base,
         CAST(ceil(count(*) / 10.0) AS BIGINT) AS total_pages
  FROM orders GROUP BY o_custkey
) c, LATERAL (SELECT CAST(unnest(range(1, total_pages + 1)) AS BIGINT) AS page)
""")
def q_page_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of a per-customer order listing, 10 records a page, sequential URL scheme."""
    counts = read_table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.ceil(F.count("*") / 10).cast("bigint").alias("total_pages"))
    base = F.concat(F.lit("https://api.invalid/customers/"), F.col("o_custkey").cast("string"), F.lit("/orders"))
    return requests.page_plan(counts, base, F.col("total_pages"), "sequential", keep=("o_custkey",))


@register("optional_fields", f"""
SELECT {CODE.format(k='n.n_nationkey')} AS competition_code, f.field,
       CAST(sum(CASE WHEN f.state = 'missing' THEN 1 ELSE 0 END) AS BIGINT) AS n_missing,
       CAST(sum(CASE WHEN f.state = 'null' THEN 1 ELSE 0 END) AS BIGINT) AS n_null,
       CAST(sum(CASE WHEN f.state = 'value' THEN 1 ELSE 0 END) AS BIGINT) AS n_value
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey,
LATERAL (VALUES
  ('nationality', CASE WHEN c.c_mktsegment = 'AUTOMOBILE' THEN 'missing' ELSE 'value' END),
  ('assists', CASE WHEN c.c_mktsegment = 'BUILDING' THEN 'missing' ELSE 'value' END),
  ('penalties', CASE WHEN c.c_mktsegment = 'MACHINERY' THEN 'null' ELSE 'value' END)
) f(field, state)
GROUP BY ALL
""")
def q_optional_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = explode_records(feeds.scorers_landing(spark, sf_dir), "scorers")
    return field_presence(recs, {"nationality": "player.nationality", "assists": "assists",
                                 "penalties": "penalties"}, by=("competition_code",))


@register("scan_competitions", f"""
SELECT CAST(n_nationkey AS BIGINT) AS competition_id, {CODE.format(k='n_nationkey')} AS competition_code,
       n_name AS competition_name, CAST(r_regionkey AS BIGINT) AS area_id, r_name AS area_name,
       {CODE.format(k='n_nationkey')} || ' — ' || n_name AS label
FROM nation JOIN region ON n_regionkey = r_regionkey
WHERE r_regionkey IN (1, 3)
""")
def q_scan_competitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + F4 + P8: competitions of areas 1 and 3 with their picker labels."""
    comps = flatten_entity(feeds.competitions_landing(spark, sf_dir, areas="1,3"), "competitions").valid
    comps = filters.filter_areas(comps, "1,3")
    return comps.withColumn("label", text.label(F.col("competition_code"), F.col("competition_name")))


@register("scan_teams", f"""
SELECT {CODE.format(k='s_nationkey')} AS competition_code, s_suppkey AS team_id, s_name AS team_name
FROM supplier
""")
def q_scan_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Competition teams, paged by supplier-key range."""
    return flatten_entity(feeds.teams_landing(spark, sf_dir), "teams").valid
