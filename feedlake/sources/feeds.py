"""Render warehouse tables as API-shaped landing pages.

This is the stand-in for the remote API when no network is available: Spark
joins the given tables and writes the same nested JSON the API would return,
one landing row per (request, page). Every page is cut by a key range
(``PAGE_KEYS`` consecutive entity ids), so a page is bounded no matter how
skewed a competition or season is; there is no group whose size grows with
the data.

Mapping (fixed values; the oracle SQL in ``plans.catalog`` mirrors them):
  competitions  nation      id n_nationkey, name n_name, code 'N' + two-digit key
  teams         supplier    id s_suppkey, name s_name
  matches       orders x customer x nation
                  id o_orderkey; utcDate o_orderdate as yyyy-MM-ddTHH:mm:ssZ
                  season id year*100 + nation, startDate year-08-01
                  status F FINISHED, O SCHEDULED, P IN_PLAY
                  matchday month of the order date, key absent when SCHEDULED
                  stage order priority without its digit prefix, upper, '_' for ' '
                  homeTeam customer, awayTeam nation side (1000 + nation, name + ' XI')
                  full time o_orderkey % 5 : o_custkey % 4 (FINISHED only, else JSON null)
                  half time full-time values div 2 (FINISHED and IN_PLAY)
                  winner HOME_TEAM / AWAY_TEAM / DRAW when FINISHED, else JSON null
  standings     lineitem x supplier, one group per order
                  request competition from the supplier nation, season year of ship date
                  group stage 'ORDER_' + l_orderkey, type TOTAL/HOME/AWAY by l_orderkey % 3
                  row position l_linenumber, team l_partkey / 'Team ' + l_partkey,
                  played floor(quantity), won played div 3, draw played % 3,
                  lost the rest, points 3*won + draw, goalsFor floor(price) % 100,
                  goalsAgainst round(discount*100), form flag+status only when flag = 'R'
  scorers       customer x nation, season 2024, server order goals desc then id
                  player c_custkey / c_name, nationality n_name (absent for AUTOMOBILE)
                  team nation side; goals floor(|acctbal|) % 40
                  assists c_custkey % 7 (absent for BUILDING)
                  penalties goals % 5 (JSON null for MACHINERY)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.coerce import int_div
from feedlake.session import read_table, scratch_path

PAGE_KEYS = 1000
SCORER_SEASON = 2024


def competition_code(nationkey: Column) -> Column:
    return F.concat(F.lit("N"), F.lpad(nationkey.cast("string"), 2, "0"))


def _landing(keys: DataFrame, endpoint: str, task_index: Column, params: Column, page: Column,
             payload: Column) -> DataFrame:
    return keys.select(
        task_index.cast("bigint").alias("task_index"),
        F.lit(endpoint).alias("endpoint"),
        params.alias("params"),
        page.cast("bigint").alias("page"),
        F.lit(200).cast("bigint").alias("http_status"),
        F.lit("ok").alias("status"),
        F.lit(1).cast("bigint").alias("attempts"),
        F.lit(None).cast("string").alias("error"),
        payload.alias("payload"),
    )


STATUS_CODES = {"FINISHED": "F", "SCHEDULED": "O", "IN_PLAY": "P"}


def server_order_filter(season: int | None = None, status: str | None = None, date_from: str | None = None,
                        date_to: str | None = None) -> Column:
    """What the "server" evaluates for the request parameters, on the orders scan.

    Every term is a plain comparison on a stored column, so it reaches the
    Parquet reader as a pushed filter (row groups skipped by min/max).
    """
    cond = F.lit(True)
    d = F.col("o_orderdate")
    if season:
        cond &= (d >= F.lit(f"{int(season):04d}-01-01").cast("timestamp_ntz")) & (
            d < F.lit(f"{int(season) + 1:04d}-01-01").cast("timestamp_ntz"))
    if status:
        cond &= F.col("o_orderstatus") == F.lit(STATUS_CODES.get(status, "?"))
    if date_from:
        cond &= d >= F.lit(date_from).cast("timestamp_ntz")
    if date_to:
        cond &= d < F.date_add(F.lit(date_to).cast("date"), 1).cast("timestamp_ntz")
    return cond


def match_records(spark: SparkSession, sf_dir: str, **server_filter) -> DataFrame:
    """orders x customer x nation -> one nested match struct per order (plus routing keys)."""
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    if server_filter:
        o = o.where(server_order_filter(**server_filter))
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)

    year = F.year("o_orderdate")
    status = (F.when(F.col("o_orderstatus") == "F", "FINISHED")
              .when(F.col("o_orderstatus") == "O", "SCHEDULED").otherwise("IN_PLAY"))
    finished = F.col("o_orderstatus") == "F"
    started = F.col("o_orderstatus") != "O"
    ft_h, ft_a = F.col("o_orderkey") % 5, F.col("o_custkey") % 4
    winner = F.when(finished, F.when(ft_h > ft_a, "HOME_TEAM").when(ft_h < ft_a, "AWAY_TEAM").otherwise("DRAW"))
    score = F.to_variant_object(F.struct(
        winner.alias("winner"),
        F.struct(F.when(finished, ft_h).alias("home"), F.when(finished, ft_a).alias("away")).alias("fullTime"),
        F.struct(F.when(started, int_div(ft_h, 2)).alias("home"),
                 F.when(started, int_div(ft_a, 2)).alias("away")).alias("halfTime"),
    ))
    nation_key = F.col("n_nationkey").cast("bigint")
    rec = F.struct(
        F.struct(nation_key.alias("id"), F.col("n_name").alias("name"),
                 competition_code(F.col("n_nationkey")).alias("code")).alias("competition"),
        F.struct((year * 100 + nation_key).cast("bigint").alias("id"),
                 F.concat(year.cast("string"), F.lit("-08-01")).alias("startDate")).alias("season"),
        F.col("o_orderkey").alias("id"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("utcDate"),
        status.alias("status"),
        F.when(started, F.month("o_orderdate")).cast("bigint").alias("matchday"),
        F.upper(F.regexp_replace(F.expr("substring(o_orderpriority, 3)"), " ", "_")).alias("stage"),
        F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")).alias("homeTeam"),
        F.struct((nation_key + 1000).alias("id"), F.concat("n_name", F.lit(" XI")).alias("name")).alias("awayTeam"),
        score.alias("score"),
    )
    return j.select(
        competition_code(F.col("n_nationkey")).alias("competition"),
        year.alias("season"),
        nation_key.alias("nation"),
        int_div(F.col("o_orderkey"), PAGE_KEYS).alias("page"),
        rec.alias("rec"),
    )


def matches_landing(spark: SparkSession, sf_dir: str, **server_filter) -> DataFrame:
    """Competition-matches responses: ``{"matches": [...]}`` per (competition, season, page)."""
    recs = match_records(spark, sf_dir, **server_filter)
    pages = recs.groupBy("competition", "season", "nation", "page").agg(F.collect_list("rec").alias("recs"))
    params = F.create_map(F.lit("competition"), F.col("competition"),
                          F.lit("season"), F.col("season").cast("string"))
    return _landing(pages, "competition_matches", F.col("nation") * 10000 + F.col("season"), params,
                    F.col("page"), F.to_json(F.struct(F.col("recs").alias("matches"))))


def standings_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standings responses: ``{"standings": [{stage, type, table: [...]}, ...]}``.

    One group per (request, order); groups are paged by order-key range. The
    hash repartition on (competition, season, page) satisfies both the group
    and the page aggregation, so the two collects share one shuffle.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_returnflag", "l_linestatus", "l_shipdate")
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    j = li.join(s, li.l_suppkey == s.s_suppkey)
    played = F.floor("l_quantity").cast("bigint")
    won, draw = int_div(played, 3), played % 3
    gf = F.floor("l_extendedprice").cast("bigint") % 100
    ga = F.round(F.col("l_discount") * 100).cast("bigint")
    row = F.struct(
        F.col("l_linenumber").cast("bigint").alias("position"),
        F.struct(F.col("l_partkey").alias("id"),
                 F.concat(F.lit("Team "), F.col("l_partkey").cast("string")).alias("name")).alias("team"),
        played.alias("playedGames"), won.alias("won"), draw.alias("draw"),
        (played - won - draw).alias("lost"), (won * 3 + draw).alias("points"),
        gf.alias("goalsFor"), ga.alias("goalsAgainst"), (gf - ga).alias("goalDifference"),
        F.when(F.col("l_returnflag") == "R", F.concat("l_returnflag", "l_linestatus")).alias("form"),
    )
    keyed = j.select(
        competition_code(F.col("s_nationkey")).alias("competition"),
        F.col("s_nationkey").cast("bigint").alias("nation"),
        F.year("l_shipdate").alias("season"),
        int_div(F.col("l_orderkey"), PAGE_KEYS).alias("page"),
        "l_orderkey", row.alias("row"),
    ).repartition("competition", "season", "page")
    gtype = F.when(F.col("l_orderkey") % 3 == 0, "TOTAL").when(F.col("l_orderkey") % 3 == 1, "HOME").otherwise("AWAY")
    groups = keyed.groupBy("competition", "nation", "season", "page", "l_orderkey").agg(
        F.struct(F.concat(F.lit("ORDER_"), F.col("l_orderkey").cast("string")).alias("stage"),
                 gtype.alias("type"), F.collect_list("row").alias("table")).alias("grp"))
    pages = groups.groupBy("competition", "nation", "season", "page").agg(F.collect_list("grp").alias("grps"))
    params = F.create_map(F.lit("competition"), F.col("competition"),
                          F.lit("season"), F.col("season").cast("string"))
    return _landing(pages, "standings", F.col("nation") * 10000 + F.col("season"), params, F.col("page"),
                    F.to_json(F.struct(F.col("grps").alias("standings"))))


def scorer_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal",
                                                     "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    goals = F.floor(F.abs("c_acctbal")).cast("bigint") % 40
    seg = F.col("c_mktsegment")
    rec = F.struct(
        F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                 F.when(seg != "AUTOMOBILE", F.col("n_name")).alias("nationality")).alias("player"),
        F.struct((F.col("n_nationkey").cast("bigint") + 1000).alias("id"),
                 F.concat("n_name", F.lit(" XI")).alias("name")).alias("team"),
        goals.alias("goals"),
        F.when(seg != "BUILDING", F.col("c_custkey") % 7).alias("assists"),
        F.when(seg == "MACHINERY", F.parse_json(F.lit("null")))
        .otherwise(F.parse_json((goals % 5).cast("string"))).alias("penalties"),
    )
    return j.select(
        competition_code(F.col("n_nationkey")).alias("competition"),
        F.col("n_nationkey").cast("bigint").alias("nation"),
        int_div(F.col("c_custkey"), PAGE_KEYS).alias("page"),
        (-goals).alias("neg_goals"), F.col("c_custkey"), rec.alias("rec"),
    )


def scorers_landing(spark: SparkSession, sf_dir: str, season: int = SCORER_SEASON) -> DataFrame:
    """Scorer responses in server order (goals desc, then player id) within each page."""
    recs = scorer_records(spark, sf_dir)
    def server_order(a, b):
        ka, kb = F.struct(a["neg_goals"], a["c_custkey"]), F.struct(b["neg_goals"], b["c_custkey"])
        return F.when(ka < kb, -1).when(ka > kb, 1).otherwise(0)

    pages = recs.groupBy("competition", "nation", "page").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("neg_goals", "c_custkey", "rec")), server_order),
                    lambda x: x["rec"]).alias("recs"))
    params = F.create_map(F.lit("competition"), F.col("competition"), F.lit("season"), F.lit(str(season)))
    return _landing(pages, "scorers", F.col("nation") * 10000 + season, params, F.col("page"),
                    F.to_json(F.struct(F.col("recs").alias("scorers"))))


def competitions_landing(spark: SparkSession, sf_dir: str, areas: str | None = None) -> DataFrame:
    """``{"competitions": [...]}``, one page per region (areas), nations as competitions."""
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    if areas:
        r = r.where(F.col("r_regionkey").isin([int(a) for a in areas.split(",") if a.strip()]))
    j = n.join(r, n.n_regionkey == r.r_regionkey)
    rec = F.struct(
        F.col("n_nationkey").cast("bigint").alias("id"),
        competition_code(F.col("n_nationkey")).alias("code"),
        F.col("n_name").alias("name"),
        F.struct(F.col("r_regionkey").cast("bigint").alias("id"), F.col("r_name").alias("name")).alias("area"),
    )
    pages = j.groupBy("r_regionkey").agg(F.collect_list(rec).alias("recs"))
    params = F.create_map(F.lit("areas"), F.col("r_regionkey").cast("string"))
    return _landing(pages, "competitions", F.col("r_regionkey"), params, F.lit(1),
                    F.to_json(F.struct(F.col("recs").alias("competitions"))))


def teams_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``{"teams": [...]}`` per supplier nation, paged by supplier-key range."""
    s = read_table(spark, sf_dir, "supplier")
    rec = F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                   F.col("s_acctbal").alias("balance"))
    pages = s.groupBy(F.col("s_nationkey").cast("bigint").alias("nation"),
                      int_div(F.col("s_suppkey"), PAGE_KEYS).alias("page")).agg(F.collect_list(rec).alias("recs"))
    params = F.create_map(F.lit("competition"), competition_code(F.col("nation")))
    return _landing(pages, "competition_teams", F.col("nation"), params, F.col("page"),
                    F.to_json(F.struct(F.col("recs").alias("teams"))))


def number_pages(landing: DataFrame) -> DataFrame:
    """Renumber each request's pages 1..N and add ``total_pages``.

    ``landing`` is written once; numbering is a running count over its
    (task_index, page) keys only - the distributed prefix scan, so a request
    with very many pages is not walked by one task - then joined back on the
    unique (task_index, page).
    """
    from feedlake.operators.scan import prefix_scan

    spark = landing.sparkSession
    path = scratch_path(spark, "pages")
    landing.write.parquet(path)
    landing = spark.read.schema(landing.schema).parquet(path)
    keys = landing.select("task_index", "page", F.lit(1).cast("bigint").alias("_one"))
    numbered = prefix_scan(keys, ["task_index"], ["page"], "_one", "sum", "page_no")
    totals = keys.groupBy("task_index").agg(F.count("*").alias("total_pages"))
    return (landing.join(numbered.select("task_index", "page", "page_no"), ["task_index", "page"])
            .join(totals, "task_index"))


def store_rows(landing: DataFrame, endpoint: str) -> DataFrame:
    """Landing pages -> canned API responses keyed like the client's requests.

    Bodies gain ``total_pages``; page 1 is the bare URL, later pages ``page=i``.
    """
    from feedlake.sources.requests import ENDPOINTS, render_path

    ep = ENDPOINTS[endpoint]
    numbered = number_pages(landing)
    comp = F.col("params").getItem("competition")
    sent = F.map_filter(F.col("params"), lambda k, v: k.isin(list(ep.params)))
    body = F.concat(F.lit('{"total_pages":'), F.col("total_pages").cast("string"), F.lit(","),
                    F.expr("substring(payload, 2)"))
    return numbered.select(
        "task_index",
        render_path(endpoint, competition=comp if "{competition}" in ep.path else None).alias("path"),
        sent.alias("params"),
        F.create_map(F.lit("competition"), comp).alias("args"),
        F.col("page_no").alias("page"),
        body.alias("body"),
    )
