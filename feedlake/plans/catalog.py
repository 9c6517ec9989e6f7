"""Registered queries (``queries()``) and their DuckDB oracles (``oracle_sql()``).

Every query reads the driver's tables (or data Spark derives from them) and
runs over whole tables. The oracle SQL recomputes the same result straight
from the tables, so it also pins down the feed mapping in ``sources.feeds``.
Column names and types (BIGINT / VARCHAR / BOOLEAN) are the same on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return wrap


# ---------------------------------------------------------------------------
# Shared SQL fragments mirroring ``sources.feeds`` (fixed mapping).
# ---------------------------------------------------------------------------

CODE = "'N' || lpad(CAST({k} AS VARCHAR), 2, '0')"

MATCH_ROWS_SQL = f"""
SELECT
  CAST(n.n_nationkey AS BIGINT) AS competition_id,
  n.n_name AS competition_name,
  {CODE.format(k='n.n_nationkey')} AS competition_code,
  CAST(year(o.o_orderdate) * 100 + n.n_nationkey AS BIGINT) AS season_id,
  CAST(year(o.o_orderdate) AS BIGINT) AS season_start_year,
  o.o_orderkey AS match_id,
  strftime(o.o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS utc_date,
  strftime(o.o_orderdate, '%Y-%m-%d') AS match_date,
  CASE o.o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'SCHEDULED' ELSE 'IN_PLAY' END AS status,
  CASE WHEN o.o_orderstatus <> 'O' THEN CAST(month(o.o_orderdate) AS BIGINT) END AS matchday,
  upper(replace(substr(o.o_orderpriority, 3), ' ', '_')) AS stage,
  c.c_custkey AS home_team_id,
  c.c_name AS home_team_name,
  CAST(n.n_nationkey + 1000 AS BIGINT) AS away_team_id,
  n.n_name || ' XI' AS away_team_name,
  CASE WHEN o.o_orderstatus = 'F' THEN o.o_orderkey % 5 END AS home_score_ft,
  CASE WHEN o.o_orderstatus = 'F' THEN o.o_custkey % 4 END AS away_score_ft,
  CASE WHEN o.o_orderstatus <> 'O' THEN (o.o_orderkey % 5) // 2 END AS home_score_ht,
  CASE WHEN o.o_orderstatus <> 'O' THEN (o.o_custkey % 4) // 2 END AS away_score_ht,
  CASE WHEN o.o_orderstatus = 'F' THEN
    CASE WHEN o.o_orderkey % 5 > o.o_custkey % 4 THEN 'HOME_TEAM'
         WHEN o.o_orderkey % 5 < o.o_custkey % 4 THEN 'AWAY_TEAM' ELSE 'DRAW' END END AS winner
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
"""

STANDING_ROWS_SQL = f"""
SELECT
  {CODE.format(k='s.s_nationkey')} AS competition_code,
  CAST(year(l.l_shipdate) AS BIGINT) AS season_start_year,
  'ORDER_' || CAST(l.l_orderkey AS VARCHAR) AS stage,
  CASE l.l_orderkey % 3 WHEN 0 THEN 'TOTAL' WHEN 1 THEN 'HOME' ELSE 'AWAY' END AS type,
  CAST(l.l_linenumber AS BIGINT) AS position,
  l.l_partkey AS team_id,
  'Team ' || CAST(l.l_partkey AS VARCHAR) AS team_name,
  CAST(floor(l.l_quantity) AS BIGINT) AS played,
  CAST(floor(l.l_quantity) AS BIGINT) // 3 AS won,
  CAST(floor(l.l_quantity) AS BIGINT) % 3 AS drawn,
  CAST(floor(l.l_quantity) AS BIGINT) - CAST(floor(l.l_quantity) AS BIGINT) // 3
    - CAST(floor(l.l_quantity) AS BIGINT) % 3 AS lost,
  3 * (CAST(floor(l.l_quantity) AS BIGINT) // 3) + CAST(floor(l.l_quantity) AS BIGINT) % 3 AS points,
  CAST(floor(l.l_extendedprice) AS BIGINT) % 100 AS goals_for,
  CAST(round(l.l_discount * 100) AS BIGINT) AS goals_against,
  CAST(floor(l.l_extendedprice) AS BIGINT) % 100 - CAST(round(l.l_discount * 100) AS BIGINT) AS goal_difference,
  CASE WHEN l.l_returnflag = 'R' THEN l.l_returnflag || l.l_linestatus END AS form
FROM lineitem l
JOIN supplier s ON l.l_suppkey = s.s_suppkey
"""

SCORER_ROWS_SQL = f"""
SELECT
  {CODE.format(k='n.n_nationkey')} AS competition_code,
  CAST(2024 AS BIGINT) AS season_start_year,
  c.c_custkey AS player_id,
  c.c_name AS player_name,
  CASE WHEN c.c_mktsegment <> 'AUTOMOBILE' THEN n.n_name END AS nationality,
  CAST(n.n_nationkey + 1000 AS BIGINT) AS team_id,
  n.n_name || ' XI' AS team_name,
  CAST(floor(abs(c.c_acctbal)) AS BIGINT) % 40 AS goals,
  CASE WHEN c.c_mktsegment <> 'BUILDING' THEN c.c_custkey % 7 END AS assists,
  CASE WHEN c.c_mktsegment <> 'MACHINERY' THEN (CAST(floor(abs(c.c_acctbal)) AS BIGINT) % 40) % 5 END AS penalties
FROM customer c
JOIN nation n ON c.c_nationkey = n.n_nationkey
"""


def _import_all() -> None:
    """Query modules register themselves on import."""
    from feedlake.plans import (  # noqa: F401
        queries_changes, queries_core, queries_fetch, queries_ingest, queries_ops, queries_shape, queries_sinks, queries_time,
        queries_validate)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _import_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _import_all()
    return dict(ORACLE)
