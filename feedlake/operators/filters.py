"""Filters and limits on landed / flat data.

In the client these are request parameters the server evaluates; here the
same predicates are also applied to landed rows, so a result is right even
when a server (or a canned file) ignores a parameter. On Parquet inputs they
are plain column predicates, so Catalyst pushes them into the scan and prunes
partitions (``match_date`` / ``competition_code`` layouts).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the pickers' "no filter" choice.
ALL = "All"


def _falsy(v) -> bool:
    return v is None or v == "" or v == 0 or v == ALL


def match_predicate(season: int | None = None, status: str | None = None, date_from: str | None = None,
                    date_to: str | None = None, season_col: str = "season_start_year",
                    date_col: str = "match_date") -> Column:
    """F1 season, F2 status, F3 inclusive date range; falsy arguments add nothing."""
    cond = F.lit(True)
    if not _falsy(season):
        cond = cond & (F.col(season_col) == F.lit(int(season)))
    if not _falsy(status):
        cond = cond & (F.col("status") == F.lit(status))
    if not _falsy(date_from):
        cond = cond & (F.col(date_col) >= F.lit(date_from))
    if not _falsy(date_to):
        cond = cond & (F.col(date_col) <= F.lit(date_to))
    return cond


def filter_matches(flat: DataFrame, **kw) -> DataFrame:
    return flat.where(match_predicate(**kw))


def filter_areas(competitions: DataFrame, areas: str | None) -> DataFrame:
    """``areas`` is a comma list of area ids (an assumption on the list format)."""
    if _falsy(areas):
        return competitions
    ids = [int(a) for a in str(areas).split(",") if a.strip()]
    return competitions.where(F.col("area_id").isin(ids))


def team_matches(flat: DataFrame, team_id: int, limit: int = 100, **kw) -> DataFrame:
    """a team's matches, home or away, earliest ``limit`` by (utc_date, match_id).

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps its own
    top ``limit`` and only those reach the final merge, so no task holds more
    than ``limit`` rows per partition regardless of input size.
    """
    if limit < 0:
        raise ValueError("limit must be >= 0")
    side = (F.col("home_team_id") == F.lit(team_id)) | (F.col("away_team_id") == F.lit(team_id))
    return flat.where(side & match_predicate(**kw)).orderBy("utc_date", "match_id").limit(limit)


def skip_empty(landing: DataFrame) -> DataFrame:
    """drop requests that returned nothing usable (failed or empty array)."""
    return landing.where((F.col("status") == "ok") & F.col("payload").isNotNull())
