"""Flat output schemas and the field specs that derive them from nested records.

A spec lists, in output order, where each column comes from and how strict the
source is about it:

  required  key must exist and value must be non-null      (subscript access)
  nullable  key must exist, value may be JSON null          (subscript access)
  optional  key may be missing, value may be null           (``.get`` access)

Sources: ``record`` paths are read from the exploded record, ``group`` paths
from the enclosing group (standings), ``context`` columns come from the
request that fetched the payload.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class FieldSpec:
    name: str
    path: str
    kind: str = "long"  # long | string
    presence: str = "required"  # required | nullable | optional
    source: str = "record"  # record | group | context
    derive: str | None = None  # None | year4 | slice10


def _f(name, path, kind="long", presence="required", source="record", derive=None):
    return FieldSpec(name, path, kind, presence, source, derive)


MATCH_FIELDS: tuple[FieldSpec, ...] = (
    _f("competition_id", "competition.id"),
    _f("competition_name", "competition.name", "string"),
    _f("competition_code", "competition.code", "string"),
    _f("season_id", "season.id"),
    _f("season_start_year", "season.startDate", "long", derive="year4"),
    _f("match_id", "id"),
    _f("utc_date", "utcDate", "string"),
    _f("match_date", "utcDate", "string", derive="slice10"),
    _f("status", "status", "string"),
    _f("matchday", "matchday", "long", "optional"),
    _f("stage", "stage", "string"),
    _f("home_team_id", "homeTeam.id"),
    _f("home_team_name", "homeTeam.name", "string"),
    _f("away_team_id", "awayTeam.id"),
    _f("away_team_name", "awayTeam.name", "string"),
    _f("home_score_ft", "score.fullTime.home", "long", "nullable"),
    _f("away_score_ft", "score.fullTime.away", "long", "nullable"),
    _f("home_score_ht", "score.halfTime.home", "long", "nullable"),
    _f("away_score_ht", "score.halfTime.away", "long", "nullable"),
    _f("winner", "score.winner", "string", "nullable"),
)

STANDING_FIELDS: tuple[FieldSpec, ...] = (
    _f("competition_code", "competition_code", "string", source="context"),
    _f("season_start_year", "season_start_year", "long", source="context"),
    _f("stage", "stage", "string", source="group"),
    _f("type", "type", "string", source="group"),
    _f("position", "position"),
    _f("team_id", "team.id"),
    _f("team_name", "team.name", "string"),
    _f("played", "playedGames"),
    _f("won", "won"),
    _f("drawn", "draw"),
    _f("lost", "lost"),
    _f("points", "points"),
    _f("goals_for", "goalsFor"),
    _f("goals_against", "goalsAgainst"),
    _f("goal_difference", "goalDifference"),
    _f("form", "form", "string", "optional"),
)

SCORER_FIELDS: tuple[FieldSpec, ...] = (
    _f("competition_code", "competition_code", "string", source="context"),
    _f("season_start_year", "season_start_year", "long", source="context"),
    _f("player_id", "player.id"),
    _f("player_name", "player.name", "string"),
    _f("nationality", "player.nationality", "string", "optional"),
    _f("team_id", "team.id"),
    _f("team_name", "team.name", "string"),
    _f("goals", "goals"),
    _f("assists", "assists", "long", "optional"),
    _f("penalties", "penalties", "long", "optional"),
)

# Competitions: the pickers read code and name; area feeds the areas filter.
COMPETITION_FIELDS: tuple[FieldSpec, ...] = (
    _f("competition_id", "id"),
    _f("competition_code", "code", "string"),
    _f("competition_name", "name", "string"),
    _f("area_id", "area.id", "long", "optional"),
    _f("area_name", "area.name", "string", "optional"),
)

# Teams: the client never reads a team's fields; id and name are kept.
TEAM_FIELDS: tuple[FieldSpec, ...] = (
    _f("competition_code", "competition_code", "string", source="context"),
    _f("team_id", "id"),
    _f("team_name", "name", "string"),
)

# Entity -> (array key in the payload, field specs, partition column of its dataset)
ENTITIES = {
    "matches": ("matches", MATCH_FIELDS, "match_date"),
    "standings": ("standings", STANDING_FIELDS, "competition_code"),
    "scorers": ("scorers", SCORER_FIELDS, "competition_code"),
    "competitions": ("competitions", COMPETITION_FIELDS, None),
    "teams": ("teams", TEAM_FIELDS, "competition_code"),
}


def struct_of(fields: tuple[FieldSpec, ...]) -> T.StructType:
    """The fixed flat StructType; nullability follows the presence rule."""
    out = []
    for f in fields:
        dt = T.LongType() if f.kind == "long" else T.StringType()
        out.append(T.StructField(f.name, dt, f.presence != "required"))
    return T.StructType(out)


MATCH = struct_of(MATCH_FIELDS)
STANDING = struct_of(STANDING_FIELDS)
SCORER = struct_of(SCORER_FIELDS)

COMPETITION = struct_of(COMPETITION_FIELDS)
TEAM = struct_of(TEAM_FIELDS)

SCHEMAS = {"matches": MATCH, "standings": STANDING, "scorers": SCORER, "competitions": COMPETITION, "teams": TEAM}

# Landing table: one row per fetched response (or per failed request).
LANDING = T.StructType(
    [
        T.StructField("task_index", T.LongType(), False),
        T.StructField("endpoint", T.StringType(), False),
        T.StructField("params", T.MapType(T.StringType(), T.StringType()), True),
        T.StructField("page", T.LongType(), True),
        T.StructField("http_status", T.LongType(), True),
        T.StructField("status", T.StringType(), False),  # ok | failed
        T.StructField("attempts", T.LongType(), True),
        T.StructField("error", T.StringType(), True),
        T.StructField("payload", T.StringType(), True),
    ]
)

ERROR_STRUCT = T.StructType(
    [T.StructField("field", T.StringType(), False), T.StructField("reason", T.StringType(), False)]
)
ERRORS_TYPE = T.ArrayType(ERROR_STRUCT)
