"""Request tables: one row per API call, built from any DataFrame.

A request row is ``task_index, endpoint, path, params MAP<STRING,STRING>``
(plus ``page`` once planned). Parameters follow the client's rule: a falsy
value is not sent (NULL, empty text, season 0); ``limit`` is always sent.
The map keeps the client's parameter order, so the rendered query string is
stable.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Endpoint:
    name: str
    path: str  # template with {competition} / {team}
    array_key: str
    params: tuple[str, ...]  # in the order the client adds them
    always: tuple[str, ...] = ()


# Endpoint paths, payload array keys and parameter order.
ENDPOINTS = {
    "competitions": Endpoint("competitions", "/competitions", "competitions", ("areas",)),
    "standings": Endpoint("standings", "/competitions/{competition}/standings", "standings", ("season",)),
    "scorers": Endpoint("scorers", "/competitions/{competition}/scorers", "scorers", ("season",)),
    "competition_matches": Endpoint("competition_matches", "/competitions/{competition}/matches", "matches",
                                    ("season", "status", "dateFrom", "dateTo")),
    "competition_teams": Endpoint("competition_teams", "/competitions/{competition}/teams", "teams", ("season",)),
    "team_matches": Endpoint("team_matches", "/teams/{team}/matches", "matches",
                             ("limit", "season", "status", "dateFrom", "dateTo"), always=("limit",)),
}

DEFAULT_TEAM_LIMIT = 100


def _text(c) -> Column:
    return (c if isinstance(c, Column) else F.lit(c)).cast("string")


def sent_params(endpoint: str, values: dict[str, Column]) -> Column:
    """MAP of the parameters the client would send, in its order."""
    ep = ENDPOINTS[endpoint]
    unknown = set(values) - set(ep.params)
    if unknown:
        raise ValueError(f"{endpoint} takes no parameters {sorted(unknown)}")
    pairs = [F.struct(F.lit(k).alias("k"), _text(values.get(k)).alias("v")) for k in ep.params if k in values]
    if not pairs:
        return F.create_map().cast("map<string,string>")
    always = F.array(*[F.lit(k) for k in ep.always]) if ep.always else F.array().cast("array<string>")
    kept = F.filter(
        F.array(*pairs),
        lambda p: F.array_contains(always, p["k"])
        | (p["v"].isNotNull() & (p["v"] != "") & ~((p["k"] == "season") & (p["v"] == "0"))),
    )
    return F.map_from_entries(kept)


def render_path(endpoint: str, competition: Column | None = None, team: Column | None = None) -> Column:
    """Path template -> text."""
    tpl = ENDPOINTS[endpoint].path
    parts: list[Column] = []
    rest = tpl
    for key, col in (("{competition}", competition), ("{team}", team)):
        if key in rest:
            if col is None:
                raise ValueError(f"{endpoint} needs {key}")
            head, rest = rest.split(key, 1)
            parts += [F.lit(head), col.cast("string")]
    parts.append(F.lit(rest))
    return F.concat(*parts)


def query_string(params: Column) -> Column:
    """``k=v&k=v`` in map order, values URL-encoded; empty map -> ''."""
    return F.array_join(
        F.transform(F.map_entries(params), lambda e: F.concat(e["key"], F.lit("="), F.url_encode(e["value"]))), "&")


def request_table(df: DataFrame, endpoint: str, task_index: Column, competition: Column | None = None,
                  team: Column | None = None, **params: Column) -> DataFrame:
    """Any DataFrame -> request rows; extra columns are dropped.

    ``args`` holds the path arguments (competition / team): standings and
    scorers take their competition from the request, not the payload.
    """
    args = [F.lit(k) for k in ()]
    for k, c in (("competition", competition), ("team", team)):
        if c is not None:
            args += [F.lit(k), c.cast("string")]
    return df.select(
        task_index.cast("bigint").alias("task_index"),
        F.lit(endpoint).alias("endpoint"),
        render_path(endpoint, competition, team).alias("path"),
        sent_params(endpoint, params).alias("params"),
        (F.create_map(*args) if args else F.create_map().cast("map<string,string>")).alias("args"),
    )


def page_url(base: Column, page: Column, bare_first: bool) -> Column:
    """``base?page=i``; with ``bare_first`` page 1 is the bare URL (sequential/async scans)."""
    paged = F.concat(base, F.lit("?page="), page.cast("string"))
    return F.when(page == 1, base).otherwise(paged) if bare_first else paged


def page_plan(df: DataFrame, base: Column, total_pages: Column, mode: str = "sequential",
              keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per page to fetch (S8 sequential, S9 threaded, S10 async).

    sequential / async: page 1 is the bare URL (it also reports total_pages),
    then ``?page=2..N``. threaded: caller supplies N, URLs ``?page=1..N``.
    ``total_pages`` < 1 still fetches the first page in sequential/async mode.
    """
    if mode not in ("sequential", "threaded", "async"):
        raise ValueError(f"unknown page mode {mode!r}")
    bare = mode != "threaded"
    first = F.lit(1)
    last = F.greatest(total_pages.cast("bigint"), F.lit(1)) if bare else total_pages.cast("bigint")
    pages = F.when(last >= first, F.sequence(first.cast("bigint"), last))
    planned = df.select(*keep, base.alias("_base"), F.explode(pages).alias("page"))
    return planned.select(*keep, "page", page_url(F.col("_base"), F.col("page"), bare).alias("url"))
