"""Hand-written payloads covering the edge rows of FIXTURES.md."""

import json
import re

import pytest
from pyspark.sql import functions as F

from feedlake.operators.entity import flatten_entity
from feedlake.operators.flatten import ERRORS, REC, flatten_records
from feedlake.schemas import LANDING, FieldSpec


def _match(**over):
    m = {"id": 1, "utcDate": "2024-08-17T14:00:00Z", "status": "FINISHED", "matchday": 1, "stage": "REGULAR",
         "competition": {"id": 2021, "name": "League", "code": "PL"},
         "season": {"id": 9, "startDate": "2024-08-16"},
         "homeTeam": {"id": 10, "name": "Home"}, "awayTeam": {"id": 11, "name": "Away"},
         "score": {"winner": "HOME_TEAM", "fullTime": {"home": 2, "away": 1}, "halfTime": {"home": 1, "away": 0}}}
    for k, v in over.items():
        m[k] = v
    return m


def _landing(spark, endpoint, payloads, params=None):
    rows = [(i, endpoint, params or {}, 1, 200, "ok", 1, None, json.dumps(p)) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, LANDING)


def test_unplayed_match_nulls_keep_types(spark):
    m = _match(status="SCHEDULED", score={"winner": None, "fullTime": {"home": None, "away": None},
                                          "halfTime": {"home": None, "away": None}})
    del m["matchday"]
    out = flatten_entity(_landing(spark, "competition_matches", [{"matches": [m]}]), "matches").valid
    r = out.collect()[0]
    assert r.matchday is None and r.winner is None and r.home_score_ft is None
    assert dict(out.dtypes)["home_score_ft"] == "bigint"
    assert r.season_start_year == 2024 and r.match_date == "2024-08-17"


def _reasons(spark, m):
    v = flatten_entity(_landing(spark, "competition_matches", [{"matches": [m]}]), "matches", "quarantine")
    return sorted((r.field, r.reason) for r in v.rejects.collect())


def test_rejects(spark):
    m = _match()
    del m["score"]["winner"]
    assert _reasons(spark, m) == [("winner", "missing")]
    assert _reasons(spark, _match(score={"winner": None, "fullTime": None, "halfTime": {"home": 0, "away": 0}})) == [
        ("away_score_ft", "null_parent"), ("home_score_ft", "null_parent")]
    assert _reasons(spark, _match(homeTeam={"id": None, "name": "x"})) == [("home_team_id", "null")]
    assert _reasons(spark, _match(season={"id": 1, "startDate": "20x4-08-01"})) == [("season_start_year", "bad_year")]
    assert _reasons(spark, _match(homeTeam={"id": 5, "name": 5})) == [("home_team_name", "type")]
    assert _reasons(spark, _match(matchday=None)) == []


def test_short_utc_date_kept_whole(spark):
    out = flatten_entity(_landing(spark, "competition_matches", [{"matches": [_match(utcDate="2024-08")]}]),
                         "matches").valid.collect()[0]
    assert out.match_date == "2024-08"


def test_failfast_raises(spark):
    m = _match(homeTeam={"id": None, "name": "x"})
    with pytest.raises(Exception, match="home_team_id"):
        flatten_entity(_landing(spark, "competition_matches", [{"matches": [m]}]), "matches").valid.collect()


ACCEPT = [("5", 5), ('"5"', 5), ('" 5 "', 5), ('"5.0"', 5), ("5.0", 5), ("true", 1), ('"1_000"', 1000),
          ('"+5"', 5), ("5e0", 5), ("false", 0)]
REJECT = ["5.5", '"5."', '"5e0"', '"x"', '""', "[1]", "{}", "99999999999999999999"]


@pytest.mark.parametrize("text,want", ACCEPT)
def test_lax_long_accepts(spark, text, want):
    df = spark.createDataFrame([(f'{{"n": {text}}}',)], "j string").select(F.parse_json("j").alias(REC))
    r = flatten_records(df, None, fields=(FieldSpec("n", "n"),)).collect()[0]
    assert r.n == want and r[ERRORS] == []


@pytest.mark.parametrize("text", REJECT)
def test_lax_long_rejects(spark, text):
    df = spark.createDataFrame([(f'{{"n": {text}}}',)], "j string").select(F.parse_json("j").alias(REC))
    r = flatten_records(df, None, fields=(FieldSpec("n", "n"),)).collect()[0]
    assert r.n is None and r[ERRORS][0]["reason"] == "type"


@pytest.mark.parametrize("text", ["5", "true"])
def test_string_field_rejects_non_strings(spark, text):
    df = spark.createDataFrame([(f'{{"s": {text}}}',)], "j string").select(F.parse_json("j").alias(REC))
    r = flatten_records(df, None, fields=(FieldSpec("s", "s", "string"),)).collect()[0]
    assert r.s is None and r[ERRORS][0]["reason"] == "type"


def test_standings_empty_table_gives_no_rows(spark):
    payload = {"standings": [{"stage": "REGULAR", "type": "TOTAL", "table": []}]}
    land = _landing(spark, "standings", [payload], {"competition": "PL", "season": "2024"})
    assert flatten_entity(land, "standings").valid.count() == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_on_errors_stays_above_the_checks(spark):
    v = flatten_entity(_landing(spark, "competition_matches", [{"matches": [_match()]}]), "matches", "quarantine")
    for df in (v.valid, v.rejects):
        filters = [line for line in _plan(df).splitlines() if line.lstrip(" :+-*()0123456789").startswith("Filter")]
        assert any("_errors" in line for line in filters)
        assert not any("schemaOfVariant" in line or "variant_get" in line for line in filters)


def test_leaves_of_a_record_come_from_one_pass(spark):
    out = flatten_entity(_landing(spark, "competition_matches", [{"matches": [_match()]}]), "matches").valid
    assert "variant_get(_rec" in _plan(out)
    # the parents, read where no leaf below is there; never a leaf of its own
    assert not re.search(r"variant_get\(_rec#\d+, \$\.(competition\.id|utcDate|score\.fullTime\.home)\b", _plan(out))


def test_specs_without_one_tree(spark):
    """A path that is a leaf and a parent, names that differ in case, two kinds of one path, quoted names: leaf by leaf."""
    rec = {"a": {"b": 1}, "A": {"c": "x"}, "id": 7, "n": "5", "odd": {"x y": 2}}
    fields = (FieldSpec("a", "a", "string", "optional"), FieldSpec("b", "a.b"), FieldSpec("c", "A.c", "string"),
              FieldSpec("n", "n"), FieldSpec("n_text", "n", "string"), FieldSpec("gone", "odd.gone", "long", "optional"))
    rows = spark.createDataFrame([(json.dumps(rec),), (json.dumps({**rec, "n": 5, "odd": None}),)], "j string")
    out = flatten_records(rows.select(F.parse_json("j").alias(REC)), None, fields=fields).collect()
    assert [(r.b, r.c, r.n, r.n_text) for r in out] == [(1, "x", 5, "5"), (1, "x", 5, None)]
    assert [[(e.field, e.reason) for e in r[ERRORS]] for r in out] == [
        [("a", "type")], [("a", "type"), ("n_text", "type"), ("gone", "null_parent")]]


def test_two_kinds_of_one_path_share_a_leaf(spark):
    fields = (FieldSpec("n", "x.n"), FieldSpec("n_text", "x.n", "string"), FieldSpec("year", "x.n", "long", "nullable", derive="year4"))
    texts = ['{"x": {"n": 2024}}', '{"x": {"n": "2024"}}', '{"x": {"n": null}}', '{"x": {}}', '{"x": [1]}', '{}', '[]', 'null', '{"x": {"n": 1.5, "m": 3}}']
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, j string")
    out = flatten_records(rows.select("i", F.parse_json("j").alias(REC)), None, keep=("i",), fields=fields)
    got = {r.i: (r.n, r.n_text, r.year, [(e.field, e.reason) for e in r[ERRORS]]) for r in out.collect()}
    three = lambda *reasons: [(f, x) for f, x in zip(("n", "n_text", "year"), reasons) if x]
    assert got == {
        0: (2024, None, None, three(None, "type", "type")), 1: (2024, "2024", 2024, []),
        2: (None, None, None, three("null", "null", None)), 3: (None, None, None, three("missing", "missing", "missing")),
        4: (None, None, None, three("type", "type", "type")), 5: (None, None, None, three("missing", "missing", "missing")),
        6: (None, None, None, [("_record", "type")]), 7: (None, None, None, [("_record", "type")]),
        8: (None, None, None, three("type", "type", "type"))}
