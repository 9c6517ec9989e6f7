"""Leaf paths and drift against plain Python walks: deep and odd records, null groups, empty tables."""

import json
from collections import Counter

from pyspark.sql import functions as F

from feedlake.operators import drift
from feedlake.operators.drift import LEVELS, drift_report, expected_paths, leaf_types, plain_shape
from feedlake.schemas import MATCH_FIELDS, FieldSpec

FIELDS = (FieldSpec("a", "id"), FieldSpec("b", "x.name", "string"), FieldSpec("c", "x.rank", "long", "nullable"),
          FieldSpec("d", "note", "string", "optional"))


def _deep(n):
    return {"d": _deep(n - 1)} if n else [1, {"e": "x"}, []]


RECORDS = [
    ("g", {"id": 1, "x": {"name": "n", "rank": None}}),
    ("g", {"id": "1", "x": {"name": 5, "rank": 2}, "note": None}),
    ("g", {"id": 1.5, "x": None, "more": {"a b": [True, None], 'q"': {}}}),
    (None, {"x": {"name": "n"}, "id": {"v": 1}}),
    (None, {"id": 3, "x": {"name": "n", "rank": 1}, "note": "ok"}),
    ("deep", _deep(2 * LEVELS + 3)), ("deep", _deep(LEVELS)), ("deep", _deep(LEVELS - 1)),
    ("odd", 5), ("odd", []), ("odd", {}), ("odd", None), ("odd", [[], [1]]),
]


def _frame(spark, records=RECORDS):
    rows = spark.createDataFrame([(g, json.dumps(r)) for g, r in records], "g string, j string")
    return rows.select("g", F.parse_json("j").alias("_rec"))


def _type(v):
    return {str: "STRING", bool: "BOOLEAN", int: "BIGINT", float: "DECIMAL", dict: "OBJECT", list: "ARRAY"}.get(type(v), "VOID")


def _leaves(v, path=""):
    if isinstance(v, dict) and v:
        for k, x in v.items():
            plain = k.isidentifier()
            step = (f"{path}.{k}" if path else k) if plain else path + '["' + k.replace('"', '\\"') + '"]'
            yield from _leaves(x, step)
    elif isinstance(v, list) and v:
        for x in v:
            yield from _leaves(x, path + "[]")
    else:
        yield path, _type(v)


def test_leaf_types_equal_a_plain_walk(spark):
    got = {(r.g, r.path, r.type): r.n for r in leaf_types(_frame(spark), ("g",)).collect()}
    assert got == Counter((g, p, t) for g, v in RECORDS for p, t in _leaves(v))


def test_whole_table_and_empty_table(spark):
    got = {(r.path, r.type): r.n for r in leaf_types(_frame(spark)).collect()}
    assert got == Counter(x for _, v in RECORDS for x in _leaves(v))
    assert leaf_types(_frame(spark).filter("false"), ("g",)).count() == 0
    assert drift_report(_frame(spark).filter("false"), FIELDS, ("g",)).count() == 0
    nothing = _frame(spark).select("g", F.lit(None).cast("variant").alias("_rec"))
    assert drift_report(nothing, FIELDS, ("g",)).count() == 0


def test_drift_of_each_group(spark):
    got = {(r.g, r.path, r.type): (r.n, r.drift) for r in drift_report(_frame(spark, RECORDS[:5]), FIELDS, ("g",)).collect()}
    assert got == {
        ("g", "id", "STRING"): (1, "changed"), ("g", "id", "DECIMAL"): (1, "changed"), ("g", "x.name", "BIGINT"): (1, "changed"),
        ("g", "x", "VOID"): (1, "changed"), ("g", "x.name", None): (1, "lost"), ("g", "x.rank", None): (1, "lost"),
        ("g", 'more["a b"][]', "BOOLEAN"): (1, "unknown"), ("g", 'more["a b"][]', "VOID"): (1, "unknown"),
        ("g", 'more["q\\""]', "OBJECT"): (1, "unknown"),
        (None, "id.v", "BIGINT"): (1, "unknown"), (None, "id", None): (1, "lost"), (None, "x.rank", None): (1, "lost"),
    }


def test_records_as_specified_have_no_drift(spark):
    fine = [("g", {"id": 1, "x": {"name": "n", "rank": None}}), ("g", {"id": 2, "x": {"name": "", "rank": 7}, "note": None})]
    assert drift_report(_frame(spark, fine), FIELDS, ("g",)).count() == 0


def test_expected_paths_of_the_match_record():
    allowed, needed, parents = expected_paths(MATCH_FIELDS)
    assert allowed["utcDate"] == {"STRING"} and allowed["season.startDate"] == {"STRING"}
    assert allowed["score.winner"] == {"STRING", "VOID"} and "matchday" not in needed and "score.fullTime" in parents


def test_only_departing_records_are_walked(spark, monkeypatch):
    plain = [(g, r) for g, r in RECORDS if g in ("g", None)][:1] * 20 + [RECORDS[4]] * 20
    walked = []

    def counted(records, by=(), column="_rec"):
        walked.append(records.count())
        return leaf_types(records, by, column)

    monkeypatch.setattr(drift, "leaf_types", counted)
    out = {(r.g, r.path, r.type, r.n, r.drift) for r in drift_report(_frame(spark, plain + RECORDS[1:2]), FIELDS, ("g",)).collect()}
    assert walked == [1]
    assert out == {("g", "id", "STRING", 1, "changed"), ("g", "x.name", "BIGINT", 1, "changed")}


def test_plain_shape(spark):
    texts = {'{"id":1,"x":{"name":"n","rank":null}}': True, '{"note":null,"x":{"rank":2,"name":"n"},"id":1}': True,
             '{"id":1,"x":{"name":"n"}}': False, '{"id":1,"x":{"name":"n","rank":1},"more":[]}': False,
             '{"id":1,"x":{"name":"n","rank":1},"note":"","id2: BIGINT":1}': False, '{"id":1.0,"x":{"name":"n","rank":1}}': False,
             '{"id":null,"x":{"name":"n","rank":1}}': False, '{"id":1,"x":[{"name":"n","rank":1}]}': False, '[]': False}
    rows = spark.createDataFrame([(t,) for t in texts], "j string")
    got = rows.select("j", F.schema_of_variant(F.parse_json("j")).rlike(plain_shape(FIELDS)).alias("ok")).collect()
    assert {r.j: r.ok for r in got} == texts
    assert plain_shape((FieldSpec("a", "a"), FieldSpec("b", "a.b"))) is None
    assert plain_shape((FieldSpec("a", "x"), FieldSpec("b", "x", "string"))) is None
    assert plain_shape((FieldSpec("a", "odd key"),)) is None
