"""Snapshot difference against a plain one; sketches within their bounds, merged runs equal one run."""

import math
import random

import pytest
from pyspark.sql import functions as F

from feedlake.operators import sketches
from feedlake.operators.snapshot_diff import snapshot_diff
from feedlake.session import scratch_path

S = "id bigint, kind string, x double, `a b` string"


def _diff(old, new, **args):
    rows = snapshot_diff(old, new, ["id"], **args).collect()
    return sorted((str(r[0]), r[1], r[2], r[3], tuple(r[4])) for r in rows)


def test_kinds_nulls_and_repeated_keys(spark):
    old = [(1, "a", 1.0, "x"), (2, None, None, "x"), (3, "c", 0.0, "x"), (4, "d", 1.0, "x"), (None, "n", 1.0, "x"),
           (6, "r", 1.0, "x"), (6, "s", 1.0, "x"), (7, "r", 1.0, "x"), (7, "r", 1.0, "x"), (8, None, None, "x"), (9, "q", None, "x")]
    new = [(1, "a", 1.0, "x"), (2, "x", None, "y"), (3, "c", -0.0, "x"), (5, "e", 1.0, "x"), (None, "n", 2.0, "x"),
           (6, "s", 1.0, "x"), (6, "r", 1.0, "x"), (7, "r", 1.0, "x"), (8, "x", None, None), (9, "q", None, "x")]
    a, b = spark.createDataFrame(old, S), spark.createDataFrame(new, S)
    assert _diff(a, b) == sorted([
        ("2", "changed", 1, 1, ("kind", "a b")), ("4", "deleted", 1, 0, ()), ("5", "inserted", 0, 1, ()),
        ("None", "changed", 1, 1, ("x",)), ("7", "repeated", 2, 1, ()), ("8", "changed", 1, 1, ("kind", "a b"))])
    assert _diff(a, a) == [] and _diff(a.filter("false"), b.filter("false")) == []
    assert _diff(a, b, compare=["x"]) == sorted([
        ("4", "deleted", 1, 0, ()), ("5", "inserted", 0, 1, ()), ("None", "changed", 1, 1, ("x",)), ("7", "repeated", 2, 1, ())])
    assert len(_diff(a.filter("false"), b)) == b.select("id").distinct().count()
    with pytest.raises(ValueError):
        snapshot_diff(a.drop("x"), b, ["id"])


def test_quantiles_within_accuracy_and_runs_merge(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["f", "g", None]), rng.choice([0, 1, 2, int(math.exp(rng.uniform(0, 20)))]), rng.randrange(300)) for _ in range(3000)]
    rows.append(("only null", None, 5))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, f string, v bigint, who int")
    one, many = scratch_path(spark, "t-one"), scratch_path(spark, "t-many")
    sketches.save_run(df, one, "all", ["f"], "v", "who")
    for _ in range(2):  # a repeated run replaces itself
        for run in range(3):
            sketches.save_run(df.filter(F.col("i") % 3 == run), many, f"r{run}", ["f"], "v", "who")
    q = {"q0": 0.0, "q50": 0.5, "q99": 0.99, "q100": 1.0}
    a = {(r["level"], r["f"]): r.asDict() for r in sketches.merged(spark, one, ["f"], q).collect()}
    b = {(r["level"], r["f"]): r.asDict() for r in sketches.merged(spark, many, ["f"], q).collect()}
    assert a.keys() == b.keys() == {(0, None), (1, None), (1, "f"), (1, "g"), (1, "only null")}
    for key, got in a.items():
        assert {k: v for k, v in got.items() if k != "n_distinct"} == {k: v for k, v in b[key].items() if k != "n_distinct"}
        mine = [r for r in rows if key[0] == 0 or r[0] == key[1]]
        values = sorted(r[1] for r in mine if r[1] is not None)
        assert got["n"] == len(values) and got["most"] == (values[-1] if values else None)
        for name, share in q.items():
            if not values:
                assert got[name] is None
                continue
            exact = values[max(math.ceil(share * len(values)), 1) - 1]
            assert abs(got[name] - exact) <= sketches.ACCURACY * exact + 1e-6
        assert abs(b[key]["n_distinct"] - len({r[2] for r in mine})) <= 0.08 * len({r[2] for r in mine})


def test_negative_values_are_refused(spark):
    df = spark.createDataFrame([("f", -1, 1)], "f string, v bigint, who int")
    with pytest.raises(Exception, match="negative value"):
        sketches.save_run(df, scratch_path(spark, "t-neg"), "r", ["f"], "v", "who")
