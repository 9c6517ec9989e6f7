"""As-of and interval joins against plain loops, with hot keys, ties, nulls, clashing names and empty tables."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from feedlake.plans import queries_time
from feedlake.operators.time_joins import asof_join, interval_join

L = "k string, at bigint, id bigint"
R = "k string, at bigint, id bigint, v string"


def _plain(lefts, rights, strict=False, within=None):
    out = []
    for k, at, i in lefts:
        hits = [r for r in rights if k is not None and at is not None and r[0] == k and r[1] is not None
                and (r[1] < at if strict else r[1] <= at)]
        best = max(hits, key=lambda r: (r[1], r[2], r[3])) if hits else None
        if best and within is not None and at - best[1] > within:
            best = None
        out.append((i, best[2] if best else None))
    return sorted(out, key=str)


def _sides(n=600):
    rng = random.Random(3)
    pick = lambda: rng.choice(["hot"] * 5 + ["a", "b", "c", None])
    at = lambda: rng.choice([None] + [rng.randrange(-50, 200)] * 20)
    lefts = [(pick(), at(), i) for i in range(n)] + [("hot", 100, 7)] * 200
    rights = [(pick(), at(), i, rng.choice("xyz")) for i in range(n // 3)]
    return lefts, rights + rights[:20]


@pytest.mark.parametrize("strict,within,buckets", [(False, None, None), (True, None, 40), (False, 5, 16), (True, 0, 4), (False, None, 1)])
def test_asof_equals_loop(spark, strict, within, buckets):
    lefts, rights = _sides()
    got = asof_join(spark.createDataFrame(lefts, L), spark.createDataFrame(rights, R), ["k"], "at", "at", strict=strict,
                    within=within, buckets=buckets).select("id", F.col("right.id").alias("r"))
    assert sorted(((r.id, r.r) for r in got.collect()), key=str) == _plain(lefts, rights, strict, within)


def test_asof_hot_key_spans_buckets(spark):
    lefts = [("hot", i, i) for i in range(2000)]
    rights = [("hot", 0, 1, "x")]  # one row in the first bucket has to reach all later ones
    got = asof_join(spark.createDataFrame(lefts, L), spark.createDataFrame(rights, R), ["k"], "at", "at", buckets=32)
    assert got.filter("right.id = 1").count() == 2000


def test_asof_empty_sides_and_refusals(spark):
    left, right = spark.createDataFrame([("a", 1, 1)], L), spark.createDataFrame([("a", 1, 1, "x")], R)
    no_l, no_r = left.filter("false"), right.filter("false")
    assert asof_join(no_l, right, ["k"], "at", "at").count() == 0
    assert asof_join(left, no_r, ["k"], "at", "at").first()["right"] is None
    assert asof_join(left, right, [], "at", "at").first()["right"]["v"] == "x"
    with pytest.raises(ValueError):
        asof_join(left, right, ["k"], "at", "at", keep="id")
    with pytest.raises(TypeError):
        asof_join(left.withColumn("at", F.current_timestamp()), right, ["k"], "at", "at")


def test_asof_timestamps_of_both_kinds(spark):
    times = [dt.datetime(1969, 12, 31, 23, 59, 59, 999999), dt.datetime(2024, 2, 29, 1, 2, 3, 4)]
    for kind in ("timestamp", "timestamp_ntz"):
        left = spark.createDataFrame([(t,) for t in times], f"t {kind}")
        right = spark.createDataFrame([(t - dt.timedelta(microseconds=1), i) for i, t in enumerate(times)], f"t {kind}, n int")
        got = asof_join(left, right, [], "t", "t", within=1)
        assert [r["right"].n for r in got.orderBy("t").collect()] == [0, 1]


def _spans(n=250):
    rng = random.Random(5)
    out = []
    for i in range(n):
        s = rng.randrange(-300, 300)
        length = rng.choice([-3, 0, 1, 2, 3, 7, 8, 9, 64, 65, 500])
        out.append((rng.choice(["a", "hot", "hot", None]), s, s + length, i))
    return out + [("hot", None, 4, 900), ("hot", 4, None, 901), ("hot", -5, 5, 1), ("hot", -5, 5, 1)]


@pytest.mark.parametrize("unit", [1, 7, 1000])
@pytest.mark.parametrize("keyed", [True, False])
def test_interval_join_equals_loop(spark, unit, keyed):
    spans = _spans()
    dots = [(k, at, i) for i, (k, at, _) in enumerate(_sides(200)[0][:300])]
    pairs = interval_join(spark.createDataFrame(dots, L), spark.createDataFrame(spans, "k string, s bigint, e bigint, id bigint"),
                          "at", "s", "e", ["k"] if keyed else None, unit=unit)
    got = sorted((r.point.id, r.interval.id, r.interval.s) for r in pairs.collect())
    want = sorted((i, j, s) for k, at, i in dots for kk, s, e, j in spans
                  if at is not None and s is not None and e is not None and s <= at < e
                  and (not keyed or (k is not None and k == kk)))
    assert got == want


def test_interval_join_empty_sides(spark):
    dots, spans = spark.createDataFrame([("a", 1, 1)], L), spark.createDataFrame([("a", 0, 9, 1)], "k string, s bigint, e bigint, id bigint")
    assert interval_join(dots, spans, "at", "s", "e").count() == 1
    assert interval_join(dots.filter("false"), spans, "at", "s", "e").count() == 0
    assert interval_join(dots, spans.filter("false"), "at", "s", "e").count() == 0
    assert interval_join(dots, spans.filter("id > 5"), "at", "s", "e", ["k"]).count() == 0


def test_lines_of_customers_without_events_do_not_reach_the_interval_join(spark, sf, monkeypatch):
    seen, join = [], queries_time.interval_join

    def watched(points, intervals, *args, **kwargs):
        seen.append((points, intervals))
        return join(points, intervals, *args, **kwargs)

    monkeypatch.setattr(queries_time, "interval_join", watched)
    assert queries_time.q_interval_open_orders(spark, sf).count() > 0
    points, spans = seen[0]
    assert spans.count() > 0
    assert spans.join(points.select("customer").distinct(), "customer", "left_anti").count() == 0
