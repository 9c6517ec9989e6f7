"""Filters sent to the server, pages in flight, jitter, incremental ingest, event-time windows, keyed merge."""

import datetime as dt
import json
import re
import threading
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.plans import queries_ingest as qi
from feedlake.session import scratch_path
from feedlake.sinks import merge, versions
from feedlake.sources import rest_json, rest_records
from feedlake.sources import transport as tp
from feedlake.sources.fetch import write_store
from feedlake.streaming import ingest, windows

# --- rest_records


def put(root, url, records, total=1):
    doc = {"status": 200, "body": json.dumps({"total_pages": total, "items": records})}
    (root / f"{tp.request_key(url)}.json").write_text(json.dumps(doc))


def listing(spark, root, schema="id bigint, season bigint, status string, day string, team string", **options):
    rest_records.register(spark)
    params = {"season =": "season", "status =": "status", "day >=": "dateFrom", "day <=": "dateTo"}
    r = spark.read.format("rest_records").schema(schema).option("url", "/x").option("records", "items").option(
        "transport", json.dumps({"kind": "file", "root": str(root)})).option("params", json.dumps(params)).option(
        "paths", json.dumps({"team": "home.name"}))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load()


def test_filters_become_parameters(spark, tmp_path):
    """Only the filtered pages exist: asking for any other page would fail the read."""
    put(tmp_path, "/x?season=1996&status=F", [{"id": 1, "season": 1996, "status": "F"}, {"id": 2, "season": 1996, "status": "F"}], 2)
    put(tmp_path, "/x?season=1996&status=F&page=2", [{"id": 3, "season": 1996, "status": "F"}], 2)
    df = listing(spark, tmp_path).where("status = 'F' and season = 1996 and id <> 2")
    assert sorted(r.id for r in df.collect()) == [1, 3]
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = df._jdf.queryExecution().explainString(mode)
    assert re.search(r"PushedFilters: \[.*EqualTo\(status,F\)", plan)
    kept = plan.split("Filter\n")[-1]
    assert "= F)" not in kept and "= 2)" in kept  # the comparison that the server cannot answer stays


def test_a_server_that_ignores_parameters(spark, tmp_path):
    put(tmp_path, "/x?season=1996", [{"id": 1, "season": 1996}, {"id": 2, "season": 1997}, {"id": 3}, {"id": 4, "season": "1996"}])
    assert [r.id for r in listing(spark, tmp_path).where("season = 1996").collect()] == [1]


def test_strict_bounds_stay_with_spark(spark, tmp_path):
    days = [{"id": i, "day": f"1996-03-0{i}", "home": {"name": f"t{i}"}} for i in range(1, 8)]
    put(tmp_path, "/x?dateFrom=1996-03-02&dateTo=1996-03-05", days[1:5])
    df = listing(spark, tmp_path).where("day > '1996-03-02' and day <= '1996-03-05'")
    assert sorted((r.id, r.team) for r in df.collect()) == [(3, "t3"), (4, "t4"), (5, "t5")]


@pytest.mark.parametrize("where,want", [("season = 0", [2]), ("status = ''", [3]), ("season is null", [3]), ("season in (1996, 0)", [1, 2]),
                                        ("season = 1996 or status = 'F'", [1])])
def test_values_that_are_never_sent(spark, tmp_path, where, want):
    put(tmp_path, "/x", [{"id": 1, "season": 1996, "status": "F"}, {"id": 2, "season": 0, "status": "G"}, {"id": 3, "status": ""}])
    assert sorted(r.id for r in listing(spark, tmp_path).where(where).collect()) == want


def test_a_parameter_takes_one_value(spark, tmp_path):
    put(tmp_path, "/x?season=1996", [{"id": 1, "season": 1996}])
    put(tmp_path, "/x?season=1997", [{"id": 2, "season": 1997}])
    assert listing(spark, tmp_path).where("season = 1996 and id > 0").count() == 1
    assert listing(spark, tmp_path).where(F.col("season") == 1996).where(F.col("season") == 1997).collect() == []


def test_odd_values_and_types(spark, tmp_path):
    put(tmp_path, "/x", [{"a": 1.5, "b": True, "i": 2**31, "s": 5, "d": None}, {"a": 2, "b": 1, "i": True, "s": "x", "d": {"e": 3}}, {}])
    df = listing(spark, tmp_path, "a double, b boolean, i int, s string, k bigint", paths=json.dumps({"k": "d.e"}))
    assert [tuple(r) for r in df.collect()] == [(1.5, True, None, None, None), (2.0, None, None, "x", 3), (None,) * 5]
    with pytest.raises(Exception, match="not supported"):
        listing(spark, tmp_path, "a array<int>").collect()


def test_fewer_pages_of_orders(spark, sf):
    root = scratch_path(spark, "t-orders")
    write_store(qi.filtered_order_pages(spark, sf, "/orders"), root)
    conf = {"url": "/orders", "transport": json.dumps({"kind": "file", "root": root}), "params": json.dumps(qi.SERVER_PARAMS)}
    from pyspark.sql.datasource import EqualTo

    def pages(filters):
        reader = rest_records.RestRecordsReader(conf, T.StructType.fromDDL(qi.ORDER_COLUMNS))
        assert list(reader.pushFilters(filters)) == []
        return sum(p.stop - p.start + (p.first is not None) for p in reader.partitions())

    assert pages([EqualTo(("season",), 1996), EqualTo(("status",), "F")]) * 5 < pages([])


def test_pages_in_flight_keep_their_order(monkeypatch):
    reader = rest_json.RestJsonReader({"url": "/x", "transport": "{}", "mode": "async"})
    now, most, lock = [0], [0], threading.Lock()

    def fetch(page, limiter):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.02 if page % 3 else 0.06)
        with lock:
            now[0] -= 1
        return page

    monkeypatch.setattr(reader, "_fetch", fetch)
    assert list(reader._pages(range(2, 30))) == list(range(2, 30))
    assert 2 <= most[0] <= 5
    reader.mode, most[0] = "sequential", 0
    assert list(reader._pages(range(2, 8))) == list(range(2, 8)) and most[0] == 1


def test_waits_are_jittered(tmp_path):
    def waits(**more):
        out = []
        got = tp.fetch({"kind": "file", "root": str(tmp_path / "none")}, "/x", tp.Limiter(None), sleep=out.append, **more)
        assert got["status"] == "failed" and len(out) == 2
        return out

    assert waits(jitter=lambda: 0.5) == [1.5, 2.5] and waits(jitter=lambda: 20) == [10, 10]
    drawn = [tuple(waits()) for _ in range(5)]
    assert len(set(drawn)) == 5 and all(1 <= a <= 2 <= b <= 3 for a, b in drawn)


# --- incremental ingest

ROWS = "id bigint, ts timestamp_ntz, v string"


def rows(spark, data):
    return spark.createDataFrame([(i, None if t is None else dt.datetime(2024, 1, 1) + dt.timedelta(minutes=t), v) for i, t, v in data], ROWS)


def test_halves_equal_one_run(spark):
    data = [(i, i, f"v{i}") for i in range(100)]
    schema = rows(spark, data[:1]).schema
    landed, one, two = (scratch_path(spark, f"t-{x}") for x in ("landed", "one", "two"))
    for half in (data[:37], data[37:]):
        rows(spark, half).repartition(3).write.mode("append").parquet(landed)
        ingest.ingest_new(spark, landed, schema, two, max_files=2)
    ingest.ingest_new(spark, landed, schema, one)
    assert ingest.ingest_new(spark, landed, schema, two) == ingest.ledger(spark, two)
    read = [sorted((r.id, r.v) for r in ingest.accepted(spark, schema, t).collect()) for t in (one, two)]
    assert read[0] == read[1] == [(i, f"v{i}") for i in range(100)]
    assert sum(e["rows"] for e in ingest.ledger(spark, two)) == 100 and len(ingest.ledger(spark, two)) >= 4


@pytest.mark.parametrize("when", ["before the rows", "before the ledger", "after the ledger"])
def test_a_killed_batch_is_there_once(spark, monkeypatch, when):
    landed, target = scratch_path(spark, "t-landed"), scratch_path(spark, "t-killed")
    data = [(i, i, "x") for i in range(50)]
    schema = rows(spark, data[:1]).schema
    rows(spark, data).write.parquet(landed)
    publish = versions.publish

    def killed(*args):
        if when == "after the ledger":
            publish(*args)
        raise RuntimeError("killed")

    def early(df):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        if when != "before the rows":
            m.setattr(versions, "publish", killed)
        with pytest.raises(Exception, match="killed"):
            ingest.ingest_new(spark, landed, schema, target, transform=early if when == "before the rows" else None)
    assert ingest.accepted(spark, schema, target).count() == (50 if when == "after the ledger" else 0)
    for _ in range(2):
        got = ingest.ingest_new(spark, landed, schema, target)
    assert [(e["batch"], e["rows"]) for e in got] == [(0, 50)]
    assert sorted(r.id for r in ingest.accepted(spark, schema, target).collect()) == list(range(50))


def test_late_rows_and_repeated_batches(spark):
    target = scratch_path(spark, "t-late")
    schema = rows(spark, [(1, 0, "a")]).schema
    hour = dt.timedelta(hours=1)
    first, second = [(1, 0, "a"), (2, 120, "b"), (3, None, "c")], [(4, 59, "late"), (5, 60, "edge"), (6, None, "d"), (7, 500, "e")]
    assert ingest.write_batch(rows(spark, first), 0, target, "ts", hour)
    assert ingest.write_batch(rows(spark, second), 1, target, "ts", hour)
    assert not ingest.write_batch(rows(spark, second), 1, target, "ts", hour)
    assert ingest.write_batch(rows(spark, []), 2, target, "ts", hour)
    assert ingest.write_batch(rows(spark, [(8, 430, "late"), (9, 440, "f")]), 3, target, "ts", hour)
    assert sorted(r.id for r in ingest.late(spark, schema, target).collect()) == [4, 8]
    assert sorted((r.id, r.batch) for r in ingest.accepted(spark, schema, target).collect()) == [
        (1, 0), (2, 0), (3, 0), (5, 1), (6, 1), (7, 1), (9, 3)]
    assert [(e["rows"], e["late"]) for e in ingest.ledger(spark, target)] == [(3, 0), (4, 1), (0, 0), (2, 1)]


def test_nothing_landed(spark):
    target = scratch_path(spark, "t-empty")
    schema = T.StructType.fromDDL(ROWS)
    landed = scratch_path(spark, "t-none")
    spark.createDataFrame([], schema).write.parquet(landed)
    ingest.ingest_new(spark, landed, schema, target)
    assert ingest.accepted(spark, schema, target).collect() == [] == ingest.late(spark, schema, target).collect()


# --- windows

def test_windows_by_brute_force(spark):
    data = [(i % 3, (i * 37) % 1500, "x") for i in range(400)] + [(1, None, "x"), (None, 5, "x"), (None, 6, "x")]
    df = rows(spark, data)
    start = dt.datetime(2024, 1, 1)
    got = windows.sliding(df, "ts", "60 minutes", "20 minutes", ["id"], [F.count("*").alias("n")])
    want = {}
    for i, t, _ in data:
        for k in range(3) if t is not None else ():
            at = start + dt.timedelta(minutes=t // 20 * 20 - 20 * k)
            want[i, at] = want.get((i, at), 0) + 1
    assert {(r.id, r.window_start): r.n for r in got.collect()} == want

    sessions = windows.sessions(df, "ts", "9 minutes", ["id"], [F.count("*").alias("n")])
    want = []
    for i in (None, 0, 1, 2):
        times = sorted(t for j, t, _ in data if j == i and t is not None)
        groups = []
        for t in times:
            if groups and t < groups[-1][-1] + 9:
                groups[-1].append(t)
            else:
                groups.append([t])
        want += [(i, start + dt.timedelta(minutes=g[0]), start + dt.timedelta(minutes=g[-1] + 9), len(g)) for g in groups]
    assert sorted(map(tuple, sessions.collect()), key=str) == sorted(want, key=str)
    assert windows.sessions(df.limit(0), "ts", "9 minutes", ["id"], [F.count("*").alias("n")]).collect() == []


def test_stream_closes_windows_behind_the_watermark(spark):
    landed, out = scratch_path(spark, "t-stream"), scratch_path(spark, "t-out")
    for part in ([(1, 1, "x"), (1, 2, "x"), (1, 61, "x")], [(1, 200, "x"), (1, 3, "in time")], [(1, 400, "x"), (1, 4, "late")]):
        rows(spark, part).coalesce(1).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(T.StructType.fromDDL(ROWS)).parquet(landed).withColumn("ts", F.col("ts").cast("timestamp"))
        done = windows.sliding(stream, "ts", "60 minutes", "60 minutes", ["id"], [F.count("*").alias("n")], delay="30 minutes")
        done.writeStream.outputMode("append").format("parquet").option("path", out).option(
            "checkpointLocation", out + "-checkpoint").trigger(availableNow=True).start().awaitTermination()
    got = sorted((r.window_start.hour, r.n) for r in spark.read.parquet(out).collect())
    assert got[:2] == [(0, 3), (1, 1)]  # the first hour was closed when the last row came


# --- merge

def table(spark, data):
    return spark.createDataFrame(data, "k bigint, p string, v string, seq int, gone boolean")


def run(spark, root, data):
    return merge.merge(spark, root, table(spark, data), ["k"], ["seq"], "p", "gone")


def now(spark, root, **kw):
    return sorted((tuple(r) for r in merge.read_table(spark, root, **kw).collect()), key=str)


def test_merge_latest_row_wins(spark):
    root = scratch_path(spark, "t-merge")
    run(spark, root, [(1, "a", "1", 0, False), (2, "a", "2", 0, False), (3, "b", "3", 0, None), (4, "c/ d", "4", 0, False), (None, None, "n", 0, False)])
    before = versions.read(spark, f"{root}/manifest", 1)["parts"]
    got = run(spark, root, [(2, "b", "old", 1, True), (2, "b", "new", 2, False), (9, "d", "9", 1, False), (8, "e", "never", 1, True)])
    assert got["rewritten"] == ["a", "b", "d"] and got["kept"] == ["__HIVE_DEFAULT_PARTITION__", "c/ d"]
    after = versions.read(spark, f"{root}/manifest", 2)["parts"]
    assert all(after[p] == before[p] for p in got["kept"]) and after["b"] != before["b"]
    want = [(1, "a", "1"), (2, "b", "new"), (3, "b", "3"), (4, "c/ d", "4"), (9, "d", "9"), (None, None, "n")]
    assert now(spark, root) == sorted(want, key=str)
    assert len(now(spark, root, version=1)) == 5
    run(spark, root, [(1, "a", "", 1, True), (None, "d", "moved", 1, False)])
    assert now(spark, root) == sorted([(2, "b", "new"), (3, "b", "3"), (4, "c/ d", "4"), (9, "d", "9"), (None, "d", "moved")], key=str)
    assert "a" not in versions.read(spark, f"{root}/manifest", 3)["parts"]
    run(spark, root, [])
    assert len(now(spark, root)) == 5


def test_merge_reads_and_writes_touched_partitions_only(spark):
    root = scratch_path(spark, "t-merge")
    run(spark, root, [(i, f"p{i % 20}", "x", 0, False) for i in range(400)])
    got = run(spark, root, [(5, "p5", "y", 1, False), (405, "p5", "new", 1, False)])
    assert got["rewritten"] == ["p5"] and len(got["kept"]) == 19
    assert len(now(spark, root)) == 401 and now(spark, root, partitions=["p5"])[0][1] == "p5"


def test_two_merges_of_one_version(spark, monkeypatch):
    root = scratch_path(spark, "t-merge")
    run(spark, root, [(1, "a", "1", 0, False)])
    publish = versions.publish

    def other_first(s, folder, number, content):
        publish(s, folder, number, versions.read(s, folder, 1))
        publish(s, folder, number, content)

    with monkeypatch.context() as m:
        m.setattr(versions, "publish", other_first)
        with pytest.raises(versions.Conflict):
            run(spark, root, [(1, "a", "2", 1, False)])
    assert now(spark, root) == [(1, "a", "1")]
    with pytest.raises(ValueError, match="no table"):
        merge.read_table(spark, scratch_path(spark, "t-none"))
    with pytest.raises(ValueError, match="not those of the table"):
        merge.merge(spark, root, spark.createDataFrame([(1, "a")], "k bigint, p string"), ["k"], [], "p")
