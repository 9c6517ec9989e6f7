"""Compaction of appended files: rows unchanged, few files, old versions readable, nothing half done."""

from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.session import scratch_path
from feedlake.sinks import compact, versions
from feedlake.sinks.errors import SinkError

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("note", T.StringType()), T.StructField("part", T.StringType())])
PARTS = ["a", "b c", None, "50%=x"]


def _append(spark, path, lo, hi, files=1):
    rows = [(i % 7 if i % 11 else None, f"n{i % 5}" * 20, PARTS[i % 4]) for i in range(lo, hi)]
    spark.createDataFrame(rows, SCHEMA).repartition(files).write.partitionBy("part").mode("append").parquet(path)
    return Counter(rows)


def _rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_ten_appends_become_one_file_a_folder(spark):
    path, want = scratch_path(spark, "t-compact"), Counter()
    for i in range(10):
        want += _append(spark, path, i * 50, i * 50 + 50, files=2)
    done = compact.compact(spark, path, SCHEMA, ["part"], ["id"])
    assert done["version"] == 1 and done["replaced"] == 80 and done["written"] == 4 and done["rows"] == 500
    assert _rows(compact.read(spark, path, SCHEMA)) == want
    assert _rows(compact.read(spark, path, SCHEMA, version=0)) == want
    again = compact.compact(spark, path, SCHEMA, ["part"], ["id"])
    assert again == {"version": 1, "replaced": 0, "written": 0, "rows": 0}
    # appends go on: they are live beside the generation, and the next compaction takes both
    want += _append(spark, path, 900, 950)
    assert _rows(compact.read(spark, path, SCHEMA)) == want
    assert compact.compact(spark, path, SCHEMA, ["part"], ["id"])["version"] == 2
    assert _rows(compact.read(spark, path, SCHEMA)) == want
    assert compact.live_files(spark, path).count() == 4


def test_hot_value_is_split_and_files_are_sorted(spark):
    path = scratch_path(spark, "t-compact-hot")
    one = spark.range(40_000).select(F.lit(1).cast("bigint").alias("id"), F.sha2(F.col("id").cast("string"), 256).alias("note"),
                                     F.lit("a").alias("part"))
    one.repartition(40).write.partitionBy("part").parquet(path)
    total = compact.live_files(spark, path).agg(F.sum("length")).first()[0]
    done = compact.compact(spark, path, SCHEMA, ["part"], ["id", "note"], target_bytes=total // 4)
    assert 4 <= done["written"] <= 6 and done["rows"] == 40_000
    sizes = [r.length for r in compact.live_files(spark, path).collect()]
    assert max(sizes) < total // 2
    back = compact.read(spark, path, SCHEMA).withColumn("f", F.col("_metadata.file_path"))
    spans = sorted((r.a, r.b) for r in back.groupBy("f").agg(F.min("note").alias("a"), F.max("note").alias("b")).collect())
    assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))


def test_large_and_lone_files_stay(spark):
    path = scratch_path(spark, "t-compact-lone")
    _append(spark, path, 0, 40)
    assert compact.compact(spark, path, SCHEMA, ["part"], ["id"])["replaced"] == 0  # one file a folder
    _append(spark, path, 40, 80)
    assert compact.compact(spark, path, SCHEMA, ["part"], ["id"], target_bytes=1)["replaced"] == 0  # all are large


def test_unpartitioned_and_empty(spark):
    path, schema = scratch_path(spark, "t-compact-flat"), T.StructType(SCHEMA.fields[:2])
    for _ in range(3):
        spark.createDataFrame([(1, "x"), (1, "x"), (None, None)], schema).coalesce(1).write.mode("append").parquet(path)
    assert compact.compact(spark, path, schema, [], ["id"])["written"] == 1
    assert _rows(compact.read(spark, path, schema)) == Counter({(1, "x"): 6, (None, None): 3})
    none = scratch_path(spark, "t-compact-none")
    spark.createDataFrame([], schema).write.parquet(none)
    assert compact.read(spark, none, schema).count() == 0
    with pytest.raises(ValueError):
        compact.compact(spark, path, schema, [], ["id"], target_bytes=0)


def test_conflict_and_lost_rows_change_nothing(spark, monkeypatch):
    path, want = scratch_path(spark, "t-compact-conflict"), Counter()
    for i in range(3):
        want += _append(spark, path, i * 20, i * 20 + 20)
    publish = versions.publish

    def late(*args):
        publish(spark, f"{path}/_compact/manifest", 1, {"generation": "gen-none", "replaced": []})
        publish(*args)

    with monkeypatch.context() as m:
        m.setattr(versions, "publish", late)
        (spark.createDataFrame([], SCHEMA).write.parquet(f"{path}/_compact/data/gen-none"))
        with pytest.raises(versions.Conflict):
            compact.compact(spark, path, SCHEMA, ["part"], ["id"])
    assert _rows(compact.read(spark, path, SCHEMA)) == want
    real = compact._rows
    with monkeypatch.context() as m:
        calls = []

        def fewer(*args):
            calls.append(1)
            rows = real(*args)
            return _Short(rows)

        class _Short:
            def __init__(self, rows):
                self.rows = rows

            def count(self):
                return self.rows.count() + 1

            def __getattr__(self, name):
                return getattr(self.rows, name)

        m.setattr(compact, "_rows", fewer)
        with pytest.raises(SinkError):
            compact.compact(spark, path, SCHEMA, ["part"], ["id"])
    assert _rows(compact.read(spark, path, SCHEMA)) == want


def test_an_append_reads_its_own_rows(spark, monkeypatch):
    from feedlake.plans import queries_sinks

    plans, write = [], queries_sinks.writers.write_partitioned

    def seen(df, *args, **kw):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, *args, **kw)

    monkeypatch.setattr(queries_sinks.writers, "write_partitioned", seen)
    rows = queries_sinks.q_sink_compaction(spark, "/root/testdata/sf0.001").collect()
    assert rows and len(plans) == 10
    assert all("batch" in p.split("PartitionFilters: [", 1)[1].split("]", 1)[0] for p in plans)
