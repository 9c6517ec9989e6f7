import pytest
from pyspark.sql import functions as F

from feedlake.plans import catalog
from feedlake.schemas import SCORER
from feedlake.session import scratch_path
from feedlake.sinks import writers

NAMES = ["plain", "comma, inside", 'quote " inside', "new\nline", "  edge spaces  ", "Ñandú Öß", ""]


def _rows(spark):
    data = [("PL", 2024, i, n, None, 1, n, 3, None, 1) for i, n in enumerate(NAMES)]
    return spark.createDataFrame(data, SCORER)


def test_csv_round_trip(spark):
    path = scratch_path(spark, "t-csv")
    assert writers.write_csv(_rows(spark), path, SCORER) == len(NAMES)
    back = {r.player_id: r.player_name for r in writers.read_csv(spark, path, SCORER).collect()}
    assert back == {i: (n if n != "" else None) for i, n in enumerate(NAMES)}


def test_parquet_append_twice_doubles_and_upsert_does_not(spark):
    p1, p2 = scratch_path(spark, "t-app"), scratch_path(spark, "t-ups")
    for _ in range(2):
        writers.write_partitioned(_rows(spark), p1, ["competition_code"], SCORER)
        writers.write_partitioned(_rows(spark), p2, ["competition_code"], SCORER, mode="upsert")
    assert writers.read_partitioned(spark, p1, SCORER).count() == 2 * len(NAMES)
    assert writers.read_partitioned(spark, p2, SCORER).count() == len(NAMES)
    assert writers.read_partitioned(spark, p1, SCORER).columns == SCORER.names


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], SCORER)
    assert writers.write_partitioned(empty, scratch_path(spark, "t-empty"), ["competition_code"], SCORER) == 0
    with pytest.raises(writers.SinkError):
        writers.write_csv(empty, scratch_path(spark, "t-empty-csv"), SCORER)


def test_unknown_format_is_rejected(spark):
    with pytest.raises(ValueError):
        writers.write_records(_rows(spark), scratch_path(spark, "t-x"), "orc")


def test_partition_filter_reaches_scan(spark):
    path = scratch_path(spark, "t-prune")
    writers.write_partitioned(_rows(spark), path, ["competition_code"], SCORER)
    plan = writers.read_partitioned(spark, path, SCORER).where(F.col("competition_code") == "PL")._jdf \
        .queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(competition_code" in plan


def test_empty_input_keeps_earlier_output(spark):
    for write, read, tag in ((writers.write_single, lambda p: spark.read.parquet(p), "t-keep"),
                             (writers.write_csv, lambda p: writers.read_csv(spark, p, SCORER), "t-keep-csv")):
        path = scratch_path(spark, tag)
        assert write(_rows(spark), path, SCORER) == len(NAMES)
        with pytest.raises(writers.SinkError):
            write(spark.createDataFrame([], SCORER), path, SCORER)
        assert read(path).count() == len(NAMES)
        assert write(_rows(spark).limit(2), path, SCORER) == 2 and read(path).count() == 2


def test_single_write_reads_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    rows = _rows(spark).coalesce(1).mapInPandas(touch, SCORER)
    writers.write_single(rows, scratch_path(spark, "t-once"), SCORER)
    assert seen.value == len(NAMES)


def test_files_within_batch(spark):
    path = scratch_path(spark, "t-batch")
    writers.write_partitioned(_rows(spark).coalesce(1), path, [], SCORER, batch_size=3)
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert sorted(sizes) == [1, 3, 3]


@pytest.mark.parametrize("query", ["sink_append_twice", "sink_upsert"])
def test_pages_are_flattened_once_for_two_writes(spark, sf, monkeypatch, query):
    plans, write = [], writers.write_partitioned

    def seen(df, *args, **kwargs):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, *args, **kwargs)

    monkeypatch.setattr(writers, "write_partitioned", seen)
    assert catalog.queries()[query](spark, sf).agg({"n": "sum"}).first()[0] > 0
    assert len(plans) == 2 and not any("payload" in p or "l_orderkey" in p for p in plans)
