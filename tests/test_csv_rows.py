"""The ``csv_rows`` sink: bytes as Python's csv module and DuckDB read them, two-phase commit."""

import csv
import io
from pathlib import Path
from types import SimpleNamespace

import duckdb
import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from feedlake.schemas import SCORER
from feedlake.session import scratch_path as shared_path
from feedlake.sinks import csv_rows, writers

TEXTS = ["plain", "comma, inside", 'quote " inside', "new\nline", "crlf\r\ninside", "lone\rreturn", "  edges  ", "Ñandú 日本 😀",
         "", None, '"', ",", "\n", "tail\n", "x" * 200_000]
SCHEMA = "id bigint, note string, amount double, flag boolean"


def scratch_path(spark, tag):
    return shared_path(spark, tag).removeprefix("file:")


def _rows(spark, parts=4):
    return spark.createDataFrame([(i, t, i / 4 if i % 3 else None, i % 2 == 0) for i, t in enumerate(TEXTS)], SCHEMA).repartition(parts, "id")


csv.field_size_limit(1_000_000)


def _joined(path):
    return b"".join(p.read_bytes() for p in sorted(Path(path).glob("part-*.csv")))


def _beside(path):
    return [p.name for p in Path(path).parent.iterdir() if Path(path).name in p.name]


@pytest.mark.parametrize("quoting", ["minimal", "strings"])
def test_joined_files_are_one_csv(spark, quoting):
    path = scratch_path(spark, "t-rows")
    csv_rows.save(_rows(spark), path, quoting=quoting)
    data = _joined(path)
    assert data.count(b"id,note,amount,flag\r\n") == 1 and data.startswith(b"id,note,amount,flag\r\n") and data.endswith(b"\r\n")
    read = list(csv.reader(io.StringIO(data.decode("utf-8"), newline="")))[1:]
    assert {int(r[0]): r[1] for r in read} == {i: t or "" for i, t in enumerate(TEXTS)}
    one = Path(path).parent / f"{Path(path).name}-one.csv"
    one.write_bytes(data)
    got = duckdb.sql(f"SELECT id, note, amount, flag FROM read_csv('{one}', header=true, delim=',', quote='\"', escape='\"', "
                     "new_line='\\r\\n', strict_mode=false, max_line_size=1000000, allow_quoted_nulls=false, "
                     "columns={'id': 'BIGINT', 'note': 'VARCHAR', 'amount': 'DOUBLE', 'flag': 'BOOLEAN'})").fetchall()
    want = [(i, (t or None) if quoting == "minimal" else t, i / 4 if i % 3 else None, i % 2 == 0) for i, t in enumerate(TEXTS)]
    assert sorted(got) == want


@pytest.mark.parametrize("quoting", ["minimal", "strings"])
def test_round_trip_through_spark(spark, quoting):
    path = scratch_path(spark, "t-rows")
    rows = _rows(spark)
    csv_rows.save(rows, path, quoting=quoting)
    back = {r.id: (r.note, r.amount, r.flag) for r in csv_rows.load(spark, path, rows.schema, quoting).collect()}
    assert back == {i: ((t or None) if quoting == "minimal" else t, i / 4 if i % 3 else None, i % 2 == 0) for i, t in enumerate(TEXTS)}


def test_failed_task_leaves_earlier_output_alone(spark):
    path = scratch_path(spark, "t-fail")
    csv_rows.save(_rows(spark), path)
    before = _joined(path)
    broken = _rows(spark).withColumn("amount", F.when(F.col("id") == 7, F.raise_error(F.lit("broken row"))).otherwise(F.col("amount")))
    with pytest.raises(Exception, match="broken row"):
        csv_rows.save(broken, path)
    with pytest.raises(Exception, match="no records"):
        csv_rows.save(_rows(spark).filter("false"), path)
    assert _joined(path) == before and _beside(path) == [Path(path).name]


def test_failure_without_earlier_output_leaves_nothing(spark):
    path = scratch_path(spark, "t-none")
    with pytest.raises(Exception, match="no records"):
        csv_rows.save(_rows(spark).filter("false"), path)
    assert _beside(path) == []


def test_files_of_lost_attempts_are_removed(spark):
    path = scratch_path(spark, "t-lost")
    writer = csv_rows.CsvRowsWriter(_rows(spark).schema, {"path": path})
    Path(writer.staged).mkdir(parents=True)
    for name in ("part-00001-aaa.csv", "part-00001-bbb.csv"):
        (Path(writer.staged) / name).write_bytes(b"1,a,,True\r\n")
    writer.commit([csv_rows.Written("part-00001-bbb.csv", 1), csv_rows.Written(None, 0)])
    assert sorted(p.name for p in Path(path).iterdir()) == ["part-00000-header.csv", "part-00001-bbb.csv"]


def test_replaced_as_a_whole_and_empty_allowed(spark):
    path = scratch_path(spark, "t-again")
    for rows in (_rows(spark), _rows(spark).limit(2), _rows(spark).filter("false")):
        csv_rows.save(rows, path, fail_if_empty=False)
        assert csv_rows.load(spark, path, rows.schema).count() == rows.count()
    assert _joined(path) == b"id,note,amount,flag\r\n"


def test_writer_and_refusals(spark):
    data = [("PL", 2024, i, t, None, 1, t, 3, None, 1) for i, t in enumerate(TEXTS) if t is not None]
    rows, path = spark.createDataFrame(data, SCORER), scratch_path(spark, "t-crlf")
    assert writers.write_csv(rows, path, SCORER, crlf=True) == len(data)
    back = {r.player_id: r.player_name for r in csv_rows.load(spark, f"{path}/data.csv", SCORER).collect()}
    assert back == {r[2]: r[3] or None for r in data}
    with pytest.raises(ValueError):
        csv_rows.save(rows, path, quoting="all")
    with pytest.raises(Exception, match="no text form"):
        csv_rows.save(rows.select(F.array("goals").alias("g")), path)


def test_a_task_that_outlives_an_abort_leaves_nothing(spark, monkeypatch):
    monkeypatch.setattr(TaskContext, "get", classmethod(lambda cls: SimpleNamespace(partitionId=lambda: 0)))
    path = scratch_path(spark, "t-late")
    source = csv_rows.CsvRows({"path": path})
    writer = source.writer(_rows(spark).schema, True)
    writer.abort([])
    with pytest.raises(OSError):
        writer.write(iter(_rows(spark).toArrow().to_batches()))
    assert _beside(path) == []
