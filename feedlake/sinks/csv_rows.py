"""Data sink ``csv_rows`` (K4): CSV with CRLF row ends that leaves the values alone.

Spark's CSV writer rewrites newlines in values when the row end is CRLF, and a
text sink cannot put one header over many files. Here each task writes one
file of CRLF rows without a header through Python's ``csv`` module, column by column from Arrow batches, so nothing is
rewritten. The commit adds ``part-00000-header.csv``, a file of one row: the files of the folder, joined in
the order of their names, are one CSV file with one header.

Two phases: tasks write below a hidden staging folder; the commit removes files
that no committed task reported (lost executors, repeated attempts) and renames the folder to its
place, replacing what was there. A failed task, an abort or an empty input (unless allowed) removes the
staging folder, and earlier output stays. The file system must be able to rename folders (local, HDFS).
"""

from __future__ import annotations

import csv
import io
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from feedlake.sinks.errors import SinkError
from feedlake.sources.transport import open_fs

ROW_END = "\r\n"  # fixed value: the client's row end
#: ``minimal``: the client's dialect, null and '' are both an empty field. ``strings``: texts are quoted, so '' stays apart from null.
QUOTING = {"minimal": csv.QUOTE_MINIMAL, "strings": csv.QUOTE_STRINGS}
PIECE_ROWS = 4096
SIMPLE = (T.StringType, T.BooleanType, T.IntegralType, T.FractionalType, T.DecimalType)


@dataclass
class Written(WriterCommitMessage):
    file: str | None
    rows: int


def _text(rows, quoting: int) -> bytes:
    out = io.StringIO(newline="")
    csv.writer(out, quoting=quoting, lineterminator=ROW_END).writerows(rows)
    return out.getvalue().encode("utf-8")


class CsvRows(DataSource):
    @classmethod
    def name(cls) -> str:
        return "csv_rows"

    def writer(self, schema: T.StructType, overwrite: bool) -> "CsvRowsWriter":
        if not overwrite:
            raise SinkError("csv_rows replaces its folder: use mode('overwrite')")
        made = CsvRowsWriter(schema, dict(self.options))
        # made here and never by a task, so a task that outlives an abort cannot bring it back
        fs, folder = open_fs(made.staged)
        fs.create_dir(folder, recursive=True)
        return made


class CsvRowsWriter(DataSourceArrowWriter):
    def __init__(self, schema: T.StructType, options: dict):
        odd = [f.name for f in schema.fields if not isinstance(f.dataType, SIMPLE)]
        if odd:
            raise SinkError(f"no text form for the columns {odd}: cast them to strings first")
        self.names = schema.fieldNames()
        self.target = options["path"].rstrip("/")
        self.quoting = QUOTING[options.get("quoting", "minimal")]
        self.fail_if_empty = options.get("failifempty", options.get("failIfEmpty", "true")) == "true"
        self.staged = f"{self.target}.staging-{uuid.uuid4().hex[:12]}"

    def write(self, iterator) -> Written:
        from pyspark import TaskContext

        context = TaskContext.get()
        fs, folder = open_fs(self.staged)
        name = f"part-{context.partitionId() + 1:05d}-{uuid.uuid4().hex[:12]}.csv"
        rows, out = 0, None
        try:
            for batch in iterator:
                if batch.num_rows and out is None:  # a task without rows leaves no file
                    out = fs.open_output_stream(f"{folder}/{name}")
                for at in range(0, batch.num_rows, PIECE_ROWS):
                    piece = batch.slice(at, PIECE_ROWS)
                    out.write(_text(zip(*(c.to_pylist() for c in piece.columns)), self.quoting))
                rows += batch.num_rows
        finally:
            if out is not None:
                out.close()
        return Written(name if rows else None, rows)

    def commit(self, messages: list) -> None:
        import pyarrow.fs as pafs

        done = [m for m in messages if m is not None]
        if self.fail_if_empty and not any(m.rows for m in done):
            raise SinkError("no records to write")
        fs, folder = open_fs(self.staged)
        _, target = open_fs(self.target)
        fs.create_dir(folder, recursive=True)
        keep = {m.file for m in done}
        for info in fs.get_file_info(pafs.FileSelector(folder)):
            if info.base_name not in keep:
                fs.delete_file(info.path)
        with fs.open_output_stream(f"{folder}/part-00000-header.csv") as out:
            out.write(_text([self.names], csv.QUOTE_MINIMAL))
        if fs.get_file_info(target).type == pafs.FileType.Directory:
            fs.delete_dir(target)
        fs.move(folder, target)

    def abort(self, messages: list) -> None:
        import pyarrow.fs as pafs

        fs, folder = open_fs(self.staged)
        for last in [False] * 9 + [True]:
            if fs.get_file_info(folder).type != pafs.FileType.Directory:
                return
            try:
                fs.delete_dir(folder)
            except OSError:  # a task not yet killed added a file meanwhile
                if last:
                    raise
                time.sleep(0.1)


def save(df: DataFrame, path: str, quoting: str = "minimal", fail_if_empty: bool = True) -> None:
    """Write ``df`` to the folder ``path``, replacing it; an empty input raises and keeps it (unless allowed: header only)."""
    if quoting not in QUOTING:
        raise ValueError(f"unknown quoting {quoting!r}; expected one of {tuple(QUOTING)}")
    df.sparkSession.dataSource.register(CsvRows)
    (df.write.format("csv_rows").mode("overwrite").option("quoting", quoting)
     .option("failIfEmpty", str(fail_if_empty).lower()).save(path))


def load(spark: SparkSession, path: str, schema: T.StructType, quoting: str = "minimal") -> DataFrame:
    """Rows of a folder written by ``save`` (all files but the header)."""
    rows = spark.read.schema(schema).options(quote='"', escape='"', multiLine="true", lineSep=ROW_END, encoding="UTF-8",
                                             ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false",
                                             pathGlobFilter="part-*[0-9a-f].csv", maxCharsPerColumn="-1")
    # the reader compares fields with its null text, quoted ones too: a text of its own for each read keeps '' apart
    null = "" if quoting == "minimal" else uuid.uuid4().hex
    return rows.option("nullValue", null).option("emptyValue", "").csv(path)
