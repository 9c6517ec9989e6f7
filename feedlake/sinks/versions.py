"""Small JSON files that say which data folders count: written once, never changed, listed by number.

A file gets its name by a rename that never replaces, so of two writers that publish
one number only one succeeds, and a reader sees either the old state or the new one.
The files go through Hadoop's file system, which knows every store that Spark reads.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Another writer has published this number."""


def _folder(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def numbers(spark: SparkSession, folder: str) -> list[int]:
    """Published numbers in ascending order."""
    fs, at = _folder(spark, folder)
    if not fs.exists(at):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(at)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def publish(spark: SparkSession, folder: str, number: int, content: dict) -> None:
    """Create ``<number>.json``: written under a hidden name, then renamed, which fails if the number is taken."""
    fs, at = _folder(spark, folder)
    hadoop = spark._jvm.org.apache.hadoop.fs
    hidden = hadoop.Path(at, f"_{number:010d}.{uuid.uuid4().hex[:12]}")
    out = fs.create(hidden, True)
    out.write(bytearray(json.dumps(content).encode("utf-8")))
    out.close()
    files = hadoop.FileContext.getFileContext(fs.makeQualified(at).toUri(), spark._jsc.hadoopConfiguration())
    never_over = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        files.rename(fs.makeQualified(hidden), fs.makeQualified(hadoop.Path(at, f"{number:010d}.json")), never_over)
    except Exception as e:
        fs.delete(hidden, False)
        if number in numbers(spark, folder):
            raise Conflict(f"{folder} already has number {number}") from e
        raise


def read(spark: SparkSession, folder: str, number: int) -> dict:
    fs, at = _folder(spark, folder)
    stream = fs.open(spark._jvm.org.apache.hadoop.fs.Path(at, f"{number:010d}.json"))
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
