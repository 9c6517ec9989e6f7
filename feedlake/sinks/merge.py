"""Keyed merge into a partitioned table (K2): copy-on-write, the latest row of a key wins.

Layout under ``root``: ``data/version=<v>/<partition>=<value>/*.parquet`` and ``manifest/<v>.json``. A
manifest names, for every live partition value, the version whose folder
holds it. A merge

1. reduces the changes to the latest row of each key (partial aggregation, so a key with very many
   changes is not gathered);
2. finds the touched partitions: those of the changes, and those where a changed key
   lives now (only the key and partition columns of the table are read), because a row may move;
3. writes the touched partitions anew under the next version: their rows whose key did not change, and the changes;
4. publishes the next manifest. Until then readers see the old version; a merge that dies leaves folders that no
   manifest names; of two merges from one version one fails with ``Conflict`` and changes nothing.

Untouched partitions are neither read (but for the keys) nor written. What
goes to the driver is the list of partition values.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.sinks import versions

VERSION = "version"


def _manifest(spark: SparkSession, root: str, version: int | None) -> tuple[int, dict | None]:
    known = versions.numbers(spark, f"{root}/manifest")
    if version is None:
        version = known[-1] if known else 0
    if version and version not in known:
        raise ValueError(f"{root} has no version {version}")
    return version, versions.read(spark, f"{root}/manifest", version) if version else None


def read_table(spark: SparkSession, root: str, version: int | None = None, partitions: list[str] | None = None) -> DataFrame:
    """The table as of a version (default: the latest); ``partitions``: only these partition values."""
    _, found = _manifest(spark, root, version)
    if found is None:
        raise ValueError(f"{root} holds no table")
    schema = T.StructType.fromJson(found["schema"])
    paths = [p for value, p in found["parts"].items() if partitions is None or value in partitions]
    if not paths:
        return spark.createDataFrame([], schema)
    wide = T.StructType(schema.fields + [T.StructField(VERSION, T.StringType())])
    rows = spark.read.schema(wide).option("basePath", f"{root}/data").parquet(*[f"{root}/data/{p}" for p in paths])
    return rows.select(*schema.fieldNames())


def merge(spark: SparkSession, root: str, changes: DataFrame, key: list[str], order: list[str], partition: str,
          deleted: str | None = None) -> dict:
    """Merge ``changes`` and publish the next version; returns ``version``, ``rewritten`` and ``kept`` partition values.

    ``order``: columns that say which of several changes of a key is the latest; they are not stored. ``deleted``: a boolean
    column, not stored either; true takes the key out. A null key is a key; partition values are compared as text.
    """
    version, found = _manifest(spark, root, None)
    columns = [c for c in changes.columns if c not in order and c != deleted]
    if VERSION in columns:
        raise ValueError(f"column name {VERSION} is taken by the layout")
    # all columns take part in the order, so the same row wins whatever the physical order of equal changes
    latest = changes.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)]).agg(
        F.max(F.struct(*order, *[c for c in changes.columns if c not in order])).alias("r")).select("r.*")
    staged = f"{root}/staged/{uuid.uuid4().hex[:12]}"
    latest.write.parquet(staged)  # read three times below: once written, it is the same each time
    latest = spark.read.schema(latest.schema).parquet(staged)
    gone = F.coalesce(F.col(deleted), F.lit(False)) if deleted else F.lit(False)
    rows = latest.filter(~gone).select(*columns)

    text = F.coalesce(F.col(partition).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
    touched = rows.select(text.alias("p"))
    old = None
    if found is not None:
        if T.StructType.fromJson(found["schema"]).fieldNames() != columns:
            raise ValueError(f"columns {columns} are not those of the table")
        old = read_table(spark, root, version)
        same = [old[k].eqNullSafe(latest[k]) for k in key]
        touched = touched.unionByName(old.join(latest, same, "left_semi").select(text.alias("p")))
    values = sorted(r.p for r in touched.distinct().collect())
    if old is not None:
        part = read_table(spark, root, version, values)
        rows = part.join(latest, [part[k].eqNullSafe(latest[k]) for k in key], "left_anti").select(*columns).unionByName(rows)

    new = f"{VERSION}={version + 1:010d}-{uuid.uuid4().hex[:8]}"
    rows.hint("rebalance", partition).write.partitionBy(partition).parquet(f"{root}/data/{new}")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in changes.select(*columns).schema.fields])
    parts = dict(found["parts"]) if found else {}
    for v in values:
        parts.pop(v, None)
    for folder in _folders(spark, f"{root}/data/{new}", partition):
        parts[_value(spark, folder)] = f"{new}/{folder}"
    versions.publish(spark, f"{root}/manifest", version + 1, {"schema": schema.jsonValue(), "parts": parts})
    return {"version": version + 1, "rewritten": values, "kept": sorted(set(parts) - set(values))}


def _folders(spark: SparkSession, path: str, partition: str) -> list[str]:
    fs, at = versions._folder(spark, path)
    return sorted(n for n in (f.getPath().getName() for f in fs.listStatus(at)) if n.startswith(f"{partition}="))


def _value(spark: SparkSession, folder: str) -> str:
    """The partition value as text (folder names escape some characters)."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(folder.split("=", 1)[1])
