"""Operator 5: exact duplicate removal with a heavy-hitter split (built-in functions only).

1. Every text becomes its SHA-256; (doc_id, digest) rows are written once.
2. A Misra-Gries style counter sketch (``approx_top_k`` with ``COUNTERS``
   counters) names the digests that may be frequent. Any digest with more
   than rows / (0.75 * COUNTERS) copies is among the sketch's counters, so at most
   ``CANDIDATES`` names reach the driver-sized candidate table.
3. The candidates are counted exactly; those with at least 1 / HEAVY_SHARE of the rows (two copies at least) are the
   verified winners (at most ``CANDIDATES`` rows), broadcast and joined on
   the map side, so copies of a frequent text are never shuffled.
4. All other digests are aggregated (partially in each task) and joined back by an ordinary shuffle.

Of equal texts the row with the largest doc_id stays.

Defined cases: null and empty texts are the same text; rows with a null
doc_id count in the group and stay only when the whole group has null ids;
repeated (doc_id, text) rows each count and share ``kept``; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import text_of, written

CANDIDATES = 256
COUNTERS = 4096
HEAVY_SHARE = 1000


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest): SHA-256 (32 bytes) of the UTF-8 text."""
    return docs.select("doc_id", F.unhex(F.sha2(text_of().cast("binary"), 256)).alias("digest"))


def heavy_digests(rows: DataFrame, candidates: int = CANDIDATES, counters: int = COUNTERS) -> DataFrame:
    """Verified frequent digests with their exact size and largest doc_id (at most ``candidates`` rows)."""
    named = rows.agg(F.expr(f"approx_top_k(hex(digest), {candidates}, {counters})").alias("top"),
                     F.count("*").alias("rows"))
    named = named.select(F.explode("top").alias("t"), "rows").select(F.unhex("t.item").alias("digest"), "rows")
    exact = rows.join(F.broadcast(named), "digest").groupBy("digest", "rows").agg(
        F.count("*").alias("group_size"), F.max("doc_id").alias("keep_id"))
    return exact.filter((F.col("group_size") > 1) & (F.col("group_size") * HEAVY_SHARE >= F.col("rows"))).drop("rows")


def dedup(docs: DataFrame, candidates: int = CANDIDATES, counters: int = COUNTERS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = written(digests(docs), "dedup-digests")
    heavy = written(heavy_digests(rows, candidates, counters), "dedup-heavy")
    split = rows.join(F.broadcast(heavy), "digest", "left")
    frequent = split.filter(F.col("group_size").isNotNull())
    rest = split.filter(F.col("group_size").isNull()).select("doc_id", "digest")
    # an aggregate and a join, not a window: AQE can split a digest that many rows share
    groups = rest.groupBy("digest").agg(F.count("*").alias("group_size"), F.max("doc_id").alias("keep_id"))
    rest = rest.join(groups, "digest").select("digest", "doc_id", "group_size", "keep_id")
    frequent = frequent.select(*rest.columns)
    return frequent.unionByName(rest).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)"""
