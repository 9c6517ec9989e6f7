"""Operator 10: rendezvous hashing of stable record keys over weighted shards (built-in functions only).

Every (key, shard) pair has a hash ``u`` in (0, 1); the record goes to the
shard with the largest ``weight / -ln(u)``. The choice depends on the key and
the shard list alone, so adding a shard moves rows only into the new shard,
and changing one weight moves rows only to or from that shard.

Slots (a gapless numbering inside each shard) never sort a whole shard in one
task: rows are dealt to ``(shard, bucket)`` cells of about ``cell_rows`` rows,
numbered inside the cell, and shifted by the number of rows in earlier cells
of the shard (a table of one row per cell).

Defined cases: a null key hashes as the text ``null``; repeated rows get the
same shard and different slots; an empty table gives an empty result; columns
of the input are kept as they are, whatever their names, unless they carry the
name of an output column, which then replaces them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.common import bounded_broadcast, text_of, written

SHARDS = 16
CELL_ROWS = 2_000


def _unit(key: Column, salt: str) -> Column:
    """48 bits of md5(key | salt) as a number strictly between 0 and 1."""
    digest = F.md5(F.concat(key, F.lit(f"|{salt}")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(2**48))


def _score(key: Column, weight: float, i: int) -> Column:
    return F.struct((F.lit(float(weight)) / -F.log(_unit(key, f"shard{i}"))).alias("score"), F.lit(-i).alias("i"))


def _best(key: Column, weights: Sequence[float]) -> Column:
    if not weights or any(w <= 0 for w in weights):
        raise ValueError("weights must be positive and not empty")
    key = F.coalesce(key.cast("string"), F.lit("null"))
    return F.array_max(F.array(*[_score(key, w, i) for i, w in enumerate(weights)]))


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Shard of ``key``: the index of the largest weight / -ln(u); the smaller index on a tie."""
    return -(_best(key, weights)["i"])


def assign(df: DataFrame, key: str, weights: Sequence[float], grown: Sequence[float] | None = None,
           tie: Sequence[str] = (), cell_rows: int = CELL_ROWS) -> DataFrame:
    """Add ``shard``, ``slot`` and, if ``grown`` weights are given, ``grown_shard``.

    Slots follow (cell, key, ``tie`` columns). ``tie`` columns also help to deal
    rows with equal keys to different cells; a group of equal rows larger than a cell is dealt to parts by row number
    (``df`` is a stored table: it is read twice).
    """
    n = df.count()
    cells = max(1, -(-n // (len(weights) * cell_rows)))
    spread = F.concat_ws("|", F.coalesce(F.col(key).cast("string"), F.lit("null")),
                         *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in tie])
    cell = F.pmod(F.conv(F.substring(F.md5(F.concat(spread, F.lit("|cell")).cast("binary")), 1, 12), 16, 10)
                  .cast("bigint"), F.lit(cells))
    out = df.drop("shard", "slot", "grown_shard", "_cell").withColumn("_best", _best(F.col(key), weights))
    out = out.withColumn("_number", F.monotonically_increasing_id())  # of the stored input, the same each time it is read
    out = out.withColumn("shard", -F.col("_best.i"))
    if grown is not None:
        if list(grown[:-1]) != list(weights):
            raise ValueError("grown weights are the weights and one more")
        name = F.coalesce(F.col(key).cast("string"), F.lit("null"))  # only the new shard can win the row
        out = out.withColumn("grown_shard", -F.greatest(F.col("_best"), _score(name, grown[-1], len(weights)))["i"])
    out = out.drop("_best").withColumn("_cell", cell).withColumn("_spread", spread)
    # rows with one key and one tie beyond a cell's size (at most n / cell_rows such groups) are dealt to cells of their own
    hot = out.groupBy("_spread").agg(F.count("*").alias("_rows")).filter(F.col("_rows") > cell_rows)
    hot = hot.select("_spread", F.ceil(F.col("_rows") / cell_rows).cast("int").alias("_parts"))
    out = out.join(bounded_broadcast(written(hot, "shard-hot")), "_spread", "left").drop("_spread")
    part = F.when(F.col("_parts").isNull(), 0).otherwise(1 + F.pmod(F.col("_number"), F.col("_parts")).cast("int"))
    out = out.withColumn("_part", part).drop("_parts", "_number")
    sizes = out.groupBy("shard", "_cell", "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_cell", "_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "_cell", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("shard", "_cell", "_part").orderBy(key, *tie)
    ranked = out.withColumn("slot", F.row_number().over(inside).cast("bigint") - 1)
    return (ranked.join(offsets, ["shard", "_cell", "_part"])
            .withColumn("slot", F.col("slot") + F.col("_offset")).drop("_cell", "_part", "_offset"))


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Digest rows of the ``key`` law: size in bytes plus one, crc32 of the text, shard, slot, shard of one more."""
    text = text_of()
    base = written(docs.select("doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"),
                               F.crc32(text.cast("binary")).cast("bigint").alias("text_crc32")), "shard-base")
    out = assign(base, "doc_id", [1.0] * shards, [1.0] * (shards + 1), tie=("text_crc32", "size"))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int"), "slot",
                      F.col("grown_shard").cast("int"))


def shard_rows(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Whole documents with ``shard`` and ``slot`` (pipeline form)."""
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    rows = docs.select("doc_id", F.crc32(text_of().cast("binary")).alias("_crc"), F.struct(*kept).alias("_row"))
    out = assign(rows, "doc_id", [1.0] * shards, tie=("_crc",))
    return out.select("_row.*", F.col("shard").cast("int").alias("shard"), "slot")


def oracle(shards: int = SHARDS, cell_rows: int = CELL_ROWS) -> str:
    """The same result in DuckDB SQL."""
    def unit(salt: str) -> str:
        return (f"((('0x' || substr(md5(k || '|' || {salt}), 1, 12))::BIGINT)::DOUBLE + 0.5) / 281474976710656.0")

    def pick(n: int) -> str:
        scored = ", ".join(f"{{'s': 1.0 / -ln({unit(f"'shard{i}'")}), 'i': {-i}}}" for i in range(n))
        return f"-(list_max([{scored}]).i)"

    return f"""
WITH crc_table AS (
  SELECT list(c ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_concat([i], range(8)), lambda c, _: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(i))),
b AS (
  SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), 'null') AS k, coalesce(text, '') AS t,
    (SELECT count(*) FROM documents) AS n FROM documents),
s AS (
  SELECT doc_id, k, n, CAST(strlen(t) + 1 AS BIGINT) AS size,
    xor(list_reduce(list_concat([4294967295], list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda h: ('0x' || h)::BIGINT)),
      lambda c, x: xor(tab[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) AS text_crc32,
    {pick(shards)} AS shard, {pick(shards + 1)} AS grown_shard
  FROM b, crc_table),
c AS (
  SELECT *, ('0x' || substr(md5(concat_ws('|', k, CAST(text_crc32 AS VARCHAR), CAST(size AS VARCHAR)) || '|cell'), 1, 12))::BIGINT
    % greatest(1, CAST(ceil(n / {shards * cell_rows}.0) AS BIGINT)) AS cell FROM s)
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
  CAST(row_number() OVER (PARTITION BY shard ORDER BY cell, doc_id, text_crc32, size) - 1 AS BIGINT) AS slot,
  CAST(grown_shard AS INTEGER) AS grown_shard
FROM c"""
