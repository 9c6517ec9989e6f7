"""Sink round trips (K1-K7). Each call writes under a fresh folder of the shared root."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from feedlake.operators.entity import flatten_matches, flatten_scorers, flatten_standings
from feedlake.plans.catalog import MATCH_ROWS_SQL, SCORER_ROWS_SQL, STANDING_ROWS_SQL, register
from feedlake.schemas import MATCH, SCORER, STANDING
from feedlake.session import read_table, scratch_path
from feedlake.sinks import compact, csv_rows, writers
from feedlake.sources import feeds


def _flat(spark: SparkSession, rows: DataFrame, tag: str, schema) -> DataFrame:
    """Flattened rows written once and read back, for queries that write them more than once."""
    landed = scratch_path(spark, f"{tag}-flat")
    rows.write.parquet(landed)
    return spark.read.schema(schema).parquet(landed)


@register("sink_partitioned", f"""
SELECT match_date, count(*) AS n, CAST(sum(match_id) AS BIGINT) AS sum_id
FROM ({MATCH_ROWS_SQL}) m
GROUP BY match_date
""")
def q_sink_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2/K6: matches by ``match_date``, every date read back (pruning is checked by a plan test)."""
    path = scratch_path(spark, "matches")
    writers.write_partitioned(flatten_matches(feeds.matches_landing(spark, sf_dir)), path, ["match_date"], MATCH)
    back = writers.read_partitioned(spark, path, MATCH)
    return back.groupBy("match_date").agg(F.count("*").alias("n"), F.sum("match_id").alias("sum_id"))


@register("sink_append_twice", f"""
SELECT competition_code, 2 * count(*) AS n
FROM ({STANDING_ROWS_SQL}) s GROUP BY competition_code
""")
def q_sink_append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: appending the same rows twice doubles them (the client's re-run behaviour)."""
    path = scratch_path(spark, "standings")
    rows = _flat(spark, flatten_standings(feeds.standings_landing(spark, sf_dir)), "standings", STANDING)
    for _ in range(2):
        writers.write_partitioned(rows, path, ["competition_code"], STANDING)
    back = writers.read_partitioned(spark, path, STANDING)
    return back.groupBy("competition_code").agg(F.count("*").alias("n"))


@register("sink_upsert", f"""
SELECT competition_code, count(*) AS n
FROM ({STANDING_ROWS_SQL}) s GROUP BY competition_code
""")
def q_sink_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 extension: dynamic partition overwrite makes the re-run idempotent."""
    path = scratch_path(spark, "standings")
    rows = _flat(spark, flatten_standings(feeds.standings_landing(spark, sf_dir)), "standings", STANDING)
    for _ in range(2):
        writers.write_partitioned(rows, path, ["competition_code"], STANDING, mode="upsert")
    back = writers.read_partitioned(spark, path, STANDING)
    return back.groupBy("competition_code").agg(F.count("*").alias("n"))


@register("sink_single", SCORER_ROWS_SQL)
def q_sink_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: one dataset, fixed schema (nullable columns keep their types)."""
    path = scratch_path(spark, "scorers")
    writers.write_single(flatten_scorers(feeds.scorers_landing(spark, sf_dir)), path, SCORER)
    return spark.read.schema(SCORER).parquet(path)


@register("sink_csv", SCORER_ROWS_SQL)
def q_sink_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: CSV round trip with the client's dialect."""
    path = scratch_path(spark, "scorers-csv")
    writers.write_csv(flatten_scorers(feeds.scorers_landing(spark, sf_dir)), path, SCORER)
    return writers.read_csv(spark, path, SCORER)


@register("sink_csv_exact", """
SELECT doc_id, text || chr(13) || chr(10) || '"' || lang AS note, source FROM documents
""")
def q_sink_csv_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: whole texts with newlines, CRLF and quotes inside values, CRLF row ends; null and empty stay apart."""
    path = scratch_path(spark, "documents-csv")
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", F.concat("text", F.lit('\r\n"'), "lang").alias("note"), "source")
    csv_rows.save(docs, path, quoting="strings")
    return csv_rows.load(spark, path, docs.schema, quoting="strings")


@register("sink_batches", f"""
SELECT count(*) AS n_rows, true AS files_within_batch, count(*) > 1000 AS many_files
FROM ({STANDING_ROWS_SQL}) s
""")
def q_sink_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: no file holds more than ``batch_size`` rows."""
    path = scratch_path(spark, "standings-batches")
    writers.write_partitioned(flatten_standings(feeds.standings_landing(spark, sf_dir)), path, [], STANDING,
                              batch_size=1000)
    per_file = spark.read.schema(STANDING).parquet(path).groupBy(F.input_file_name().alias("f")).count()
    return per_file.agg(F.sum("count").alias("n_rows"), F.min(F.col("count") <= 1000).alias("files_within_batch"),
                        (F.count("*") > 1).alias("many_files"))


@register("sink_compaction", f"""
SELECT competition_code, count(*) AS n, CAST(sum(match_id) AS BIGINT) AS sum_id, min(match_date) AS first_date,
  count(*) FILTER (WHERE home_score_ft IS NULL) AS n_open, true AS many_before, true AS few_after
FROM ({MATCH_ROWS_SQL}) m GROUP BY competition_code
""")
def q_sink_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten appends of matches, compacted; rows of each competition and the number of its files before and after."""
    path = scratch_path(spark, "matches-appended")
    rows = flatten_matches(feeds.matches_landing(spark, sf_dir)).withColumn("batch", F.col("match_id") % 10)
    landed = scratch_path(spark, "matches-flat")
    rows.write.partitionBy("batch").parquet(landed)  # so that an append reads its own rows alone
    rows = spark.read.schema(StructType([*MATCH, StructField("batch", LongType())])).parquet(landed)
    for i in range(10):
        writers.write_partitioned(rows.filter(F.col("batch") == i), path, ["competition_code"], MATCH)
    sizes = F.sum("length").alias("bytes"), F.count("*").alias("n_files")
    before = compact.live_files(spark, path, version=0).groupBy("folder").agg(*sizes)
    compact.compact(spark, path, MATCH, ["competition_code"], ["match_date", "match_id"])
    after = compact.live_files(spark, path).groupBy("folder").agg(*sizes)
    files = before.alias("b").join(after.alias("a"), "folder").select(
        F.regexp_extract("folder", "competition_code=(.*)$", 1).alias("competition_code"), (F.col("b.n_files") > 1).alias("many_before"),
        # a folder's rows span at most one range more than its bytes need, at either end
        (F.col("a.n_files") <= F.ceil(F.col("b.bytes") / compact.TARGET_BYTES) + 1).alias("few_after"))
    back = compact.read(spark, path, MATCH).groupBy("competition_code").agg(
        F.count("*").alias("n"), F.sum("match_id").alias("sum_id"), F.min("match_date").alias("first_date"),
        F.count_if(F.col("home_score_ft").isNull()).alias("n_open"))
    return back.join(files, "competition_code")


@register("sink_route", f"""
SELECT 'csv' AS fmt, count(*) AS n FROM ({SCORER_ROWS_SQL}) a
UNION ALL SELECT 'parquet', count(*) FROM ({SCORER_ROWS_SQL}) b
""")
def q_sink_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: the format picks the writer; counts read back from each."""
    rows = flatten_scorers(feeds.scorers_landing(spark, sf_dir))
    out = []
    for fmt in writers.FORMATS:
        path = scratch_path(spark, f"route-{fmt}")
        writers.write_records(rows, path, fmt, ["competition_code"], SCORER)
        back = (writers.read_csv(spark, path, SCORER) if fmt == "csv" else
                writers.read_partitioned(spark, path, SCORER))
        out.append(back.agg(F.count("*").alias("n")).select(F.lit(fmt).alias("fmt"), "n"))
    return out[0].unionByName(out[1])
