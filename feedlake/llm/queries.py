"""Registered queries of this subpackage (``queries()``) and their DuckDB oracles (``oracle_sql()``)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feedlake.llm import (decontaminate, exact_dedup, fingerprints, hard_negatives, html_text, mixing, periodic, quality, sharding,
                          similar, suffix_dedup, tokens, url_rules)
from feedlake.session import read_table

TOKENIZER = "word_bpe_49k.json"


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.encode_and_digest(read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar.join(read_table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(read_table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read_table(spark, sf_dir, "pages"))


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(read_table(spark, sf_dir, "pages"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.find(read_table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(periodic.find(read_table(spark, sf_dir, "documents"), periodic.repeat_part))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited(read_table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(hard_negatives.prepare(read_table(spark, sf_dir, "embeddings"), shift_every=7))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_token_output, op2_quality, op3_source_mixing, op4_ngram_join, op5_exact_dedup, op6_decontaminate, op7_html_text,
        op8_url_rules, op9_suffix_dedup, op10_sharding, op11_periodic_runs, op12_fingerprints, op13_hard_negatives)}


def oracle_sql() -> dict[str, str]:
    return {"op4_ngram_join": similar.ORACLE, "op5_exact_dedup": exact_dedup.ORACLE, "op6_decontaminate": decontaminate.ORACLE,
            "op10_sharding": sharding.oracle(), "op11_periodic_runs": periodic.ORACLE, "op13_hard_negatives": hard_negatives.ORACLE}
