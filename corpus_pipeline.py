"""Corpus pipeline: the stages that turn ``documents`` into sharded training rows.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, written and reread as the next stage's ``docs``. All
but the last return the columns of ``documents``.

1. quality: documents scored below the threshold go.
2. near_duplicates: five-word shingles, similarity 0.8 or more; of each
   component the document with the smallest doc_id stays.
3. decontamination: documents with a benchmark window of ten words go.
4. mixing: documents are repeated 0, 1 or 2 times so that the sources reach their targets.
5. sharding: rendezvous hashing of doc_id over 16 shards; adds ``shard`` and ``slot``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedlake.llm import decontaminate, mixing, quality, sharding, similar
from feedlake.llm.common import written
from feedlake.session import read_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_documents(docs, read_table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return similar.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove(docs, read_table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_rows(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: Classifier scores and iterative solutions have no SQL form; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared scratch folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs
