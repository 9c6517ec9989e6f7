"""The pipeline's stages, each against a plain version on its own input."""

import corpus_pipeline
import pytest
from feedlake.llm.common import written
from feedlake.llm import mixing, quality, sharding, similar
from pyspark.sql import functions as F
from test_operators import components_by_brute_force

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf), "pipeline-test")
        out.append((name, docs))
    return dict(out)


def test_stages(spark, sf, steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]
    assert all(steps[n].columns == COLUMNS for n in list(steps)[:-1])
    ids = {n: [r.doc_id for r in d.select("doc_id").collect()] for n, d in steps.items()}

    labels = spark.read.parquet(f"{sf}/labels.parquet")
    good = quality.score_documents(steps["documents"], labels).filter("predicted = 1").select("doc_id").collect()
    assert sorted(ids["quality"]) == sorted(r.doc_id for r in good)

    rows = [(r.doc_id, r.text) for r in steps["quality"].collect()]
    brute = components_by_brute_force(rows, 5, 80)
    assert sorted(ids["near_duplicates"]) == sorted(i for i, (_, c) in brute.items() if i == c)

    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    import re

    def cut(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    windows = {tuple(w[i:i + 10]) for w in map(cut, items) if w for i in range(max(len(w) - 9, 1))}
    lengths = {len(w) for w in windows}
    clean = [r.doc_id for r in steps["near_duplicates"].collect() if not any(
        tuple(w[i:i + n]) in windows for w in [cut(r.text)] for n in lengths for i in range(len(w) - n + 1))]
    assert sorted(ids["decontamination"]) == sorted(clean)

    want = [r.doc_id for r in mixing.mix(steps["decontamination"]).collect() for _ in range(r.copies)]
    assert sorted(ids["mixing"]) == sorted(want)

    last = steps["sharding"]
    assert last.columns == [*COLUMNS, "shard", "slot"] and sorted(ids["sharding"]) == sorted(ids["mixing"])
    by = {}
    for r in last.collect():
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values()) and set(by) <= set(range(16))


def test_growing_moves_rows_only_into_the_new_shard(documents):
    rows = sharding.shard_documents(documents).collect()
    assert all(r.grown_shard in (r.shard, 16) for r in rows) and any(r.grown_shard == 16 for r in rows)


def test_weights_share_the_rows(spark):
    weights = [3.0, 1.0]
    out = sharding.assign(spark.range(4000).withColumnRenamed("id", "doc_id"), "doc_id", weights, cell_rows=100)
    counts = {r.shard: r["count"] for r in out.groupBy("shard").count().collect()}
    assert abs(counts[0] / 4000 - 0.75) < 0.03


def test_columns_named_like_inner_ones_stay(spark, sf):
    """The stages keep input columns whose names they use inside."""
    names = ["_text", "_crc", "_drop", "_row", "_cell", "_n", "_offset"]
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60).select("*", *[F.concat(F.lit(c), F.col("doc_id")).alias(c) for c in names])
    docs = written(docs, "pipeline-test")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    for out in (quality.filter_documents(docs, labels, threshold=0.0), sharding.shard_rows(docs), similar.keep_one(docs)):
        assert [c for c in out.columns if c not in ("shard", "slot")] == docs.columns
        rows = out.collect()
        assert rows and all(r[c] == f"{c}{r.doc_id}" for r in rows for c in names)
