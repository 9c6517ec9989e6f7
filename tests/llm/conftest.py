import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use inside
    *[T.StructField(c, T.StringType()) for c in ("size", "score", "shard", "digest", "fp", "node", "sig", "label", "n")]])


def sentence(rng: random.Random, n: int) -> str:
    vocab = ["the", "of", "And", "stone", "river", "élan", "über", "mañana", "x1", "42", "it's", "well-known", "end."]
    return " ".join(rng.choice(vocab) + rng.choice(["", "", "a", "ing", "ed"]) for _ in range(n))


def odd_texts() -> list:
    """Null, empty, white space, marks only, ties, copies, near copies, a shared passage, a very long text."""
    rng = random.Random(7)
    base, passage = sentence(rng, 120), sentence(rng, 60)
    words = base.split()
    near = [" ".join(words[:i] + ["swapped"] + words[i + 1:]) for i in (3, 60, 110)]
    return [None, "", "   \t\n", "!!! ***", "one", "one two", "One TWO", base, base, base.upper(), *near,
            sentence(rng, 40) + " " + passage + " " + sentence(rng, 30), passage + " " + sentence(rng, 80),
            sentence(rng, 20_000), sentence(rng, 9), "<|endoftext|> is text", "ÀÉ\u0301 \u00a0x\u2003y 漢字 ½ İ", sentence(rng, 300)]


@pytest.fixture(scope="session")
def odd_rows():
    rows = [(i, t, "en", f"s{i % 3}" if i % 5 else None, len(t or ""), *["clash"] * 9) for i, t in enumerate(odd_texts())]
    return rows + [(7, odd_texts()[7], "en", "s1", 1, *["again"] * 9), (None, "no id at all", None, None, None, *[None] * 9)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOCS).repartition(4)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
