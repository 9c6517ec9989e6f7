"""Operator 2: quality classifier, a regularised quadratic discriminant on document statistics.

Features are statistics of the whole text (``FEATURES``), transformed to be
nearly Gaussian: shares by the arcsine of their root, sizes by logarithms.
Each class gets a mean and a covariance shrunk towards the pooled covariance
(``TO_POOLED``) and towards a multiple of the identity (``TO_IDENTITY``). The
score is the posterior of label 1: half Mahalanobis distances and log
determinants come from Cholesky factors computed once and shipped in the
task's closure.

Training uses labelled rows only, never the held-out fold, and at most
``TRAIN_ROWS`` of them, those with the smallest hash of doc_id (this bound is
a parameter; it also bounds the broadcast that picks the rows, and the
moments are small sums). Scoring is one pass over all documents, in Arrow
batches; only batch-sized data is held. Rows of a text that repeats are
scored alike.

Defined cases: null and empty texts have all statistics 0 and are scored like
any other; rows with null doc_id or null label do not train; documents with
several labels train once per label row; with no training rows, or one class only,
every score is that class's share (1.0 with none); repeated rows give repeated
results; an empty table gives an empty result; extra columns are ignored
by ``score_documents`` and kept by ``filter_documents``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import small_arrow_batches, text_of

FEATURES = ("log_bytes", "upper", "digits", "bang", "bar", "marks", "stops", "non_ascii", "word_length", "long_words",
            "new_words", "new_pairs", "same_next", "line_words", "marked_words")
TO_POOLED, TO_IDENTITY = 0.1, 0.02
TRAIN_ROWS = 20_000
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3

_MARKS = np.zeros(256)
_MARKS[list(b"#$%&*+/<=>@[]\\^_`{}~")] = 1
_END_MARKS = frozenset(b"!#$%&*|@^~=+<>")


def _statistics(text: bytes) -> list[float]:
    if not text:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n = len(text)
    upper, lower = counts[65:91].sum(), counts[97:123].sum()
    words = text.split()
    k = max(len(words), 1)
    distinct = len(set(words))
    pairs = len(set(zip(words, words[1:])))
    same = sum(map(bytes.__eq__, words, words[1:]))
    marked = sum(w[-1] in _END_MARKS for w in words)
    black = max(n - counts[9:14].sum() - counts[32], 1)
    root = np.sqrt
    shares = np.array([upper / max(upper + lower, 1), counts[48:58].sum() / black, counts[33] / black,
                       counts[124] / black, counts @ _MARKS / black, counts[46] / k, counts[128:].sum() / n])
    up, digits, bang, bar, marks, stops, high = np.arcsin(root(np.minimum(shares, 1.0)))
    return [np.log1p(n), up, digits, bang, bar, marks, stops, high, np.log(black / k),
            np.arcsin(root(max(map(len, words), default=0) / n)), np.log(distinct / k) if words else 0.0,
            np.log((pairs + 1) / k), np.arcsin(root(same / k)), np.log(k / (counts[10] + 1)), np.arcsin(root(marked / k))]


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    return np.array([_statistics(t) for t in texts], float).reshape(len(texts), len(FEATURES))


@dataclass(frozen=True)
class Model:
    """Two Gaussians over standardised statistics; ``prior`` alone if one class was never seen."""

    prior: float
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    centers: tuple = ()
    factors: tuple = ()

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.mean is None:
            return np.full(len(x), self.prior)
        z = (x - self.mean) / self.scale
        logs = []
        for center, factor, share in zip(self.centers, self.factors, (1.0 - self.prior, self.prior)):
            half = np.linalg.solve(factor, (z - center).T)
            logs.append(np.log(share) - 0.5 * (half * half).sum(0) - np.log(np.diag(factor)).sum())
        return 1.0 / (1.0 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def fit(moments: dict[int, tuple[int, np.ndarray, np.ndarray]], to_pooled: float = TO_POOLED,
        to_identity: float = TO_IDENTITY) -> Model:
    """``moments``: class -> (rows, sums, sums of products)."""
    seen = {k: m for k, m in moments.items() if m[0] > 0}
    total = sum(m[0] for m in seen.values())
    prior = seen.get(1, (0,))[0] / total if total else 1.0
    if len(seen) < 2:
        return Model(prior)
    d = len(FEATURES)
    mean = sum(m[1] for m in seen.values()) / total
    var = np.diag(sum(m[2] for m in seen.values())) / total - mean**2
    scale = np.sqrt(np.maximum(var, 1e-12)) + 1e-9
    centers, covs = [], []
    for k in (0, 1):
        n, s, p = seen[k]
        mu = s / n
        centers.append((mu - mean) / scale)
        covs.append((p / n - np.outer(mu, mu)) / np.outer(scale, scale))
    pooled = sum(seen[k][0] * covs[k] for k in (0, 1)) / total
    factors = []
    for c in covs:
        c = (1 - to_pooled) * c + to_pooled * pooled
        c = (1 - to_identity) * c + to_identity * max(np.trace(c) / d, 1e-6) * np.eye(d)
        factors.append(np.linalg.cholesky((c + c.T) / 2))
    return Model(prior, mean, scale, tuple(centers), tuple(factors))


def held_out(doc_id="doc_id"):
    """True for the fold that never trains: crc32 of the id's text, modulo FOLDS."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == HELD_OUT


def _partial_moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and class: rows, sums and products."""
    d = len(FEATURES)
    sums = {k: [0, np.zeros(d), np.zeros((d, d))] for k in (0, 1)}
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            x = statistics(part.column("text").cast(pa.binary()).to_pylist())
            y = part.column("label").to_numpy(zero_copy_only=False)
            for k, m in sums.items():
                z = x[y == k]
                m[0] += len(z)
                m[1] += z.sum(0)
                m[2] += z.T @ z
    yield pa.RecordBatch.from_arrays(
        [pa.array([0, 1], pa.int32()), pa.array([sums[0][0], sums[1][0]], pa.int64()),
         pa.array([sums[k][1].tolist() + sums[k][2].ravel().tolist() for k in (0, 1)])], ["label", "n", "sums"])


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Fit on at most ``train_rows`` labelled rows outside the held-out fold."""
    small_arrow_batches(docs.sparkSession)
    d = len(FEATURES)
    picked = (labels.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("label"))
              .filter(F.col("_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out("_id"))
              .orderBy(F.xxhash64(F.col("_id").cast("string")), "_id", "label").limit(train_rows))
    rows = docs.select("doc_id", text_of().alias("text")).join(
        F.broadcast(picked), F.col("doc_id") == F.col("_id")).select("text", "label")
    parts = rows.mapInArrow(_partial_moments, "label int, n bigint, sums array<double>").filter("n > 0")
    size = d + d * d
    total = parts.groupBy("label").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(size)]).alias("sums")).collect()
    moments = {}
    for r in total:
        s = np.array(r.sums)
        moments[r.label] = (r.n, s[:d], s[d:].reshape(d, d))
    return fit(moments)


def _score_batches(model: Model, columns: list[str], threshold: float, keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = part.column("_text").cast(pa.binary()).to_pylist()
                score = model.score(statistics(texts)) if texts else np.zeros(0)
                if keep:
                    yield part.filter(pa.array(score >= threshold)).select(columns)
                else:
                    yield pa.RecordBatch.from_arrays([*[part.column(c) for c in columns], pa.array(score)],
                                                     [*columns, "score"])

    return run


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
                    train_rows: int = TRAIN_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = train(docs, labels, train_rows)
    rows = docs.select("doc_id", text_of().alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(_score_batches(model, ["doc_id"], threshold, False), f"doc_id {kind}, score double")
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def filter_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
                     train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The documents whose score reaches the threshold, with all their columns."""
    model = train(docs, labels, train_rows)
    rows = docs.select(F.struct(*docs.columns).alias("_row"), text_of().alias("_text"))
    return rows.mapInArrow(_score_batches(model, ["_row"], threshold, True), rows.drop("_text").schema).select("_row.*")
