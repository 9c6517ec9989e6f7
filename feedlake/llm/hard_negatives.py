"""Operator 13: hard negatives for anchors, by threshold joins over a pruned inverted index (L2AP style).

For each anchor: its positives (the best rows of its own label), then for each
positive the best rows of other labels whose score lies in a window below the positive's.

Vectors are whole numbers; a score is an inner product, computed exactly.
Every search is a threshold join, all (anchor, row) pairs that score t or more:

* Blocks. Rows are dealt by ranges of (label, vec_id), so a hot label fills many
  blocks, and packed into blocks of ``ROWS`` vectors; anchors likewise. A
  task joins one block of rows with one of anchors. Blocks of anchors are broadcast in portions of at most
  ``PORTION`` bytes; for positives only blocks with a common label meet.
* Index. Dimensions are ordered by energy and taken in groups. Of each row the index leaves out the last groups
  from which the suffix norms of row and anchors give less than any anchor's threshold;
  a row that is left out wholly is never looked at. A group's posting list is then the
  first rows in order of indexed length.
* Scores are accumulated list by list. After each, rows for which no anchor can reach its
  threshold with the remaining norms go. The groups left out are added for the remaining pairs only.
* Thresholds. They begin high and are lowered, round by round, for the anchors
  whose positives or windows are not full yet, at last to the window's end (for positives: none), so nothing is
  missed. What a task sends on is the best few of each window.

Defined cases: rows with a null label, vector or component, or one that is not
finite, take no part, nor do rows without an id; of rows with one vec_id the one with the
smallest (label, vector) counts; shorter vectors are filled up with zeros; ties go to the smaller vec_id; anchors
without positives, and windows without rows, give no rows; an empty table
gives an empty result; extra columns are ignored. Components are whole numbers
after scaling; scores are exact while they stay below 2**53.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.common import small_arrow_batches, written

ROWS, ANCHORS, GROUP = 2048, 512, 16
PORTION = 16 << 20
#: Thresholds for positives, as shares of the anchor's square norm; the last round has none.
POSITIVE_ROUNDS = (0.5, 0.25, 0.1, None)
#: Thresholds for negatives, as shares of the positive's score; the last round takes the window's lower end.
NEGATIVE_ROUNDS = (0.85, 0.7, None)

_BLOCK = "n int, ids binary, labels binary, q binary, own array<bigint>"


def prepare(rows: DataFrame, scale: int = 256, shift_every: int | None = None, classes: int = 10) -> DataFrame:
    """(vec_id, label, q): valid rows, one for each vec_id, components as whole numbers.

    ``shift_every`` k: rows whose vec_id is divisible by k get the next label (modulo ``classes``).
    """
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    label = F.col("label").cast("bigint")
    if shift_every:
        label = F.when(F.col("vec_id") % shift_every == 0, (label + 1) % classes).otherwise(label)
    valid = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & fine)
    whole = valid.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.struct(label.alias("label"), F.transform(
        "embedding", lambda x: F.floor(scale * x.cast("double")).cast("bigint")).alias("q")).alias("row"))
    return whole.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.*")


def _pack(size: int, dim: int, order: list[int], state: tuple[str, ...] = ()):
    """Blocks of up to ``size`` rows; ``state``: columns of ``windows`` numbers each that go along."""
    def block(parts: list[tuple]) -> pa.RecordBatch:
        ids, labels, q, more = (np.concatenate([p[i] for p in parts]) for i in range(4))
        return pa.RecordBatch.from_arrays(
            [pa.array([len(ids)], pa.int32()), pa.array([ids.tobytes()], pa.binary()), pa.array([labels.tobytes()], pa.binary()),
             pa.array([q.tobytes()], pa.binary()), pa.array([np.unique(labels).tolist()], pa.list_(pa.int64())),
             pa.array([more.tobytes()], pa.binary())], ["n", "ids", "labels", "q", "own", "state"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                lists = part.column("q")
                offsets = lists.offsets.to_numpy()
                flat = lists.values.to_numpy(zero_copy_only=False)
                counts = np.diff(offsets)
                q = np.zeros((part.num_rows, dim), np.int64)
                q[np.repeat(np.arange(len(counts)), counts), np.arange(offsets[0], offsets[-1]) - np.repeat(offsets[:-1], counts)] = \
                    flat[offsets[0]:offsets[-1]]
                more = [np.stack(part.column(c).to_pylist()).astype(np.int64) for c in state]
                parts.append((part.column("vec_id").to_numpy(), part.column("label").to_numpy(), q[:, order],
                              np.concatenate(more, axis=1) if more else np.zeros((part.num_rows, 0), np.int64)))
                held += part.num_rows
                while held >= size:
                    whole = tuple(np.concatenate([p[i] for p in parts]) for i in range(4))
                    yield block([tuple(x[:size] for x in whole)])
                    parts, held = [tuple(x[size:] for x in whole)], held - size
        if held:
            yield block(parts)

    return run


def scores_from(q: np.ndarray, x: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of all pairs with score >= t of the anchor. ``q``, ``x``: float64 whole numbers."""
    edges = list(range(0, q.shape[1], GROUP)) + [q.shape[1]]
    last = len(edges) - 1
    if not len(q) or not len(x):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def suffix_norms(m: np.ndarray) -> np.ndarray:
        parts = [np.einsum("ij,ij->i", m[:, a:b], m[:, a:b]) for a, b in zip(edges[:-1], edges[1:])]
        sums = np.cumsum(np.stack([*parts, np.zeros(len(m))], axis=1)[:, ::-1], axis=1)[:, ::-1]
        return np.sqrt(sums) * (1 + 1e-9)

    nq, nx = suffix_norms(q), suffix_norms(x)
    if (t > 0).all():
        reach = (nq / t[:, None]).max(axis=0)  # per group: the most that any anchor can add, in thresholds
        indexed = (nx * reach >= 1).sum(axis=1).clip(max=last)
    else:
        indexed = np.full(len(x), last)
    rows = np.argsort(-indexed, kind="stable")
    rows = rows[:int((indexed > 0).sum())]
    acc = np.zeros((len(q), len(rows)))
    for g in range(last):
        k = int((indexed[rows] > g).sum())
        if not k:
            break
        dims = slice(edges[g], edges[g + 1])
        acc[:, :k] += q[:, dims] @ x[rows[:k], dims].T
        hope = (acc[:, :k] + nq[:, g + 1, None] * nx[rows[:k], g + 1] >= t[:, None]).any(axis=0)
        live = np.concatenate((np.flatnonzero(hope), np.arange(k, len(rows))))
        if len(live) < 0.8 * len(rows):
            rows, acc = rows[live], acc[:, live]
    cut = indexed[rows]
    a, r = np.nonzero(acc + nq[:, cut] * nx[rows, cut] >= t[:, None])
    score = acc[a, r]
    rest = np.flatnonzero(cut[r] < last)
    for at in range(0, len(rest), 1 << 15):
        some = rest[at:at + (1 << 15)]
        out = np.arange(q.shape[1]) >= np.array(edges)[cut[r[some]]][:, None]
        score[some] += np.einsum("ij,ij->i", q[a[some]] * out, x[rows[r[some]]])
    ok = score >= t[a]
    return a[ok], rows[r[ok]], score[ok]


def _best(a: np.ndarray, ids: np.ndarray, score: np.ndarray, count: int) -> np.ndarray:
    """Positions of the ``count`` best of each anchor (higher score, then smaller id)."""
    order = np.lexsort((ids, -score, a))
    a = a[order]
    first = np.searchsorted(a, a, side="left")
    return order[np.arange(len(a)) - first < count]


def _read(batch: pa.RecordBatch, i: int, side: str, dim: int) -> tuple[np.ndarray, ...]:
    def numbers(name: str) -> np.ndarray:
        return np.frombuffer(batch.column(side + name)[i].as_buffer(), np.int64)

    return numbers("ids"), numbers("labels"), numbers("q").reshape(-1, dim).astype(np.float64)


def _found(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
    joined = [np.concatenate(x) for x in zip(*rows)] if rows else [np.zeros(0, np.int64)] * 4
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(joined, kinds)], ["anchor_id", "win", "vec_id", "score"])


_FOUND = "anchor_id bigint, win int, vec_id bigint, score bigint"


def _positive_batches(dim: int, share: float | None, count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, label in enumerate(batch.column("label").to_pylist()):
                ids, labels, q = _read(batch, i, "a_", dim)
                ids, q = ids[labels == label], q[labels == label]
                other, labels, x = _read(batch, i, "", dim)
                other, x = other[labels == label], x[labels == label]
                square = np.einsum("ij,ij->i", q, q)
                t = np.full(len(q), -np.inf) if share is None else np.ceil(share * square)
                a, r, score = scores_from(q, x, t)
                new = ids[a] != other[r]
                a, r, score = a[new], r[new], score[new]
                top = _best(a, other[r], score, count)
                out.append((ids[a[top]], np.zeros(len(top), np.int32), other[r[top]], score[top].astype(np.int64)))
            yield _found(out)

    return run


def _negative_batches(dim: int, windows: int, count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                ids, labels, q = _read(batch, i, "a_", dim)
                state = np.frombuffer(batch.column("a_state")[i].as_buffer(), np.int64).reshape(len(ids), 2, windows)
                low, high = state[:, 0], state[:, 1]
                other, theirs, x = _read(batch, i, "", dim)
                t = np.where(low <= high, low, np.iinfo(np.int64).max).min(axis=1).astype(np.float64)
                a, r, score = scores_from(q, x, t)
                apart = labels[a] != theirs[r]
                a, r, score = a[apart], r[apart], score[apart]
                for w in range(windows):
                    fit = np.flatnonzero((score >= low[a, w]) & (score <= high[a, w]))
                    top = fit[_best(a[fit], other[r[fit]], score[fit], count)]
                    out.append((ids[a[top]], np.full(len(top), w, np.int32), other[r[top]], score[top].astype(np.int64)))
            yield _found(out)

    return run


class _Search:
    """Blocks of the rows, and threshold joins of anchors with them."""

    def __init__(self, rows: DataFrame):
        self.spark = rows.sparkSession
        small_arrow_batches(self.spark)
        self.rows = written(rows, "negatives-rows")
        size = self.rows.agg(F.max(F.size("q")).alias("dim")).first()
        self.dim = max(1, size.dim or 0)
        energy = self.rows.select(F.posexplode("q").alias("at", "x")).groupBy("at").agg(
            F.sum(F.col("x").cast("double") * F.col("x").cast("double")).alias("e")).collect()  # one row a dimension
        self.order = sorted(range(self.dim), key=lambda d: (-dict(map(tuple, energy)).get(d, 0.0), d))
        dealt = self.rows.repartitionByRange("label", "vec_id").sortWithinPartitions("label", "vec_id")
        self.blocks = written(dealt.mapInArrow(_pack(ROWS, self.dim, self.order), _BLOCK + ", state binary"), "negatives-blocks")

    def pairs(self, anchors: DataFrame, same_label: bool, state: tuple[str, ...] = ()) -> DataFrame:
        """Every block of rows with every block of anchors (or with those that share a label)."""
        n = anchors.count()
        parts = max(1, -(-n // ANCHORS))
        packed = anchors.repartitionByRange(parts, "label", "vec_id").mapInArrow(
            _pack(ANCHORS, self.dim, self.order, state), _BLOCK + ", state binary")
        packed = written(packed.withColumn("g", F.spark_partition_id()), "negatives-anchors")
        packed = packed.select("g", *[F.col(c).alias(f"a_{c}") for c in ("ids", "labels", "q", "own", "state")])
        step = max(1, PORTION // (ANCHORS * (self.dim + 16) * 8))  # groups of anchors in a broadcast
        out = None
        for at in range(0, parts, step):
            portion = packed.filter((F.col("g") >= at) & (F.col("g") < at + step))
            if same_label:
                left = self.blocks.withColumn("label", F.explode("own"))
                met = left.join(F.broadcast(portion.withColumn("label", F.explode("a_own"))), "label")
            else:
                left = self.blocks.withColumn("g", F.explode(F.sequence(F.lit(at), F.lit(min(parts, at + step) - 1))))
                met = left.join(F.broadcast(portion), "g").withColumn("label", F.lit(None).cast("bigint"))
            met = met.select("label", "ids", "labels", "q", "a_ids", "a_labels", "a_q", "a_state")
            out = met if out is None else out.unionAll(met)
        return out


def _top(found: DataFrame, count: int) -> DataFrame:
    w = Window.partitionBy("anchor_id", "win").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= count)


def positives(search: _Search, anchors: DataFrame, count: int = 5) -> DataFrame:
    """(anchor_id, vec_id, score, rank): the best ``count`` other rows of each anchor's label."""
    done, open_ = None, anchors
    for share in POSITIVE_ROUNDS:
        met = search.pairs(open_, True).mapInArrow(_positive_batches(search.dim, share, count), _FOUND)
        top = written(_top(met, count), "negatives-positives")
        if share is not None:
            full = top.groupBy("anchor_id").agg(F.count("*").alias("n")).filter(F.col("n") == count).select("anchor_id")
            top = top.join(full, "anchor_id")
            open_ = open_.join(full, open_["vec_id"] == full["anchor_id"], "left_anti")
        done = top if done is None else done.unionByName(top)
        if share is None or open_.isEmpty():
            break
    return written(done.select("anchor_id", "vec_id", "score", "rank"), "negatives-best")


def negatives(search: _Search, anchors: DataFrame, best: DataFrame, count: int, low: int, high: int, windows: int) -> DataFrame:
    """(anchor_id, win, vec_id, score, rank): the best ``count`` rows of other labels in each positive's window."""
    s = F.col("score")
    span = best.select("anchor_id", (F.col("rank") - 1).alias("win"), s.alias("positive"),
                       F.expr(f"-((-{low} * score) div 100 - if((-{low} * score) % 100 < 0, 1, 0))").cast("bigint").alias("low"),
                       F.expr(f"({high} * score) div 100 - if(({high} * score) % 100 < 0, 1, 0)").cast("bigint").alias("high"))
    open_, done = written(span.filter("low <= high"), "negatives-windows"), None
    for share in NEGATIVE_ROUNDS:
        start = F.col("low") if share is None else F.greatest("low", F.ceil(F.lit(share) * F.col("positive")))
        live = open_.withColumn("start", start.cast("bigint")).withColumn("last", F.col("start") == F.col("low"))
        none = F.struct(F.lit(1).cast("bigint").alias("start"), F.lit(0).cast("bigint").alias("high"))
        spans = live.groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(
            F.struct("win", F.struct("start", "high")))).alias("m"))  # at most ``windows`` entries
        each = F.array(*[F.coalesce(F.try_element_at("m", F.lit(w)), none) for w in range(windows)])
        spans = spans.select("anchor_id", F.transform(each, lambda x: x["start"]).alias("lows"),
                             F.transform(each, lambda x: x["high"]).alias("highs"))
        asked = anchors.join(spans, anchors["vec_id"] == spans["anchor_id"]).drop("anchor_id")
        met = search.pairs(asked, False, ("lows", "highs")).mapInArrow(_negative_batches(search.dim, windows, count), _FOUND)
        top = written(_top(met, count), "negatives-found")
        full = top.groupBy("anchor_id", "win").agg(F.count("*").alias("n")).filter(F.col("n") == count)
        over = live.join(full, ["anchor_id", "win"], "left").withColumn("over", F.col("last") | F.col("n").isNotNull())
        over = written(over.select("anchor_id", "win", "positive", "low", "high", "over"), "negatives-over")
        top = top.join(over.filter("over").select("anchor_id", "win"), ["anchor_id", "win"])
        open_ = over.filter("not over").drop("over")
        done = top if done is None else done.unionByName(top)
        if share is None or open_.isEmpty():
            break
    return done


def mine(rows: DataFrame, anchor_every: int = 50, positive_count: int = 5, negative_count: int = 3, low: int = 50,
         high: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows``: vec_id, label, q (``prepare``). Anchors are the rows whose vec_id is divisible by
    ``anchor_every``; a negative scores ``low`` to ``high`` percent of the positive.
    """
    search = _Search(rows)
    anchors = written(search.rows.filter(F.col("vec_id") % anchor_every == 0), "negatives-queries")
    best = positives(search, anchors, positive_count)
    found = negatives(search, anchors, best, negative_count, low, high, positive_count)
    named = best.select("anchor_id", (F.col("rank") - 1).alias("win"), F.col("vec_id").alias("positive_id"),
                        F.col("score").alias("positive_score"))
    return found.join(named, ["anchor_id", "win"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    CAST(coalesce(list_sum(list_transform(list_zip(a.q, b.q, true), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.vec_id AS negative_id,
  p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
WINDOW w AS (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER w <= 3"""
