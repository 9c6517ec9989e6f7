"""Operator 12: document fingerprints, a homomorphic hash of the multiset of paragraphs.

A paragraph is what stands between two newlines (an empty line is one too).
Each gives a wide vector, and a document's fingerprint is the sum of its paragraphs'
vectors modulo powers of two, so it does not depend on their order, and a
paragraph is put in or taken out by adding or subtracting its vector: no
other part of the document is read again (``update``).

* ``WIDE`` lanes modulo 2**64 hold the paragraph's BLAKE2b digest. Two documents
  have equal lanes if and only if (but for collisions of the 512-bit sum)
  they have the same paragraphs, each as often.
* ``LANES`` lanes modulo 2**24 are a signed count sketch of the paragraph's
  three-word shingles (fewer words: all of them as one), A-Z in lower case: each
  adds +1 or -1 to one lane. Sums and differences of sketches are the sketches of sums and differences, so
  lanes of two documents give the cosine of their shingle counts.

``likeness`` of two fingerprints: 1 if they are equal, else that cosine (0 at least; 0 if a
document has no words). Its error is about 1 / sqrt(LANES). A lane holds
up to 2**23 shingles of one kind; beyond that it wraps, which only the likeness feels.

``edited`` is the query's edit: a document's second half gives way to the
start of the next document's text (largest doc_id first, after the last the first again). Rows go to buckets
by ranges of (doc_id, text hash, row) with sampled boundaries, so a doc_id with very
many rows fills several buckets. Texts are shuffled once; of each bucket's
first row a copy goes to the bucket before, as the successor of its last row. The edited
fingerprint is an update: paragraphs from the cut on out, the new ones in.

Defined cases: null counts as empty; the empty text is one empty paragraph; very long texts are treated
whole; null doc_ids come last in the order; rows with one doc_id follow each
other by text hash (identical rows are each other's successors); an only row is its own
successor; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import small_arrow_batches, text_of, written
from feedlake.llm.words import BASE, blocks, mix, window_hashes, word_hashes
from feedlake.operators.scan import boundaries, bucket_of

WIDE, LANES, LANE_BYTES, SHINGLE = 8, 192, 3, 3

Vectors = tuple[np.ndarray, np.ndarray]


def _shingles(paragraphs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and paragraph number of every shingle; none crosses paragraphs."""
    h, owner = word_hashes(paragraphs)
    whole = window_hashes(h, SHINGLE)
    inside = owner[:len(whole)] == owner[SHINGLE - 1:] if len(whole) else np.zeros(0, bool)
    counts = np.bincount(owner, minlength=len(paragraphs))
    short = (counts > 0) & (counts < SHINGLE)
    firsts = np.searchsorted(owner, np.flatnonzero(short))
    lasts = firsts + counts[short] - 1
    few = mix(mix(h[firsts]) * np.uint64(BASE) + h[lasts] + counts[short].astype(np.uint64))
    return np.concatenate((whole[inside], few)), np.concatenate((owner[:len(whole)][inside], np.flatnonzero(short)))


def vectors(texts: list[bytes]) -> Vectors:
    """Vectors of texts, each the sum over its paragraphs: (n, WIDE) unsigned and (n, LANES) signed numbers."""
    wide, lanes = np.zeros((len(texts), WIDE), np.uint64), np.zeros((len(texts), LANES), np.int64)
    for lo, hi in blocks(texts):
        split = [t.split(b"\n") for t in texts[lo:hi]]
        starts = np.cumsum([0, *map(len, split)])
        flat = [p for ps in split for p in ps]
        raw = b"".join([hashlib.blake2b(p, digest_size=8 * WIDE).digest() for p in flat])
        wide[lo:hi] = np.add.reduceat(np.frombuffer(raw, "<u8").reshape(-1, WIDE), starts[:-1], axis=0)
        f, paragraph = _shingles(flat)
        text = np.searchsorted(starts, paragraph, side="right") - 1
        cell = text * LANES + (mix(f ^ np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(32)).astype(np.int64) % LANES
        sign = 1.0 - 2.0 * (f & np.uint64(1)).astype(np.float64)
        lanes[lo:hi] = np.bincount(cell, sign, (hi - lo) * LANES).astype(np.int64).reshape(-1, LANES)
    return wide, centred(lanes)


def centred(lanes: np.ndarray) -> np.ndarray:
    """Lanes modulo 2**24, as numbers around 0."""
    top = 1 << (8 * LANE_BYTES)
    return (lanes + top // 2) % top - top // 2


def put(a: Vectors, b: Vectors) -> Vectors:
    """Fingerprints of the multisets' sums."""
    return a[0] + b[0], centred(a[1] + b[1])


def take(a: Vectors, b: Vectors) -> Vectors:
    """Fingerprints of the multisets' differences."""
    return a[0] - b[0], centred(a[1] - b[1])


def rows_of(v: Vectors, at: np.ndarray) -> Vectors:
    return v[0][at], v[1][at]


def to_text(v: Vectors) -> list[str]:
    """Base64 of the wide lanes, then the sketch lanes, little-endian."""
    n = len(v[0])
    sketch = np.ascontiguousarray(v[1].astype("<i4")).view(np.uint8).reshape(n, LANES, 4)[:, :, :LANE_BYTES]
    raw = np.concatenate((v[0].astype("<u8").view(np.uint8).reshape(n, -1), sketch.reshape(n, -1)), axis=1)
    return [base64.b64encode(r.tobytes()).decode() for r in raw]


def from_text(texts: list[str]) -> Vectors:
    raw = np.frombuffer(b"".join(map(base64.b64decode, texts)), np.uint8).reshape(len(texts), -1)
    wide = np.ascontiguousarray(raw[:, :8 * WIDE]).view("<u8")
    sketch = raw[:, 8 * WIDE:].reshape(len(texts), LANES, LANE_BYTES).astype(np.int64)
    return wide.astype(np.uint64), centred(sketch @ (1 << (8 * np.arange(LANE_BYTES))))


def likeness(a: Vectors, b: Vectors) -> np.ndarray:
    """1 for equal fingerprints, else the cosine of the sketches, 0 at least."""
    x, y = a[1].astype(np.float64), b[1].astype(np.float64)
    dot, size = (x * y).sum(axis=1), (x * x).sum(axis=1) * (y * y).sum(axis=1)
    cosine = np.clip(dot / np.sqrt(np.where(size > 0, size, 1.0)), 0.0, 1.0)
    same = (a[0] == b[0]).all(axis=1) & (a[1] == b[1]).all(axis=1)
    return np.where(same, 1.0, cosine)


def _print_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        v = vectors(batch.column("text").cast(pa.binary()).to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(to_text(v), pa.string())], ["doc_id", "fingerprint"])


def fingerprint(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint of every text. A map over rows, no shuffle."""
    small_arrow_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(_print_batches, f"doc_id {kind}, fingerprint string")


def update(prints: Column, removed: Column, added: Column) -> Column:
    """Fingerprints after the paragraphs of ``removed`` went and those of ``added`` came (texts; null: no change)."""
    @F.pandas_udf("string")
    def changed(old: pd.Series, out: pd.Series, new: pd.Series) -> pd.Series:
        v = from_text(old.tolist())
        for step, texts in ((take, out), (put, new)):
            some = np.flatnonzero(texts.notna().to_numpy())
            if len(some):
                w = step(rows_of(v, some), vectors([t.encode() for t in texts.iloc[some]]))
                v[0][some], v[1][some] = w
        return pd.Series(to_text(v))

    return changed(prints, removed, added)


def _edited_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs every row with its successor in its bucket; ``carried`` rows are only successors."""
    held: tuple | None = None  # the last row, if it still waits for its successor
    for batch in batches:
        texts = batch.column("text").to_pylist()
        raw = [t.encode() for t in texts]
        for lo, hi in blocks(raw):
            own = vectors(raw[lo:hi])
            keys = batch.column("bucket").slice(lo, hi - lo).to_pylist()
            carried = batch.column("carried").slice(lo, hi - lo).to_pylist()
            rows = list(zip(keys, carried, batch.column("doc_id").slice(lo, hi - lo).to_pylist(), texts[lo:hi]))
            if held is not None:
                rows.insert(0, held[0])
                own = tuple(np.concatenate((a, b)) for a, b in zip(held[1], own))
            at = [i for i in range(len(rows) - 1) if rows[i][0] == rows[i + 1][0] and not rows[i][1]]
            held = (rows[-1], rows_of(own, np.array([len(rows) - 1])))
            if not at:
                continue
            gone, come, digests = [], [], []
            for i in at:
                text, successor = rows[i][3], rows[i + 1][3]
                half = len(text) // 2
                keep = text[:len(text) - half]
                cut = keep.rfind("\n") + 1
                gone.append(text[cut:].encode())
                new = keep[cut:] + successor[:half]
                come.append(new.encode())
                digests.append(hashlib.sha256((keep[:cut] + new).encode()).hexdigest())
            mine, following = rows_of(own, np.array(at)), rows_of(own, np.array(at) + 1)
            after = put(take(mine, vectors(gone)), vectors(come))
            yield pa.RecordBatch.from_arrays(
                [pa.array([rows[i][2] for i in at], batch.schema.field("doc_id").type),
                 pa.array([len(rows[i][3]) for i in at], pa.int64()), pa.array(digests, pa.string()),
                 pa.array(to_text(mine), pa.string()), pa.array(to_text(after), pa.string()),
                 pa.array(likeness(mine, after)), pa.array(likeness(mine, following))],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def edited(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    spark = docs.sparkSession
    small_arrow_batches(spark)
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    order = ["o0", "o1", "o2", "o3"]
    rows = docs.select(
        "doc_id", text_of().alias("text"), F.col("doc_id").isNull().alias("o0"),
        F.bitwise_not(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0))).alias("o1"),
        F.xxhash64(text_of()).alias("o2"), F.monotonically_increasing_id().alias("o3"))
    keys = written(rows.select(*order), "fingerprint-keys")
    bounds = boundaries(keys, order, n)
    # one row for each bucket: its first key. A bucket's successor is the first key of the next bucket that has one.
    # o3 may differ between two reads of a table whose row order is not fixed: only identical rows are told apart by it.
    firsts = {r.b: tuple(r.k) for r in keys.groupBy(bucket_of(keys, order, bounds).alias("b")).agg(
        F.min(F.struct(*order[:3])).alias("k")).collect()}
    if not firsts:
        return spark.createDataFrame([], f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, "
                                         "edited_fingerprint string, near_edited double, near_next double")
    full = sorted(firsts)
    after = [(b, *firsts[next((f for f in full if f > b), full[0])]) for b in range(len(bounds) + 1)]
    successors = F.broadcast(spark.createDataFrame(after, "bucket int, o0 boolean, o1 bigint, o2 bigint"))  # one row a bucket
    carried = rows.drop("o3").join(successors, order[:3]).groupBy("bucket").agg(
        F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
    placed = rows.withColumn("bucket", bucket_of(rows, order, bounds)).withColumn("carried", F.lit(False))
    both = placed.unionByName(carried.withColumn("carried", F.lit(True)), allowMissingColumns=True)
    dealt = both.repartitionById(len(bounds) + 1, F.col("bucket").cast("int")).sortWithinPartitions("bucket", "carried", *order)
    return dealt.select("bucket", "carried", "doc_id", "text").mapInArrow(
        _edited_batches, f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                         "near_edited double, near_next double")
