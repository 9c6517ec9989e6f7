"""Operator 9: passages that repeat across documents, by a sparse suffix array.

Only suffixes that start at a minimiser are kept: of every ``SPREAD``
consecutive ``GRAM``-word grams the one with the smallest hash (the first on
a tie). The choice depends on the words alone, so two documents that share
``MIN_WORDS`` words keep a suffix at the same place of the shared passage, at
most SPREAD - 1 words after its start; the suffixes agree on
``MIN_WORDS - SPREAD + 1`` words at least, their lead.

1. Sort: suffixes are range-partitioned and sorted by the words of their lead (16 bits of each word's
   hash, so a suffix is some 50 bytes), then by text. Sampled boundaries are (lead, text) pairs: a passage in
   very many documents spans tasks.
2. Compare neighbours: a suffix whose common prefix with the row before or after it fills the lead is matched; rows
   stream by and only the last one is held. The first and last row of a partition also go to a
   small table (two rows a partition), which finds matches across partition boundaries.
3. Extend left and right: around each matched suffix, the windows of MIN_WORDS words that have it as their
   minimiser reach up to SPREAD - 1 words to its left and on to its right; they are aggregated by 96 bits of
   whole word hashes. (The neighbour with the longest common prefix to the right need not be the one that agrees
   on the left, so an extension towards one neighbour would miss matches.) A window found in two
   documents is repeated; overlapping windows merge into maximal passages.

Documents with equal word sequences form a class and are searched once (a hot
copy is indexed once a task); a class with several documents of MIN_WORDS
words or more repeats as a whole.

``find`` returns one row for each document with a repeated passage: doc_id,
n_words, n_repeated, spans (start and end word), n_cut and cut, the spans that
a document with a smaller doc_id has too. Documents without one have no row.

Words are runs of other than ASCII white space, A-Z lower-cased.

Defined cases: null, empty and short texts have no passages; rows with null
doc_id are left out; repeated rows (equal doc_id) are one document; an empty
table gives an empty result; extra columns are ignored. Repeats within one document
only are not reported.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import bounded_broadcast, small_arrow_batches, text_of, written
from feedlake.llm.words import BASE, blocks, long_window_hashes, mix, window_hashes, word_hashes

MIN_WORDS, GRAM, SPREAD = 50, 8, 25
#: Digests of texts that a task remembers as indexed; beyond it a copy is indexed again, which the sort takes out.
SEEN = 200_000
_CHECK = np.uint64(0xC2B2AE3D27D4EB4F)  # fixed value: makes a second, independent hash of a window


def _digests(h: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int]]:
    """128-bit digests of word sequences, from position-weighted sums."""
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        at = np.arange(b - a, dtype=np.uint64)
        x, y = mix(h[a:b] + mix(at)), mix(h[a:b] ^ mix(at + np.uint64(0x9E3779B9)))
        out.append(tuple(int(v.sum(dtype=np.uint64).view(np.int64)) for v in (x, y)))
    return out


def _minimisers(h: np.ndarray, owner: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts of all windows of ``words`` words inside one text, each window's minimiser position)."""
    starts = np.flatnonzero(owner[: max(len(owner) - words + 1, 0)] == owner[words - 1:])
    if not len(starts):
        return starts, starts
    view = np.lib.stride_tricks.sliding_window_view(window_hashes(h, GRAM), SPREAD)
    return starts, starts + view[starts].argmin(axis=1)


def _codes(h: np.ndarray) -> np.ndarray:
    """16 bits of each word's hash: what suffixes are sorted by."""
    return h >> np.uint64(48)


def _suffix_batches(words: int, most_seen: int):
    """Distinct (lead, h1) of the sparse suffixes of each text; equal texts are indexed once a task."""
    lead = words - SPREAD + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for lo, hi in blocks(texts):
                h, owner = word_hashes(texts[lo:hi])
                bounds = np.searchsorted(owner, np.arange(hi - lo + 1))
                ids = _digests(h, bounds)
                new = np.zeros(hi - lo, bool)
                if len(seen) > most_seen:
                    seen.clear()
                for i, d in enumerate(ids):
                    if d not in seen and bounds[i + 1] - bounds[i] >= words:
                        seen.add(d)
                        new[i] = True
                starts, low = _minimisers(h, owner, words)
                at = np.unique(low[new[owner[starts]]]) if len(starts) else starts
                if len(at):
                    codes = _codes(h)
                    key, text = long_window_hashes(codes, lead)[at], owner[at]
                    order = np.lexsort((key, text))  # a passage that fills a text has one lead many times
                    key, text, at = key[order], text[order], at[order]
                    first = np.concatenate(([True], (key[1:] != key[:-1]) | (text[1:] != text[:-1])))
                    node = np.array([d[0] for d in ids], np.int64)[text[first]]
                    leads = np.lib.stride_tricks.sliding_window_view(codes.astype(">u2"), lead)[at[first]]
                    ends = np.arange(len(node) + 1, dtype=np.int32) * np.int32(2 * lead)
                    column = pa.Array.from_buffers(pa.binary(), len(node), [None, pa.py_buffer(ends), pa.py_buffer(leads.tobytes())])
                    yield pa.RecordBatch.from_arrays([column, pa.array(node)], ["lead", "h1"])

    return run


def _neighbour_batches(words: int):
    """(key, h1, edge) of sorted suffixes that share their lead with a neighbour of another text, and of the partition's edges."""
    lead = words - SPREAD + 1
    power = np.array([pow(BASE, i, 1 << 64) for i in range(lead)], np.uint64)

    def rows(leads: np.ndarray, text: np.ndarray, edge: bool) -> pa.RecordBatch:
        key = mix((mix(leads.astype(np.uint64)) * power).sum(axis=1, dtype=np.uint64))  # long_window_hashes of the codes
        return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(text), pa.array(np.full(len(text), edge))],
                                          ["key", "h1", "edge"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row before: its lead, its text, whether it agrees with the row before it
        for batch in batches:
            if not batch.num_rows:
                continue
            leads = np.frombuffer(b"".join(batch.column("lead").to_pylist()), ">u2").reshape(-1, lead)
            text = batch.column("h1").to_numpy()
            if held is None:
                yield rows(leads[:1], text[:1], True)
                held = leads[:0], text[:0], np.zeros(0, bool)
            leads, text = np.concatenate((held[0], leads)), np.concatenate((held[1], text))
            agree = (leads[1:] == leads[:-1]).all(axis=1)
            other = np.concatenate(([True], ~agree | (text[1:] != text[:-1])))  # a text indexed twice is one row
            before = np.concatenate((held[2] if len(held[2]) else [False], agree))[other]
            leads, text = leads[other], text[other]
            held = leads[-1:], text[-1:], before[-1:]
            matched = before[:-1] | before[1:]
            yield rows(leads[:-1][matched], text[:-1][matched], False)
        if held is not None:
            yield rows(held[0][held[2]], held[1][held[2]], False)
            yield rows(held[0], held[1], True)

    return run


def _class_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for lo, hi in blocks(texts):
            h, owner = word_hashes(texts[lo:hi])
            bounds = np.searchsorted(owner, np.arange(hi - lo + 1))
            ids = _digests(h, bounds)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(lo, hi - lo), pa.array(np.diff(bounds).astype(np.int64)),
                 pa.array([d[0] for d in ids], pa.int64()), pa.array([d[1] for d in ids], pa.int64())],
                ["doc_id", "n_words", "h1", "h2"])


def _window_batches(words: int):
    """(key, check, node, at, more) of the windows whose minimiser starts one of the row's suffixes.

    A key stands once for a document: ``more`` holds its further places, and is null for nearly all.
    """
    lead = words - SPREAD + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            kind = batch.schema.field("node").type
            for text, node, keys in zip(texts, batch.column("node").to_pylist(), batch.column("keys").to_pylist()):
                h, owner = word_hashes([text])
                starts, low = _minimisers(h, owner, words)
                at = starts[np.isin(long_window_hashes(_codes(h), lead)[low].view(np.int64), np.array(keys, np.int64))]
                key, check = long_window_hashes(h, words)[at], long_window_hashes(h ^ _CHECK, words)[at] >> np.uint64(32)
                order = np.lexsort((check, key))
                key, check, at = key[order], check[order].astype(np.uint32), at[order].astype(np.int32)
                cut = (np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (check[1:] != check[:-1]))))
                       if len(key) else at)
                ends = np.append(cut[1:], len(key)) if len(key) else at
                more = [at[a + 1:b] if b - a > 1 else None for a, b in zip(cut.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[cut].view(np.int64)), pa.array(check[cut].view(np.int32)), pa.array([node] * len(cut), kind),
                     pa.array(at[cut]), pa.array(more, pa.list_(pa.int32()))], ["key", "check", "node", "at", "more"])

    return run


def _merged(starts: np.ndarray, words: int) -> list[dict]:
    if not len(starts):
        return []
    starts = np.unique(starts)
    breaks = np.flatnonzero(np.diff(starts) > words) + 1
    return [{"start": int(g[0]), "end": int(g[-1]) + words} for g in np.split(starts, breaks)]


def _span_batches(words: int):
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [[_merged(np.array(x if x is not None else [], np.int64), words) for x in batch.column(c).to_pylist()]
                    for c in ("all", "later")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), *[pa.array(b, spans) for b in both]],
                                             ["node", "spans", "cut"])

    return run


def _shared(rows: DataFrame, by: list[str], who: str) -> DataFrame:
    """Rows whose key also occurs with another value of ``who``; adds ``first``, the smallest value."""
    keys = rows.groupBy(*by).agg(F.min(who).alias("first"), F.max(who).alias("last")).filter("first < last")
    return rows.join(keys.select(*by, "first"), by)


def find(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document with a passage that another document has too."""
    if min_words < GRAM + SPREAD:
        raise ValueError(f"passages need at least {GRAM + SPREAD} words")
    small_arrow_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", text_of().alias("text"))
    rows = written(texts.mapInArrow(_class_batches, f"doc_id {kind}, n_words bigint, h1 bigint, h2 bigint")
                   .filter(F.col("n_words") >= min_words), "suffix-rows")
    classes = written(rows.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("node"), F.max("doc_id").alias("last"), F.first("n_words").alias("n_words")), "suffix-classes")

    # written, since the sort reads it twice (once for the boundaries)
    sparse = written(texts.select("text").mapInArrow(_suffix_batches(min_words, SEEN), "lead binary, h1 bigint"), "suffix-sparse")
    ordered = sparse.repartitionByRange("lead", "h1").sortWithinPartitions("lead", "h1")
    compared = written(ordered.mapInArrow(_neighbour_batches(min_words), "key bigint, h1 bigint, edge boolean"), "suffix-matched")
    across = _shared(compared.filter("edge"), ["key"], "h1").select("h1", "key")
    matched = compared.filter(~F.col("edge")).select("h1", "key").unionByName(across)
    keys = (matched.join(classes.select("h1", "node"), "h1")
            .groupBy("node").agg(F.collect_set("key").alias("keys")))
    keys = written(keys, "suffix-keys")
    # few ids are broadcast so that only their texts are shuffled; the keys never are broadcast
    again = texts.withColumnRenamed("doc_id", "node").join(bounded_broadcast(keys.select("node")), "node", "left_semi")
    again = again.join(keys, "node")
    windows = written(again.mapInArrow(_window_batches(min_words), f"key bigint, check int, node {kind}, at int, more array<int>"), "suffix-windows")
    places = F.concat(F.array("at"), F.coalesce("more", F.array().cast("array<int>")))
    repeated = _shared(windows, ["key", "check"], "node").withColumn("places", F.when(F.col("more").isNull(), F.array("at")).otherwise(places))
    repeated = repeated.groupBy("node").agg(
        F.flatten(F.collect_list("places")).alias("all"),
        F.flatten(F.collect_list(F.when(F.col("node") != F.col("first"), F.col("places")))).alias("later"))
    span = "array<struct<start:int,end:int>>"
    found = written(repeated.mapInArrow(_span_batches(min_words), f"node {kind}, spans {span}, cut {span}"), "suffix-spans")

    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end")))
    none = F.array().cast(span)
    out = rows.select("doc_id", "h1", "h2").distinct().join(classes, ["h1", "h2"]).join(found, "node", "left")
    out = out.select("doc_id", "n_words",
                     F.when(F.col("node") < F.col("last"), whole).otherwise(F.coalesce("spans", none)).alias("spans"),
                     F.when(F.col("doc_id") != F.col("node"), whole).otherwise(F.coalesce("cut", none)).alias("cut"))

    def total(c: str):
        return F.aggregate(c, F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])

    return out.filter(F.size("spans") > 0).select("doc_id", "n_words", total("spans").alias("n_repeated"), "spans",
                                                  total("cut").alias("n_cut"), "cut")
