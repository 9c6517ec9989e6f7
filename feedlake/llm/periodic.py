"""Operator 11: periodic runs of words, by an online sparse diagonal DP.

A run of period q is a stretch of consecutive words in which words q apart
are identical, that no neighbouring word extends. In the DP over (word, lag)
it is a diagonal: the match length at word i and lag q is one more than that
at word i - 1 if words i and i - q are identical, else the diagonal ends. A
diagonal that ends after ``least(q) - q`` matches or more is a run and is
emitted there.

Sparse. Letting every earlier occurrence of every word open a diagonal is
quadratic in a text's frequent words. A run's diagonal matches at (exponent -
1) * q words in a row, so for lags from L to 2L (L a power of two) a diagonal is
opened only where the window of L words at i has an occurrence at i - q:

* lags below ``DENSE`` have every diagonal open (a few vector comparisons);
* larger ones take occurrences from lists of equal window hashes. The
  candidates of 2L are those windows of L that occur again within the longest
  period, so ordinary text leaves few after the first list.
* a window whose first half occurs again within a quarter of it opens
  nothing. All other windows of L words have occurrences more than L / 4 apart, at most
  seven at lags below 2L, whatever the text. No run is lost: if all
  windows of a run had such a short period, the run had it too.

Diagonals are followed word by word on identical words; hashes only open
them. A diagonal whose lag is a multiple of the smallest period gives the same
stretch, so of equal stretches the smallest lag stays.

A task holds one block of texts (about 1 MB, or one longer text) and arrays of
its size. Texts never meet, so no row needs a shuffle.

Defined cases: null, empty and wordless texts have no run and the empty
collapsed text; very long texts are treated whole; ties in the longest
exponent take the smallest start, then period; a null doc_id is a row like others (and is
never edited by ``repeat_part``); repeated rows give one row each; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import small_arrow_batches, text_of
from feedlake.llm.words import BASE, blocks, mix

SHORTEST, EXPONENT = 6, 4
#: Lags from here on need a window occurrence to open a diagonal (a power of two).
DENSE = 16
FAR = np.iinfo(np.int64).max

Run = tuple[int, int, int]
Edit = Callable[[object, list[bytes]], list[bytes]]


def _stretches(ids: np.ndarray, q: int, need: int) -> Iterator[tuple[int, int]]:
    """All (first, end) of at least ``need`` matches in a row on diagonal q."""
    ends = np.flatnonzero(ids[q:] != ids[:-q])
    edges = np.concatenate(([-1], ends, [len(ids) - q])) + q
    for k in np.flatnonzero(np.diff(edges) > need).tolist():
        yield int(edges[k]) + 1, int(edges[k + 1])


def _matches(ids: np.ndarray, i: int, q: int, step: int) -> int:
    """Matches on diagonal q from word i on (step 1) or from word i - 1 back (step -1)."""
    total, size = 0, 64
    while True:
        if step > 0:
            size = min(size, len(ids) - i - total)
            a = ids[i + total:i + total + size]
            b = ids[i - q + total:i - q + total + size]
        else:
            size = min(size, i - q - total)
            a = ids[i - total - size:i - total][::-1]
            b = ids[i - q - total - size:i - q - total][::-1]
        if size <= 0:
            return total
        bad = np.flatnonzero(a != b)
        if len(bad):
            return total + int(bad[0])
        total, size = total + size, size * 4


def _openers(h: np.ndarray, at: np.ndarray, shut: np.ndarray, size: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Occurrence lists of one window size.

    ``h``: window hash of each position ``at`` (ascending); ``shut``: positions that open nothing. Returns (position, lag)
    of diagonals to open, the positions whose window occurs again within ``most`` words, and each position's distance
    to the next occurrence.
    """
    order = np.argsort(h, kind="stable")
    h, at = h[order], at[order]
    gap = np.where(h[1:] == h[:-1], at[1:] - at[:-1], FAR)
    before, after = np.concatenate(([FAR], gap)), np.concatenate((gap, [FAR]))
    places, lags = [], []
    live = np.flatnonzero((before < 2 * size) & ~shut[at])
    back = 1
    while len(live):
        live = live[live >= back]
        lag = at[live] - at[live - back]
        near = (h[live] == h[live - back]) & (lag < 2 * size)
        live, lag = live[near], lag[near]
        places.append(at[live][lag >= size])
        lags.append(lag[lag >= size])
        back += 1
    again = np.minimum(before, after) <= most
    none = [np.zeros(0, np.int64)]
    return np.concatenate(places or none), np.concatenate(lags or none), np.sort(at[again]), after[np.argsort(order)]


def _occurring(h: np.ndarray) -> np.ndarray:
    """Positions whose hash may occur twice (a one-pass count over hash cells leaves most unique windows out)."""
    cells = 1 << max(10, int(len(h) * 8).bit_length())
    cell = (h & np.uint64(cells - 1)).astype(np.int64)
    return np.flatnonzero(np.bincount(cell, minlength=1)[cell] > 1)


def find_runs(ids: np.ndarray, longest: int, shortest: int = SHORTEST, exponent: int = EXPONENT) -> list[Run]:
    """(start, length, period) of all runs in word numbers ``ids``, ordered by start, then period.

    ``ids`` may hold several texts with a number of its own between two texts: a stretch of matches longer than its lag never
    passes such a number. ``longest``: words of the longest text.
    """
    if exponent < 3:
        raise ValueError("exponent must be 3 or more")
    found: dict[tuple[int, int], int] = {}

    def emit(first: int, end: int, q: int) -> None:
        if end - first + q >= max(shortest, exponent * q):
            key = (first - q, end - first + q)
            found[key] = min(q, found.get(key, q))

    most = longest // exponent  # the longest period
    for q in range(1, min(most, DENSE - 1) + 1):
        for first, end in _stretches(ids, q, max(shortest, exponent * q) - q):
            emit(first, end, q)
    if most >= DENSE:
        half = mix(ids.astype(np.uint64) + np.uint64(1))
        size = 1
        while size < DENSE:  # hashes of DENSE / 2 words, then of DENSE words
            before = half
            half = mix(half[:-size] * np.uint64(BASE) + half[size:])
            size *= 2
        shut = np.zeros(len(ids), bool)
        for d in range(1, DENSE // 4 + 1):
            shut[:len(before) - d] |= before[d:] == before[:-d]
        at = _occurring(half)
        while len(at) and size <= most:
            places, lags, again, after = _openers(half[at], at, shut, size, most)
            ended: dict[int, int] = {}
            order = np.lexsort((lags, places))
            for i, q in zip(places[order].tolist(), lags[order].tolist()):
                if i < ended.get(q, 0):
                    continue  # this diagonal's match length already covers word i
                end = i + _matches(ids, i, q, 1)
                ended[q] = end
                if end > i:
                    emit(i - _matches(ids, i, q, -1), end, q)
            shut[:] = False
            shut[at[after <= size // 2]] = True
            if 2 * size > most:
                break
            half = mix(half[:-size] * np.uint64(BASE) + half[size:])
            at = again[again < len(half)]
            size *= 2
    return sorted((start, length, q) for (start, length), q in found.items())


def text_runs(texts: list[list[bytes]], shortest: int = SHORTEST, exponent: int = EXPONENT) -> list[list[Run]]:
    """Runs of each text (given as words)."""
    number: dict[bytes, int] = {}
    for words in texts:
        number.update(dict.fromkeys(words, 0))
    for i, w in enumerate(number):
        number[w] = i
    lengths = np.array([len(w) for w in texts], np.int64)
    ends = np.cumsum(lengths + 1)
    ids = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
    for k, (words, end) in enumerate(zip(texts, ends.tolist())):
        ids[end - 1 - len(words):end - 1] = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        ids[end - 1] = len(number) + k  # a number of its own ends each text
    out: list[list[Run]] = [[] for _ in texts]
    starts = ends - lengths - 1
    runs = find_runs(ids, int(lengths.max(initial=0)), shortest, exponent)
    owner = np.searchsorted(ends, [r[0] for r in runs], side="right").tolist()
    for k, (start, length, q) in zip(owner, runs):
        out[k].append((start - int(starts[k]), length, q))
    return out


def collapse(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that a run repeats (all that it holds after its first period)."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        edge[start + q] += 1
        edge[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]


def repeat_part(doc_id: object, words: list[bytes]) -> list[bytes]:
    """The contract's edit: of one document in ten, the words from some place on are repeated with a period."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    part = words[a:a + p]
    return words[:a] + (part * ((n - a) // p + 1))[:n - a]


def _run_batches(edit: Edit | None, shortest: int, exponent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for lo, hi in blocks(texts):
                part = batch.slice(lo, hi - lo)
                words = [t.split() for t in texts[lo:hi]]  # bytes.split() parts at ASCII white space only
                if edit is not None:
                    words = [edit(d, w) for d, w in zip(part.column("doc_id").to_pylist(), words)]
                runs = text_runs(words, shortest, exponent)
                flat = np.array([r for rs in runs for r in rs], np.int64).reshape(-1, 3)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.cumsum([0, *map(len, runs)]), pa.int32()),
                    pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, i])) for i in range(3)], fields=list(kind)))
                kept = pa.array([b" ".join(collapse(w, r)) for w, r in zip(words, runs)], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(w) for w in words], pa.int64()), lists, kept],
                    ["doc_id", "n_words", "runs", "collapsed"])

    return run


def find(docs: DataFrame, edit: Edit | None = None, shortest: int = SHORTEST, exponent: int = EXPONENT) -> DataFrame:
    """One row per document: doc_id, n_words, runs (start, length, period; by start, then period), collapsed text.

    ``edit`` may change a document's words first (doc_id, words -> words).
    """
    small_arrow_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(
        _run_batches(edit, shortest, exponent),
        f"doc_id {kind}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def _order(a: Column, b: Column) -> Column:
    """Greatest length / period first (compared exactly), then smallest start, then smallest period."""
    x, y = a["length"] * b["period"], b["length"] * a["period"]
    return (F.when(x > y, -1).when(x < y, 1).when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1)
            .when(a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0))


def digest(found: DataFrame) -> DataFrame:
    """Digest columns of ``find``'s rows."""
    best = F.get(F.array_sort("runs", _order), F.lit(0))
    line = F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    rows = found.withColumn("best", best).withColumn("lines", F.array_join(line, ""))
    return rows.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


#: A word's window of four words occurs again q words later at all but the last three of a run's matches.
ORACLE = r"""
WITH crc_table AS (
  SELECT list(c ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_concat([i], range(8)), lambda c, _: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(i))),
t AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    xor(list_reduce(list_concat([4294967295], list_transform(regexp_extract_all(hex(encode(CAST(doc_id AS VARCHAR))), '..'),
      lambda h: ('0x' || h)::BIGINT)), lambda c, x: xor(tab[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) AS h
  FROM documents, crc_table),
g AS (SELECT doc_id, w, h % 10 = 0 AND len(w) > 0 AS hit, (h // 10) % greatest(len(w), 1) AS a, (h // 10) % 8 AS e, len(w) AS n FROM t),
o AS (SELECT doc_id, n, w, hit, a, 1 + (n - a) // (3 + e) AS p, unnest(range(n)) AS i FROM g),
x AS (SELECT doc_id, n, i, CASE WHEN hit AND i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END AS w FROM o),
f AS (
  SELECT doc_id, n, i, w || ' ' || lead(w, 1) OVER d || ' ' || lead(w, 2) OVER d || ' ' || lead(w, 3) OVER d AS w4
  FROM x WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
m AS (SELECT b.doc_id, b.i, b.i - a.i AS q FROM f a JOIN f b ON a.doc_id = b.doc_id AND a.w4 = b.w4 AND a.i < b.i AND 4 * (b.i - a.i) <= b.n),
s AS (SELECT doc_id, q, min(i) - q AS start, count(*) + 3 + q AS length
  FROM (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS part FROM m) GROUP BY doc_id, q, part),
r AS (SELECT doc_id, start, length, min(q) AS q FROM s WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length),
u AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', q, chr(10)), '' ORDER BY start, q) AS lines,
    first({'start': start, 'length': length, 'q': q} ORDER BY length / q DESC, start, q) AS b,
    list({'lo': start + q, 'hi': start + length}) AS cut
  FROM r GROUP BY doc_id),
c AS (SELECT x.doc_id, string_agg(x.w, ' ' ORDER BY x.i) AS kept FROM x LEFT JOIN u ON u.doc_id = x.doc_id
  WHERE u.doc_id IS NULL OR len(list_filter(u.cut, lambda y: x.i >= y.lo AND x.i < y.hi)) = 0 GROUP BY x.doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, CAST(b.start AS BIGINT) AS start, CAST(b.length AS BIGINT) AS length,
  CAST(b.q AS BIGINT) AS period, CAST(1000 * b.length // b.q AS BIGINT) AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM documents d LEFT JOIN u ON u.doc_id = d.doc_id LEFT JOIN c ON c.doc_id = d.doc_id"""
