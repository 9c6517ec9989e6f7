"""Operator 6: benchmark decontamination by winnowing (built-in functions only).

Words are runs of ASCII digits, letters (lower-cased) and non-ASCII
characters. For items of at least ``SPAN`` words, both sides keep the minimum
hash of ``GRAM``-word grams in every window of SPAN - GRAM + 1 grams. A span of
SPAN shared words has the same window on both sides, so it always shares a
fingerprint. Each shorter item is one span of its own length; those lengths
(at most SPAN - 1 of them) use every gram of that length. With items of GRAM
words, documents keep all their GRAM-word grams, the minima among them.

1. One pass over the documents: fingerprints are exploded and joined with the
   benchmark's (broadcast if they are few, else by shuffle). Only hits leave.
2. The documents with hits are read again. A hit gives an alignment (item,
   shift) of the two word lists; each distinct alignment is compared over the
   item's whole length, which extends the hit left and right.
3. Word positions inside matching spans are merged per document.

Defined cases: null and empty texts have no words and no hits; items without
words are ignored; repeated items count once, items with a null id never
count but their windows hit; rows with null doc_id are told apart by their
text; repeated rows give repeated results; empty tables give no hits or no rows;
extra columns are ignored by ``find`` and kept by ``remove``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import ascii_lower, bounded_broadcast, text_of, written

SPAN, GRAM = 10, 6
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), SEPARATORS), "")


def _steps(last: Column) -> Column:
    """0..last, or nothing for a negative ``last``."""
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _grams(words: str, k: int) -> Column:
    """Hashes of all k-word grams (by position). The array is only indexed, never sliced."""
    w = F.col(words)
    return F.transform(_steps(F.size(w) - k),
                       lambda i: F.xxhash64(F.lit(k), *[F.get(w, i + j) for j in range(k)]))


def _winnow(grams: str, window: int) -> Column:
    """Minimum gram hash of every window; one minimum for fewer grams than a window."""
    g = F.col(grams)
    if window == 1:
        return F.array_distinct(g)
    last = F.when(F.size(g) > 0, F.greatest(F.size(g) - window, F.lit(0))).otherwise(F.lit(-1))
    return F.array_distinct(F.transform(_steps(last), lambda i: F.least(*[F.get(g, i + j) for j in range(window)])))


def _kinds(lengths: list[int], span: int, gram: int) -> list[tuple[int, int]]:
    """(gram length, window) for the item lengths at hand; lengths of ``span`` and more share one kind."""
    return [(gram, span - gram + 1) if n == span else (n, 1) for n in lengths]


def _doc_kinds(kinds: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """One kind per gram length with its smallest window: all grams of a length hold the minima of any window."""
    return [(k, min(w for j, w in kinds if j == k)) for k in sorted({k for k, _ in kinds})]


def _items(benchmark: DataFrame, span: int) -> DataFrame:
    """One row per distinct item text: item, ids, words, n, span (the window length)."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("id"), words_of(text_of()).alias("words"))
    rows = rows.filter(F.size("words") > 0).groupBy("words").agg(F.collect_set("id").alias("ids"))
    return written(rows.select(F.monotonically_increasing_id().alias("item"), "ids", "words",
                               F.size("words").alias("n"), F.least(F.size("words"), F.lit(span)).alias("span")), "bench-items")


def _item_prints(items: DataFrame, lengths: list[int], span: int, gram: int) -> DataFrame:
    """(fp, item, at, n): the winnowed fingerprints of items, at every position where their gram stands."""
    out = None
    for length, (k, window) in zip(lengths, _kinds(lengths, span, gram)):
        g = items.filter(F.col("span") == length).select("item", "n", "words").withColumn("g", _grams("words", k))
        g = g.withColumn("kept", _winnow("g", window)).select("item", "n", "kept", F.posexplode("g").alias("at", "fp"))
        g = g.filter(F.array_contains("kept", F.col("fp"))).select("fp", "item", "at", "n")
        out = g if out is None else out.unionByName(g)
    return written(out, "bench-prints")


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, row key (id and text together) and text."""
    text = text_of()
    return docs.select("doc_id", F.xxhash64(F.col("doc_id").cast("string"), text).alias("row"), text.alias("text"))


def _same_row(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    """Join on the row key and doc_id (null ids are equal)."""
    b = b.withColumnRenamed("doc_id", "_doc_id").withColumnRenamed("row", "_row")
    return a.join(b, (F.col("row") == F.col("_row")) & F.col("doc_id").eqNullSafe(F.col("_doc_id")), how).drop(
        "_doc_id", "_row")


def _hits(docs: DataFrame, benchmark: DataFrame, span: int, gram: int) -> tuple[DataFrame, DataFrame]:
    """(all rows: doc_id, row, n_words), (rows with matches: doc_id, row, ids, positions)."""
    items = _items(benchmark, span)
    lengths = sorted(r.span for r in items.select("span").distinct().collect())  # at most ``span`` values
    texts = _keyed(docs)
    base = texts.select("doc_id", "row", words_of(F.col("text")).alias("words"))
    if not lengths:
        none = base.select("doc_id", "row", F.array().cast("array<string>").alias("ids"),
                           F.array().cast("array<int>").alias("positions")).limit(0)
        return base.select("doc_id", "row", F.size("words").cast("bigint").alias("n_words")), none
    kinds = _doc_kinds(_kinds(lengths, span, gram))
    prints = _item_prints(items, lengths, span, gram)

    scan = base
    for k, window in kinds:
        scan = scan.withColumn(f"g{k}", _grams("words", k)).withColumn(f"f{k}", _winnow(f"g{k}", window))
    fps = F.concat(F.array(F.lit(None).cast("bigint")), *[F.col(f"f{k}") for k, _ in kinds])
    scan = scan.select("doc_id", "row", F.size("words").cast("bigint").alias("n_words"), F.explode(fps).alias("fp"))
    scan = scan.join(bounded_broadcast(prints), "fp", "left").filter(F.col("fp").isNull() | F.col("item").isNotNull())
    scan = written(scan, "bench-scan")
    rows = scan.filter(F.col("fp").isNull()).select("doc_id", "row", "n_words")
    found = written(scan.filter(F.col("fp").isNotNull()).groupBy("doc_id", "row").agg(
        F.collect_set(F.struct("fp", "item", "at", "n")).alias("hits")), "bench-found")

    # few ids are broadcast so that only their texts are split again and shuffled; the hits never are broadcast
    again = _same_row(texts, bounded_broadcast(found.select("doc_id", "row")), "left_semi")
    again = _same_row(again, found, "inner").select("doc_id", "row", "hits", words_of(F.col("text")).alias("words"))
    shifts = []
    for k, _ in kinds:
        again = again.withColumn(f"g{k}", _grams("words", k)).withColumn(f"fp{k}", F.array_distinct(F.col("hits.fp")))
        g, known, hits = F.col(f"g{k}"), F.col(f"fp{k}"), F.col("hits")
        at = F.filter(_steps(F.size(g) - 1), lambda p: F.array_contains(known, F.get(g, p)))
        again = again.withColumn(f"at{k}", at)
        shifts.append(F.flatten(F.transform(F.col(f"at{k}"), lambda p: F.transform(
            F.filter(hits, lambda h: h["fp"] == F.get(g, p)),
            lambda h: F.struct(h["item"].alias("item"), h["n"].alias("n"), (p - h["at"]).alias("shift"))))))
    again = again.withColumn("shifts", F.array_distinct(F.concat(*shifts)))
    w = F.col("words")
    lined = again.select("doc_id", "row", F.explode(F.transform("shifts", lambda s: F.struct(
        s["item"].alias("item"), s["shift"].alias("shift"),
        F.transform(_steps(s["n"] - 1), lambda j: F.when(s["shift"] + j >= 0, F.when(s["shift"] + j < F.size(w), F.get(w, s["shift"] + j)))
                    ).alias("beside")))).alias("s")).select("doc_id", "row", "s.*")
    lined = lined.join(bounded_broadcast(items.withColumnRenamed("words", "item_words"), F.col("n")), "item")
    beside, own = F.col("beside"), F.col("item_words")
    lined = lined.withColumn("same", F.transform(_steps(F.col("n") - 1), lambda j: F.coalesce(
        F.get(beside, j) == F.get(own, j), F.lit(False))))
    same, length = F.col("same"), F.col("span")
    lined = lined.withColumn("starts", F.filter(_steps(F.col("n") - length), lambda j: F.forall(
        F.sequence(F.lit(0), length - 1), lambda t: F.get(same, j + t)))).filter(F.size("starts") > 0)
    covered = F.array_distinct(F.flatten(F.transform("starts", lambda j: F.sequence(
        F.col("shift") + j, F.col("shift") + j + length - 1))))
    lined = lined.select("doc_id", "row", "ids", covered.alias("positions"))
    hit = lined.groupBy("doc_id", "row").agg(
        F.array_distinct(F.flatten(F.collect_set("ids"))).alias("ids"),
        F.array_distinct(F.flatten(F.collect_set("positions"))).alias("positions"))
    return rows, written(hit, "bench-hit")


def find(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    rows, hit = _hits(docs, benchmark, span, gram)
    hit = hit.select("doc_id", "row", F.size("positions").cast("bigint").alias("hit"), F.array_sort("ids").alias("ids"))
    out = _same_row(rows, hit, "left")
    ids = F.coalesce(F.col("ids"), F.array().cast("array<string>"))
    return out.select("doc_id", "n_words", F.coalesce("hit", F.lit(0)).cast("bigint").alias("n_hit"),
                      F.size(ids).cast("bigint").alias("n_items"),
                      F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
                      (F.coalesce("hit", F.lit(0)) > 0).alias("contaminated"))


def remove(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """The documents without any benchmark window, with all their columns."""
    _, hit = _hits(docs, benchmark, span, gram)
    keyed = docs.select(F.struct(*docs.columns).alias("_all"), "doc_id",
                        F.xxhash64(F.col("doc_id").cast("string"), text_of()).alias("row"))
    return _same_row(keyed, bounded_broadcast(hit.select("doc_id", "row")), "left_anti").select("_all.*")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item, s AS span, array_to_string(w[p:p + s - 1], ' ') AS win
  FROM (SELECT item, w, least(len(w), 10) AS s, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM i WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, s AS span, p, array_to_string(w[p:p + s - 1], ' ') AS win
  FROM (SELECT doc_id, w, s, unnest(range(1, len(w) - s + 2)) AS p FROM d, (SELECT DISTINCT span AS s FROM iw) WHERE len(w) >= s)),
m AS (SELECT doc_id, item, p, span FROM dw JOIN iw USING (span, win)),
h AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + span)) AS x FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)"""
