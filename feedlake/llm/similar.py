"""Operator 4: exact n-gram Jaccard join by universe partitions (pigeonhole) with one-deletion neighbourhoods.

A document's set is its distinct word shingles. Sets of sizes la, lb with
Jaccard similarity of at least T percent differ in at most
``budget(la + lb)`` elements.

Size bands. Each band of set sizes has a scheme with budget H, that of its
largest sizes. A pair is looked for under the scheme of its larger set; the
smaller one is in the same band or the one below, so a set is
indexed under at most two or three schemes.

Exact subsets. A scheme hashes the universe of shingles into m = H + 1 + g segments.
Two sets that differ in at most H elements agree on 1 + g segments or more. If one of these
is not empty, they share the signature of that subset. Else both have more
than g empty segments: only such sets (rare, by the choice of g) index empty segments too.

Allocation, by cost. A set with e <= g empty segments shares at least 1 + g - e other subsets with any similar
set, so it may skip g - e of its own: it skips those with the largest buckets (ties by signature; the
order is the same for all sets, so the rarest subset of a similar pair is skipped by neither).

One-deletion neighbourhoods, by cost too. A bucket of k sets costs about k / 2 comparisons
for each set (``COMPARISON_COST`` each). Where that is more than indexing the sets' deletion
neighbourhoods (set size + segments rows), the bucket is dropped and its sets are indexed again under
ceil((H + 1) / 2) larger segments, by each subset and each subset less one element:
among those, two sets within H differ in at most one element of some segment. A similar
pair shares a cheap bucket, or all its shared buckets are costly and both sets are in the second index.

Groups. Sets that are nearly similar share many subsets, so buckets repeat
each other. Buckets with the same members become one, and the buckets of one leader (their smallest
member) become one group where comparing all its members costs no more than
comparing the members of each bucket.
After the star round (below) groups that overlap become one by the same rule, so
that a set's wide sketch is sent once, not once for each group.

Components. Only connected components are asked for, so pairs already
connected are not compared: a star round links every member of a group to
``LEADERS`` of its members, then the remaining pairs across components are compared in
blocks of ``BLOCK`` members, a task at a time for two blocks, so a large group is split.
All candidates pass a size test and a parity sketch with about a cell for each
element (differing cells never exceed the differing elements) where they are found, and are
verified on the shingle sets.

Equal sets form a class, represented by its smallest doc_id; only classes are indexed
(each task indexes a set once, the rest is removed on the map side).

Defined cases: null, empty and wordless texts have an empty set and link with
nothing; rows with null doc_id are never linked (their component is null); repeated rows share a
class; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.common import bounded_broadcast, small_arrow_batches, text_of, written
from feedlake.llm.components import components
from feedlake.llm.words import mix, shingle_sets

LEADERS = 4
BLOCK = 256
#: One comparison of two sketches in a block (about 0.2 microseconds for sets of some hundred elements), measured in rows of
#: an index that are made, shuffled and sorted (about 4 microseconds).
COMPARISON_COST = 1 / 16
#: Rounds in which overlapping groups find a common label.
HOPS = 2
RARE = 1e-3
#: Sets that a task remembers to have indexed; equal sets met again later are removed by the aggregation that follows.
SEEN = 1 << 17
#: A class with one in so many rows is heavy.
HEAVY_SHARE = 1000
SKETCH_BITS, MOST_BITS = 512, 1 << 17


@dataclass(frozen=True)
class Scheme:
    """Segments of one size band: ``lo`` smallest size, ``budget`` H, ``exact`` m, ``spare`` g, ``deletion`` count."""

    number: int
    lo: int
    budget: int
    exact: int
    spare: int
    deletion: int


def budget(total: int, percent: int) -> int:
    """Largest symmetric difference of two sets with sizes adding up to ``total`` at Jaccard >= percent."""
    return total - 2 * -(-percent * total // (100 + percent))


def _many_empty(m: int, g: int, n: int) -> float:
    """About the probability that a set of n elements leaves more than g of m segments empty (Poisson)."""
    rate = m * math.exp(-n / m)
    if rate > 30:
        return 0.5 * math.erfc((g + 0.5 - rate) / math.sqrt(2 * rate))
    term = math.exp(-rate)
    tail = 1 - term
    for i in range(1, min(g, 200) + 1):
        term *= rate / i
        tail -= term
    return max(tail, 0.0)


@lru_cache(maxsize=8)
def schemes(percent: int, largest: int = 1 << 40) -> tuple[Scheme, ...]:
    """The schemes of all size bands (a few dozen)."""
    out, lo = [], 1
    while lo <= largest:
        hi = max(lo, lo * 100 // percent if percent < 85 else lo * 10_000 // (percent * percent))
        h = max(budget(t, percent) for t in (2 * hi, 2 * hi - 1))
        tries = range(0, (h + 1) // 2 + 4, max(1, (h + 1) // 64)) if h else (0,)
        odds = [(max(_many_empty(h + 1 + g, g, lo), RARE), g) for g in tries]
        g = min(odds)[1]  # the fewest spare segments that make more empty ones rare
        m = h + 1 + g
        out.append(Scheme(len(out), lo, h, m, g, -(-(h + 1) // 2)))
        lo = hi + 1
    return tuple(out)


def own_schemes(n: int, percent: int) -> list[Scheme]:
    """Schemes under which a set of size n is indexed: its own band's and those of larger partners."""
    table = schemes(percent)
    los = [s.lo for s in table]
    first = int(np.searchsorted(los, n, side="right")) - 1
    found = [table[first]]
    for s in table[first + 1:]:
        if 100 * n < percent * s.lo:
            break
        found.append(s)
    return [s for s in found if s.budget > 0]  # budget 0 is equality, which the classes cover


def _tag(scheme: Scheme, segments: np.ndarray | int) -> np.ndarray:
    return mix(np.uint64(scheme.number << 32) + np.asarray(segments, np.uint64) + np.uint64(1))


def _segment_sums(s: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment of each element, its mixed value, wrapped sum of each segment)."""
    seg = (s % np.uint64(m)).astype(np.int64)
    value = mix(s + np.uint64(0x5851F42D4C957F2D))
    sums = np.zeros(m, np.uint64)
    np.add.at(sums, seg, value)
    return seg, value, sums


def exact_signatures(s: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signatures of the subsets of one set, each one's scheme, how many of that scheme the set may skip)."""
    parts: list[tuple] = [(np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32))]
    for scheme in own_schemes(len(s), percent):
        seg, _, sums = _segment_sums(s, scheme.exact)
        kept = np.bincount(seg, minlength=scheme.exact) > 0
        skip = scheme.spare - (scheme.exact - int(kept.sum()))
        if skip < 0:
            kept[:], skip = True, 0
        at = np.flatnonzero(kept)
        parts.append((mix(sums[at] ^ _tag(scheme, at)), np.full(len(at), scheme.number, np.int32), np.full(len(at), skip, np.int32)))
    return tuple(np.concatenate(x) for x in zip(*parts))


def deletion_signatures(s: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(signatures of the larger subsets, signatures of these less one element) of one set."""
    whole, less = [], []
    for scheme in own_schemes(len(s), percent):
        seg, value, sums = _segment_sums(s, scheme.deletion)
        tags = _tag(scheme, np.arange(scheme.deletion)) + np.uint64(1)
        whole.append(mix(sums ^ tags))
        less.append(mix((sums[seg] - value) ^ tags[seg]))
    none = np.zeros(0, np.uint64)
    return (np.concatenate(whole), np.concatenate(less)) if whole else (none, none)


def sketch(s: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """Parities of the elements over ``bits`` cells, as 64-bit numbers."""
    cell = (mix(s ^ np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)) % np.uint64(bits)
    odd = np.bincount(cell.astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8")


def cells(n: int) -> int:
    """Cells of the wide sketch of a set of n elements: a power of two, about one cell for each element."""
    return min(MOST_BITS, max(SKETCH_BITS, 1 << (n - 1).bit_length()))


def _digest(s: np.ndarray) -> tuple[int, int]:
    a, b = mix(s ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64), mix(s + np.uint64(0xE7037ED1A0B428DB)).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def _longs(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


def _index_batches(k: int):
    """Set size, digest and (once a task for equal sets) parity sketch of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows: list[list] = [[], [], [], [], []]
                for s in shingle_sets(part.column("text").cast(pa.binary()).to_pylist(), k):
                    h = _digest(s) if len(s) else (0, 0)
                    rows[0].append(len(s))
                    rows[1].append(h[0])
                    rows[2].append(h[1])
                    new = len(s) > 0 and h not in seen
                    rows[3].append(sketch(s) if new else None)
                    rows[4].append(sketch(s, cells(len(s))) if new else None)
                    seen.add(h)
                if len(seen) > SEEN:
                    seen.clear()
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *[pa.array(r, t) for r, t in zip(rows, kinds)]],
                                                 ["doc_id", "n", "h1", "h2", "sketch", "wide"])

    return run


def _signature_batches(k: int, percent: int):
    """(sig, h1, scheme, skip) rows; equal sets are indexed once a task, so a hot copy stays a few rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                parts: list[tuple] = []
                for s in shingle_sets(part.column("text").cast(pa.binary()).to_pylist(), k):
                    h = _digest(s)
                    if len(s) and h not in seen:
                        if len(seen) > SEEN:
                            seen.clear()
                        seen.add(h)
                        sig, scheme, skip = exact_signatures(s, percent)
                        parts.append((_longs(sig), np.full(len(sig), h[0], np.int64), scheme, skip))
                if parts:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts)],
                                                     ["sig", "h1", "scheme", "skip"])

    return run


def _set_batches(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                sets = [_longs(s) for s in shingle_sets(part.column("text").cast(pa.binary()).to_pylist(), k)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), pa.array(sets, pa.list_(pa.int64()))], ["node", "elements"])

    return run


def _deletion_batches(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 16):
                part = batch.slice(at, 16)
                lists, nodes = part.column("elements"), part.column("node").to_pylist()
                flat, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
                for node, a, b in zip(nodes, offsets[:-1].tolist(), offsets[1:].tolist()):
                    whole, less = deletion_signatures(flat[a:b].view(np.uint64), percent)
                    n = len(whole) + len(less)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(_longs(np.concatenate((whole, less)))), pa.array([node] * n, part.schema.field("node").type),
                         pa.array(np.arange(n) < len(whole))], ["sig", "node", "whole"])

    return run


def _close(percent: int, a: str, b: str) -> Column:
    """Size test and parity sketch: false only for pairs that cannot be similar."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    bits = sum((F.bit_count(F.col(f"{a}.sketch")[i].bitwiseXOR(F.col(f"{b}.sketch")[i])) for i in range(8)), F.lit(0))
    return ((100 * F.least(na, nb) >= percent * F.greatest(na, nb))
            & (bits <= na + nb - 2 * F.ceil(percent * (na + nb) / F.lit(100 + percent))))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sets are similar, decided on the elements; only the sets of some pair are moved."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = sets.join(bounded_broadcast(written(ends, "similar-ends")), "node", "left_semi")
    a = sets.select(F.col("node").alias("a"), F.col("elements").alias("ea"))
    b = sets.select(F.col("node").alias("b"), F.col("elements").alias("eb"))
    both = F.size(F.array_intersect("ea", "eb")).cast("bigint")
    return (pairs.join(a, "a").join(b, "b")
            .filter(100 * both >= percent * (F.size("ea") + F.size("eb") - both)).select("a", "b"))


def _with_component(rows: DataFrame, comp: DataFrame) -> DataFrame:
    return rows.join(comp.withColumnRenamed("component", "comp"), "node", "left").withColumn(
        "comp", F.coalesce("comp", "node"))


def _mixed(rows: DataFrame) -> DataFrame:
    """Rows of buckets that still hold more than one component."""
    w = Window.partitionBy("sig")
    return rows.withColumn("c0", F.min("comp").over(w)).withColumn("c1", F.max("comp").over(w)).filter("c0 < c1")


def link_classes(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(rows: doc_id, n, h1, h2), (classes: node, h1, h2, component)."""
    small_arrow_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", text_of().alias("text"))
    index = written(texts.mapInArrow(
        _index_batches(k), f"doc_id {kind}, n bigint, h1 bigint, h2 bigint, sketch array<bigint>, wide array<bigint>"), "similar-index")
    rows = index.select("doc_id", "n", "h1", "h2")
    classes = written(index.filter("n > 0 and doc_id is not null").groupBy("h1", "h2").agg(
        F.min("doc_id").alias("node"), F.first("n").alias("n")), "similar-classes")

    # buckets of two sets or more; h1 routes, the class table tells classes apart
    w = Window.partitionBy("sig")
    shared = (texts.filter(F.col("doc_id").isNotNull()).select("text")
              .mapInArrow(_signature_batches(k, percent), "sig bigint, h1 bigint, scheme int, skip int")
              .withColumn("lo", F.min("h1").over(w)).withColumn("hi", F.max("h1").over(w)).filter("lo < hi")
              .groupBy("sig", "h1").agg(F.first("scheme").alias("scheme"), F.first("skip").alias("skip"))
              .withColumn("k", F.count("*").over(w)))
    # every set skips its costliest subsets, as many as its spare segments allow
    rank = Window.partitionBy("h1", "scheme").orderBy(F.col("k").desc(), F.col("sig"))
    shared = written(shared.filter("k > 1").withColumn("rank", F.row_number().over(rank)).filter("rank > skip").select("sig", "h1"),
                     "similar-shared")
    sketches = index.filter(F.col("sketch").isNotNull()).join(
        shared.select("h1").distinct(), "h1", "left_semi").groupBy("h1", "h2").agg(
            F.first("sketch").alias("sketch"), F.first("wide").alias("wide"))
    nodes = written(classes.join(sketches, ["h1", "h2"]).select("h1", "h2", "node", "n", "sketch", "wide"), "similar-nodes")
    groups = _groups(shared)
    found = groups.join(nodes.select("h1", "node", "n", "sketch"), "h1").drop("h1")
    found = found.withColumn("k", F.count("*").over(w)).withColumn("mean", F.avg("n").over(w))
    costly = (F.col("k") - 1) * COMPARISON_COST > 2 * (F.col("mean") + F.col("mean") * (100 - percent) / (100 + percent))
    found = written(found.withColumn("costly", costly).drop("k", "mean"), "similar-rows")

    sets = texts.join(bounded_broadcast(nodes.select(F.col("node").alias("doc_id"))), "doc_id")
    if not index.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").isEmpty():
        sets = sets.dropDuplicates(["doc_id"])
    sets = written(sets.withColumnRenamed("doc_id", "node").mapInArrow(
        _set_batches(k), f"node {kind}, elements array<bigint>"), "similar-sets")

    comp = nodes.select("node", F.col("node").alias("component"))
    live = _mixed(_with_component(found, comp))
    leads = [F.min(F.struct(F.xxhash64("node", "sig", F.lit(i)).alias("h"), "node", "n", "sketch", "comp")).over(w)
             for i in range(LEADERS)]
    star = live.withColumn("leads", F.array(*leads)).select("node", "comp", F.struct("n", "sketch").alias("me"), F.explode("leads").alias("lead"))
    star = star.filter(F.col("comp") != F.col("lead.comp")).filter(_close(percent, "me", "lead"))
    pairs = star.select(F.least("node", "lead.node").alias("a"), F.greatest("node", "lead.node").alias("b")).distinct()
    links, comp = _grow(None, _wide_close(pairs, nodes, percent), sets, percent)

    side = ["sig", "node", "n", "wide", "comp", "whole"]
    wide = nodes.select("node", "wide")
    rest = _mixed(_with_component(found.drop("sketch"), comp)).withColumn("k", F.count("*").over(w))
    rest = written(rest.filter(F.col("costly") | (F.col("k") > 2)).select("sig", "node", "n", "comp", "costly", "k"), "similar-rest")
    # (a group of two has been compared by the star round)
    cheap = written(_overlapping(rest.filter(~F.col("costly")).drop("costly")), "similar-overlapping")
    pairs = _across(cheap.withColumn("whole", F.lit(True)).join(wide, "node").select(*side), percent)
    again = written(rest.filter("costly").select("node").distinct(), "similar-again")
    second = sets.join(bounded_broadcast(again), "node", "left_semi").mapInArrow(
        _deletion_batches(percent), f"sig bigint, node {kind}, whole boolean")
    second = _mixed(_with_component(second.join(nodes.select("node", "n"), "node"), comp))
    second = written(second.select("sig", "node", "n", "comp", "whole"), "similar-deletion")
    pairs = pairs.unionByName(_across(second.join(wide, "node").select(*side), percent)).distinct()
    links, comp = _grow(links, pairs, sets, percent)
    return rows, nodes.join(comp, "node").select("node", "h1", "h2", "component")


def _groups(shared: DataFrame) -> DataFrame:
    """(sig, h1): buckets with the same members as one, and the buckets of one leader as one where that costs no more."""
    w = Window.partitionBy("sig")
    buckets = shared.withColumn("k", F.count("*").over(w)).filter("k > 1")
    buckets = buckets.withColumn("same", F.bit_xor(F.xxhash64("h1")).over(w)).withColumn("lead", F.min("h1").over(w))
    buckets = written(buckets.groupBy("same", "h1").agg(F.min("k").alias("k"), F.min("lead").alias("lead")), "similar-buckets")
    members = buckets.select("lead", "h1").distinct()
    each = buckets.filter("h1 = lead").groupBy("lead").agg(F.sum(F.col("k") * F.col("k")).alias("cost"))
    joined = members.groupBy("lead").agg(F.count("*").alias("size")).join(each, "lead").filter(
        F.col("size") * F.col("size") <= 2 * F.col("cost")).select("lead")
    joined = written(joined, "similar-leaders")
    own = buckets.join(joined, "lead", "left_anti").select(F.col("same").alias("sig"), "h1")
    return members.join(joined, "lead").select(F.col("lead").alias("sig"), "h1").unionByName(own)


def _overlapping(rows: DataFrame) -> DataFrame:
    """(sig, node, n, comp): groups (of k rows) that overlap as one, where that costs no more; a member's sketch is then sent once.

    Each group takes the smallest label of the groups that it shares a member with, ``HOPS`` times. A group is merged
    whole, so its pairs still meet, whatever the labels.
    """
    rows = rows.withColumn("label", F.col("sig"))
    for _ in range(HOPS):
        for key in ("node", "sig"):
            rows = rows.withColumn("label", F.min("label").over(Window.partitionBy(key)))
    rows = written(rows, "similar-labels")
    members = rows.groupBy("label", "node").agg(F.sum("k").alias("cost"), F.first("n").alias("n"), F.first("comp").alias("comp"))
    joined = members.groupBy("label").agg(F.count("*").alias("size"), F.sum("cost").alias("cost")).filter(
        F.col("size") * F.col("size") <= 2 * F.col("cost")).select("label")
    joined = written(joined, "similar-merged")
    own = rows.join(joined, "label", "left_anti").select("sig", "node", "n", "comp")
    return members.join(joined, "label").select(F.col("label").alias("sig"), "node", "n", "comp").unionByName(own)


def _fold(m: np.ndarray, words: int) -> np.ndarray:
    """Sketches of fewer cells (a power of two of them) from those of more."""
    while m.shape[1] > words:
        half = m.shape[1] // 2
        m = m[:, :half] ^ m[:, half:]
    return m


def close_pairs(n: np.ndarray, wide: list[np.ndarray], apart: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of ``apart`` that the sizes and the wide sketches cannot rule out."""
    i, j = np.nonzero(apart)
    low, high = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
    fit = 100 * low >= percent * high
    i, j = i[fit], j[fit]
    total = n[i] + n[j]
    most = total - 2 * -(-percent * total // (100 + percent))
    words = np.array([len(x) for x in wide])
    least = np.minimum(words[i], words[j])
    ok = np.zeros(len(i), bool)
    for size in np.unique(least).tolist():
        rows = np.flatnonzero(words >= size)
        place = np.zeros(len(n), np.int64)
        place[rows] = np.arange(len(rows))
        m = np.zeros((len(rows), size), np.uint64)
        for length in np.unique(words[rows]).tolist():
            at = np.flatnonzero(words[rows] == length)
            m[at] = _fold(np.stack([wide[k] for k in rows[at].tolist()]), size)
        some = np.flatnonzero(least == size)
        step = max(1, (1 << 19) // size)
        for lo in range(0, len(some), step):
            part = some[lo:lo + step]
            differing = np.bitwise_count(m[place[i[part]]] ^ m[place[j[part]]]).sum(axis=1, dtype=np.int64)
            ok[part] = differing <= most[part]
    return i[ok], j[ok]


def _block_batches(percent: int):
    """Close pairs of different components in each (sig, i, j); rows come sorted by it."""
    names = ["sig", "i", "j", "blk", "node", "n", "comp", "whole"]

    def compare(group: list[tuple], schema: pa.Schema) -> pa.RecordBatch | None:
        cols = {name: np.array([r[c] for r in group]) for c, name in enumerate(names)}
        apart = cols["comp"][:, None] != cols["comp"][None, :]
        apart &= cols["whole"][:, None] | cols["whole"][None, :]
        if group[0][1] != group[0][2]:
            apart &= cols["blk"][:, None] != cols["blk"][None, :]
        apart &= np.triu(np.ones(apart.shape, bool), 1)
        i, j = close_pairs(cols["n"].astype(np.int64), [r[-1] for r in group], apart, percent)
        if not len(i):
            return None
        a, b = cols["node"][i], cols["node"][j]
        swap = a > b
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        kind = schema.field("node").type
        return pa.RecordBatch.from_arrays([pa.array(a.tolist(), kind), pa.array(b.tolist(), kind)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        schema = None
        for batch in batches:
            schema = batch.schema
            lists = batch.column("wide")
            flat, offsets = lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy().tolist()
            columns = [batch.column(c).to_pylist() for c in names]
            for r, row in enumerate(zip(*columns)):
                if group and row[:3] != group[0][:3]:
                    out = compare(group, schema)
                    if out is not None:
                        yield out
                    group = []
                group.append((*row, flat[offsets[r]:offsets[r + 1]]))
        if group:
            out = compare(group, schema)
            if out is not None:
                yield out

    return run


def _across(rows: DataFrame, percent: int) -> DataFrame:
    """Close pairs (a, b) of one group from different components, one of them ``whole``.

    A group is dealt into blocks of about ``BLOCK`` members; a row goes to the block pairs (i, j) of its block.
    """
    kind = rows.schema["node"].dataType.simpleString()
    blocks = F.ceil(F.count("*").over(Window.partitionBy("sig")) / BLOCK).cast("int")
    dealt = rows.withColumn("nb", blocks).withColumn("blk", F.pmod(F.xxhash64("node"), F.col("nb")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    dealt = dealt.withColumn("i", F.least("blk", "other")).withColumn("j", F.greatest("blk", "other")).drop("nb", "other")
    dealt = dealt.repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j")
    return dealt.mapInArrow(_block_batches(percent), f"a {kind}, b {kind}").distinct()


def _wide_close(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs that the wide sketches cannot rule out either (the narrow ones saturate for long texts).

    Sketches of sets of similar size have as many cells, or one has twice as many and is folded.
    """
    a = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("wide").alias("wa"))
    b = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("wide").alias("wb"))
    def fold(long: str) -> Column:
        half = F.shiftright(F.size(long), 1)
        return F.zip_with(F.slice(long, F.lit(1), half), F.slice(long, half + 1, half), lambda x, y: x.bitwiseXOR(y))

    x = F.when(F.size("wa") > F.size("wb"), fold("wa")).otherwise(F.col("wa"))
    y = F.when(F.size("wb") > F.size("wa"), fold("wb")).otherwise(F.col("wb"))
    bits = F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda t, b: t + b)
    total = F.col("na") + F.col("nb")
    return pairs.join(a, "a").join(b, "b").filter(
        bits <= total - 2 * F.ceil(percent * total / F.lit(100 + percent))).select("a", "b")


def _grow(links: DataFrame | None, pairs: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Verify pairs, add them to the links, and find the components again."""
    new = written(_verified(written(pairs, "similar-pairs"), sets, percent), "similar-links")
    links = new if links is None else links.unionByName(new)
    return links, written(components(links), "similar-components")


def join(docs: DataFrame, k: int = 3, percent: int = 90) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    rows, classes = link_classes(docs, k, percent)
    found = rows.filter("n > 0")
    comp = found.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.count("*").alias("c")).join(
        classes.select("h1", "h2", "component"), ["h1", "h2"], "left")
    comp = written(comp.select("h1", "h2", "c", F.coalesce("component", "first").alias("component_id")), "similar-classes-found")
    # classes with a thousandth of the rows or more are at most that many: they are joined on the map side
    total = comp.agg(F.sum("c")).first()[0] or 0
    heavy = comp.filter((F.col("c") > 1) & (F.col("c") * HEAVY_SHARE >= total)).select("h1", "h2", F.col("component_id").alias("large"))
    split = found.join(F.broadcast(heavy), ["h1", "h2"], "left")
    linked = split.filter("large is not null").withColumnRenamed("large", "component_id").unionByName(
        split.filter("large is null").drop("large").join(comp.drop("c"), ["h1", "h2"], "left"))
    linked = linked.select("doc_id", F.col("n").alias("n_shingles"),
                           F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
    alone = rows.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The document with the smallest doc_id of each component (rows with null doc_id stay), with all columns."""
    out = join(docs, k, percent).filter(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("_drop"))
    gone = written(out.distinct(), "similar-gone")
    rows = docs.select("doc_id", F.struct(*docs.columns).alias("_row"))
    return rows.join(bounded_broadcast(gone), F.col("doc_id") == F.col("_drop"), "left_anti").select("_row.*")


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE array_to_string(w[p:p + 2], ' ') END AS x
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS p FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 90 * (na.n + nb.n - count(*))),
r(doc_id, reached) AS (
  SELECT doc_id, doc_id FROM w UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.reached = l.a)
SELECT w.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r.reached) AS component_id
FROM w JOIN r USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY w.doc_id"""
