"""Operator 1: token ids in Parquet list columns.

``write_tokens`` range-partitions documents by doc_id, encodes them on the
executors and writes one row per document: doc_id, n_tokens, file_start (ids
before it in its file) and ids. Ids are dictionary-encoded list values; the
Parquet version 2 writer falls back to delta packing. Row groups and pages
have fixed byte sizes and column/offset indexes, so a filter on doc_id reads
only the pages that can match and ``read_index`` never touches the ids.

Files are in ascending doc_id order (the part number is the order of the
range partitions, rows are sorted inside). ``start`` is file_start plus the
ids of all earlier files: one total per file is summed, never the rows.

Encoding runs the tokenizers library over whole texts. Some vocabularies
encode every piece of every white-space separated chunk on its own (``_word_rule``); there
a block of texts is cut into pieces with array operations, each distinct piece
is looked up once in a bounded per-worker cache, and only new pieces go through the library (chunks with
other characters than ASCII and Latin-1 letters go through it whole). Other vocabularies encode each text as one.
The ids are the same either way (tests compare both).

Defined cases: null text counts as empty and gives only the end id; null
doc_ids come first; repeated rows are written as often as they occur; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.common import bounded_broadcast, small_arrow_batches, text_of
from feedlake.llm.words import blocks, span_hashes
from feedlake.session import scratch_path

END_ID = 1
WRITE_OPTIONS = {
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "true",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(128 << 10),
    "parquet.page.row.count.limit": "2000",
    "compression": "zstd",
}

#: The split pattern and word end of the vocabulary file that encodes chunks on their own.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"

PIECE_CACHE, CHUNK_CACHE, JOINED = 300_000, 30_000, 256
BLOCK_BYTES = 1 << 20

#: Classes of lower-case bytes: white space, letters, digits, others.
_SPACE, _LETTER, _DIGIT, _OTHER = 0, 1, 2, 3
_CLASS = np.full(256, _OTHER, np.int8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[ord("a"):ord("z") + 1] = _LETTER
_CLASS[ord("0"):ord("9") + 1] = _DIGIT
#: Second bytes (after C3) of the Latin-1 letters, and of those in upper case.
_LATIN, _LATIN_UPPER = np.zeros(256, bool), np.zeros(256, bool)
_LATIN[0x80:0xC0] = True
_LATIN_UPPER[0x80:0x9F] = True
_LATIN[[0x97, 0xB7]] = _LATIN_UPPER[0x97] = False
#: Masks of the first 0 to 8 bytes of a little-endian word.
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


class Cache:
    """Ids by key, bounded: a full generation is kept until the next is full, so keys in use are not learned again."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def ids(self, keys: list[bytes], learn: Callable[[list[bytes]], list[bytes]]) -> list[bytes]:
        found = list(map(self.new.get, keys))
        missing = [i for i, x in enumerate(found) if x is None]
        if not missing:
            return found
        lost = list(dict.fromkeys([keys[i] for i in missing]))
        if len(self.new) + len(lost) > self.size:
            self.old, self.new = self.new, {}
        if self.old:
            again = {k: x for k, x in zip(lost, map(self.old.get, lost)) if x is not None}
            self.new.update(again)
            lost = [k for k in lost if k not in again]
        if lost:
            self.new.update(zip(lost, learn(lost)))
        for i in missing:
            found[i] = self.new[keys[i]]
        return found


def split_units(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, plain) of the units of a block of text that ends in white space.

    Plain chunks (ASCII and the Latin-1 letters, all NFC-stable, without the special token's opening) are lower-cased and cut into the
    pieces of ``WORD_PATTERN``; any other white-space separated chunk is one unit as it stands.
    """
    low = raw + (((raw >= 65) & (raw <= 90)) * np.uint8(32))
    kind = _CLASS[low]
    strange = np.zeros(len(raw), bool)
    high = np.flatnonzero(raw >= 0x80)
    if len(high):
        strange[high] = True
        lead = high[raw[high] == 0xC3]
        lead = lead[_LATIN[raw[lead + 1]]]
        strange[lead] = strange[lead + 1] = False
        kind[lead] = kind[lead + 1] = _LETTER
        low[lead + 1] += _LATIN_UPPER[raw[lead + 1]] * np.uint8(32)
    strange[:-1] |= (raw[:-1] == ord("<")) & (raw[1:] == ord("|"))
    inside = kind != _SPACE
    change = np.concatenate(([True], kind[1:] != kind[:-1]))
    cut = inside & (change | (kind == _DIGIT))
    edge = np.flatnonzero(np.concatenate(([inside[0]], inside[1:] != inside[:-1])))
    starts, ends = edge[::2], edge[1::2]
    # contractions: an apostrophe alone between pieces takes the letters after it along
    mark = np.flatnonzero((raw == ord("'")) & cut)
    mark = mark[kind[mark + 1] == _LETTER]
    one, two = low[mark + 1], low[np.minimum(mark + 2, len(low) - 1)]
    taken = np.isin(one, np.frombuffer(b"stmd", np.uint8)).astype(np.int64)
    for pair in (b"re", b"ve", b"ll"):
        taken[(one == pair[0]) & (two == pair[1])] = 2
    mark, taken = mark[taken > 0], taken[taken > 0]
    cut[mark + 1] = False
    after = mark + 1 + taken
    cut[after] |= inside[after]
    # strange chunks stay whole
    hit = np.flatnonzero(strange)
    if 16 * len(hit) < len(raw):
        odd = np.unique(np.searchsorted(starts, hit, side="right") - 1)
    else:
        odd = np.flatnonzero(np.add.reduceat(strange, starts))
    if len(odd):
        step = np.zeros(len(raw) + 1, np.int8)
        step[starts[odd]] = 1
        step[ends[odd]] -= 1
        within = np.cumsum(step[:-1], dtype=np.int8) > 0
        cut &= ~within
        cut[starts[odd]] = True
        low[within] = raw[within]
    first = np.flatnonzero(cut)
    chunk = np.searchsorted(starts, first, side="right") - 1
    last = np.minimum(np.concatenate((first[1:], [len(raw)])), ends[chunk]) if len(first) else first
    plain = np.ones(len(starts), bool)
    plain[odd] = False
    return low, first, last, plain[chunk] if len(first) else np.ones(0, bool)


def _distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of one element of each value, ascending by value; each element's place among the values)."""
    order = np.argsort(h)
    ranked = h[order]
    new = np.ones(len(h), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    which = np.empty(len(h), np.int64)
    which[order] = np.cumsum(new) - 1
    return order[new], which


def same_spans(data: np.ndarray, starts: np.ndarray, others: np.ndarray, lengths: np.ndarray) -> bool:
    """True if the bytes of each span equal those at the other start, compared eight at a time."""
    words = np.ndarray(len(data), "<u8", np.concatenate((data, np.zeros(7, np.uint8))), 0, (1,)).copy()
    left = np.flatnonzero(starts != others)
    while len(left):
        starts, others, lengths = starts[left], others[left], lengths[left]
        if ((words[starts] ^ words[others]) & _FIRST_BYTES[np.minimum(lengths, 8)]).any():
            return False
        left = np.flatnonzero(lengths > 8)
        starts, others, lengths = starts + 8, others + 8, lengths - 8
    return True


class Encoder:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.no_padding()
        self.lib.no_truncation()
        with open(path, encoding="utf-8") as f:
            self.by_word = self._word_rule(json.load(f))
        self.pieces, self.chunks = Cache(PIECE_CACHE), Cache(CHUNK_CACHE)

    def _word_rule(self, spec: dict) -> bool:
        """True if the file's rules never join or merge anything across white space."""
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        splits = [p for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", []) if p["type"] == "Split"]
        if kinds != ["NFC", "Replace", "Lowercase"] or len(splits) != 1:
            return False
        if splits[0]["pattern"].get("Regex") != WORD_PATTERN or spec["model"].get("end_of_word_suffix") != WORD_END:
            return False
        vocab = self.lib.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith(WORD_END)]] = True
        self.mark = "<|endoftext|>"
        self.mark_id = vocab.get(self.mark)
        return self.mark_id is not None and len(self.ends) < 1 << 24

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, parts: list[str], sep: str) -> list[bytes]:
        """Ids of many short strings, ``JOINED`` in a call; strings whose borders are unsure go one by one."""
        out: list[bytes] = []
        groups = [parts[i:i + JOINED] for i in range(0, len(parts), JOINED)]
        for group, e in zip(groups, self.lib.encode_batch_fast([sep.join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            if sep == " ":
                stop = np.flatnonzero(self.ends[ids]) + 1
                start = np.concatenate(([0], stop[:-1])) if len(stop) else stop
            else:
                mark = np.flatnonzero(ids == self.mark_id)
                start, stop = np.concatenate(([0], mark + 1)), np.concatenate((mark, [len(ids)]))
            if len(stop) != len(group) or (len(stop) and stop[-1] != len(ids)):
                out += self._whole(group)
            else:
                raw = ids.tobytes()
                out += [raw[4 * a:4 * b] for a, b in zip(start.tolist(), stop.tolist())]
        return out

    def _piece_ids(self, pieces: list[bytes]) -> list[bytes]:
        return self._joined([p.decode() for p in pieces], " ")

    def _strange_ids(self, chunks: list[bytes]) -> list[bytes]:
        strings = [c.decode("utf-8", "replace") for c in chunks]
        marked = ["<|" in s for s in strings]
        alone = iter(self._whole([s for s, m in zip(strings, marked) if m]))
        rest = iter(self._joined([s for s, m in zip(strings, marked) if not m], self.mark))
        return [next(alone if m else rest) for m in marked]

    def _block(self, texts: list[bytes]) -> list[bytes]:
        """Ids of a block of texts: each distinct unit is looked up once, its ids are copied to all places by index."""
        data, starts, ends, plain = split_units(np.frombuffer(b" ".join(texts) + b" ", np.uint8))
        lengths = ends - starts
        h = (span_hashes(data, starts, ends) >> np.uint64(1)) | (plain.astype(np.uint64) << np.uint64(63))  # plain units come last
        first, which = _distinct(h)
        # are equal hashes equal units? their bytes are compared; after a collision every unit is looked up
        if not ((lengths == lengths[first][which]).all() and same_spans(data, starts, starts[first][which], lengths)):
            first = np.argsort(plain, kind="stable")
            which = np.argsort(first)
        raw = data.tobytes()
        keys = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        strange = len(keys) - int(plain[first].sum())
        ids = self.chunks.ids(keys[:strange], self._strange_ids) + self.pieces.ids(keys[strange:], self._piece_ids)
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        values, offsets = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(size) - size
        n = size[which]
        stops = np.cumsum(n)
        out = values[np.repeat(offsets[which] - (stops - n), n) + np.arange(int(stops[-1]) if len(n) else 0)].tobytes()
        units = np.searchsorted(starts, np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1))  # up to each text's end
        bounds = 4 * np.concatenate(([0], np.concatenate(([0], stops))[units]))
        return [out[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if not self.by_word:
            return self._whole([t.decode("utf-8", "replace") for t in texts])
        return [ids for lo, hi in blocks(texts, BLOCK_BYTES) for ids in self._block(texts[lo:hi])]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each Python worker and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _encode_batches(path: str, end_id: int, step: int = 1000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gc

        enc, total = encoder(path), 0
        end = np.array([end_id], "<u4").tobytes()
        collected = gc.isenabled()
        gc.disable()  # the caches hold no cycles, and scanning them is most of a collection
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, step):
                    part = batch.slice(at, step)
                    ids = [x + end for x in enc.encode(part.column("text").cast(pa.binary()).to_pylist())]
                    n = np.array([len(x) // 4 for x in ids], np.int64)
                    offsets = np.concatenate(([0], np.cumsum(n)))
                    values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(ids))])
                    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id"), pa.array(n), pa.array(total + offsets[:-1]), lists],
                        ["doc_id", "n_tokens", "file_start", "ids"])
                    total += int(offsets[-1])
        finally:  # also when the task is cancelled: the worker is used again
            if collected:
                gc.enable()

    return run


def write_tokens(docs: DataFrame, tokenizer_path: str, out: str, end_id: int = END_ID) -> None:
    """Encode ``docs`` (doc_id, text) and write the token files to ``out``."""
    small_arrow_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", text_of().alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    coded = rows.mapInArrow(_encode_batches(tokenizer_path, end_id),
                            f"doc_id {kind}, n_tokens bigint, file_start bigint, ids array<int>")
    coded.write.options(**WRITE_OPTIONS).parquet(out)


def _with_start(rows: DataFrame, out: str) -> DataFrame:
    """Add ``start``: ids of all documents before the row, from one total per file."""
    files = rows.sparkSession.read.parquet(out).groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.sum("n_tokens").alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    return (rows.join(bounded_broadcast(files), "file")
            .withColumn("start", (F.col("file_start") + F.col("_before")).cast("bigint")).drop("_before"))


def read_index(spark, out: str) -> DataFrame:
    """doc_id, start, n_tokens; the id lists are not read."""
    rows = spark.read.parquet(out).select("doc_id", "n_tokens", "file_start", F.col("_metadata.file_name").alias("file"))
    return _with_start(rows, out).select("doc_id", "start", "n_tokens")


def read_tokens(spark, out: str, first=None, last=None) -> DataFrame:
    """doc_id, ids of documents with first <= doc_id <= last; other row groups and pages are skipped by their index."""
    rows = spark.read.parquet(out).select("doc_id", "ids")
    if first is not None:
        rows = rows.filter(F.col("doc_id") >= F.lit(first))
    return rows if last is None else rows.filter(F.col("doc_id") <= F.lit(last))


def _crc_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        offsets = lists.offsets.to_numpy()
        raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4")).cast("B")
        crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("file"), batch.column("file_start"),
             pa.array(np.diff(offsets).astype(np.int64)), pa.array(crc, pa.int64())],
            ["doc_id", "file", "file_start", "n_tokens", "ids_crc32"])


def token_digest(spark, out: str) -> DataFrame:
    """Per document, read back from the files: doc_id, start, n_tokens, ids_crc32."""
    rows = spark.read.parquet(out).select("doc_id", F.col("_metadata.file_name").alias("file"), "file_start", "ids")
    kind = rows.schema["doc_id"].dataType.simpleString()
    sums = rows.mapInArrow(_crc_batches, f"doc_id {kind}, file string, file_start bigint, n_tokens bigint, ids_crc32 bigint")
    return _with_start(sums, out).select("doc_id", "start", "n_tokens", "ids_crc32")


def encode_and_digest(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Write the token files to the shared scratch folder and return their digest."""
    out = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, tokenizer_path, out, end_id)
    return token_digest(docs.sparkSession, out)
