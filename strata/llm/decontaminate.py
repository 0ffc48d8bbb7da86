"""Benchmark decontamination: a broadcast hash set of the benchmark's word windows.

Texts are lower-cased (A-Z) and cut into words; every run of ``WINDOW`` words of a
benchmark item is a window, a shorter item is one window as a whole. The windows become
64-bit rolling hashes, which are broadcast as sorted arrays together with the SHA-256 of
each window and the item it comes from. A task hashes all word windows of its documents
at once, looks them up, and verifies each hit by the digest of its words. Verified hits
give the words to remove and the items concerned; documents are never shuffled.

The set is split by hash into as many slices as keep each within ``SLICE_BYTES``,
counted before anything is broadcast. With more than one slice (a very large benchmark)
every slice scans all documents by itself and the hits are merged per document.

Defined cases: null and word-less texts have no words and no hits; texts and words of any
length are scanned whole, in pieces that overlap by one window; rows that share an
item id are one item, a null item id counts as the empty text; repeated rows give repeated
rows; no documents give no rows, no benchmark gives no hits; only the text and what the
caller keeps are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.llm.common import lower_ascii, map_arrow, stored

WINDOW = 10
#: Bytes that are no part of a word (after lower-casing A-Z).
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
#: Broadcast bytes of one slice of the window set, and bytes of text hashed at once.
SLICE_BYTES, PIECE = 64 << 20, 1 << 20
#: Bytes of an entry beside its item id: hash, digest, offset.
_ENTRY = 48

_FOUND = "n_words long, n_hit long, items array<string>, spans array<struct<first:long,last:long,start:long,end:long>>"

# a word byte as it is compared, 0 for all others
_LETTER = np.zeros(256, np.uint8)
_LETTER[ord("0") : ord("9") + 1] = np.arange(ord("0"), ord("9") + 1)
_LETTER[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTER[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTER[128:] = np.arange(128, 256)

# odd multipliers of the two rolling hashes (bytes of a word, words of a window)
_BYTE, _WORD = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Rolling:
    """Hashes of all stretches of a sequence from one pass of sums, modulo 2**64."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def sums(self, values: np.ndarray) -> np.ndarray:
        if len(self.up) < len(values) + 1:
            n = len(values) + len(values) // 4 + 1024
            self.up, self.down = _powers(self.base, n), _powers(self.inverse, n)
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[: len(values)], out=out[1:])
        return out

    def between(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((sums[end] - sums[start]) * self.down[start])


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


class Words:
    """The words of a stretch of bytes; a word never crosses one of the ``breaks``."""

    bytes_, words_ = _Rolling(_BYTE), _Rolling(_WORD)

    def __init__(self, raw: np.ndarray, breaks: np.ndarray):
        self.letters = _LETTER[raw]
        inside = np.zeros(len(raw) + 2, bool)
        inside[1:-1] = self.letters > 0
        cut = np.zeros(len(raw) + 1, bool)
        cut[breaks] = True
        self.start = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
        self.end = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
        self.text = np.searchsorted(breaks, self.start, side="right")
        sums = self.bytes_.sums(self.letters.astype(np.uint64))
        self.hash = self.bytes_.between(sums, self.start, self.end)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of the windows of ``size`` words within one text."""
        n = len(self.start) - size + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        first = np.flatnonzero(self.text[:n] == self.text[size - 1 :])
        return first, self.words_.between(self.words_.sums(self.hash), first, first + size)

    def digest(self, first: int, size: int) -> bytes:
        cut = range(first, first + size)
        return hashlib.sha256(b" ".join(self.letters[self.start[i] : self.end[i]].tobytes() for i in cut)).digest()


class WindowSet:
    """A slice of the benchmark's (window, item) pairs, looked up by hash and digest."""

    def __init__(self, hashes: np.ndarray, digests: list[bytes], items: list[str], sizes: list[int]):
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.sizes = hashes[order], sizes
        self.digests = b"".join(digests[i] for i in order)
        self.items = pa.array([items[i] for i in order], pa.string())
        # a table of some hash bits answers nearly all lookups
        self.bits = max(10, int(np.ceil(np.log2(16 * len(hashes) + 1))))
        self.some = np.zeros(1 << self.bits, bool)
        self.some[self.slots(self.hashes)] = True

    def slots(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def hits(self, words: Words) -> Iterator[tuple[int, int, list[int]]]:
        """(first word, words, entries) of every verified window."""
        for size in self.sizes:
            first, h = words.windows(size)
            near = self.some[self.slots(h)]
            first, h = first[near], h[near]
            low, high = (np.searchsorted(self.hashes, h, side=s) for s in ("left", "right"))
            for i in np.flatnonzero(high > low):
                digest = words.digest(int(first[i]), size)
                same = [e for e in range(low[i], high[i]) if self.digests[32 * e : 32 * e + 32] == digest]
                if same:
                    yield int(first[i]), size, same


class _Found:
    """What one text has so far: spans of hit words in order, and the items hit."""

    def __init__(self):
        self.n_words, self.items, self.spans = 0, set(), []

    def add(self, first: int, last: int, start: int, end: int) -> None:
        """Hit words ``first`` to ``last`` (in bytes ``start`` to ``end``); pieces come in order."""
        if self.spans and first <= self.spans[-1][1] + 1:
            before = self.spans[-1]
            if last > before[1]:
                self.spans[-1] = (before[0], last, before[2], end)
        else:
            self.spans.append((first, last, start, end))

    def row(self) -> tuple[int, int, list[str], list[dict]]:
        spans = [dict(zip(("first", "last", "start", "end"), s)) for s in self.spans]
        return self.n_words, sum(s[1] - s[0] + 1 for s in self.spans), sorted(self.items), spans


def _look(words: Words, entries: WindowSet, found: list[_Found], offsets: np.ndarray, skip: int = 0, base: int = 0) -> None:
    """Enter the hits of ``words`` into ``found`` (by text); for a piece of one text, ``skip`` words
    were counted before and ``base`` is the number of the piece's first word."""
    change = np.zeros(len(words.start) + 1, np.int64)
    for first, size, same in entries.hits(words):
        change[first] += 1
        change[first + size] -= 1
        found[words.text[first]].items.update(entries.items[e].as_py() for e in same)
    for text, n in zip(*np.unique(words.text[skip:], return_counts=True)):
        found[text].n_words += int(n)
    hit = np.flatnonzero(np.cumsum(change[:-1]) > 0)
    if not len(hit):
        return
    cuts = np.flatnonzero((np.diff(hit) > 1) | (np.diff(words.text[hit]) > 0)) + 1
    first_word = np.searchsorted(words.text, np.arange(len(found)))
    for run in np.split(hit, cuts):
        text, a, b = words.text[run[0]], run[0], run[-1]
        shift = base - first_word[text]
        found[text].add(int(a + shift), int(b + shift), int(words.start[a] + offsets[text]), int(words.end[b] + offsets[text]))


def _scan_long(raw: np.ndarray, entries: WindowSet, piece: int) -> _Found:
    """One long text in pieces that end between words and begin with the last words of the one before."""
    found, at, back, seen = _Found(), 0, 0, 0
    overlap = max(entries.sizes, default=1) - 1
    while at < len(raw):
        end = min(at + piece, len(raw))
        while end < len(raw) and _LETTER[raw[end]]:
            gap = np.flatnonzero(_LETTER[raw[end : end + piece]] == 0)
            end = end + int(gap[0]) if len(gap) else min(end + piece, len(raw))
        words = Words(raw[back:end], np.empty(0, np.int64))
        skip = int(np.searchsorted(words.start, at - back))
        _look(words, entries, [found], np.array([back]), skip, seen - skip)
        seen += len(words.start) - skip
        keep = min(overlap, len(words.start))
        back, at = (back + int(words.start[len(words.start) - keep]) if keep else end), end
    return found


def _scan(texts: pa.Array, entries: WindowSet, piece: int) -> Iterator[_Found]:
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + piece, side="right")) - 1)
        if j == i + 1 and offsets[j] - offsets[i] > piece:
            yield _scan_long(raw[offsets[i] : offsets[j]], entries, piece)
        else:
            starts = offsets[i : j + 1] - offsets[i]
            # empty texts share their start with the next one: a word belongs to the last that starts at or before it
            found = [_Found() for _ in range(i, j)]
            _look(Words(raw[offsets[i] : offsets[j]], starts[1:-1]), entries, found, -starts[:-1])
            yield from found
        i = j


def _rows(found: list[_Found]) -> list[pa.Array]:
    types = (pa.int64(), pa.int64(), pa.list_(pa.string()),
             pa.list_(pa.struct([(n, pa.int64()) for n in ("first", "last", "start", "end")])))
    columns = list(zip(*[f.row() for f in found])) or [[]] * 4
    return [pa.array(list(c), t) for c, t in zip(columns, types)]


def _hash_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rolling hash of each window's words."""
    for b in batches:
        hashes = []
        for text, size in zip(b.column("grams").to_pylist(), b.column("size").to_pylist()):
            raw = np.frombuffer(text.encode(), np.uint8)
            hashes.append(int(Words(raw, np.empty(0, np.int64)).windows(size)[1][0].astype(np.int64)))
        digest = [hashlib.sha256(t.encode()).digest() for t in b.column("grams").to_pylist()]
        names = ["h", "digest", "size", "item"]
        yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(digest, pa.binary()), b.column("size"), b.column("item")], names=names)


def item_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Every distinct (window, item): rolling hash ``h``, SHA-256 ``digest``, words ``size`` and ``item``."""
    words = F.filter(F.split(lower_ascii(F.coalesce(F.col(f"`{text}`"), F.lit(""))), NOT_WORD + "+", -1), lambda w: w != "")
    cut = benchmark.select(F.coalesce(F.col(f"`{item}`").cast("string"), F.lit("")).alias("item"), words.alias("w"))
    cut = cut.where(F.size("w") > 0).withColumn("size", F.least(F.size("w"), F.lit(window)))
    first = F.sequence(F.lit(1), F.size("w") - F.col("size") + 1)
    grams = cut.select("item", "size", F.explode(F.transform(first, lambda i: F.array_join(F.slice("w", i, F.col("size")), " "))).alias("grams"))
    return map_arrow(grams.distinct(), _hash_windows, "h long, digest binary, size int, item string")


def find(
    docs: DataFrame, benchmark: DataFrame, keep: Column, text: str = "text", item: str = "item_id",
    window: int = WINDOW, slice_bytes: int = SLICE_BYTES, piece: int = PIECE,
) -> DataFrame:
    """``row`` (what ``keep`` names), ``n_words``, ``n_hit`` words inside benchmark windows, the
    ``items`` whose windows occur, and the maximal ``spans`` of hit words (words and bytes; last word
    included, end byte excluded)."""
    spark = docs.sparkSession
    windows = stored(item_windows(benchmark, item, text, window), "benchmark_windows")
    total = windows.agg(F.sum(F.octet_length("item") + _ENTRY)).first()[0] or 0
    sizes = sorted(r[0] for r in windows.select("size").distinct().collect())  # at most ``window`` numbers
    slices = max(1, -(-total // slice_bytes))
    read = docs.select(keep.alias("row"), F.col(f"`{text}`").alias("text"))
    if slices > 1:  # rows meet again by number
        read = stored(read.withColumn("number", F.monotonically_increasing_id()), "numbered_documents")
    kept = [f for f in read.schema.fields if f.name != "text"]
    schema = StructType([*kept, *StructType.fromDDL(_FOUND).fields])
    part = F.pmod(F.xxhash64("digest", "item"), F.lit(slices))
    names = [f.name for f in schema.fields]

    def scanned(number: int) -> DataFrame:
        got = windows.where(part == number).toArrow()  # bounded by slice_bytes
        hashes = got.column("h").to_numpy().astype(np.int64).view(np.uint64)
        digests, items = got.column("digest").to_pylist(), got.column("item").to_pylist()
        entries = spark.sparkContext.broadcast(WindowSet(hashes, digests, items, sizes))

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                found = list(_scan(b.column("text"), entries.value, piece))
                yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in kept], *_rows(found)], names=names)

        return map_arrow(read, task, schema)

    if slices == 1:
        return scanned(0)
    every = scanned(0)
    for i in range(1, slices):
        every = every.unionByName(scanned(i))
    first = [F.first(f.name).alias(f.name) for f in kept if f.name != "number"]
    merged = every.groupBy("number").agg(
        *first, F.first("n_words").alias("n_words"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
    )

    def join_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for n, items, spans in zip(*[b.column(c).to_pylist() for c in ("n_words", "items", "spans")]):
                f = _Found()
                f.n_words, f.items = n, set(items)
                for s in spans:
                    f.add(s["first"], s["last"], s["start"], s["end"])
                found.append(f)
            yield pa.RecordBatch.from_arrays([b.column("row"), *_rows(found)], names=["row", *names[-4:]])

    return map_arrow(merged, join_spans, StructType([f for f in schema.fields if f.name != "number"]))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, remove: str = "spans", text: str = "text", item: str = "item_id", **options
) -> DataFrame:
    """The documents without what they share with the benchmark, in their own columns:
    ``remove="spans"`` cuts the hit words out, ``"documents"`` drops documents with a hit."""
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove {remove!r}")
    found = find(docs, benchmark, F.struct("*"), text, item, **options)
    rows = [F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    if remove == "documents":
        return found.where("n_hit = 0").select(*rows)
    raw = F.encode(F.col(f"row.`{text}`"), "UTF-8")
    ends = F.concat(F.array(F.lit(0).cast("long")), F.col("spans.end"))
    starts = F.concat(F.col("spans.start"), F.array(F.octet_length(raw).cast("long")))
    pieces = F.zip_with(ends, starts, lambda a, b: F.decode(raw.substr((a + 1).cast("int"), (b - a).cast("int")), "UTF-8"))
    cut = F.when(F.size("spans") == 0, F.col(f"row.`{text}`")).otherwise(F.array_join(pieces, ""))
    return found.select(*[cut.alias(c) if c == text else r for c, r in zip(docs.columns, rows)])
