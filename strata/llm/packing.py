"""Packing documents into token sequences along a Hilbert curve.

Every document's token ids give a vector of few dimensions (a signed random
projection of its hashed token counts); the cell of that vector on a Hilbert
curve is its sort key. The documents are range-sorted by it and laid end to
end, cut at every ``length`` tokens, so neighbours on the curve share
sequences and only the last sequence of all is padded.

Only keys and token counts are range-sorted; a range that many copies fill is
split further by a hash of the id and text. The sums of tokens per range (one
row per partition) give each range its first position. Ids, two bytes each,
travel once, to meet their positions.

Defined cases: a null text is an empty document, which still has its end id;
repeated rows are documents of their own; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import map_arrow, stored

LENGTH = 1024
END_ID = 0
#: Dimensions of the curve and bits per dimension (their product is the key's width).
DIMS = 3
BITS = 16
#: Chunks whose ids a worker remembers.
CACHE = 400_000
#: White space in a row that goes to ``tokenizers``; the regular expression of ``tiktoken`` gives up on a million.
RUN = 100_000
SEED = 20_240_601

_LONG_RUN = re.compile(r"\s{%d}" % RUN)


class Encoder:
    """Token ids of the byte-level BPE vocabulary as little-endian 16-bit integers.

    ``tokenizers`` and ``tiktoken`` give the same ids with this vocabulary (the tests
    compare them); the second is faster. A single space before a visible character always
    starts a token, so texts are cut there and the ids of frequent chunks are remembered.
    The string of an added token in a text is that token, which only the first knows.
    """

    def __init__(self, json_path: str, ranks_path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.whole = Tokenizer.from_file(json_path)
        self.added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.cache: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """Ids of a text without added tokens."""
        ids = None
        if len(text) < RUN or not _LONG_RUN.search(text):
            try:
                ids = self.fast.encode_ordinary(text)
            except BaseException as e:  # a limit of the fast library on odd texts can be a panic, which is no Exception
                if not isinstance(e, Exception) and type(e).__name__ != "PanicException":
                    raise
        return self.slow(text) if ids is None else np.array(ids, dtype="<u2").tobytes()

    def slow(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u2").tobytes()

    def __call__(self, text: str) -> bytes:
        if any(a in text for a in self.added):
            return self.slow(text)
        chunks = text.split(" ")
        cache, out = self.cache, []
        first = True
        for c in chunks:
            if not first:
                c = " " + c
            got = cache.get(c)
            if got is None:
                inner = c if first else c[1:]
                if not inner or inner[0].isspace() or inner[-1].isspace():
                    return self.encode(text)
                if len(cache) >= CACHE:
                    cache.clear()
                got = self.encode(c)
                if len(c) < 64:
                    cache[c] = got
            out.append(got)
            first = False
        return b"".join(out)


_ENCODERS: dict[str, Encoder] = {}


def encoder(json_path: str | None = None) -> Encoder:
    """One encoder per worker; paths from the public tokenizer files unless given."""
    import public_tokenizers as P

    path = json_path or P.path("byte_bpe_50k.json")
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path, path.removesuffix(".json") + ".tiktoken", P.PATTERN)
    return _ENCODERS[path]


def hilbert_key(point: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position on the Hilbert curve of integer points (n, dims) in [0, 2**bits)."""
    x = point.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the rotations and reflections of each level
        p = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where((x[-1] & q) != 0, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def projection(dims: int = DIMS, vocabulary: int = 1 << 16) -> np.ndarray:
    """A hashed sign per token id and dimension."""
    return np.random.default_rng(SEED).choice(np.array([-1, 1], dtype=np.int8), size=(dims, vocabulary))


def curve_position(ids: np.ndarray, signs: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Integer point of one document: its projected count vector, scaled by its length, squashed to the grid."""
    v = np.array([s[ids].sum(dtype=np.int64) for s in signs], dtype=np.float64) / max(1.0, np.sqrt(len(ids)))
    return np.minimum((np.arctan(v / 4) / np.pi + 0.5) * (1 << bits), (1 << bits) - 1).astype(np.int64)


def _tokenize(batches: Iterator[pa.RecordBatch], json_path: str | None) -> Iterator[pa.RecordBatch]:
    enc, signs = encoder(json_path), projection()
    end = np.array([END_ID], dtype="<u2").tobytes()
    for b in batches:
        texts = b.column("text")
        for i in range(0, len(texts), 256):
            part = [enc(t.as_py() or "") + end for t in texts.slice(i, 256)]
            points = np.array([curve_position(np.frombuffer(p, dtype="<u2"), signs) for p in part])
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id").slice(i, 256),
                    b.column("tie").slice(i, 256),
                    pa.array(hilbert_key(points)),
                    pa.array([len(p) // 2 for p in part], pa.int64()),
                    pa.array(part, pa.binary()),
                ],
                names=["doc_id", "tie", "key", "doc_tokens", "ids"],
            )


def tokenized(df: DataFrame, json_path: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: id, tie breaker, curve key, number of ids and the ids (16-bit little-endian)."""
    t = F.col(f"`{text}`")
    src = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.xxhash64(F.col(f"`{doc_id}`"), t).alias("tie"), t.alias("text"))
    return map_arrow(
        src, lambda it: _tokenize(it, json_path), "doc_id long, tie long, key long, doc_tokens long, ids binary"
    )


def _lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Position of each document within its sorted range."""
    part, at = TaskContext.get().partitionId(), 0
    for b in batches:
        n = b.column("doc_tokens").to_numpy()
        inside = at + np.cumsum(n) - n
        at += int(n.sum())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(n), part, np.int32)),
                pa.array(inside),
                b.column("row"),
                b.column("doc_tokens"),
            ],
            names=["part", "inside", "row", "doc_tokens"],
        )


def _pieces(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    for b in batches:
        rows: dict[str, list] = {n: [] for n in names}
        for doc, at, n, ids in zip(
            b.column("doc_id").to_pylist(), b.column("at").to_pylist(), b.column("doc_tokens").to_pylist(), b.column("ids")
        ):
            wide = np.frombuffer(ids.as_py(), dtype="<u2").astype("<u4")
            start = 0
            while start < n:
                sequence, offset = divmod(at + start, length)
                size = min(length - offset, n - start)
                piece = (doc, start, size, zlib.crc32(wide[start : start + size].tobytes()), n, sequence, offset)
                for k, v in zip(names, piece):
                    rows[k].append(v)
                start += size
        yield pa.RecordBatch.from_arrays([pa.array(rows[n], pa.int64()) for n in names], names=names)


def pack(
    df: DataFrame, length: int = LENGTH, json_path: str | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per piece: its document, place in it, checksum, and place in a sequence.

    Token ids are stored once; only keys and counts are sorted, and every document's
    position comes back to its ids by row number. The sorted positions are stored too,
    because two passes (sums, then pieces) must see the same ranges even if an executor
    is lost between them.
    """
    docs = stored(
        tokenized(df, json_path, doc_id, text).withColumn("row", F.monotonically_increasing_id()), "tokens"
    )
    order = ["key", "tie", "doc_id", "row"]
    ranged = docs.select(*order, "doc_tokens").repartitionByRange("key", "tie").sortWithinPartitions(*order)
    laid = stored(map_arrow(ranged, _lay, "part int, inside long, row long, doc_tokens long"), "packing")
    sums = laid.groupBy("part").agg(F.sum("doc_tokens").alias("tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    # one row per shuffle partition: that count bounds the broadcast
    at = laid.join(F.broadcast(sums), "part").select("row", (F.col("base") + F.col("inside")).alias("at"))
    placed = docs.select("row", "doc_id", "doc_tokens", "ids").join(at, "row").drop("row")
    return map_arrow(
        placed,
        lambda it: _pieces(it, length),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )
