"""Removal of repeated byte strings by a sparse suffix array with deep-shallow sorting.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts
anywhere else. Every window of that length contains one anchor, the leftmost
smallest hash of its ``GRAM``-byte strings; equal windows have equal anchors at
equal places. So only suffixes that start at an anchor whose hash occurs twice
are sorted, each with the bytes of the windows that chose it.

Periodic texts repeat one anchor every few bytes. Such runs of anchors are kept
as one row each, and of the equal contexts of a text only one leaves it: the
others are repeats already.

Suffixes of one anchor string meet in one task, which orders the bytes after the
anchor, and the bytes before it read backwards, by deep-shallow sorting: multikey
quicksort to a shallow depth, then a blind trie for each group that still shares
its prefix. From the common prefixes of neighbours in both orders follows, for
every place of the window, which windows are equal. An anchor string with more
than ``HOT`` rows is taken apart by window: its windows' digests are counted
over all tasks instead, with partial sums before the shuffle.

Texts are shuffled once (both joins use the same exchange).

Defined cases: a null text is empty; repeated rows are documents of their own,
copies of each other; texts shorter than the length stay whole; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_arrow, stored

LENGTH = 400
GRAM = 160
HOT = 20_000
#: Depth of the multikey quicksort before blind tries take over.
SHALLOW = 32
#: Window starts of a text handled at a time, and places of a packed minimum.
CHUNK = 1 << 20
_PLACE = 21

_MUL = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _POWERS[name] = np.cumprod(p, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """64-bit hash of every ``gram``-byte string (prefix sums of a polynomial, then mixed)."""
    n = len(data)
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * down[: n - gram + 1]
    h ^= h >> np.uint64(32)
    h *= _MUL
    h ^= h >> np.uint64(29)
    return h


def anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(hash, place, first window, last window) of every anchor of a text."""
    found = []
    starts = len(data) - length + 1
    span = length - gram + 1  # strings per window
    for at in range(0, max(starts, 0), CHUNK):
        many = min(CHUNK, starts - at)
        h = gram_hashes(data[at : at + many + length - 1], gram)
        low = (h >> np.uint64(_PLACE) << np.uint64(_PLACE)) | np.arange(len(h), dtype=np.uint64)
        size = 1
        while size * 2 <= span:  # sliding minimum by doubling
            low = np.minimum(low[: len(low) - size], low[size:])
            size *= 2
        if size < span:
            low = np.minimum(low[:many], low[span - size : span - size + many])
        place = (low[:many] & np.uint64((1 << _PLACE) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        last = np.concatenate((first[1:], [many])) - 1
        where = place[first]
        found.append((h[where].view(np.int64), where + at, first + at, last + at))
    if not found:
        empty = np.empty(0, np.int64)
        return empty, empty, empty, empty
    return tuple(np.concatenate(x) for x in zip(*found))


def anchor_runs(h, place, first, last) -> tuple[np.ndarray, ...]:
    """Anchors (h, place, first, last) with ``step`` and ``reps``: neighbours of equal hash, shape and
    distance are one row, the i-th of which lies i * step bytes further."""
    if not len(h):
        return h, place, first, last, h, h
    step = np.concatenate(([0], np.diff(place)))
    like = np.zeros(len(h), dtype=bool)
    like[1:] = (h[1:] == h[:-1]) & (np.diff(place - first) == 0) & (np.diff(last - first) == 0)
    turn = np.zeros(len(h), dtype=bool)
    turn[2:] = like[2:] & like[1:-1] & (step[2:] != step[1:-1])
    start = np.flatnonzero(~like | turn)
    reps = np.diff(np.concatenate((start, [len(h)])))
    after = np.minimum(start + 1, len(h) - 1)
    return h[start], place[start], first[start], last[start], np.where(reps > 1, step[after], 0), reps


def _anchor_rows(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    names = ["h", "id", "digest", "place", "first", "last", "step", "reps"]
    for b in batches:
        ids, digests = b.column("id").to_numpy(), b.column("digest").to_numpy()
        parts, size = [], 0

        def flush() -> pa.RecordBatch:
            cols = [np.concatenate(c) for c in zip(*parts)]
            types = [pa.int64()] * 3 + [pa.int32()] * 5
            return pa.RecordBatch.from_arrays([pa.array(c).cast(t) for c, t in zip(cols, types)], names=names)

        for i, t in enumerate(b.column("text")):
            data = np.frombuffer((t.as_py() or "").encode("utf-8", "surrogatepass"), np.uint8)
            if len(data) < length:
                continue
            h, *rest = anchor_runs(*anchors(data, length, gram))
            n = len(h)
            parts.append((h, np.full(n, ids[i]), np.full(n, digests[i]), *rest))
            size += n
            if size > 100_000:
                yield flush()
                parts, size = [], 0
        if parts:
            yield flush()


def common_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix, known to be at least ``start``."""
    low, high = start, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:  # a[:low] == b[:low], a[:high] != b[:high]
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class BlindTrie:
    """Orders strings that share a prefix: nodes keep a depth and branch on one byte; the rest is
    compared once per string, with the one leaf that a blind descent finds."""

    END = -1  # branch of a string that ends at the node's depth

    def __init__(self, strings: list[bytes], depth: int):
        self.strings = strings
        self.root: int | list = 0  # a leaf is a string's index, a node is [depth, {byte: child}]
        for i in range(1, len(strings)):
            self._insert(i, depth)

    def _branch(self, i: int, depth: int) -> int:
        s = self.strings[i]
        return s[depth] if depth < len(s) else self.END

    def _insert(self, i: int, depth: int) -> None:
        at = self.root
        while isinstance(at, list):
            at = at[1].get(self._branch(i, at[0])) if self._branch(i, at[0]) in at[1] else next(iter(at[1].values()))
        lcp = common_prefix(self.strings[i], self.strings[at], depth)
        parent, key, node = None, None, self.root
        while isinstance(node, list) and node[0] < lcp:
            parent, key = node, self._branch(i, node[0])
            node = node[1][key]
        if isinstance(node, list) and node[0] == lcp:
            node[1][self._branch(i, lcp)] = i
            return
        old = node
        while isinstance(old, list):
            old = next(iter(old[1].values()))
        split = [lcp, {self._branch(old, lcp): node, self._branch(i, lcp): i}]
        if parent is None:
            self.root = split
        else:
            parent[1][key] = split

    def walk(self) -> Iterator[tuple[int, int]]:
        """(index, common prefix with the string before; -1 for the first) in order."""
        stack, lcp = [(self.root, -1)], -1
        while stack:
            node, lcp = stack.pop()
            if isinstance(node, list):
                for n, key in enumerate(sorted(node[1], reverse=True)):
                    first = n == len(node[1]) - 1
                    stack.append((node[1][key], lcp if first else node[0]))
            else:
                yield node, lcp


def suffix_order(strings: list[bytes], shared: int = 0) -> tuple[list[int], list[int]]:
    """Order of distinct strings with ``shared`` bytes in common, and the common prefix of each with
    the one before it: multikey quicksort down to ``SHALLOW`` bytes, blind tries below."""
    order: list[int] = []
    lcps: list[int] = []
    # (indices, depth they share, common prefix of the first with what stands before)
    stack = [(list(range(len(strings))), shared, 0)]
    while stack:
        group, depth, before = stack.pop()
        if len(group) == 1:
            order.append(group[0])
            lcps.append(before)
        elif depth >= shared + SHALLOW:
            for i, lcp in BlindTrie([strings[g] for g in group], depth).walk():
                order.append(group[i])
                lcps.append(before if lcp < 0 else lcp)
        else:
            byte = [strings[g][depth] if depth < len(strings[g]) else -1 for g in group]
            pivot = sorted((byte[0], byte[len(byte) // 2], byte[-1]))[1]
            less = [g for g, c in zip(group, byte) if c < pivot]
            same = [g for g, c in zip(group, byte) if c == pivot]
            more = [g for g, c in zip(group, byte) if c > pivot]
            if more:
                stack.append((more, depth, depth))
            stack.append((same, depth + 1, depth if less else before))
            if less:
                stack.append((less, depth, before))
    return order, lcps


def _classes(order: list[int], lcps: list[int], lengths: np.ndarray, depths: np.ndarray) -> np.ndarray:
    """Class of every string at every depth: equal iff the strings agree so far; too short: its own."""
    order_ = np.array(order)
    cut = np.array(lcps)[None, :] < depths[:, None]
    cut[:, 0] = True
    out = np.empty(cut.shape, dtype=np.int64)
    out[:, order_] = np.cumsum(cut, axis=1)
    short = lengths[None, :] < depths[:, None]
    return np.where(short, len(order) + 1 + np.arange(len(order))[None, :], out)


def equal_windows(befores: list[bytes], afters: list[bytes], length: int, gram: int) -> np.ndarray:
    """Per (d, member): does the window that starts d bytes before the anchor occur again in the group?

    Members are distinct pairs of backward and forward bytes. One row per d from 0 to length - gram.
    """
    left, right = list(dict.fromkeys(befores)), list(dict.fromkeys(afters))
    l_at, r_at = ({s: i for i, s in enumerate(x)} for x in (left, right))
    d = np.arange(length - gram + 1)
    # all begin with the anchor's bytes, unless two strings share its hash
    shared = gram if len({r[:gram] for r in right}) == 1 else 0
    rc = _classes(*suffix_order(right, shared), np.array([len(s) for s in right]), length - d)
    lc = _classes(*suffix_order(left), np.array([len(s) for s in left]), d)
    key = rc[:, [r_at[s] for s in afters]] * (2 * len(left) + 2) + lc[:, [l_at[s] for s in befores]]
    out = np.zeros(key.shape, dtype=bool)
    for row, flags in zip(key, out):
        order = np.argsort(row, kind="stable")
        same = row[order][1:] == row[order][:-1]
        flags[order[1:]] |= same
        flags[order[:-1]] |= same
    return out


_SPAN = "id long, digest long, first int, last int"


def _group_spans(members: list[tuple], length: int, gram: int) -> Iterator[tuple]:
    """Repeated windows (id, digest, first, last) of one anchor string's suffixes.

    A member is (id, digest, place, first, last, bytes, settled); a settled one occurs again
    in its own text, which has been reported.
    """
    # equal contexts are one member, repeated
    distinct: dict[tuple[bytes, int], list[tuple]] = {}
    for m in members:
        distinct.setdefault((m[5], m[2] - m[3]), []).append(m)
    contexts = list(distinct)
    flags = None
    if len(contexts) > 1:
        befores = [c[:a][::-1] for c, a in contexts]
        afters = [c[a:] for c, a in contexts]
        flags = equal_windows(befores, afters, length, gram)
    for i, group in enumerate(distinct.values()):
        if len(group) > 1:  # the whole context occurs again
            for m in group:
                if not m[6]:
                    yield m[0], m[1], m[3], m[4]
        elif flags is not None and not group[0][6]:
            id_, digest, place, first, last, _, _ = group[0]
            mine = flags[place - last : place - first + 1, i][::-1]  # by window start
            edge = np.flatnonzero(np.diff(np.concatenate(([0], mine.astype(np.int8), [0]))))
            for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
                yield id_, digest, first + a, first + b - 1


def _spans(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Repeated windows of all anchor strings of a partition, which come sorted."""

    def rows_to_batch(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) if rows else [[], [], [], []]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, types)], names=["id", "digest", "first", "last"]
        )

    now, members, out = None, [], []
    for b in batches:
        cols = [b.column(c).to_pylist() for c in ("id", "digest", "place", "first", "last", "bytes", "settled")]
        for h, *m in zip(b.column("h").to_pylist(), *cols):
            if m[5] is None:  # a run of windows that its own text repeats
                out.append((m[0], m[1], m[3], m[4]))
                continue
            if h != now:
                if len(members) > 1:
                    out.extend(_group_spans(members, length, gram))
                now, members = h, []
                if len(out) > 20_000:
                    yield rows_to_batch(out)
                    out = []
            members.append(tuple(m))
    if len(members) > 1:
        out.extend(_group_spans(members, length, gram))
    yield rows_to_batch(out)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of (first, last) runs of window starts."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _text_contexts(data: bytes, found: list[dict], length: int) -> Iterator[tuple]:
    """(h, place, first, last, bytes, settled) of the candidate anchors of one text: every different
    context once; then the runs of windows of the contexts that occur again in the text, without bytes."""
    seen: dict[tuple[int, int, bytes], list[tuple[int, int]]] = {}
    for x in found:
        for i in range(x["reps"]):
            first, last = x["first"] + i * x["step"], x["last"] + i * x["step"]
            key = (x["h"], x["place"] - x["first"], data[first : last + length])
            seen.setdefault(key, []).append((first, last))
    again = []
    for (h, before, context), places in seen.items():
        first, last = places[0]
        yield h, first + before, first, last, context, len(places) > 1
        if len(places) > 1:
            again += places
    for first, last in merged(again):
        yield first, first, first, last, None, True


def _contexts(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the windows of every candidate anchor."""
    types = [pa.int64()] * 3 + [pa.int32()] * 3 + [pa.binary(), pa.bool_()]
    names = ["h", "id", "digest", "place", "first", "last", "bytes", "settled"]
    for b in batches:
        rows, size = [], 0
        for text, id_, digest, found in zip(
            b.column("text"), b.column("id").to_pylist(), b.column("digest").to_pylist(), b.column("found").to_pylist()
        ):
            data = (text.as_py() or "").encode("utf-8", "surrogatepass")
            for h, place, first, last, context, settled in _text_contexts(data, found, length):
                rows.append((h, id_, digest, place, first, last, context, settled))
                size += len(context or b"")
                if size > 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _window_digests(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """One row per window of the contexts of hot anchor strings: 128-bit digest, place, and how often
    the context counts (twice if its own text repeats it). Runs without bytes pass, their digest null."""
    names = ["id", "digest", "first", "last", "low", "high", "times"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
    for b in batches:
        for i in range(0, b.num_rows, 256):
            rows = []
            cols = (b.slice(i, 256).column(c).to_pylist() for c in ("id", "digest", "first", "last", "bytes", "settled"))
            for id_, digest, first, last, data, settled in zip(*cols):
                if data is None:
                    rows.append((id_, digest, first, last, None, None, 0))
                    continue
                for s in range(len(data) - length + 1):
                    w = xxhash.xxh3_128_digest(data[s : s + length])
                    low, high = (int.from_bytes(x, "big", signed=True) for x in (w[:8], w[8:]))
                    rows.append((id_, digest, first + s, first + s, low, high, 1 + settled))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _strip(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Remove the union of the repeated windows of every text."""
    for b in batches:
        rows = []
        for text, spans in zip(b.column("text"), b.column("spans").to_pylist()):
            data = (text.as_py() or "").encode("utf-8", "surrogatepass")
            keep, at, removed, runs = [], 0, 0, 0
            end = -1
            for s in sorted((x["first"], x["last"] + length) for x in spans or ()):
                if s[0] > end:  # a new run; touching runs are one
                    runs += 1
                    keep.append(data[at : s[0]])
                    removed += s[1] - s[0]
                elif s[1] > end:
                    removed += s[1] - end
                at = end = max(end, s[1])
            keep.append(data[at:])
            kept = b"".join(keep)
            rows.append((len(data), removed, runs, hashlib.sha256(kept).hexdigest(), kept))
        cols = list(zip(*rows)) if rows else [[]] * 5
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), *[pa.array(c, t) for c, t in zip(cols, types)]],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
        )


def repeated_windows(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(id, digest, first, last): runs of starts of repeated windows. ``docs`` has id, digest, text
    and doc_id (all four, so that both joins share one exchange of it)."""
    found = stored(
        map_arrow(
            docs.select("id", "digest", "text"),
            lambda it: _anchor_rows(it, length, gram),
            "h long, id long, digest long, place int, first int, last int, step int, reps int",
        ),
        "anchors",
    )
    often = found.groupBy("h").agg(F.sum("reps").alias("n"), F.count(F.lit(1)).alias("rows")).where("n > 1")

    def contexts(some: DataFrame) -> DataFrame:
        # a row repeated in the table meets its own anchors once per copy; each copy has them all
        per_doc = (
            found.join(some, "h")
            .groupBy("id", "digest")
            .agg(F.array_distinct(F.collect_list(F.struct("h", "place", "first", "last", "step", "reps"))).alias("found"))
        )
        return map_arrow(
            docs.join(per_doc, ["id", "digest"]),
            lambda it: _contexts(it, length),
            "h long, id long, digest long, place int, first int, last int, bytes binary, settled boolean",
        )

    cold = contexts(often.where(F.col("rows") <= hot)).repartition("h").sortWithinPartitions("h")
    spans = map_arrow(cold, lambda it: _spans(it, length, gram), _SPAN)
    if often.where(F.col("rows") > hot).isEmpty():
        return spans
    windows = map_arrow(
        contexts(often.where(F.col("rows") > hot)),
        lambda it: _window_digests(it, length),
        "id long, digest long, first int, last int, low long, high long, times int",
    )
    windows = stored(windows, "windows")
    twice = windows.where("low is not null").groupBy("low", "high").agg(F.sum("times").alias("n")).where("n > 1").drop("n")
    span = ["id", "digest", "first", "last"]
    settled = windows.where("low is null").select(*span)
    return spans.unionByName(windows.join(twice, ["low", "high"]).select(*span)).unionByName(settled)


def remove_repeats(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, hot: int = HOT
) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the bytes ``kept``.

    ``gram`` is at most ``length``; longer grams make fewer candidates, shorter ones fewer anchors.
    """
    id_, t = F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`")
    docs = df.select(
        F.coalesce(id_, F.lit(0)).alias("id"), F.xxhash64(id_.isNull(), t).alias("digest"), t.alias("text"), id_.alias("doc_id")
    )
    spans = repeated_windows(docs, length, gram, hot)
    per_doc = spans.groupBy("id", "digest").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    return map_arrow(
        docs.join(per_doc, ["id", "digest"], "left").select("doc_id", "text", "spans"),
        lambda it: _strip(it, length),
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary",
    )
