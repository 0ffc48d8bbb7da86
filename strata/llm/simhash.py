"""SimHash near-duplicates: bit-sliced comparison of 64-bit fingerprints.

Fingerprints are computed per text, collapsed to the distinct ones, and compared
inside cells. Two fingerprints within ``radius`` bits agree on at least ``agree`` of
``radius + agree`` blocks of bits (pigeonhole), so a cell is a choice of ``agree`` blocks and
their values. ``agree`` grows with the number of fingerprints (``blocks_that_agree``), so that
cells stay near ``CELL`` where fingerprints spread evenly; a cell with more than that is cut
into parts and each pair of parts is compared on its own, so no link is lost and no task grows.
Inside a task the fingerprints are stored as vertical bit planes, 64 lanes to a
word; distances of 64 lanes grow together in carry-save counters, and a block of
lanes is abandoned once all of them exceed the radius. A task returns a forest
over the fingerprints it linked, never all pairs. Components over all forests
come from rounds of hooking and pointer jumping on stored tables.

Defined cases: a null or wordless text has fingerprint zero, linked like any
other; a text of any length is one fingerprint, its words and shingle hashes held by one
task (about 200 bytes a word); repeated rows share a fingerprint; ``component_id`` is the smallest id
reachable (null ids are ignored, null if there is no other); an empty table
gives an empty result; other columns are not read by ``near_duplicates`` and
pass unchanged through ``keep_one``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import fresh, map_arrow, stored
from strata.operators.joins import hot_keys, skew_join

SHINGLE = 4
RADIUS = 4
SEED = 42
#: Largest part of a cell; two parts (and their planes) are what a comparison holds.
CELL = 4096
LANES = 64
#: (fingerprint, block of lanes) pairs whose counters are held at once.
PAIRS = 1 << 14
#: Bit planes between two looks at which blocks can be abandoned.
STRIDE = 8


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of a text; A-Z lowered, bytes split at ASCII space."""
    if text is None:
        return 0
    toks = text.encode("utf-8", "surrogatepass").lower().split()
    if not toks:
        return 0
    line = b" ".join(toks)
    if len(toks) <= shingle:
        h = np.array([xxhash.xxh64_intdigest(line, SEED)], dtype=np.uint64)
    else:
        ends = np.cumsum([len(w) + 1 for w in toks])
        starts = np.concatenate(([0], ends[:-1]))[: len(toks) - shingle + 1].tolist()
        stops = (ends[shingle - 1 :] - 1).tolist()
        digest = xxhash.xxh64_intdigest
        h = np.array([digest(line[a:b], SEED) for a, b in zip(starts, stops)], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), 1 << 16):
        part = h[i : i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    bits = ones * 2 > len(h)
    return int(np.packbits(bits).view(">u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column("_text")], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays(
            [b.column("_row"), pa.array(fps.view(np.int64))], names=["_row", "fp"]
        )


def fingerprints(df: DataFrame, row: Column, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``_row`` and its fingerprint ``fp`` (a long with the same bits)."""
    src = df.select(row.alias("_row"), F.col(f"`{text}`").alias("_text"))
    schema = f"_row {src.schema['_row'].dataType.simpleString()}, fp long"
    return map_arrow(src, lambda it: _fingerprints(it, shingle), schema)


def blocks_that_agree(n: int, radius: int = RADIUS, cell: int = CELL) -> int:
    """Fewest blocks whose values split ``n`` evenly spread fingerprints into cells of ``cell`` or fewer."""
    agree = 1
    while n > cell << agree * (64 // (radius + agree)) and radius + agree < 64:
        agree += 1
    return agree


def cell_masks(radius: int, agree: int) -> list[int]:
    """Masks (signed longs) of every choice of ``agree`` out of ``radius + agree`` blocks that split the 64 bits.

    Up to ``radius`` differing bits touch at most ``radius`` blocks, so one choice is left untouched.
    """
    of = radius + agree
    edges = [64 * i // of for i in range(of + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    masks = [sum(some) for some in combinations(parts, agree)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if (up == parent).all():
            return parent
        parent = up


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Merge the sets of a[i] and b[i]; every root is the smallest index of its set."""
    while True:
        ra, rb = parent[a], parent[b]
        differ = ra != rb
        if not differ.any():
            return parent
        a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        parent = _roots(parent)


def link_forest(fps: np.ndarray, cells: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links within ``radius`` bits inside runs of equal ``cells``, reduced to a forest.

    ``fps`` (uint64) is sorted by cell, then value. Returns (index, root index).
    """
    n = len(fps)
    parent = np.arange(n)
    if n < 2:
        return parent[:0], parent[:0]
    lanes = np.zeros(-(-n // LANES) * LANES, dtype=np.uint64)
    lanes[:n] = fps
    bits = np.unpackbits(lanes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")  # lane x bit
    planes = np.packbits(bits.reshape(-1, LANES, 64).transpose(2, 0, 1), axis=2, bitorder="little")
    planes = np.ascontiguousarray(planes).view(np.uint64).reshape(64, -1)  # bit x block of lanes
    starts = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1])))
    ends = np.concatenate((starts[1:], [n]))
    run = np.repeat(np.arange(len(starts)), ends - starts)
    first, last = np.arange(n) // LANES, (ends[run] - 1) // LANES  # later lanes of its run
    per_row = last - first + 1
    offsets = np.concatenate(([0], np.cumsum(per_row)))
    limit = np.uint64(1)
    at = 0
    while at < n:
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PAIRS, "right")) - 1)
        rows = np.repeat(np.arange(at, stop), per_row[at:stop])
        block = first[rows] + np.arange(len(rows)) - (offsets[rows] - offsets[at])
        at = stop
        probe = fps[rows]
        # counters of up to radius in carry-save form: ones, twos, fours ... and the lanes beyond the radius
        width = max(1, int(radius).bit_length())
        counter = [np.zeros(len(rows), dtype=np.uint64) for _ in range(width)]
        over = np.zeros(len(rows), dtype=np.uint64)
        for plane in range(64):
            differ = planes[plane][block] ^ (np.uint64(0) - ((probe >> np.uint64(plane)) & limit))
            for c in counter:
                differ, c[:] = differ & c, differ ^ c
            over |= differ
            if plane % STRIDE == STRIDE - 1:
                past = over | _exceeds(counter, radius)
                open_ = past != np.uint64(0xFFFFFFFFFFFFFFFF)
                if not open_.all():
                    rows, block, probe, over = rows[open_], block[open_], probe[open_], over[open_]
                    counter = [c[open_] for c in counter]
                    if not len(rows):
                        break
        if not len(rows):
            continue
        near = ~(over | _exceeds(counter, radius))
        hit = np.flatnonzero(near)
        lane_bits = np.unpackbits(near[hit].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        which, lane = np.nonzero(lane_bits)
        a, b = rows[hit][which], block[hit][which] * LANES + lane
        real = (b > a) & (b < n)
        if real.any():
            parent = _unite(parent, a[real], b[real])
    moved = np.flatnonzero(parent != np.arange(n))
    return moved, parent[moved]


def _exceeds(counter: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter is greater than ``radius``, by comparing bit planes from the top."""
    greater = np.zeros_like(counter[0])
    equal = ~greater
    for i in range(len(counter) - 1, -1, -1):
        if radius >> i & 1:
            equal = equal & counter[i]
        else:
            greater |= equal & counter[i]
            equal = equal & ~counter[i]
    return greater


def _compare(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Forests of the cells of one partition, whose rows come sorted by cell."""

    def forest(cell: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        value = fp.view(np.uint64)
        i, root = link_forest(value, cell, radius)
        return pa.RecordBatch.from_arrays([pa.array(fp[i]), pa.array(fp[root])], names=["a", "b"])

    cells, fps = np.empty(0, np.int64), np.empty(0, np.int64)
    for b in batches:
        cells = np.concatenate((cells, b.column("cell").to_numpy()))
        fps = np.concatenate((fps, b.column("fp").to_numpy()))
        if len(cells) >= 8 * CELL:
            cut = int(np.searchsorted(cells, cells[-1])) if cells[0] != cells[-1] else 0
            if cut:
                yield forest(cells[:cut], fps[:cut])
                cells, fps = cells[cut:], fps[cut:]
    yield forest(cells, fps)


def forest_links(distinct: DataFrame, radius: int = RADIUS, cell: int = CELL, agree: int | None = None) -> DataFrame:
    """Links (a, b) that connect every two of the distinct ``fp`` within ``radius`` bits.

    ``distinct`` is a stored table: its rows are counted, unless ``agree`` is given.
    """
    agree = agree or blocks_that_agree(distinct.count(), radius, cell)
    keys = [F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(cell_masks(radius, agree))]
    rows = distinct.select("fp", F.explode(F.array(*keys)).alias("key"))
    hot = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cell)
    # parts of a hot cell: every pair of parts meets in one cell of its own
    parts = hot.select("key", F.ceil(F.col("n") / F.lit(cell / 2)).cast("int").alias("parts"))
    mine = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    meets = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda j: F.struct(F.least(mine, j).alias("p"), F.greatest(mine, j).alias("q")),
    )
    alone = F.array(F.struct(F.lit(0).alias("p"), F.lit(0).alias("q")))
    cells = (
        rows.join(parts, "key", "left")
        .select("fp", "key", F.explode(F.when(F.col("parts").isNull(), alone).otherwise(meets)).alias("m"))
        .select("fp", F.xxhash64("key", "m.p", "m.q").alias("cell"))
    )
    placed = cells.repartition("cell").sortWithinPartitions("cell", "fp")
    return map_arrow(placed, lambda it: _compare(it, radius), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of an undirected link table; roots are the smallest nodes.

    Each round hooks the label of a node on the smallest label around it and then
    follows labels of labels, so long chains take a logarithmic number of rounds.
    """
    edges = stored(
        links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links"
    )
    trees = edges.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    first = True
    while not edges.isEmpty():
        around = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = around.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up"))
        hook = stored(hook.select("node", F.least("node", "up").alias("root")), "hooks")
        moved = True
        while moved:
            above = hook.select(F.col("node").alias("root"), F.col("root").alias("above"))
            jump = hook.join(above, "root").select("node", F.col("above").alias("root"), F.col("root").alias("was"))
            jump = stored(jump, "hooks")
            moved = not jump.where("root <> was").isEmpty()
            hook = jump.select("node", "root")
        above = hook.select(F.col("node").alias("root"), F.col("root").alias("above"))
        followed = trees.join(above, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
        trees = hook if first else stored(followed, "trees")
        first = False
        ends = (hook.select(F.col("node").alias(c), F.col("root").alias(f"r{c}")) for c in "ab")
        edges = stored(
            edges.join(next(ends), "a")
            .join(next(ends), "b")
            .where("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .distinct(),
            "links",
        )
    return trees


def near_duplicates(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    cell: int = CELL,
) -> DataFrame:
    """Per row of ``df``: ``id``, text ``digest``, fingerprint ``fp``, ``root`` and ``component_id``."""
    row = F.struct(F.col(f"`{doc_id}`").alias("id"), text_digest(text).alias("digest"))
    prints = stored(fingerprints(df, row, text, shingle).select("_row.id", "_row.digest", "fp"), "fingerprints")
    smallest = stored(prints.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    trees = components(forest_links(smallest.select("fp"), radius, cell))
    labelled = smallest.join(trees.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    per_root = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    # a component may hold a third of the fingerprints, and a fingerprint a third of the rows
    labelled = labelled.select("fp", "root")
    of_fp = skew_join(labelled, per_root, "root", hot=lambda: hot_keys(trees, ["root"]))
    return skew_join(prints, of_fp, "fp").select("id", "digest", "fp", "root", "component_id")


def text_digest(text: str) -> Column:
    return F.xxhash64(F.col(f"`{text}`").isNull(), F.col(f"`{text}`"))


def keep_one(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """One row of each component stays: the one with the smallest id (null ids last), then the
    smallest text digest; of rows equal in both one stays. Columns unchanged.

    The stayers' (id, digest) pairs are joined back, and repeats are numbered on the same
    partitioning, so whole rows are shuffled once.
    """
    found = near_duplicates(df, doc_id, text, shingle, radius)
    pair = F.struct(F.col("id").isNull().alias("late"), F.col("id"), F.col("digest"))
    stay = found.groupBy("root").agg(F.min(pair).alias("pair")).select("pair.late", "pair.digest", F.coalesce("pair.id", F.lit(0)).alias("id"))
    box = fresh(df, "_row")
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(box),
        F.col(f"`{doc_id}`").isNull().alias("late"),
        F.coalesce(F.col(f"`{doc_id}`"), F.lit(0)).alias("id"),
        text_digest(text).alias("digest"),
    )
    on = ["late", "id", "digest"]
    kept = rows.join(stay, on, "left_semi")
    first = F.row_number().over(Window.partitionBy(*on).orderBy("digest"))
    kept = kept.withColumn("place", first).where("place = 1")
    return kept.select(*[F.col(box)[c].alias(c) for c in df.columns])


def hex64(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
