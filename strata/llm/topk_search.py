"""Exact top-k by inner product over norm-sorted blocks.

Vectors become integers, are range-sorted by descending length and packed into
blocks. A chunk of queries first meets the block of longest vectors, which gives
each query a lower bound of its k-th score; by Cauchy-Schwarz only the leading
blocks whose longest vector can still reach it are sent to the chunk at all. Chunks
and groups of ``GROUP`` blocks form a grid: each cell is a unit of work of its own,
which starts from its chunk's bounds, takes its blocks in descending length and gives
the k best of every query among them; the cells' results are merged by a ranking window.
Inside a block the first coordinates after an SVD rotation (which gathers most of the
length there) are added up and the rest is bounded by the residual lengths; the vectors
that remain are scored exactly, on integers.

Only one block and the d x d moment matrix are ever gathered; blocks and chunks are
numbered across tasks. A task holds one chunk, one block and k rows a query. Where all
vectors have one length and no common direction, nothing can be pruned, and the work is
that of all (query, vector) pairs, spread evenly over the grid.

Defined cases: vectors that are null or hold a null or non-finite component take
no part; shorter vectors count as padded with zeros; rows sharing the query's id
are no candidates of it; ties go to the smaller id; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import map_arrow, stored
from strata.operators.ranking import global_rank

K = 20
#: Vectors in a block and queries in a chunk.
BLOCK, CHUNK = 2048, 512
#: Blocks in a cell of the grid.
GROUP = 4
#: Share of the squared length that the leading rotated coordinates should hold.
LEADING = 0.5
SCALE = 64

_PACKED = "part int, seq int, longest double, n int, ids binary, vectors binary"


def integer_vectors(df: DataFrame, vec_id: str, embedding: str, scale: int = SCALE) -> DataFrame:
    """``id``, integer vector ``v`` and squared length of the rows that take part."""
    e = F.col(f"`{embedding}`")
    finite = e.isNotNull() & ~F.exists(
        e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    )
    v = F.transform(e, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    rows = df.where(finite & F.col(f"`{vec_id}`").isNotNull()).select(F.col(f"`{vec_id}`").alias("id"), v.alias("v"))
    return rows.withColumn(
        "length2", F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    )


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    out = np.zeros((len(sizes), dims), dtype=np.int64)
    if len(flat):
        row = np.repeat(np.arange(len(sizes)), sizes)
        out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _pack(batches: Iterator[pa.RecordBatch], dims: int, size: int) -> Iterator[pa.RecordBatch]:
    """Blocks of at most ``size`` vectors, in the order they come."""
    part, seq = TaskContext.get().partitionId(), 0
    for b in batches:
        for i in range(0, b.num_rows, size):
            cut = b.slice(i, size)
            ids = cut.column("id").to_numpy()
            lengths = np.sqrt(cut.column("length2").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([seq], pa.int32()),
                    pa.array([lengths.max()], pa.float64()),
                    pa.array([len(ids)], pa.int32()),
                    pa.array([ids.tobytes()], pa.binary()),
                    pa.array([_matrix(cut.column("v"), dims).tobytes()], pa.binary()),
                ],
                names=["part", "seq", "longest", "n", "ids", "vectors"],
            )
            seq += 1


def packed(vectors: DataFrame, dims: int, size: int, label: str) -> DataFrame:
    """Numbered blocks of vectors by descending length (one summary row each in the numbering)."""
    order = [F.desc("length2"), F.asc("id")]
    blocks = stored(
        map_arrow(
            vectors.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "v", "length2"),
            lambda it: _pack(it, dims, size),
            _PACKED,
        ),
        label,
    )
    # ranges may come back in any task order, so blocks are numbered by their longest vector
    numbered = global_rank(blocks.select("part", "seq", "longest"), [F.desc("longest"), F.asc("part"), F.asc("seq")], out="place")
    numbered = numbered.select("part", "seq", (F.col("place") - 1).cast("int").alias("block"))
    return stored(blocks.join(numbered, ["part", "seq"]), label)


def _moment(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros((dims, dims))
    for b in batches:
        for raw in b.column("vectors"):
            x = np.frombuffer(raw.as_buffer(), np.int64).reshape(-1, dims).astype(np.float64)
            total += x.T @ x
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(dims * dims)), pa.array(total.ravel())], names=["cell", "x"]
    )


def rotation(blocks: DataFrame, dims: int) -> tuple[np.ndarray, int]:
    """Right singular vectors of all vectors, strongest first, and how many are leading."""
    cells = map_arrow(blocks.select("vectors"), lambda it: _moment(it, dims), "cell long, x double")
    sums = cells.groupBy("cell").agg(F.sum("x").alias("x")).toPandas()
    m = np.zeros(dims * dims)
    m[sums["cell"].to_numpy()] = sums["x"].to_numpy()
    values, vectors = np.linalg.eigh(m.reshape(dims, dims))
    values = np.maximum(values[::-1], 0)
    share = np.cumsum(values) / max(values.sum(), 1e-300)
    return vectors[:, ::-1].copy(), int(np.searchsorted(share, LEADING) + 1)


def inner(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer inner products (floating point where every partial sum fits 53 bits)."""
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1]
    if bound < 2.0**53:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    return q @ c.T


class Best:
    """The k best (score, id) per query so far, and the score a newcomer must reach (at first ``floor``)."""

    def __init__(self, ids: np.ndarray, k: int, floor: np.ndarray | None = None):
        self.ids, self.k = ids, k
        self.q = np.empty(0, np.int64)
        self.score = np.empty(0, np.int64)
        self.cand = np.empty(0, np.int64)
        self.rank = np.empty(0, np.int64)
        self.floor = np.full(len(ids), -np.inf) if floor is None else floor.copy()

    def add(self, q: np.ndarray, score: np.ndarray, cand: np.ndarray) -> None:
        fit = (score >= self.floor[q]) & (cand != self.ids[q])
        self.q = np.concatenate((self.q, q[fit]))
        self.score = np.concatenate((self.score, score[fit]))
        self.cand = np.concatenate((self.cand, cand[fit]))
        order = np.lexsort((self.cand, -self.score, self.q))
        self.q, self.score, self.cand = self.q[order], self.score[order], self.cand[order]
        start = np.searchsorted(self.q, np.arange(len(self.ids)))
        rank = np.arange(len(self.q)) - start[self.q]
        keep = rank < self.k
        last = rank == self.k - 1
        self.floor[self.q[last]] = np.maximum(self.floor[self.q[last]], self.score[last])
        self.q, self.score, self.cand, self.rank = self.q[keep], self.score[keep], self.cand[keep], rank[keep]


class Chunk:
    """One chunk of queries meeting blocks of candidates."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, turn: np.ndarray, lead: int, k: int, floor: np.ndarray | None = None):
        self.q, self.turn, self.lead = q, turn, lead
        rotated = q @ turn
        self.head, self.length = rotated[:, :lead], np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
        self.rest = np.sqrt((rotated[:, lead:] ** 2).sum(axis=1))
        self.best = Best(ids, k, floor)

    def meet(self, ids: np.ndarray, c: np.ndarray, longest: float) -> None:
        slack = 1e-9 * (1 + self.length * longest)  # rounding of the bounds; scores are exact
        reach = np.flatnonzero(self.length * longest + slack >= self.best.floor)
        if not len(reach):
            return
        rotated = c @ self.turn
        rest = np.sqrt((rotated[:, self.lead :] ** 2).sum(axis=1))
        bound = self.head[reach] @ rotated[:, : self.lead].T + self.rest[reach, None] * rest + slack[reach, None]
        qi, ci = np.nonzero(bound >= self.best.floor[reach, None])
        if len(qi) > bound.size // 8:
            score = inner(self.q[reach], c)[qi, ci]
        else:
            score = np.concatenate(
                [(self.q[reach[qi[i : i + 65536]]] * c[ci[i : i + 65536]]).sum(axis=1) for i in range(0, len(qi), 65536)]
                or [np.empty(0, np.int64)]
            )
        self.best.add(reach[qi], score, ids[ci])


def _unpack(ids, vectors, dims: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids.as_buffer(), np.int64), np.frombuffer(vectors.as_buffer(), np.int64).reshape(-1, dims)


def search(
    df: DataFrame, is_query: Column, k: int = K, vec_id: str = "vec_id", embedding: str = "embedding",
    block: int = BLOCK, chunk: int = CHUNK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of every row for which ``is_query`` holds."""
    out = "query_id long, rank int, vec_id long, score long"
    spark = df.sparkSession
    vectors = integer_vectors(df, vec_id, embedding)
    dims = int(vectors.agg(F.max(F.size("v"))).first()[0] or 0)
    if dims == 0 and vectors.isEmpty():
        return spark.createDataFrame([], out)
    dims = max(dims, 1)
    blocks = packed(vectors, dims, block, "vectors")
    queries = packed(integer_vectors(df.where(is_query), vec_id, embedding), dims, chunk, "queries")
    turn, lead = rotation(blocks, dims)
    top = blocks.where("block = 0").select("ids", "vectors", "longest").toArrow()  # at most one block
    top_ids, top_vectors = _unpack(top.column("ids")[0], top.column("vectors")[0], dims)
    longest = top.column("longest")[0].as_py()

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query's score to reach, and the vector length below which no block can change any of them."""
        for b in batches:
            need, floors = [], []
            for ids, q in zip(b.column("ids"), b.column("vectors")):
                c = Chunk(*_unpack(ids, q, dims), turn, lead, k)
                c.meet(top_ids, top_vectors, longest)
                with np.errstate(divide="ignore", invalid="ignore"):
                    least = np.where(c.length > 0, c.best.floor / c.length, -np.inf) * (1 - 1e-9)
                need.append(float(least.min()))
                floors.append(c.best.floor.tobytes())
            columns = [b.column("chunk"), pa.array(need, pa.float64()), pa.array(floors, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["chunk", "need", "floors"])

    chunks = queries.withColumnRenamed("block", "chunk")
    needs = stored(map_arrow(chunks.select("chunk", "ids", "vectors"), bounded, "chunk int, need double, floors binary"), "needs")
    # blocks before a chunk in the joint descending order are those it needs
    steps = blocks.select(F.col("longest").alias("at"), F.lit(-1).alias("chunk")).union(needs.select("need", "chunk"))
    order = [F.desc("at"), F.asc("chunk")]
    ranked = global_rank(steps, order, out="place").where("chunk >= 0")
    ranked = global_rank(ranked, order, out="chunks_before")  # itself included, as in its place
    wanted = ranked.select("chunk", (F.col("place") - F.col("chunks_before")).alias("blocks")).where("blocks > 0")
    cell = F.explode(F.sequence(F.lit(0), ((F.col("blocks") - 1) / GROUP).cast("int"))).alias("cell")
    cells = wanted.select("chunk", "blocks", cell)
    heads = chunks.select("chunk", "ids", "vectors").join(needs.select("chunk", "floors"), "chunk").join(cells, "chunk")
    heads = heads.select("chunk", "cell", F.lit(-1).alias("block"), F.lit(0.0).alias("longest"), "ids", "vectors", "floors")
    of_cell = blocks.withColumn("cell", F.expr(f"block div {GROUP}").cast("int"))
    sent = cells.join(of_cell, "cell").where("block < blocks")
    sent = sent.select("chunk", "cell", "block", "longest", "ids", "vectors", F.lit(None).cast("binary").alias("floors"))
    stream = heads.unionByName(sent).repartition("chunk", "cell").sortWithinPartitions("chunk", "cell", "block")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Chunk | None = None
        chunk = -1

        def result() -> pa.RecordBatch:
            b = now.best
            columns = [np.full(len(b.q), chunk, np.int32), b.q.astype(np.int32), b.ids[b.q], b.cand, b.score]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["chunk", "place", "query_id", "vec_id", "score"])

        for b in batches:
            for of, number, size, ids, v, floors in zip(
                *[b.column(c).to_pylist() for c in ("chunk", "block", "longest")], *[b.column(c) for c in ("ids", "vectors", "floors")]
            ):
                if number < 0:
                    if now is not None:
                        yield result()
                    chunk = of
                    now = Chunk(*_unpack(ids, v, dims), turn, lead, k, np.frombuffer(floors.as_buffer()))
                else:
                    now.meet(*_unpack(ids, v, dims), size)
        if now is not None:
            yield result()

    # queries that share an id are apart in the grid: a query is a place in a chunk
    best = Window.partitionBy("chunk", "place").orderBy(F.desc("score"), "vec_id")
    merged = map_arrow(stream, scan, "chunk int, place int, query_id long, vec_id long, score long")
    merged = merged.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return merged.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
