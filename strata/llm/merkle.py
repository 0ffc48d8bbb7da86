"""Merkle manifest of a dataset: one tree per source, one tree over the sources' roots.

Leaves are hashed where the rows lie. They are numbered per source without a one-task
window and cut into superblocks of ``FAN ** DEPTH`` leaves. Upwards, one group per
superblock becomes one node, round after round, until each source has its subroot;
the subroots go through the same rounds to the root. Downwards, each round cogroups the
nodes of a superblock with the one row that holds the outer path of that superblock: the
group is reduced again, the inner siblings are joined with the outer ones, and at the
leaves the path is folded with the hash of the row as it is now. A group is never larger
than a superblock; nodes and paths stay on the executors, and every round is a table in
the shared scratch folder.

Defined cases: a null column is ``-`` in the leaf, an empty one ``0:``; null ids come
first, null sources first; rows that repeat an id follow each other by leaf hash; texts
of any length are hashed where they lie and never shuffled; an empty table has no rows
and no root; only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ship, stored
from strata.operators.ranking import global_rank

#: Consecutive nodes that become one, and levels that one superblock reduces.
FAN, DEPTH = 16, 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

_NODES = "tree string, pos long, n long, node string, name string"
_PATHS = "tree string, pos long, name string, node string, subroot string, root string, lefts array<string>, rights array<string>"


def field(c: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_hash(columns: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def combined(nodes: Sequence[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def height(n: int, fan: int) -> int:
    """Reductions until ``n`` nodes are one."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fan), levels + 1
    return levels


def reduced(nodes: list[str], fan: int, depth: int) -> list[list[str]]:
    """The levels of a superblock, from its nodes to its top."""
    levels = [nodes]
    for _ in range(depth):
        below = levels[-1]
        levels.append([combined(below[i : i + fan]) for i in range(0, len(below), fan)])
    return levels


def siblings(levels: list[list[str]], fan: int) -> tuple[list[list[str]], list[list[str]]]:
    """Per node of the lowest level: what stands left and right of its path, level by level."""
    sides = []
    for level in levels[:-1]:
        at = []
        for i in range(len(level)):
            run = i - i % fan
            at.append(("".join(level[run:i]), "".join(level[i + 1 : run + fan])))
        sides.append(at)
    lefts, rights = [], []
    for i in range(len(levels[0])):
        path = [at[i // fan**k] for k, at in enumerate(sides)]
        lefts.append([x for x, _ in path])
        rights.append([x for _, x in path])
    return lefts, rights


def folded(node: str, lefts: Sequence[str], rights: Sequence[str]) -> str:
    """The root that a node and its siblings lead to."""
    for left, right in zip(lefts, rights):
        node = combined((left, node, right))
    return node


def _superblock(fan: int, depth: int) -> Column:
    return F.expr(f"pos div {fan**depth}").alias("block")


def _climb(nodes: DataFrame, fan: int, depth: int) -> tuple[list[DataFrame], DataFrame]:
    """The nodes of every round, and one top node per tree."""

    def top(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        n = int(rows["n"].iloc[0])
        levels = reduced(list(rows.sort_values("pos")["node"]), fan, min(depth, height(n, fan)))
        above = -(-n // fan**depth)
        return pd.DataFrame({"tree": [key[0]], "pos": [key[1]], "n": [above], "node": [levels[-1][0]], "name": [None]})

    rounds = []
    while True:
        rounds.append(nodes)
        nodes = nodes.select("tree", "pos", "n", "node").groupBy("tree", _superblock(fan, depth)).applyInPandas(top, _NODES)
        nodes = stored(nodes, "merkle_nodes")
        if nodes.where("n > 1").isEmpty():
            return rounds, nodes


def _exchange(nodes: DataFrame, outer: DataFrame, join: Callable, schema: str, fan: int, depth: int) -> DataFrame:
    """Cogroup the nodes of each superblock with its outer path."""
    inner = nodes.groupBy("tree", _superblock(fan, depth))
    return inner.cogroup(outer.groupBy("tree", F.col("pos").alias("block"))).applyInPandas(join, schema)


def _paths(rows: pd.DataFrame, outer: pd.DataFrame, fan: int, depth: int) -> pd.DataFrame:
    rows = rows.sort_values("pos", ignore_index=True)
    levels = reduced(list(rows["node"]), fan, min(depth, height(int(rows["n"].iloc[0]), fan)))
    above = outer.iloc[0]
    lefts, rights = siblings(levels, fan)
    rows["lefts"] = [x + list(above["lefts"]) for x in lefts]
    rows["rights"] = [x + list(above["rights"]) for x in rights]
    rows["subroot"], rows["root"] = above["subroot"], above["root"]
    return rows


def _descend(rounds: list[DataFrame], outer: DataFrame, fan: int, depth: int) -> DataFrame:
    def join(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        names = ["tree", "pos", "name", "node", "subroot", "root", "lefts", "rights"]
        return _paths(rows, above, fan, depth)[names]

    for nodes in reversed(rounds):
        outer = stored(_exchange(nodes, outer, join, _PATHS, fan, depth), "merkle_paths")
    return outer


def manifest(
    docs: DataFrame, seen: Sequence[Column] | None = None, columns: Sequence[str] = COLUMNS, key: str = "doc_id",
    source: str = "source", fan: int = FAN, depth: int = DEPTH,
) -> DataFrame:
    """One row per document: ``key``, ``leaf``, ``subroot``, ``root``, its proof and what it proves.

    ``lefts[i]`` and ``rights[i]`` are the hashes beside the document's path on level i,
    concatenated. ``seen`` gives the columns as they are found now (default: unchanged);
    ``folded_root`` is the root that the row seen now and the stored siblings lead to, and
    ``verified`` says whether it is the root.
    """
    ship(docs.sparkSession)
    stated = [F.col(f"`{c}`") for c in columns]
    key_type = docs.select(f"`{key}`").schema[0].dataType
    leaf = leaf_hash(stated)
    hashed = docs.select(
        F.col(f"`{key}`").alias("key"),
        F.coalesce(F.concat(F.lit("="), F.col(f"`{source}`").cast("string")), F.lit("")).alias("tree"),  # null first
        leaf.alias("node"),
        (leaf if seen is None else leaf_hash(seen)).alias("now"),
    )
    hashed = stored(hashed, "merkle_leaves")  # texts are hashed once
    order = [F.asc_nulls_first("key"), F.asc("node")]
    leaves = global_rank(hashed, order, ["tree"], "place", size="n").select(
        "tree", (F.col("place") - 1).alias("pos"), "n", "node", F.col("key").cast("string").alias("name"), "now"
    )
    leaves = stored(leaves, "merkle_numbered")
    rounds, subroots = _climb(leaves, fan, depth)

    sources = global_rank(subroots.select("tree", "node"), [F.asc("tree")], (), "place", size="n").select(
        F.lit("").alias("tree"), (F.col("place") - 1).alias("pos"), "n", "node", F.col("tree").alias("name")
    )
    source_rounds, top = _climb(stored(sources, "merkle_sources"), fan, depth)
    none = F.array().cast("array<string>")
    outer = top.select("tree", "pos", "name", "node", F.lit("").alias("subroot"), F.col("node").alias("root"),
                       none.alias("lefts"), none.alias("rights"))
    outer = _descend(source_rounds, outer, fan, depth)
    outer = outer.select(
        F.col("name").alias("tree"), F.lit(0).cast("long").alias("pos"), F.lit(None).cast("string").alias("name"),
        "node", F.col("node").alias("subroot"), "root", "lefts", "rights",
    )
    outer = _descend(rounds[1:], outer, fan, depth)

    def finish(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        out = _paths(rows, above, fan, depth)
        out["folded_root"] = [folded(*x) for x in zip(out["now"], out["lefts"], out["rights"])]
        return out[["name", "node", "subroot", "root", "lefts", "rights", "folded_root"]]

    schema = "name string, node string, subroot string, root string, lefts array<string>, rights array<string>, folded_root string"
    proved = _exchange(leaves, outer, finish, schema, fan, depth)
    return proved.select(
        F.col("name").cast(key_type).alias(key), F.col("node").alias("leaf"), "subroot", "root", "lefts", "rights",
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def proof_hash() -> Column:
    """H of a proof's siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.zip_with("lefts", "rights", lambda a, b: F.concat(a, b)), ""), 256)
