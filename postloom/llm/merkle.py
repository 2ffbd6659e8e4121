"""Merkle manifest of a dataset: one root for all rows, and a proof for each.

A leaf is the SHA-256 of a row's fields, each with its length. The leaves of a group (such as a
language) ascend by id; while several nodes remain, every eight consecutive ones become their
hash. What remains is the group's subroot; the subroots, ordered by group, give the root in
the same way.

Texts are hashed once, by Spark's own functions; from then on only digests move. Nodes get
their position from a range sort and one count per partition and group. A superblock is 512
consecutive nodes of one tree, three levels:

* up: superblocks are reduced to their tops, which are the nodes of the next round, until every
  tree is a single node; a round has 1/512 of the rows of the one before;
* down: the nodes of a round are cogrouped by superblock with the outer nodes they need, the
  siblings from the superblock's top to the root; one function finishes the local reduction,
  joins the proofs and hands the outer nodes to the round below;
* at the leaves the same cogroup also folds each shown leaf with its siblings.

A group of trees never matters to a task: superblocks have at most 512 rows, whatever the size
of their group, and rows that repeat are spread by their place in the stored table.

Cases: a NULL field counts as ``-``; a NULL id comes first in its group; a NULL group comes
before all others; rows with the same id are ordered by leaf, equal rows are leaves of their
own that may stand in either order; an empty text has length 0; long texts are hashed whole;
an empty table gives no rows and no root; a single leaf is its own subroot, a single subroot the
root, with the hash of nothing as proof; only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postloom.llm.store import keep

FANOUT = 8
LEVELS = 3
BLOCK = FANOUT**LEVELS
_ROW_BITS = 33  # of monotonically_increasing_id(): the row within its partition

NODE = "tree string, size bigint, pos bigint, digest binary"
OUTER = "tree string, pos bigint, lefts array<string>, rights array<string>, subroot string, root string"


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(column: Column) -> Column:
    """A value with its length in bytes; ``-`` if NULL."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*columns: Column) -> Column:
    """Digest of a row's fields, in bytes."""
    return F.unhex(F.sha2(F.concat(*[field(c) for c in columns]), 256))


@dataclass(frozen=True)
class Manifest:
    """Stored levels: ``leaves`` and ``inner`` of the groups, ``upper`` of the subroots."""

    leaves: DataFrame
    inner: list[DataFrame]
    upper: list[DataFrame]

    def subroots(self) -> DataFrame:
        """(tree, digest) of every group."""
        return (self.inner[-1] if self.inner else self.leaves).select("tree", "digest")


def _numbered(nodes: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """Position and tree size of every node of a stored table; also the largest tree's size.

    A row's place in the stored table comes last in the order, so that rows with equal values
    spread over partitions.
    """
    keys = ["tree", *order, "_file", "_line"]
    placed = nodes.select("*", F.xxhash64("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_line"))
    ordered = placed.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
        *nodes.columns,
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_row"),
    )
    stored = keep(ordered, "merkle-ordered")
    runs = stored.groupBy("tree", "_part").agg(F.count(F.lit(1)).alias("_count"), F.min("_row").alias("_first"))
    # One row per partition and tree; a tree's window has at most one row per partition.
    own = Window.partitionBy("tree")
    before = own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        "tree", "_part", "_first",
        F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_start"),
        F.sum("_count").over(own).alias("size"),
    )
    starts = keep(starts, "merkle-starts")
    largest = starts.agg(F.max("size")).first()[0] or 0
    position = (F.col("_start") + F.col("_row") - F.col("_first")).alias("pos")
    return stored.join(starts, ["tree", "_part"]).select(*nodes.columns, "size", position), largest


def climb(digests: list[str], size: int) -> list[list[str]]:
    """Levels of a superblock: its nodes, then the hashes of their runs.

    The tree's size says how many levels there are: a short last superblock of a large tree
    is reduced as often as the others.
    """
    levels = [digests]
    for _ in range(LEVELS):
        if size == 1:
            break
        below = levels[-1]
        levels.append([sha256("".join(below[i : i + FANOUT])) for i in range(0, len(below), FANOUT)])
        size = -(-size // FANOUT)
    return levels


def siblings(levels: list[list[str]], at: int) -> tuple[list[str], list[str]]:
    """Left and right siblings of a node, one text per level below the top."""
    lefts, rights = [], []
    for level in levels[:-1]:
        run = at - at % FANOUT
        lefts.append("".join(level[run:at]))
        rights.append("".join(level[at + 1 : run + FANOUT]))
        at //= FANOUT
    return lefts, rights


def fold(leaf: str, lefts: list[str], rights: list[str]) -> str:
    """Root that a leaf and its siblings give."""
    node = leaf
    for left, right in zip(lefts, rights):
        node = sha256(left + node + right)
    return node


def _block() -> Column:
    return F.floor(F.col("pos") / BLOCK).alias("block")


def _tops(nodes: DataFrame) -> DataFrame:
    """The round above: one node per superblock."""

    def reduce(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        size = int(block["size"].iloc[0])
        top = climb([d.hex() for d in block["digest"]], size)[-1][0]
        tree, pos = block["tree"].iloc[0], int(block["pos"].iloc[0]) // BLOCK
        return pd.DataFrame([(tree, -(-size // BLOCK), pos, bytes.fromhex(top))], columns=["tree", "size", "pos", "digest"])

    return nodes.select("tree", "size", "pos", "digest", _block()).groupBy("tree", "block").applyInPandas(reduce, NODE)


def _rounds(nodes: DataFrame, largest: int) -> list[DataFrame]:
    """All rounds above ``nodes``, until every tree is one node."""
    rounds = []
    while largest > 1:
        rounds.append(keep(_tops(rounds[-1] if rounds else nodes), "merkle-round"))
        largest = -(-largest // BLOCK)
    return rounds


def build(docs: DataFrame, columns: list[str], group: str, id_col: str = "doc_id", shown: Column | None = None) -> Manifest:
    """Manifest of a table: leaves over ``columns``, one tree per value of ``group``.

    ``shown`` is the digest that a holder of the row shows, see :func:`leaf_of`; where it is NULL the
    leaf itself is shown.
    """
    leaf = leaf_of(*[F.col(c) for c in columns])
    tree = F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit(""))  # NULL comes first
    nothing = F.lit(None).cast("binary")
    leaves = docs.select(
        F.col(id_col).alias("id"), tree.alias("tree"), leaf.alias("digest"), (nothing if shown is None else shown).alias("shown")
    )
    ordered, largest = _numbered(keep(leaves, "merkle-leaves"), ["id", "digest"])
    leaves = keep(ordered, "merkle-numbered")
    inner = _rounds(leaves, largest)
    subroots = keep((inner[-1] if inner else leaves).select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), "merkle-subroots")
    top, groups = _numbered(subroots, ["name"])
    top = keep(top, "merkle-top")
    return Manifest(leaves, inner, [top, *_rounds(top, groups)])


def _paths(block: pd.DataFrame, outer: pd.DataFrame) -> Iterator[tuple]:
    """Each node of a superblock, as a named tuple, with its siblings up to the root."""
    (above,) = outer.itertuples(index=False)
    block = block.sort_values("pos")
    levels = climb([d.hex() for d in block["digest"]], int(block["size"].iloc[0]))
    above_lefts, above_rights = list(above.lefts), list(above.rights)
    for i, node in enumerate(block.itertuples(index=False)):
        lefts, rights = siblings(levels, i)
        yield node, lefts + above_lefts, rights + above_rights, above


def _exchange(nodes: DataFrame, outer: DataFrame, finish, schema: str) -> DataFrame:
    """Nodes cogrouped by superblock with the outer nodes of their superblock's top."""
    blocks = nodes.withColumn("block", _block()).groupBy("tree", "block")
    above = outer.withColumnRenamed("pos", "block").groupBy("tree", "block")
    return blocks.cogroup(above).applyInPandas(finish, schema)


def _down(nodes: DataFrame, outer: DataFrame, name: bool = False) -> DataFrame:
    """Outer nodes for the round below; with ``name``, each node is the subroot of the tree it names."""

    def finish(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = [
            (n.name, 0, lefts, rights, n.digest.hex(), a.root) if name else (n.tree, n.pos, lefts, rights, a.subroot, a.root)
            for n, lefts, rights, a in _paths(block, above)
        ]
        return pd.DataFrame(rows, columns=["tree", "pos", "lefts", "rights", "subroot", "root"])

    return keep(_exchange(nodes, outer, finish, OUTER), "merkle-outer")


def _outer(manifest: Manifest) -> DataFrame:
    """The siblings from each superblock of leaves to the root."""
    upper, inner = manifest.upper, manifest.inner
    empty = F.array().cast("array<string>")
    root = F.lower(F.hex("digest"))
    outer = upper[-1].select("tree", "pos", empty.alias("lefts"), empty.alias("rights"), root.alias("subroot"), root.alias("root"))
    for nodes in reversed(upper[1:-1]):
        outer = _down(nodes, outer)
    outer = _down(upper[0], outer, name=True)
    for nodes in reversed(inner[:-1]):
        outer = _down(nodes, outer)
    return outer


def verify(manifest: Manifest, id_col: str = "doc_id", with_proofs: bool = False) -> DataFrame:
    """Every row's proof and what the shown leaf folds to: (id, leaf, subroot, root, proof_sha256,
    folded_root, verified), with the group; ``with_proofs`` adds the siblings, a text per level and side."""

    def finish(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for n, lefts, rights, a in _paths(block, above):
            leaf = n.digest.hex()
            proof = sha256("".join(x for pair in zip(lefts, rights) for x in pair))
            folded = fold(n.shown.hex() if n.shown is not None else leaf, lefts, rights)
            group = n.tree[1:] if n.tree else None
            row = (n.id, group, leaf, a.subroot, a.root, proof, folded, folded == a.root)
            rows.append((*row, lefts, rights) if with_proofs else row)
        return pd.DataFrame({c: pd.Series(v, dtype=object) for c, v in zip(names, zip(*rows))})

    names = [id_col, "group", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    kind = manifest.leaves.schema["id"].dataType.simpleString()
    schema = f"{id_col} {kind}, group string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    if with_proofs:
        names += ["lefts", "rights"]
        schema += ", lefts array<string>, rights array<string>"
    return _exchange(manifest.leaves, _outer(manifest), finish, schema)
