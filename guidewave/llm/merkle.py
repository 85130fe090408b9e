"""Merkle manifest of a dataset: an aligned append in blocks, whose open subtrees carry the witnesses of their leaves.

Leaves are placed in their group (language) by an exact global order and cut into aligned blocks.  A block appends its
leaves one by one: an open subtree holds the partial witnesses of its leaves, and when its sibling is complete both are
joined and every witness grows by one digest.  The roots of the blocks are then appended in the same way, level above
level, and the roots of the groups last, so no task ever holds more than one block.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.session import cut_lineage
from .numbering import numbered
from .textruns import widened

#: log2 of the leaves of a block
BLOCK_BITS = 10


def digest(parts: str) -> str:
    return hashlib.sha256(parts.encode("ascii")).hexdigest()


def append_aligned(leaves: list[str], height: int | None = None) -> tuple[str, list[list[str]]]:
    """The root over ``leaves`` and, per leaf, the sibling digests bottom up ('' where a node rises alone).

    ``height``: the tree is raised to this height by lone steps (a block of a larger tree); None: no higher than needed.
    """
    witnesses: list[list[str]] = [[] for _ in leaves]
    open_trees: list[tuple[int, int, str]] = []  # height, first leaf, root

    def attach(first: int, end: int, sibling: str) -> None:
        for k in range(first, end):
            witnesses[k].append(sibling)

    def complete(tree: tuple[int, int, str], end: int) -> tuple[int, int, str]:
        """Join a tree that ends before leaf ``end`` to its open elder sibling."""
        h, first, root = tree
        _, elder, left = open_trees.pop()
        attach(elder, first, root)
        attach(first, end, left)
        return h + 1, elder, digest(left + root)

    for k, leaf in enumerate(leaves):
        tree = (0, k, leaf)
        while open_trees and open_trees[-1][0] == tree[0]:
            tree = complete(tree, k + 1)
        open_trees.append(tree)
    n = len(leaves)
    while len(open_trees) > 1 or (height is not None and open_trees[0][0] < height):
        tree = open_trees.pop()
        if open_trees and open_trees[-1][0] == tree[0]:
            open_trees.append(complete(tree, n))
        else:
            attach(tree[1], n, "")
            open_trees.append((tree[0] + 1, tree[1], digest(tree[2])))
    return open_trees[0][2], witnesses


def _written(value: Column) -> Column:
    """``-`` for null, else byte count, colon and value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(docs: DataFrame, n_chars: Column | None = None) -> Column:
    fields = [docs["doc_id"], docs["source"], docs["lang"], docs["n_chars"] if n_chars is None else n_chars, docs["text"]]
    return F.sha2(F.concat(*map(_written, fields)).cast("binary"), 256)


def _group_key(lang: Column) -> Column:
    """A text that orders as null first, then the languages by their bytes."""
    return F.when(lang.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), lang.cast("string")))


def _blocks(level: DataFrame, bits: int) -> DataFrame:
    """Append every block of ``level`` (group, number, digest, ...): its rows with ``block``, ``block_root`` and ``witness``.

    The first block of a group rises as far as its own leaves need (a full one to the height of a block), later blocks always to that height.
    """
    placed = level.withColumn("block", F.shiftright("number", bits))
    schema = widened(placed.schema, "block_root string, witness array<string>")

    def append(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("number")
        root, witnesses = append_aligned(rows.column("digest").to_pylist(), bits if rows.column("block")[0].as_py() else None)
        return rows.append_column("block_root", pa.array([root] * len(rows))).append_column("witness", pa.array(witnesses, pa.list_(pa.string())))

    return placed.groupBy("group", "block").applyInArrow(append, schema)


def climb(nodes: DataFrame, bits: int = BLOCK_BITS) -> list[DataFrame]:
    """The levels of blocks over ``nodes`` (group, number, digest, ...), lowest first; the last has one block per group.

    Each level has 2^-bits of the rows of the one below and is a written table.
    """
    levels = [cut_lineage(_blocks(nodes, bits))]
    while (levels[-1].agg(F.max("block")).first()[0] or 0) > 0:
        roots = levels[-1].groupBy("group", "block").agg(F.first("block_root").alias("digest"))
        levels.append(cut_lineage(_blocks(roots.select("group", F.col("block").alias("number"), "digest"), bits)))
    return levels


def subroots(levels: list[DataFrame]) -> DataFrame:
    """(group, digest): the root of every group."""
    return levels[-1].groupBy("group").agg(F.first("block_root").alias("digest"))


def descend(levels: list[DataFrame], crown: DataFrame) -> DataFrame:
    """The lowest level with whole witnesses: what ``crown`` (group, ...) says of a group is handed down block by block."""
    done = levels[-1].withColumnRenamed("block_root", "subroot").join(crown, "group")
    for lower in reversed(levels[:-1]):
        upper = done.select("group", F.col("number").alias("block"), "subroot", F.col("witness").alias("upper"), *[c for c in crown.columns if c != "group"])
        done = lower.join(upper, ["group", "block"]).withColumn("witness", F.concat("witness", "upper")).drop("upper", "block_root")
    return done


def _steps(witness: Column, number: Column) -> Column:
    """Sides follow from a node's place: where bit j is set, the node of level j is a right one and its sibling stands left."""
    def step(sibling: Column, j: Column) -> Column:
        side = F.when(sibling == "", "alone").when(F.call_function("shiftright", number, j.cast("int")) % 2 == 1, "left").otherwise("right")
        return F.struct(side.alias("side"), sibling.alias("digest"))
    return F.transform(witness, step)


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its witness lead to."""
    def rise(node: Column, step: Column) -> Column:
        left = F.when(step["side"] == "left", step["digest"]).otherwise("")
        right = F.when(step["side"] == "right", step["digest"]).otherwise("")
        return F.sha2(F.concat(left, node, right).cast("binary"), 256)
    return F.aggregate(steps, leaf, rise)


def proof(steps: Column) -> Column:
    """Digest of all siblings of a witness, bottom up."""
    return F.sha2(F.concat_ws("", F.transform(steps, lambda s: s["digest"])).cast("binary"), 256)


def manifest(docs: DataFrame, claimed_chars: Column | None = None, bits: int = BLOCK_BITS, earlier: DataFrame | None = None) -> DataFrame:
    """One row per document with its place, ``leaf``, ``subroot`` (of its language), ``root`` (of the dataset) and
    ``witness``: the steps from the leaf to the root; ``claimed``: the leaf with ``claimed_chars`` in place of n_chars.

    Leaves ascend by doc_id (nulls first) within a language, equal ids by leaf digest, equal rows in table order; null
    languages come first.  Any column may be null; texts of any length are hashed whole in the JVM; other columns are
    left out; an empty table gives an empty manifest.  ``earlier``: a manifest to which ``docs`` are appended; the new
    ids of a language must lie above its old ones (else ValueError).
    """
    claimed = docs["n_chars"] if claimed_chars is None else claimed_chars
    changed = ~claimed.eqNullSafe(docs["n_chars"])
    rows = docs.select(docs["doc_id"].alias("doc_id"), _group_key(docs["lang"]).alias("group"), leaf_digest(docs).alias("digest"),
                       F.when(changed, leaf_digest(docs, claimed)).alias("claimed"))
    placed = numbered(cut_lineage(rows), "group", [F.col("doc_id").asc_nulls_first(), F.col("digest")])
    levels = climb(placed if earlier is None else _appended(placed, earlier), bits)
    tops = cut_lineage(subroots(levels).select(F.lit("").alias("all"), F.col("group").alias("name"), "digest"))
    tops = climb(numbered(tops, "all", [F.col("name")]).withColumnRenamed("all", "group"), bits)
    crown = descend(tops, subroots(tops).select("group", F.col("digest").alias("root")))
    crown = crown.select(F.col("name").alias("group"), "root", _steps(F.col("witness"), F.col("number")).alias("crown"))
    found = descend(levels, cut_lineage(crown))
    return found.select("doc_id", F.when(F.col("group") != "", F.expr("substring(group, 2)")).alias("lang"), "number", F.col("digest").alias("leaf"),
                        F.coalesce("claimed", "digest").alias("claimed"), "subroot", "root", F.concat(_steps(F.col("witness"), F.col("number")), "crown").alias("witness"))


def _appended(fresh: DataFrame, earlier: DataFrame) -> DataFrame:
    """Old places with the new rows behind them."""
    old = earlier.select("doc_id", _group_key(F.col("lang")).alias("group"), F.col("leaf").alias("digest"), "claimed", "number")
    ends = old.groupBy("group").agg(F.count("*").alias("held"), F.max("doc_id").alias("top"))
    starts = fresh.groupBy("group").agg(F.min("doc_id").alias("least"), F.max(F.col("doc_id").isNull()).alias("unnamed"))
    if ends.join(starts, "group").where("unnamed or least <= top").limit(1).count():
        raise ValueError("appended ids must lie above those that their language holds")
    moved = fresh.join(ends, "group", "left")
    return old.unionByName(moved.select("doc_id", "group", "digest", "claimed", (F.col("number") + F.coalesce("held", F.lit(0))).alias("number")))
