"""Modularity communities of a weighted graph as rounds of joins in which modularity never falls.

Communities merge: in a round, those on one side of a hash coin join their best neighbour on the other, and the merged
ones are the nodes of the next, smaller round, so rounds grow with the logarithm of the graph.  Then single nodes move
between communities until little is left to gain: once while communities are small, as ties between first mergers are
blind, and again whenever merging has ended.

A graph of at most ``TASK_EDGES`` edges goes through these rounds inside one task (``taskgraph``), so a merging and the
moves after it are one Spark job instead of several per round; a larger one goes through them as joins.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.session import cut_lineage
from . import taskgraph as TG

#: moves of single nodes end when all open ones together promise less than this modularity
TOLERANCE = 2e-3
#: the same while communities are small, in units of the final tolerance
FIRST_TOLERANCE = 10.0
#: a community joins a neighbour that stays only if that gains at least this part of its best merger
NEAR_BEST = 0.9
#: mean size of a community at which the first mergers pause
FIRST_SIZE = 4
#: the most edges that one task holds (690 MB of Python were measured with 5 million)
TASK_EDGES = 10_000_000
#: ranks of gains inside a community: powers of two and, inside one of them, hash parts
_POWERS, _PARTS = 64, 16
#: whether a node stays in a round; the salt is a column, so the code that Spark compiles serves all rounds
_COIN = "pmod(xxhash64({}, salt), 2) = 0"


@dataclass
class Communities:
    """Labels (cell_id, cluster) with the rounds of each step, merging and moving in turn."""

    clusters: DataFrame
    rounds: list[int]


def _written(df: DataFrame, figure: Column) -> tuple[DataFrame, float]:
    """``df`` written and read back, and an aggregate over it that is taken while it is written (0 for null)."""
    seen = Observation()
    out = cut_lineage(df.observe(seen, figure.alias("figure")))
    return out, seen.get["figure"] or 0


def _shuffled(df: DataFrame) -> DataFrame:
    """``df`` for a join that may not broadcast it: a written table of a row per node is small in Parquet, not on the driver."""
    return df.hint("merge")


def undirected(edges: DataFrame) -> DataFrame:
    """(a, b, w) in both directions; an edge may be listed once or twice, self loops go."""
    e = edges.where("src <> dst").select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"), "weight").groupBy("a", "b").agg(F.max("weight").alias("w"))
    return e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"), "w"))


def communities(edges: DataFrame, resolution: float = 1.0, seed: int = 0, tolerance: float = TOLERANCE) -> DataFrame:
    """Communities (cell_id, cluster) of ``edges(src, dst, weight)``, numbered from 0 by falling size, ties by member."""
    return find_communities(edges, resolution, seed, tolerance).clusters


def find_communities(edges: DataFrame, resolution: float = 1.0, seed: int = 0, tolerance: float = TOLERANCE) -> Communities:
    """Communities by merging and moving; those which moves have taken apart are split into their connected parts.

    Splitting raises modularity, so no step lowers it, and every community is connected.
    """
    graph, entries = _written(undirected(edges), F.count("*"))
    total = graph.agg(F.sum("w").alias("t")).first()["t"]
    nodes, n = _written(graph.groupBy(F.col("a").alias("node")).agg(F.sum("w").alias("k")).withColumn("com", F.col("node")), F.count("*"))
    rounds: list[int] = []
    in_task = entries <= 2 * TASK_EDGES
    while total and in_task:
        nodes, merged, moved = _in_task(graph, nodes, resolution, seed + len(rounds), 0 if rounds else n - n // FIRST_SIZE, tolerance * (1.0 if rounds else FIRST_TOLERANCE))
        rounds += [merged, moved] if merged else [merged]
        if not merged or not moved and len(rounds) > 2:
            break
    while total and not in_task:
        nodes, merged = _merging(graph, nodes, resolution, float(total), seed + len(rounds), 0 if rounds else n - n // FIRST_SIZE)
        rounds.append(merged)
        if not merged:
            break
        nodes, moved = _moving(graph, nodes, resolution, float(total), seed + len(rounds), tolerance * (FIRST_TOLERANCE if len(rounds) == 1 else 1.0))
        rounds.append(moved)
        if not moved and len(rounds) > 2:
            break
        parts = connected_parts(graph, nodes.select(F.col("node").alias("cell_id"), F.col("com").alias("node")))
        nodes = cut_lineage(nodes.drop("com").join(_shuffled(parts.select(F.col("cell_id").alias("node"), F.col("node").alias("com"))), "node"))
    sizes = nodes.groupBy("com").agg(F.count(F.lit(1)).alias("n"))
    order = W.orderBy(F.col("n").desc(), F.col("com"))  # one row per community
    numbers = sizes.withColumn("cluster", (F.row_number().over(order) - 1).cast("string"))
    return Communities(nodes.join(numbers, "com").select(F.col("node").alias("cell_id"), "cluster"), rounds)


def _one_task(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``nodes`` (a, b) and ``links`` (a, b, w) as rows of one partition, in the order that ``taskgraph.read`` takes."""
    rows = nodes.select(F.lit(0).alias("kind"), "a", "b", F.lit(0.0).alias("w")).unionByName(links.select(F.lit(1).alias("kind"), "a", "b", "w"))
    return rows.repartition(1).sortWithinPartitions("kind", "a", "b")


def _in_task(graph: DataFrame, nodes: DataFrame, resolution: float, seed: int, most: int, tolerance: float) -> tuple[DataFrame, int, int]:
    """``nodes`` after merging, moves and the split into connected parts in one task, and the rounds of the first two."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, com, held = TG.read(batches)
        if not len(ids):
            return
        total = float(held.k.sum())
        found, merged = TG.merged(held, com, resolution / total, seed, most)
        moved = 0
        if merged:
            found, moved = TG.moved(held, found, resolution / total, seed + 1, tolerance * total)
        names = TG.connected(held, found) if merged else com
        n = len(ids)
        out = {"node": ids, "k": held.k, "com": ids.take(pa.array(names)), "salt": np.full(n, seed, np.int32), "moved": names != com, "merged": np.full(n, merged, np.int32), "rounds": np.full(n, moved, np.int32)}
        yield from pa.table(out).to_batches(max_chunksize=1 << 16)

    name = graph.schema["a"].dataType.simpleString()
    seen = Observation()
    done = _one_task(nodes.select(F.col("node").alias("a"), F.col("com").alias("b")), graph).mapInArrow(step, f"node {name}, k double, com {name}, salt int, moved boolean, merged int, rounds int")
    out = cut_lineage(done.observe(seen, F.max("merged").alias("merged"), F.max("rounds").alias("rounds")).select("node", "k", "com", "salt", "moved"))
    return out.select("node", "k", "com"), seen.get["merged"] or 0, seen.get["rounds"] or 0


def _merging(graph: DataFrame, nodes: DataFrame, resolution: float, total: float, seed: int, most: int) -> tuple[DataFrame, int]:
    """``nodes`` with the communities after rounds of mergers, and the rounds; they pause after ``most`` mergers (0: never).

    A round works on the edges between communities only; their degrees travel with them.
    If no merger is sure, the best one is made alone.
    """
    sums = nodes.groupBy("com").agg(F.sum("k").alias("k"))
    end = lambda side: _shuffled(nodes.select(F.col("node").alias(side), F.col("com").alias(f"c{side}")))
    pairs = graph.where("a < b").join(end("a"), "a").join(end("b"), "b").where("ca <> cb")
    pairs = pairs.groupBy(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).agg(F.sum("w").alias("w"))
    degree = lambda side: sums.select(F.col("com").alias(side), F.col("k").alias(f"k{side}"))
    level = cut_lineage(pairs.join(degree("a"), "a").join(degree("b"), "b").withColumn("salt", F.lit(seed)))
    parents: list[DataFrame] = []
    merged = 0
    while True:
        gain = F.round(F.col("w") - resolution * F.col("ka") * F.col("kb") / total, 9)
        gains = level.withColumn("gain", gain).where("gain > 0")
        joined, n = _written(_joiners(gains, resolution, total), F.count("*"))
        if not n:
            first = gains.orderBy(F.desc("gain"), "a", "b").limit(1).select(F.col("b").alias("node"), F.col("a").alias("target"), F.col("kb").alias("k"), F.col("ka").alias("there"))
            joined, n = _written(first, F.count("*"))
            if not n:
                break
        parents.append(joined.select("node", "target"))
        merged += n
        if most and merged >= most:
            break
        level = cut_lineage(_merged(level, joined))
    if not parents:
        return nodes, 0
    parent = parents[0]
    for more in parents[1:]:
        parent = parent.unionByName(more)
    return cut_lineage(nodes.join(_shuffled(_roots(parent).select(F.col("node").alias("com"), "root")), "com", "left").select("node", "k", F.coalesce("root", "com").alias("com"))), len(parents)


def _joiners(gains: DataFrame, resolution: float, total: float) -> DataFrame:
    """(node, target, k, there): communities that join one which stays in this round, with both degrees."""
    stays = _COIN.format
    ends = gains.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("target"), F.col("ka").alias("k"), F.col("kb").alias("there"), "gain", "salt"),
                                          F.struct(F.col("b").alias("node"), F.col("a").alias("target"), F.col("kb").alias("k"), F.col("ka").alias("there"), "gain", "salt"))).alias("e")).select("e.*")
    best = ends.groupBy("node", "k", "salt").agg(F.max("gain").alias("most"), F.max(F.when(F.expr(stays("target")), F.struct("gain", F.xxhash64("node", "target").alias("tie"), "target", "there"))).alias("sure"))
    moves = best.where(~F.expr(stays("node")) & (F.col("sure.gain") >= NEAR_BEST * F.col("most")))
    moves = moves.select("node", F.col("node").alias("com"), "k", "sure.target", "sure.gain", "sure.there")
    return _admitted(moves, resolution, total).select("node", "target", "k", "there")


def _merged(level: DataFrame, joined: DataFrame) -> DataFrame:
    """The edges between communities after mergers."""
    grown = joined.groupBy("target").agg((F.sum("k") + F.first("there")).alias("grown"))
    moved = joined.join(grown, "target").select(F.col("node").alias("old"), F.col("target").alias("new"), "grown").unionByName(grown.select(F.col("target").alias("old"), F.col("target").alias("new"), "grown"))
    for side in ("a", "b"):
        level = level.join(_shuffled(moved.select(F.col("old").alias(side), F.col("new").alias(f"n{side}"), F.col("grown").alias(f"g{side}"))), side, "left")
    x = F.struct(F.coalesce("na", "a").alias("c"), F.coalesce("ga", "ka").alias("k"))
    y = F.struct(F.coalesce("nb", "b").alias("c"), F.coalesce("gb", "kb").alias("k"))
    apart = level.select(x.alias("x"), y.alias("y"), "w", "salt").where("x.c <> y.c").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"), "w", "salt")
    return apart.groupBy(F.col("x.c").alias("a"), F.col("y.c").alias("b")).agg(F.first(F.col("salt") + 1).alias("salt"), F.sum("w").alias("w"), F.first("x.k").alias("ka"), F.first("y.k").alias("kb"))


def _roots(parent: DataFrame) -> DataFrame:
    """(node, root) of a forest (node, target): every round doubles the length of the jumps."""
    names = cut_lineage(parent.select("node", F.col("target").alias("root")))
    while True:
        up = names.select(F.col("node").alias("root"), F.col("root").alias("above"))
        jumped, n = _written(names.join(_shuffled(up), "root", "left").select("node", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")), F.count_if("moved"))
        if not n:
            return jumped.drop("moved")
        names = jumped.drop("moved")


def _proposals(graph: DataFrame, nodes: DataFrame, resolution: float, total: float) -> DataFrame:
    """(node, com, k, best, sure) of every node with a gain to be had; gains are in units of edge weight.

    ``best`` (gain, target) counts all links, ``sure`` only those to nodes that stay in this
    round, so that it holds whatever the other nodes do; it is null for nodes
    that stay themselves.
    """
    mass = nodes.groupBy("com").agg(F.sum("k").alias("mass"))
    near = nodes.select(F.col("node").alias("b"), F.col("com").alias("target"), (~F.expr(_COIN.format("node"))).alias("goes"))
    links = graph.where("a <> b").join(_shuffled(near), "b").groupBy(F.col("a").alias("node"), "target").agg(F.sum("w").alias("to"), F.sum(F.when(~F.col("goes"), F.col("w")).otherwise(0.0)).alias("held"))
    own = nodes.join(mass, "com").join(links.select("node", F.col("target").alias("com"), F.col("to").alias("inside")), ["node", "com"], "left")
    stay = F.coalesce("inside", F.lit(0.0)) - resolution * F.col("k") * (F.col("mass") - F.col("k")) / total
    options = links.join(own.select("node", "com", "k", "salt", stay.alias("stay")), "node").where("target <> com").join(mass.select(F.col("com").alias("target"), F.col("mass").alias("there")), "target")
    cost = resolution * F.col("k") * F.col("there") / total + F.col("stay")
    best = options.groupBy("node", "com", "k", "salt").agg(F.max(F.struct(F.round(F.col("to") - cost, 9).alias("gain"), "target")).alias("best"), F.max(F.struct(F.round(F.col("held") - cost, 9).alias("gain"), "target")).alias("sure"))
    return best.where("best.gain > 0").withColumn("sure", F.when(~F.expr(_COIN.format("node")) & (F.col("sure.gain") > 0), F.col("sure")))


def _admitted(moves: DataFrame, resolution: float, total: float) -> DataFrame:
    """Those of ``moves`` (node, com, k, target, gain) that still gain when all greater ones into or out of the same communities happen too.

    Two nodes that enter, or leave, one community together lose the product of their
    degrees over the total; it is charged to the smaller gain.  Sums of degrees per rank,
    at most 1,024 rows a community, stand for the moves themselves.
    """
    power = F.greatest(F.lit(0), F.least(F.lit(_POWERS - 1), F.floor(-F.log2("gain")) + 8))
    moves = moves.withColumn("rank", power * _PARTS + F.pmod(F.xxhash64("node", "gain"), F.lit(_PARTS)))
    upto = W.partitionBy("side").orderBy("rank")

    def ahead(column: str, name: str) -> DataFrame:
        sums = moves.groupBy(F.col(column).alias("side"), "rank").agg(F.sum("k").alias("k"))
        return sums.select(F.col("side").alias(column), "rank", F.sum("k").over(upto).alias(name))

    found = moves.join(ahead("target", "entering"), ["target", "rank"]).join(ahead("com", "leaving"), ["com", "rank"])
    return found.where(F.col("gain") > resolution * F.col("k") * (F.col("entering") + F.col("leaving") - 2 * F.col("k")) / total)


def _moving(graph: DataFrame, nodes: DataFrame, resolution: float, total: float, seed: int, tolerance: float) -> tuple[DataFrame, int]:
    """``nodes`` (node, k, com) after moves of single nodes that together raise modularity in every round, and the rounds.

    A hash coin lets half of the nodes move in a round.  If no move is sure, the best one is made alone.
    """
    nodes = nodes.withColumn("salt", F.lit(seed))
    for step in itertools.count():
        proposals, open_gain = _written(_proposals(graph, nodes, resolution, total), F.sum("best.gain"))
        if not open_gain or open_gain < tolerance * total:
            return nodes.drop("salt"), step
        sure = proposals.where("sure IS NOT NULL").select("node", "com", "k", "sure.target", "sure.gain")
        moved, n = _written(_moved(nodes, _admitted(sure, resolution, total).select("node", "target")), F.count_if("moved"))
        if not n:
            first = proposals.orderBy(F.desc("best.gain"), "node").limit(1).select("node", "best.target")
            moved = cut_lineage(_moved(nodes, first))
        nodes = moved.drop("moved")


def _moved(nodes: DataFrame, chosen: DataFrame) -> DataFrame:
    return nodes.join(chosen, "node", "left").select("node", "k", F.coalesce("target", "com").alias("com"), (F.col("salt") + 1).alias("salt"), F.col("target").isNotNull().alias("moved"))


def connected_parts(graph: DataFrame, label: DataFrame) -> DataFrame:
    """(cell_id, node): the connected parts of every community, named by their least member.

    Least names spread along the edges inside communities and jump over names already
    reached, so rounds grow with the logarithm of a community's diameter.
    """
    com = _shuffled(label.select("cell_id", F.col("node").alias("com")))
    inside = graph.join(com.select(F.col("cell_id").alias("a"), F.col("com").alias("ca")), "a").join(com.select(F.col("cell_id").alias("b"), F.col("com").alias("cb")), "b")
    inside, entries = _written(inside.where("ca = cb").select("a", "b"), F.count("*"))
    if entries <= 2 * TASK_EDGES:
        return _parts_in_task(inside, label)
    names = cut_lineage(label.select("cell_id", F.col("cell_id").alias("node")))
    while True:
        heard = inside.join(_shuffled(names.select(F.col("cell_id").alias("b"), "node")), "b").groupBy(F.col("a").alias("cell_id")).agg(F.min("node").alias("heard"))
        least = names.join(heard, "cell_id", "left").select("cell_id", "node", F.least("node", "heard").alias("low"))
        # the name that the named cell itself has heard of
        jump = least.select(F.col("cell_id").alias("low"), F.col("low").alias("lower"))
        step, n = _written(least.join(jump, "low").select("cell_id", F.col("lower").alias("node"), (F.col("lower") != F.col("node")).alias("moved")), F.count_if("moved"))
        if not n:
            return step.select("cell_id", "node")
        names = step.select("cell_id", "node")


def _parts_in_task(inside: DataFrame, label: DataFrame) -> DataFrame:

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, _, held = TG.read(batches)
        if len(ids):
            names = TG.connected(held, np.zeros(len(ids), np.int8))
            yield from pa.table({"cell_id": ids, "node": ids.take(pa.array(names))}).to_batches(max_chunksize=1 << 16)

    name = label.schema["cell_id"].dataType.simpleString()
    links = inside.select("a", "b", F.lit(0.0).alias("w"))
    return _one_task(label.select(F.col("cell_id").alias("a"), F.col("cell_id").alias("b")), links).mapInArrow(parts, f"cell_id {name}, node {name}")
