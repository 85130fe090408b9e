"""Agglomerative modules as rounds of joins, and the modularity of a partition."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.session import cut_lineage

LINKAGES = ("average", "complete", "single", "weighted", "ward")


def agglomerate(pairs: DataFrame, linkage: str = "average") -> DataFrame:
    """Merge table (parent, child, height, round) of hierarchical clustering.

    ``pairs(a, b, distance)`` holds every pair of distinct items once, ids being
    strings.  Each round merges all reciprocal nearest neighbours at the same time
    (exact for these linkages up to ties) and updates the distances by joins; a
    cluster is named after its smallest member.  Rounds are written out and go on
    until one cluster is left: the smallest pair of least distance is always
    reciprocal, so no round is in vain.
    """
    if linkage not in LINKAGES:
        raise ValueError(f"unknown linkage: {linkage}")
    spark = pairs.sparkSession
    power = 2.0 if linkage == "ward" else 1.0
    d = pairs.select("a", "b", F.pow(F.col("distance"), power).alias("d"))
    d = cut_lineage(d.unionByName(d.select(F.col("b").alias("a"), F.col("a").alias("b"), "d")))
    sizes = d.select("a").distinct().withColumn("n", F.lit(1.0))
    merges = spark.createDataFrame([], "parent string, child string, height double, round int")
    for step in itertools.count(1):
        nearest = d.groupBy("a").agg(F.min(F.struct("d", "b")).alias("_m")).select("a", F.col("_m.b").alias("b"), F.col("_m.d").alias("d"))
        back = nearest.select(F.col("b").alias("a"), F.col("a").alias("b"))
        mutual = cut_lineage(nearest.join(back, ["a", "b"], "left_semi").where("a < b"))
        # one row per merge; an empty table ends the loop
        if mutual.isEmpty():
            break
        merges = merges.unionByName(mutual.select(F.col("a").alias("parent"), F.col("b").alias("child"), F.pow("d", 1.0 / power).alias("height"), F.lit(step).alias("round")))
        if step % 16 == 0:  # the plan of a long chain stays short
            merges = cut_lineage(merges)
        d, sizes = _merge_round(d, sizes, mutual, linkage)
    return cut_lineage(merges)


def _merge_round(d: DataFrame, sizes: DataFrame, mutual: DataFrame, linkage: str) -> tuple[DataFrame, DataFrame]:
    """Distances and sizes after the mutual pairs are merged: one side at a time."""
    moved = mutual.select(F.col("b").alias("old"), F.col("a").alias("new"))
    inner = mutual.select(F.col("a").alias("rep"), F.col("d").alias("dij"))
    after = sizes.join(moved, sizes.a == moved.old, "left").groupBy(F.coalesce("new", "a").alias("a")).agg(F.sum("n").alias("n"))
    # first side: members still have their own sizes, partners too; second side: partners are already merged
    once = _fold(d, "a", "b", moved, inner, sizes, sizes, linkage)
    twice = _fold(once, "b", "a", moved, inner, sizes, after, linkage)
    return cut_lineage(twice.where("a <> b")), cut_lineage(after)


def _fold(d: DataFrame, side: str, other: str, moved: DataFrame, inner: DataFrame, sizes: DataFrame, other_sizes: DataFrame, linkage: str) -> DataFrame:
    rows = d.join(sizes.select(F.col("a").alias(side), F.col("n").alias("ni")), side)
    if linkage == "ward":
        rows = rows.join(other_sizes.select(F.col("a").alias(other), F.col("n").alias("nk")), other)
    rows = rows.join(moved.withColumnRenamed("old", side), side, "left").withColumn(side, F.coalesce("new", side)).drop("new")
    # the two halves of a merge facing each other vanish
    rows = rows.where(F.col(side) != F.col(other)) if side == "b" else rows
    grouped = rows.groupBy(side, other)
    value: Column
    if linkage == "average":
        out = grouped.agg((F.sum(F.col("ni") * F.col("d")) / F.sum("ni")).alias("d"))
    elif linkage == "weighted":
        out = grouped.agg(F.avg("d").alias("d"))
    elif linkage == "complete":
        out = grouped.agg(F.max("d").alias("d"))
    elif linkage == "single":
        out = grouped.agg(F.min("d").alias("d"))
    else:
        g = grouped.agg(F.count(F.lit(1)).alias("c"), F.sum((F.col("ni") + F.col("nk")) * F.col("d")).alias("s"), F.sum("ni").alias("n"), F.max("nk").alias("nk"), F.max("d").alias("d1"))
        g = g.join(inner.withColumnRenamed("rep", side), side, "left")
        value = F.when(F.col("c") == 2, (F.col("s") - F.col("nk") * F.col("dij")) / (F.col("n") + F.col("nk"))).otherwise(F.col("d1"))
        out = g.select(side, other, value.alias("d"))
    return out.select("a", "b", "d")


def cut_tree(items: DataFrame, merges: DataFrame, n_clusters: int | None = None, height: float | None = None, prefix: str = "M") -> DataFrame:
    """Labels (item, module) after undoing the highest merges or those above ``height``.

    Modules are numbered by their smallest member.
    """
    if n_clusters is not None:
        order = W.orderBy(F.col("height").desc(), F.col("round").desc(), F.col("parent"))  # one row per merge
        kept = merges.withColumn("_k", F.row_number().over(order)).where(F.col("_k") >= n_clusters)
    else:
        kept = merges.where(F.col("height") <= height)
    names = cut_lineage(items.select(F.col("item")).join(kept.select(F.col("child").alias("item"), "parent"), "item", "left").select("item", F.coalesce("parent", "item").alias("root")))
    while True:
        up = names.select(F.col("item").alias("root"), F.col("root").alias("_next"))
        jumped = cut_lineage(names.join(up, "root").select("item", F.col("_next").alias("root"), (F.col("_next") != F.col("root")).alias("_moved")))
        if jumped.where("_moved").isEmpty():
            break
        names = jumped.drop("_moved")
    roots = names.select("root").distinct().withColumn("_no", F.row_number().over(W.orderBy("root")))  # one row per module
    return names.join(roots, "root").select("item", F.concat(F.lit(prefix), F.col("_no").cast("string")).alias("module"))


def default_module_count(n_items: int) -> int:
    return max(2, min(9, n_items // 4 if n_items >= 8 else n_items))


# ---- communities

def modularity(edges: DataFrame, clusters: DataFrame, resolution: float = 1.0) -> DataFrame:
    """Modularity of a partition (one row)."""
    e = edges.where("src <> dst").select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"), "weight").groupBy("a", "b").agg(F.max("weight").alias("w"))
    both = e.join(clusters.select(F.col("cell_id").alias("a"), F.col("cluster").alias("ca")), "a").join(clusters.select(F.col("cell_id").alias("b"), F.col("cluster").alias("cb")), "b")
    ends = both.select(F.col("ca").alias("c"), "w").unionByName(both.select(F.col("cb").alias("c"), "w")).groupBy("c").agg(F.sum("w").alias("k"))
    total = both.agg(F.sum("w").alias("m"), F.sum(F.when(F.col("ca") == F.col("cb"), F.col("w")).otherwise(0.0)).alias("inside"))
    return ends.agg(F.sum(F.col("k") * F.col("k")).alias("kk")).crossJoin(total).select((F.col("inside") / F.col("m") - resolution * F.col("kk") / (4 * F.col("m") * F.col("m"))).alias("modularity"))
