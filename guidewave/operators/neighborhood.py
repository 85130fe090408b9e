"""Local enrichment of each perturbation among a cell's nearest neighbours."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.ordering import bh_adjust, exact_quantiles
from ..functions.scalars import ratio
from ..functions.session import cut_lineage
from .draws import cell_key, coefficients, edge_counts, thresholds
from .grids import complete
from .labels import CONTROL, is_perturbed, is_reference

CONTROL_LABEL = "*control*"


def stored_neighbors(n_neighbors: int, n_cells: int, max_fraction: float = 1.0) -> int:
    """Neighbours actually stored: the requested number includes the cell itself."""
    cap = n_cells - 1 if max_fraction >= 1.0 else max(15, int(max_fraction * n_cells))
    return int(min(n_neighbors, cap, max(n_cells - 1, 2))) - 1


def _labelled(cells: DataFrame, control_classes: Sequence[str], min_cells: int) -> tuple[DataFrame, DataFrame]:
    """Cells with their score label, and one row per scored label with its share of all cells."""
    label = F.when(is_perturbed(), F.col("target")).when(is_reference(control_classes), F.lit(CONTROL_LABEL))
    tagged = cells.withColumn("label", label)
    sizes = tagged.groupBy("label").agg(F.count(F.lit(1)).alias("n_label"))
    n = tagged.agg(F.count(F.lit(1)).alias("n_all"))
    kept = sizes.where(F.col("label").isNotNull() & ((F.col("label") == CONTROL_LABEL) | (F.col("n_label") >= min_cells)))
    shares = kept.crossJoin(F.broadcast(n)).withColumn("share", F.col("n_label") / F.col("n_all"))
    return tagged, shares


def local_counts(edges: DataFrame, tagged: DataFrame) -> DataFrame:
    """Neighbours of each label around each cell; only labels that occur."""
    names = tagged.where(F.col("label").isNotNull()).select(F.col("cell_id").alias("dst"), "label")
    return edges.select("src", "dst").join(names, "dst").groupBy("src", "label").agg(F.count(F.lit(1)).alias("n_near"))


def cell_scores(cells: DataFrame, edges: DataFrame, k: int, control_classes: Sequence[str], min_cells: int = 10) -> DataFrame:
    """Scores above -1: (cell_id, target, score) for labels found among the neighbours; every other pair is -1."""
    tagged, shares = _labelled(cells, control_classes, min_cells)
    near = local_counts(edges, tagged).join(shares, "label")
    return near.select(F.col("src").alias("cell_id"), F.col("label").alias("target"), (F.col("n_near") / k / F.col("share") - 1).alias("score"))


def own_scores(cells: DataFrame, edges: DataFrame, k: int, control_classes: Sequence[str], min_cells: int = 10) -> DataFrame:
    """Score of each cell for its own label, the control label included."""
    tagged, shares = _labelled(cells, control_classes, min_cells)
    near = local_counts(edges, tagged).withColumnRenamed("src", "cell_id")
    mine = tagged.where(F.col("label").isNotNull()).join(shares, "label").join(near, ["cell_id", "label"], "left")
    return mine.withColumn("score", F.coalesce("n_near", F.lit(0)) / k / F.col("share") - 1).drop("n_near", "n_all", "n_label", "share")


def summary(cells: DataFrame, edges: DataFrame, k: int, control_classes: Sequence[str], min_cells: int = 10, cut: float = 0.5) -> DataFrame:
    """One row per target: means over all, own and control cells, median, maximum, enriched shares.

    Means over all cells and over controls come from neighbour counts, so the
    cells x targets matrix is never filled.
    """
    tagged, shares = _labelled(cells, control_classes, min_cells)
    roles = tagged.select(F.col("cell_id").alias("src"), F.col("label").alias("own"))
    near = local_counts(edges, tagged).join(shares, "label").join(roles, "src").withColumn("score", F.col("n_near") / k / F.col("share") - 1)
    control = F.col("own") == CONTROL_LABEL
    sums = near.groupBy("label").agg(F.sum("n_near").alias("_all"), F.sum(F.when(control, F.col("n_near"))).alias("_ctrl"), F.max("score").alias("_max"), F.count(F.lit(1)).alias("_seen"),
                                     F.count_if(F.col("score") > cut).alias("_enriched"))
    n_control = tagged.agg(F.count_if(F.col("label") == CONTROL_LABEL).alias("n_control"))
    base = shares.where(F.col("label") != CONTROL_LABEL).join(sums, "label", "left").crossJoin(F.broadcast(n_control)).na.fill(0, ["_all", "_ctrl", "_seen", "_enriched"])
    scale = F.col("share") * k
    own = own_scores(cells, edges, k, control_classes, min_cells).where(F.col("label") != CONTROL_LABEL)
    mine = own.groupBy("label").agg(F.avg("score").alias("mean_in_own_cells"), (100 * F.avg((F.col("score") > cut).cast("double"))).alias("pct_own_cells_enriched"))
    median = exact_quantiles(own.select("label", "score"), ["label"], "score", {"median_in_own_cells": 0.5})
    out = base.join(mine, "label").join(median, "label")
    lowest = F.when(F.col("_seen") < F.col("n_all"), F.greatest(F.coalesce("_max", F.lit(-1.0)), F.lit(-1.0))).otherwise(F.col("_max"))
    return out.select(
        F.col("label").alias("target"), F.col("n_label").alias("n_cells"), (100 * F.col("share")).alias("overall_fraction_pct"), (F.col("_all") / scale / F.col("n_all") - 1).alias("mean_all_cells"),
        "mean_in_own_cells", "median_in_own_cells", lowest.alias("max_score"), (100 * (F.col("_enriched") + (F.lit(0) if cut >= -1 else F.col("n_all") - F.col("_seen"))) / F.col("n_all")).alias("pct_cells_enriched"),
        "pct_own_cells_enriched", (ratio(F.col("_ctrl") / scale, F.col("n_control")) - 1).alias("mean_in_control_cells"),
        (F.col("mean_in_own_cells") - (ratio(F.col("_ctrl") / scale, F.col("n_control")) - 1)).alias("delta_own_vs_control"))


def by_cluster(cells: DataFrame, edges: DataFrame, k: int, control_classes: Sequence[str], min_cells: int = 10) -> DataFrame:
    """Mean score per (target, cluster), cells without such neighbours included as -1."""
    tagged, shares = _labelled(cells, control_classes, min_cells)
    targets = shares.where(F.col("label") != CONTROL_LABEL)
    clusters = tagged.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_cluster"))
    near = local_counts(edges, tagged).join(tagged.select(F.col("cell_id").alias("src"), "cluster"), "src").groupBy("label", "cluster").agg(F.sum("n_near").alias("_n"))
    grid = complete(targets, clusters, "cluster").join(clusters, "cluster").join(near, ["label", "cluster"], "left")
    score = F.coalesce("_n", F.lit(0)) / k / F.col("share") / F.col("n_cluster") - 1
    return grid.select(F.col("label").alias("target"), "cluster", score.alias("mean_score"))


def top_cluster(table: DataFrame) -> DataFrame:
    best = table.groupBy("target").agg(F.max(F.struct(F.round("mean_score", 9).alias("s"), F.col("cluster"))).alias("_b"), F.max("mean_score").alias("top_cluster_mean"))
    return best.select("target", F.col("_b.cluster").alias("top_cluster"), "top_cluster_mean")


def by_sample(cells: DataFrame, edges: DataFrame, k: int, control_classes: Sequence[str], min_cells: int = 10) -> DataFrame:
    """Own-cell mean per sample."""
    own = own_scores(cells, edges, k, control_classes, min_cells).where(F.col("label") != CONTROL_LABEL)
    return own.groupBy(F.col("label").alias("target"), "sample").agg(F.avg("score").alias("mean_score"), F.count(F.lit(1)).alias("n_cells"))


def sample_support(table: DataFrame) -> DataFrame:
    """Number of samples and the share of the largest one per target."""
    return table.groupBy("target").agg(F.count(F.lit(1)).alias("n_samples"), (F.max("n_cells") / F.sum("n_cells")).alias("max_sample_share"))


def permutation_null(cells: DataFrame, edges: DataFrame, k: int, control_classes: Sequence[str], n_permutations: int, seed: int = 0, min_cells: int = 10) -> DataFrame:
    """Null mean and sd of the own-cell score under random labels, z-score, empirical p and FDR.

    One order of all cells per permutation serves every target: target t's draw is the
    first n_t cells, and an edge counts for t when both ends are among them, so the
    counts per target accumulate over the sorted n_t.  Orders are never written: tasks
    evaluate them from the ids of their edges (see ``draws``).
    """
    tagged, shares = _labelled(cells, control_classes, min_cells)
    targets = shares.where(F.col("label") != CONTROL_LABEL)
    sizes = np.array([r[0] for r in targets.select("n_label").distinct().orderBy("n_label").collect()], np.int64)  # at most one per target
    rows = coefficients(n_permutations, seed)
    limits = thresholds(cut_lineage(cells.select(cell_key(F.col("cell_id")))), rows, sizes)
    hits = edge_counts(edges, rows, limits).withColumnRenamed("n", "_n")
    spark = cells.sparkSession
    perms = spark.range(1, n_permutations + 1).select(F.col("id").cast("int").alias("perm"))
    steps = spark.createDataFrame([(i, int(n)) for i, n in enumerate(sizes)], "level int, n_label long")
    grid = complete(perms, steps.select("level"), "level").join(hits, ["perm", "level"], "left")
    upto = F.sum(F.coalesce("_n", F.lit(0))).over(W.partitionBy("perm").orderBy("level"))
    null = grid.withColumn("_upto", upto).join(F.broadcast(steps), "level").join(targets.select("label", "n_label", "share"), "n_label")
    null = null.withColumn("null_mean_score", F.col("_upto") / k / F.col("n_label") / F.col("share") - 1)
    own = own_scores(cells, edges, k, control_classes, min_cells).groupBy("label").agg(F.avg("score").alias("observed"))
    stats = null.join(own, "label").groupBy("label").agg(
        F.first("observed").alias("observed"), F.avg("null_mean_score").alias("null_mean"), F.stddev_samp("null_mean_score").alias("null_sd"),
        F.count_if(F.col("null_mean_score") >= F.col("observed") - 1e-12).alias("_ge"), F.count(F.lit(1)).alias("_b"))
    out = stats.withColumn("z_score", F.when(F.col("null_sd") > 0, (F.col("observed") - F.col("null_mean")) / F.col("null_sd"))).withColumn("p_empirical", (1 + F.col("_ge")) / (1 + F.col("_b")))
    return bh_adjust(out.drop("_ge", "_b").withColumnRenamed("label", "target"), "p_empirical", "fdr")
