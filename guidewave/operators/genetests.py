"""Whole-transcriptome comparisons: effect matrix, gene ranking, cluster markers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.ordering import bh_adjust, running_sums
from ..functions.scalars import log2_ratio, ratio
from ..functions.tails import normal_upper
from .grids import complete
from .labels import is_perturbed, is_reference
from .moments import mean_of, moment_sums, variance_of, welch

_SUMS = ["s1", "s2", "se", "nnz"]


def target_gene_sums(cells: DataFrame, expr: DataFrame, value: str = "lognorm") -> DataFrame:
    """Stored-value sums per (target, gene) over perturbed cells."""
    own = cells.where(is_perturbed()).select("cell_id", "target")
    return moment_sums(expr.select("cell_id", "feature", value).join(own, "cell_id"), ["target", "feature"], value)


def reference_gene_sums(cells: DataFrame, expr: DataFrame, control_classes: Sequence[str], value: str = "lognorm") -> DataFrame:
    ref = cells.where(is_reference(control_classes)).select("cell_id")
    return moment_sums(expr.select("cell_id", "feature", value).join(ref, "cell_id", "left_semi"), ["feature"], value)


def target_vs_control(cells: DataFrame, expr: DataFrame, features: DataFrame, control_classes: Sequence[str], min_cells: int = 20, control: str = "ntc",
                      pseudocount: float = 1e-9, value: str = "lognorm", with_p: bool = True) -> DataFrame:
    """Long (target, gene) table: moments of both groups, log2 fold change of de-logged means, Welch t and p.

    Control ``other`` is everybody's sum minus the target's own, so the pool is
    aggregated once.  Genes unseen in a group enter as zeros.
    """
    sizes = cells.where(is_perturbed()).groupBy("target").agg(F.count(F.lit(1)).alias("n_p"))
    pool = cells.agg(F.count_if(is_reference(control_classes)).alias("_nc"), F.count_if(is_perturbed()).alias("_nt"))
    own = target_gene_sums(cells, expr, value)
    if control == "ntc":
        total = reference_gene_sums(cells, expr, control_classes, value)
    else:
        pooled = cells.where(is_perturbed()).select("cell_id")
        total = moment_sums(expr.select("cell_id", "feature", value).join(pooled, "cell_id", "left_semi"), ["feature"], value)
    eligible = sizes.where(F.col("n_p") >= min_cells)
    grid = complete(features.select("feature").distinct(), eligible, "target").join(eligible, "target").crossJoin(F.broadcast(pool))
    df = grid.join(own, ["target", "feature"], "left").na.fill(0, _SUMS)
    df = df.join(total.select("feature", *[F.col(c).alias(f"c_{c}") for c in _SUMS]), "feature", "left").na.fill(0, [f"c_{c}" for c in _SUMS])
    if control == "ntc":
        df = df.withColumn("n_c", F.col("_nc"))
    else:
        df = df.withColumn("n_c", F.greatest(F.col("_nt") - F.col("n_p"), F.lit(1)))
        for c in _SUMS:
            df = df.withColumn(f"c_{c}", F.col(f"c_{c}") - F.col(c))
    for g, prefix in (("p", ""), ("c", "c_")):
        n = F.col(f"n_{g}").cast("double")
        df = df.withColumn(f"mean_{g}", mean_of(F.col(f"{prefix}s1"), n)).withColumn(f"var_{g}", variance_of(F.col(f"{prefix}s1"), F.col(f"{prefix}s2"), n))
        df = df.withColumn(f"lin_{g}", F.greatest(ratio(F.col(f"{prefix}se"), n), F.lit(0.0)))
    df = df.withColumn("log2fc", log2_ratio(F.col("lin_p"), F.col("lin_c"), pseudocount))
    df = welch(df, "p", "c", "t", "p_value" if with_p else None)
    return df.drop("_nc", "_nt", *_SUMS, *[f"c_{c}" for c in _SUMS])


def de_mask(effects: DataFrame, lfc: float = 0.5, alpha: float = 0.05) -> DataFrame:
    """FDR within each target over the panel genes, and the differential-expression flag."""
    out = bh_adjust(effects, "p_value", "fdr", ["target"])
    return out.withColumn("de", (F.abs("log2fc") > lfc) & (F.col("fdr") < alpha))


def de_counts(effects: DataFrame, key: str) -> DataFrame:
    """Differentially expressed pairs per target or gene, with direction and mean |log2 fold change|."""
    de = F.col("de")
    return effects.groupBy(key).agg(F.count_if(de).alias("n_de"), F.count_if(de & (F.col("log2fc") > 0)).alias("n_up"), F.count_if(de & (F.col("log2fc") < 0)).alias("n_down"),
                                    F.avg(F.abs("log2fc")).alias("mean_abs_log2fc"), F.avg("log2fc").alias("mean_log2fc"))


def rank_genes(effects: DataFrame, by: str = "t", absolute: bool = False) -> DataFrame:
    """All genes of each target ranked by their (signed or absolute) score, ties by name."""
    score = F.abs(by) if absolute else F.col(by)
    return effects.withColumn("rank", F.row_number().over(W.partitionBy("target").orderBy(score.desc_nulls_last(), F.col("feature"))))


def top_genes(effects: DataFrame, n: int = 100, by: str = "t", absolute: bool = False) -> DataFrame:
    """Signature of each target: the n genes with the largest score.

    Spark keeps at most n rows per target before the shuffle for this filter.
    """
    return rank_genes(effects, by, absolute).where(F.col("rank") <= n)


def response_panel(effects: DataFrame, alpha: float = 0.05, n: int = 100) -> DataFrame:
    """Union of each target's significant genes with the largest |t|."""
    significant = bh_adjust(effects, "p_value", "fdr", ["target"]).where(F.col("fdr") < alpha)
    return top_genes(significant, n, "t", absolute=True).select("feature").distinct()


def cluster_sums(clusters: DataFrame, expr: DataFrame, value: str = "lognorm") -> DataFrame:
    return moment_sums(expr.select("cell_id", "feature", value).join(clusters.select("cell_id", "cluster"), "cell_id"), ["cluster", "feature"], value)


def cluster_markers(clusters: DataFrame, expr: DataFrame, features: DataFrame, method: str = "wilcoxon", value: str = "lognorm") -> DataFrame:
    """Every (cluster, gene) against the rest: score, log2 fold change of de-logged means.

    ``wilcoxon`` is the normal score of the rank sum over all cells (no tie
    correction), ``t-test`` the Welch t, ``t-test_overestim_var`` the t with the
    rest's size replaced by the cluster's.
    """
    sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_p"))
    n_all = clusters.agg(F.count(F.lit(1)).alias("_n"))
    sums = cluster_sums(clusters, expr, value)
    total = sums.groupBy("feature").agg(*[F.sum(c).alias(f"t_{c}") for c in _SUMS])
    grid = complete(features.select("feature").distinct(), sizes, "cluster").join(sizes, "cluster").crossJoin(F.broadcast(n_all))
    df = grid.join(sums, ["cluster", "feature"], "left").na.fill(0, _SUMS).join(total, "feature", "left").na.fill(0, [f"t_{c}" for c in _SUMS])
    df = df.withColumn("n_c", F.col("_n") - F.col("n_p"))
    for g, pick in (("p", F.col), ("c", lambda c: F.col(f"t_{c}") - F.col(c))):
        n = F.col(f"n_{g}").cast("double")
        df = df.withColumn(f"mean_{g}", mean_of(pick("s1"), n)).withColumn(f"var_{g}", variance_of(pick("s1"), pick("s2"), n))
    df = df.withColumn("logfoldchange", log2_ratio(F.expm1("mean_p"), F.expm1("mean_c"), 1e-9))
    if method == "t-test":
        df = welch(df, "p", "c", "score", "p_value")
    elif method == "t-test_overestim_var":
        df = welch(df.withColumn("_rest", F.col("n_c")).withColumn("n_c", F.col("n_p")), "p", "c", "score", "p_value").withColumn("n_c", F.col("_rest"))
    elif method == "wilcoxon":
        df = df.join(_rank_scores(clusters, expr, df.select("cluster", "feature", "n_p", "nnz"), value), ["cluster", "feature"], "left")
        n, m = F.col("n_p").cast("double"), F.col("n_c").cast("double")
        df = df.withColumn("score", (F.col("_r") - n * (n + m + 1) / 2) / F.sqrt(n * m * (n + m + 1) / 12))
        df = df.withColumn("p_value", 2 * normal_upper(F.abs("score")))
    else:
        raise ValueError(f"unknown marker method: {method}")
    return df.select("cluster", "feature", "n_p", "n_c", "mean_p", "mean_c", "logfoldchange", "score", "p_value")


def _rank_scores(clusters: DataFrame, expr: DataFrame, grid: DataFrame, value: str) -> DataFrame:
    """Rank sum per (cluster, gene) over all cells: stored values ranked above one block of zeros."""
    stored = expr.where(F.col(value) != 0).select("cell_id", "feature", value).join(clusters.select("cell_id", "cluster"), "cell_id")
    counts = stored.groupBy("feature", "cluster", value).agg(F.count(F.lit(1)).alias("c"))
    zeros = grid.select("feature", "cluster", F.lit(0.0).alias(value), (F.col("n_p") - F.col("nnz")).alias("c"))
    counts = counts.unionByName(zeros)
    pooled = counts.groupBy("feature", value).agg(F.sum("c").alias("n"))
    ranks = running_sums(pooled, ["feature"], value, ["n"])
    ranked = counts.join(ranks.select("feature", value, (F.col("n_below") + (F.col("n") + 1) / 2.0).alias("_rank")), ["feature", value])
    return ranked.groupBy("cluster", "feature").agg(F.sum(F.col("c") * F.col("_rank")).alias("_r"))


def marker_panel(markers: DataFrame, n_per_cluster: int = 100) -> DataFrame:
    """Ordered union of positive markers: top n by score, then by fold change; first appearance wins."""
    best = W.partitionBy("cluster").orderBy(F.col("score").desc(), F.col("feature"))
    kept = markers.withColumn("_k", F.row_number().over(best)).where(F.col("_k") <= n_per_cluster).where("logfoldchange > 0")
    by_fold = W.partitionBy("cluster").orderBy(F.col("logfoldchange").desc(), F.col("feature"))
    placed = kept.withColumn("marker_rank", F.row_number().over(by_fold))
    first = placed.groupBy("feature").agg(F.min(F.struct("cluster", "marker_rank")).alias("_f"))
    return first.select("feature", F.col("_f.cluster").alias("cluster"), F.col("_f.marker_rank").alias("marker_rank"))


def expressed_genes(expr: DataFrame, cells: DataFrame, min_pct: float, value: str = "lognorm") -> DataFrame:
    """Genes detected in at least ``min_pct`` percent of the given cells."""
    n = cells.agg(F.count(F.lit(1)).alias("_n"))
    seen = expr.where(F.col(value) > 0).join(cells.select("cell_id"), "cell_id", "left_semi").groupBy("feature").agg(F.count(F.lit(1)).alias("n_detected"))
    return seen.crossJoin(F.broadcast(n)).where(100 * F.col("n_detected") / F.col("_n") >= min_pct).drop("_n")


def regulatory_edges(effects: DataFrame) -> DataFrame:
    """Target to target edges: a target whose perturbation moves another target's own gene."""
    names = effects.select(F.col("target").alias("feature")).distinct()
    edges = effects.where("de").join(names, "feature", "left_semi").where(F.col("target") != F.col("feature"))
    return edges.select(F.col("target").alias("source"), F.col("feature").alias("regulated"), "log2fc", F.when(F.col("log2fc") > 0, "positive").otherwise("negative").alias("sign"))
