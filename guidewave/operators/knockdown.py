"""Perturbation strength: the target's own gene in perturbed and control cells."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.ordering import bh_adjust_columns, running_sums
from ..functions.scalars import log2_ratio, ratio, significant3
from ..functions.session import cut_lineage
from . import ranktests as R
from .labels import is_perturbed, is_reference
from .ranktests import with_zero_block

#: fixed value: added to both de-logged means
PSEUDOCOUNT = 0.01
ARMS = ("ntc", "other")


def target_sizes(cells: DataFrame, control_classes: Sequence[str]) -> DataFrame:
    """target, n_perturbed, n_control_ntc, n_control_other (pool minus own cells)."""
    own = cells.where(is_perturbed()).groupBy("target").agg(F.count(F.lit(1)).alias("n_perturbed"))
    pool = cells.agg(F.count_if(is_reference(control_classes)).alias("n_control_ntc"), F.count_if(is_perturbed()).alias("_pool"))
    return own.crossJoin(F.broadcast(pool)).withColumn("n_control_other", F.col("_pool") - F.col("n_perturbed")).drop("_pool")


def target_genes(sizes: DataFrame, gene_map: Mapping[str, str] | None = None) -> DataFrame:
    gene = F.col("target")
    if gene_map:
        gene = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in gene_map.items() for x in kv]), gene), gene)
    return sizes.withColumn("gene", gene)


def own_gene_counts(cells: DataFrame, expr: DataFrame, targets: DataFrame, control_classes: Sequence[str], value: str = "lognorm") -> DataFrame:
    """Value counts of every target's own gene: perturbed, control and other-target cells, zeros included.

    Only rows of target genes survive the first join, and they are collapsed to
    (target, value) before anything else happens.
    """
    tested = targets.select(F.col("target").alias("tested"), F.col("gene").alias("feature"))
    roles = cells.where(is_perturbed() | is_reference(control_classes)).select("cell_id", F.col("target").alias("_own"), is_perturbed().alias("_p"))
    rows = expr.select("cell_id", "feature", value).join(tested, "feature").join(roles, "cell_id")
    own = F.col("_p") & (F.col("_own") == F.col("tested"))
    counts = rows.groupBy(F.col("tested").alias("target"), value).agg(
        F.count_if(own).alias("n_perturbed"), F.count_if(~F.col("_p")).alias("n_control_ntc"), F.count_if(F.col("_p") & ~own).alias("n_control_other"))
    return with_zero_block(counts, targets, ["target"], value, ["n_perturbed", "n_control_ntc", "n_control_other"])


def knockdown_effect(counts: DataFrame, value: str = "lognorm") -> DataFrame:
    """Means, log2 fold change, % knockdown and % expressing per target in both arms."""
    v = F.col(value)
    aggs = []
    for g in ("n_perturbed", "n_control_ntc", "n_control_other"):
        n = F.col(g)
        aggs += [F.sum(n).alias(g), F.sum(n * v).alias(f"_s_{g}"), F.sum(n * F.expm1(v)).alias(f"_e_{g}"), F.sum(F.when(v > 0, n).otherwise(0)).alias(f"_x_{g}")]
    out = counts.groupBy("target").agg(*aggs)
    for g in ("n_perturbed", "n_control_ntc", "n_control_other"):
        for tag in ("s", "e", "x"):
            out = out.withColumn(f"_{tag}_{g}", ratio(F.col(f"_{tag}_{g}"), F.col(g)))
    for arm in ARMS:
        c = f"n_control_{arm}"
        out = (out.withColumn(f"mean_lognorm_perturbed_{arm}", F.col("_s_n_perturbed")).withColumn(f"mean_lognorm_control_{arm}", F.col(f"_s_{c}"))
               .withColumn(f"log2fc_{arm}", log2_ratio(F.col("_e_n_perturbed"), F.col(f"_e_{c}"), PSEUDOCOUNT))
               .withColumn(f"pct_knockdown_{arm}", 100 * (1 - (F.col("_e_n_perturbed") + PSEUDOCOUNT) / (F.col(f"_e_{c}") + PSEUDOCOUNT)))
               .withColumn(f"pct_cells_expressing_perturbed_{arm}", 100 * F.col("_x_n_perturbed")).withColumn(f"pct_cells_expressing_control_{arm}", 100 * F.col(f"_x_{c}")))
    return out.drop(*[c for c in out.columns if c.startswith("_")])


def rank_statistics(counts: DataFrame, value: str = "lognorm") -> DataFrame:
    """KS distance and rank-sum statistics of both arms from one ordered pass over the value counts."""
    runs = running_sums(counts, ["target"], value, ["n_perturbed", "n_control_ntc", "n_control_other"])
    aggs = [a for arm in ARMS for a in R._pair_aggregates("n_perturbed", f"n_control_{arm}", f"_{arm}")]
    out = runs.groupBy("target").agg(*aggs)
    for arm in ARMS:
        out = R._finish_pair(out, f"_{arm}")
    return out


def eligibility(targets: DataFrame, effect: DataFrame, features: DataFrame, primary: str = "ntc", min_cells: int = 10, min_pct_expressing: float = 1.0) -> DataFrame:
    """Every target with its skip reason (NULL when testable): gene absent, too few cells, silent in controls."""
    measured = features.select(F.col("feature").alias("gene")).distinct().withColumn("_measured", F.lit(True))
    out = targets.join(measured, "gene", "left").join(effect.select("target", F.col(f"pct_cells_expressing_control_{primary}").alias("_pct")), "target", "left")
    pct = F.coalesce("_pct", F.lit(0.0))
    reason = (F.when(F.col("_measured").isNull(), "target gene not present in the expression matrix")
              .when(F.col("n_perturbed") < min_cells, f"fewer than {min_cells} perturbed cells")
              .when(pct < min_pct_expressing, F.format_string(f"not detectably expressed in control cells (%.2f%% of control cells, threshold {min_pct_expressing}%%)", pct)))
    return out.select("target", "gene", "n_perturbed", "n_control_ntc", "n_control_other", reason.alias("reason"))


def perturbation_strength(cells: DataFrame, expr: DataFrame, features: DataFrame, control_classes: Sequence[str], gene_map: Mapping[str, str] | None = None, primary: str = "ntc",
                          min_cells: int = 10, min_control: int = 10, min_pct_expressing: float = 1.0, alpha: float = 0.05, max_log2fc: float = 0.0, value: str = "lognorm") -> DataFrame:
    """One row per testable target: effects, KS and rank-sum tests with FDR per arm, hit call and rank."""
    targets = target_genes(target_sizes(cells, control_classes), gene_map)
    counts = cut_lineage(own_gene_counts(cells, expr, targets, control_classes, value))
    effect = knockdown_effect(counts, value)
    tested = eligibility(targets, effect, features, primary, min_cells, min_pct_expressing).where(F.col("reason").isNull()).select("target", "gene")
    table = tested.join(effect, "target").join(rank_statistics(counts, value), "target")
    # one row per target, but exact KS tails are the costly part: spread them over all cores
    table = table.repartition(max(1, table.sparkSession.sparkContext.defaultParallelism), "target")
    names = ["mean_lognorm_perturbed", "mean_lognorm_control", "log2fc", "pct_knockdown", "pct_cells_expressing_perturbed", "pct_cells_expressing_control", "ks_stat"]
    for arm in ARMS:
        enough = F.col(f"n_control_{arm}") >= min_control
        table = R.with_ks_p(table, f"ks_pval_{arm}", f"_{arm}")
        table = R.with_rank_sum_p(table, f"mwu_pval_less_{arm}", "less", f"_{arm}")
        for n in [*names, "ks_pval", "mwu_pval_less"]:
            table = table.withColumn(f"{n}_{arm}", F.when(enough, F.col(f"{n}_{arm}")))
    drop = [f"{c}_{arm}" for arm in ARMS for c in ("n_first", "n_second", "u", "ties", "auc")]
    table = table.drop(*drop)
    families = {f"{test}_{arm}": f"{fdr}_{arm}" for arm in ARMS for test, fdr in (("ks_pval", "ks_fdr"), ("mwu_pval_less", "mwu_fdr"))}
    table = bh_adjust_columns(table, ["target"], families)
    for arm in ARMS:
        table = table.withColumn(f"is_hit_{arm}", F.coalesce((F.col(f"ks_fdr_{arm}") < alpha) & (F.col(f"log2fc_{arm}") < max_log2fc), F.lit(False)))
    return rank_targets(table, f"is_hit_{primary}", f"log2fc_{primary}")


def rank_targets(table: DataFrame, hit: str, effect: str) -> DataFrame:
    """Hits first, strongest decrease first; one row per target, so the ordered window is library-sized."""
    order = W.orderBy(F.col(hit).desc(), F.col(effect).asc_nulls_last(), F.col("target"))
    return table.withColumn("rank", F.row_number().over(order))


def display_table(table: DataFrame, primary: str = "ntc") -> DataFrame:
    """Reader-friendly columns with three significant digits."""
    return table.select(
        F.col("rank").alias("Rank"), F.col("target").alias("Target"), F.col("n_perturbed").alias("Perturbed cells"), F.col(f"n_control_{primary}").alias("Control cells"),
        significant3(F.col(f"log2fc_{primary}")).alias("log2FC"), significant3(F.col(f"pct_knockdown_{primary}")).alias("% knockdown"))
