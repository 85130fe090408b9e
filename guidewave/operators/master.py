"""One table per perturbation target, and one per target and protein."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: fixed values: column order of the master table
LEADING = ["target", "n_cells", "target_log2fc", "target_pct_kd", "target_fdr", "is_effective_hit", "ps_mean", "ps_median", "ps_responder_fraction", "ps_net_responder_fraction", "ps_escaper_fraction",
           "lochness_mean", "lochness_median", "lochness_peak", "lochness_pct_enriched", "energy_distance", "mmd_distance", "distance_pvalue", "distance_fdr", "distance_significant", "cofunctional_module", "phenotype_module"]


# fixed values: the four dictionaries below give the output names of each part's columns

def strength_columns(table: DataFrame, primary: str = "ntc") -> DataFrame:
    names = {"n_perturbed": "n_cells", f"log2fc_{primary}": "target_log2fc", f"pct_knockdown_{primary}": "target_pct_kd", f"ks_fdr_{primary}": "target_fdr", f"is_hit_{primary}": "is_effective_hit"}
    return table.select("target", *[F.col(c).alias(n) for c, n in names.items() if c in table.columns])


def response_columns(table: DataFrame) -> DataFrame:
    names = {"n_perturbed_cells": "n_cells", "mean_ps": "ps_mean", "median_ps": "ps_median", "pct_successful_kd": "ps_responder_fraction", "net_pct_kd": "ps_net_responder_fraction", "pct_escaper": "ps_escaper_fraction"}
    return table.select("target", *[F.col(c).alias(n) for c, n in names.items() if c in table.columns])


def neighborhood_columns(table: DataFrame) -> DataFrame:
    names = {"n_cells": "n_cells", "mean_in_own_cells": "lochness_mean", "median_in_own_cells": "lochness_median", "max_score": "lochness_peak", "pct_own_cells_enriched": "lochness_pct_enriched"}
    return table.select("target", *[F.col(c).alias(n) for c, n in names.items() if c in table.columns])


def distance_columns(table: DataFrame) -> DataFrame:
    names = {"n_cells": "n_cells", "energy_distance": "energy_distance", "mmd_distance": "mmd_distance", "p_value": "distance_pvalue", "fdr": "distance_fdr", "significant": "distance_significant"}
    return table.where(F.col("reason").isNull()).select("target", *[F.col(c).alias(n) for c, n in names.items() if c in table.columns])


def combine_targets(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Full outer combination on ``target``; a column met in several tables keeps the first value present.

    All inputs have one row per target.
    """
    keys = reduce(DataFrame.union, [t.select("target") for t in tables.values()]).where("target IS NOT NULL").distinct()
    out = keys
    for table in tables.values():
        shared = [c for c in table.columns if c != "target" and c in out.columns]
        out = out.join(table.select("target", *[F.col(c).alias(f"_new_{c}" if c in shared else c) for c in table.columns if c != "target"]), "target", "left")
        for c in shared:
            out = out.withColumn(c, F.coalesce(c, f"_new_{c}")).drop(f"_new_{c}")
    return out


def master_table(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Leading columns in their fixed order, extensions after; most distant target first, missing last."""
    out = combine_targets(tables)
    lead = [c for c in LEADING if c in out.columns]
    out = out.select(*lead, *[c for c in out.columns if c not in lead])
    if "energy_distance" in out.columns:
        return out.orderBy(F.col("energy_distance").desc_nulls_last(), "target")
    return out.orderBy("target")


def protein_table(effects: DataFrame, master: DataFrame, cell_level: Mapping[str, DataFrame] | None = None, per_protein: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Target x protein rows with cell-level associations, the target's master columns and repeated per-protein summaries.

    Every added block names the level its statistics belong to.
    """
    out = effects.select("target", "protein", "n_perturbed", "n_control", F.col("effect").alias("protein_effect"), F.col("cohen_d").alias("protein_cohen_d"), F.col("p_value").alias("protein_p_value"),
                         F.col("fdr").alias("protein_fdr"), F.col("significant").alias("protein_significant"), *[c for c in ("n_samples_tested", "n_samples_same_sign", "n_guides_tested", "n_guides_same_sign") if c in effects.columns])
    out = out.withColumn("protein_effect_level", F.lit("TARGET_LEVEL"))
    for prefix, table in (cell_level or {}).items():
        kept = table.where("scope = 'within_target'") if "scope" in table.columns else table
        kept = kept.select("target", "protein", F.col("n_cells").alias(f"{prefix}_n_cells"), F.col("spearman_rho").alias(f"{prefix}_rho"), F.col("p_value").alias(f"{prefix}_p"), F.col("fdr").alias(f"{prefix}_fdr"), F.col("status").alias(f"{prefix}_status"))
        out = out.join(kept, ["target", "protein"], "left").withColumn(f"{prefix}_level", F.lit("CELL_LEVEL"))
    have = [c for c in master.columns if c not in out.columns and not c.startswith("protein_")]
    out = out.join(master.select("target", *have), "target", "left").withColumn("target_columns_level", F.lit("TARGET_LEVEL"))
    for prefix, table in (per_protein or {}).items():
        out = out.join(table.select("protein", *[F.col(c).alias(f"{prefix}_{c}") for c in table.columns if c not in ("protein", "analysis_level")], F.col("analysis_level").alias(f"{prefix}_level")), "protein", "left")
    return out


def compare_local_enrichment(table: DataFrame, local: DataFrame) -> DataFrame:
    """Strongest enriched and depleted cluster of each target beside its neighbourhood summary."""
    from .enrichment import best_pairs

    base = table.where("is_primary").groupBy("target").agg(F.max("n_target").alias("n_cells"), F.count_if("significant").alias("n_clusters_significant"))
    for direction in ("enriched", "depleted"):
        best = best_pairs(table, direction).select("target", F.col("cluster").alias(f"top_{direction}_cluster"), F.col("log2_odds_ratio").alias(f"top_{direction}_log2_or"), F.col("fdr").alias(f"top_{direction}_fdr"))
        base = base.join(best, "target", "left")
    return base.join(local.select("target", F.col("mean_in_own_cells").alias("lochness_own_mean"), F.col("delta_own_vs_control").alias("lochness_delta_own_vs_control")), "target", "left")
