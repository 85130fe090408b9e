"""Associations between RNA responses and proteins, at the cell and the target level."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.ordering import average_ranks, bh_adjust, hash_rank
from ..functions.session import cut_lineage
from .ranktests import kruskal_wallis, spearman

CELL, TARGET, PAIR, MODULE = "CELL_LEVEL", "TARGET_LEVEL", "TARGET_PAIR_LEVEL", "PHENOTYPE_MODULE_LEVEL"


def support(n: Column, rho: Column, fdr: Column, alpha: float, min_n: int) -> Column:
    """insufficient_support / significant / not_significant."""
    return (F.when((n < min_n) | rho.isNull() | F.isnan(rho), "insufficient_support").when(fdr < alpha, "significant").otherwise("not_significant"))


def score_protein(scores: DataFrame, values: DataFrame, min_cells: int = 20, alpha: float = 0.05, pooled: bool = True) -> DataFrame:
    """Rank correlation of a cell's own-target score with each protein, within target and (descriptive) pooled.

    ``scores(cell_id, target, score)``, ``values(cell_id, protein, value)``.
    """
    rows = scores.select("cell_id", "target", "score").join(values.select("cell_id", "protein", "value"), "cell_id")
    scoped = rows.withColumn("scope", F.lit("within_target"))
    if pooled:
        scoped = scoped.unionByName(rows.withColumn("target", F.lit("*")).withColumn("scope", F.lit("pooled_all_targets")))
    rho = spearman(scoped, ["scope", "target", "protein"], "score", "value", n="n_cells").withColumnRenamed("rho", "spearman_rho")
    within = F.col("scope") == "within_target"
    tested = bh_adjust(rho.withColumn("_p", F.when(within, F.col("p_value"))), "_p", "fdr").drop("_p")
    status = F.when(within, support(F.col("n_cells"), F.col("spearman_rho"), F.col("fdr"), alpha, min_cells)).otherwise("descriptive_pooled")
    return tested.withColumn("status", status).withColumn("analysis_level", F.when(within, CELL).otherwise(f"{CELL}_POOLED_DESCRIPTIVE"))


def target_association(by_target: DataFrame, effects: DataFrame, min_targets: int = 5, alpha: float = 0.05) -> DataFrame:
    """Across targets, per protein: rank correlation of a target quantity with the effect and with its size (two FDR families).

    ``by_target(target, x)``, ``effects(target, protein, effect)``.
    """
    rows = effects.select("target", "protein", "effect").join(by_target.select("target", "x"), "target")
    both = rows.select("protein", F.explode(F.array(F.struct(F.lit("signed").alias("kind"), F.col("effect").alias("y")), F.struct(F.lit("abs").alias("kind"), F.abs("effect").alias("y")))).alias("_k"), "x")
    rho = spearman(both.select("protein", "_k.kind", "_k.y", "x"), ["protein", "kind"], "x", "y", n="n_targets")
    enough = F.col("n_targets") >= min_targets
    rho = rho.withColumn("rho", F.when(enough, F.col("rho"))).withColumn("p_value", F.when(enough, F.col("p_value")))
    rho = bh_adjust(rho, "p_value", "fdr", ["kind"])
    pick = lambda k, c: F.max(F.when(F.col("kind") == k, F.col(c)))
    out = rho.groupBy("protein").agg(F.max("n_targets").alias("n_targets"), *[pick(k, c).alias(f"{n}_{k}") for k in ("signed", "abs") for n, c in (("rho", "rho"), ("p", "p_value"), ("fdr", "fdr"))])
    for k in ("signed", "abs"):
        out = out.withColumn(f"status_{k}", support(F.col("n_targets"), F.col(f"rho_{k}"), F.col(f"fdr_{k}"), alpha, min_targets))
    return out.withColumn("support", F.when(F.col("n_targets") >= 10, "ok").otherwise("few_targets(<10)")).withColumn("analysis_level", F.lit(TARGET))


def program_protein_cells(activity: DataFrame, values: DataFrame, min_cells: int = 20, alpha: float = 0.05) -> DataFrame:
    """Program activity against protein over cells; ``activity(cell_id, program, activity)``."""
    rows = activity.join(values.select("cell_id", "protein", "value"), "cell_id")
    rho = spearman(rows, ["program", "protein"], "activity", "value", n="n_cells").withColumnRenamed("rho", "spearman_rho")
    out = bh_adjust(rho, "p_value", "fdr")
    return out.withColumn("status", support(F.col("n_cells"), F.col("spearman_rho"), F.col("fdr"), alpha, min_cells)).withColumn("analysis_level", F.lit(CELL))


def program_protein_targets(program_effects: DataFrame, effects: DataFrame, min_targets: int = 5, alpha: float = 0.05) -> DataFrame:
    """Program effect against protein effect over targets; ``program_effects(target, program, mean_log2fc)``."""
    rows = program_effects.select("target", "program", "mean_log2fc").join(effects.select("target", "protein", "effect"), "target")
    rho = spearman(rows, ["program", "protein"], "mean_log2fc", "effect", n="n_targets").withColumnRenamed("rho", "spearman_rho")
    enough = F.col("n_targets") >= min_targets
    out = bh_adjust(rho.withColumn("spearman_rho", F.when(enough, F.col("spearman_rho"))).withColumn("p_value", F.when(enough, F.col("p_value"))), "p_value", "fdr")
    return out.withColumn("status", support(F.col("n_targets"), F.col("spearman_rho"), F.col("fdr"), alpha, min_targets)).withColumn("analysis_level", F.lit(TARGET))


# ---- geometry

def profile_distances(effects: DataFrame, per_protein: bool = False) -> DataFrame:
    """Euclidean distance of effect profiles for target pairs a < b; one protein gives |difference|.

    The pairs are the output itself; they are formed per protein by an equi-join
    of target-level rows.
    """
    left = effects.select("protein", F.col("target").alias("target_a"), F.col("effect").alias("_x"))
    right = effects.select("protein", F.col("target").alias("target_b"), F.col("effect").alias("_y"))
    rows = left.join(right, "protein").where(F.col("target_a") < F.col("target_b"))
    keys = ["target_a", "target_b"] + (["protein"] if per_protein else [])
    return rows.groupBy(*keys).agg(F.sqrt(F.sum((F.col("_x") - F.col("_y")) * (F.col("_x") - F.col("_y")))).alias("distance"))


def mantel(first: DataFrame, second: DataFrame, n_permutations: int = 999, seed: int = 0, by: Sequence[str] = ()) -> DataFrame:
    """Rank correlation of two pair tables and its label-permutation p (one row per group ``by`` of the second table).

    Relabelling only rearranges the second table's values, so both tables are
    ranked once; every permutation is a lookup of relabelled pairs and one sum of
    rank products.  Labels are shuffled by hash order of (seed, permutation, target),
    in all groups alike.
    """
    by = list(by)
    both = first.select("target_a", "target_b", F.col("distance").alias("d1")).join(second.select(*by, "target_a", "target_b", F.col("distance").alias("d2")), ["target_a", "target_b"])
    both = cut_lineage(both)
    r1 = average_ranks(both, by, "d1", "r1").select(*by, "d1", "r1")
    r2 = average_ranks(both, by, "d2", "r2").select(*by, "d2", "r2")
    ranked = cut_lineage(both.join(r1, [*by, "d1"]).join(r2, [*by, "d2"]).select(*by, "target_a", "target_b", "r1", "r2"))
    moments = ranked.groupBy(*by).agg(F.count(F.lit(1)).alias("n_pairs"), F.avg("r1").alias("_m1"), F.avg("r2").alias("_m2"), F.stddev_pop("r1").alias("_s1"), F.stddev_pop("r2").alias("_s2"), F.corr("r1", "r2").alias("mantel_rho"))
    names = ranked.select(*by, F.col("target_a").alias("t")).union(ranked.select(*by, "target_b")).distinct()
    numbered = names.withColumn("draw", F.row_number().over(W.partitionBy(*by).orderBy("t")).cast("bigint"))  # one row per target
    draws = names.withColumn("perm", F.explode(F.sequence(F.lit(1), F.lit(max(n_permutations, 1)))))
    digest = F.sha2(F.concat_ws("|", F.lit(str(seed)), F.col("perm").cast("string"), "t"), 256)
    shuffled = hash_rank(draws.withColumn("_h", digest), ["perm", *by], "_h").select(*by, "perm", F.col("t").alias("new"), "draw")
    mapping = numbered.join(shuffled, [*by, "draw"]).select(*by, "perm", F.col("t").alias("old"), "new")
    moved = ranked.select(*by, "target_a", "target_b", "r1").join(mapping.select(*by, "perm", F.col("old").alias("target_a"), F.col("new").alias("_x")), [*by, "target_a"])
    moved = moved.join(mapping.select(*by, "perm", F.col("old").alias("target_b"), F.col("new").alias("_y")), [*by, "perm", "target_b"])
    moved = moved.select(*by, "perm", "r1", F.least("_x", "_y").alias("target_a"), F.greatest("_x", "_y").alias("target_b"))
    sums = moved.join(ranked.select(*by, "target_a", "target_b", "r2"), [*by, "target_a", "target_b"]).groupBy(*by, "perm").agg(F.sum(F.col("r1") * F.col("r2")).alias("_s"))
    rho = (F.col("_s") / F.col("n_pairs") - F.col("_m1") * F.col("_m2")) / (F.col("_s1") * F.col("_s2"))
    joined = sums.join(F.broadcast(moments), by) if by else sums.crossJoin(F.broadcast(moments))  # one row per group
    tested = joined.groupBy(*by, "n_pairs", "mantel_rho").agg(F.count_if(rho >= F.col("mantel_rho") - 1e-12).alias("_ge"), F.count(F.lit(1)).alias("_b"))
    p = (1 + F.col("_ge")) / (1 + F.col("_b")) if n_permutations > 0 else F.lit(None).cast("double")
    return tested.select(*by, "n_pairs", "mantel_rho", p.alias("p_permutation"))


def module_association(effects: DataFrame, modules: DataFrame, min_targets: int = 3, alpha: float = 0.05) -> DataFrame:
    """Kruskal-Wallis of each protein's effect over modules with enough targets."""
    sizes = modules.groupBy("module").agg(F.count(F.lit(1)).alias("_n"))
    usable = sizes.where(F.col("_n") >= min_targets).select("module")
    rows = effects.select("target", "protein", "effect").join(modules, "target").join(usable, "module", "left_semi")
    out = bh_adjust(kruskal_wallis(rows, ["protein"], "module", "effect"), "p_value", "fdr")
    status = F.when(F.col("n_modules_eligible") < 2, "insufficient_support").when(F.col("fdr") < alpha, "significant").otherwise("not_significant")
    return out.withColumnRenamed("n", "n_targets").withColumnRenamed("n_groups", "n_modules_eligible").withColumn("status", status).withColumn("analysis_level", F.lit(MODULE))


def module_means(effects: DataFrame, modules: DataFrame, min_targets: int = 3) -> DataFrame:
    """Mean, median and significant targets per (module, protein); target-level rows only."""
    sizes = modules.groupBy("module").agg(F.count(F.lit(1)).alias("_n"))
    rows = effects.select("target", "protein", "effect", "significant").join(modules, "target").join(sizes, "module")
    return rows.groupBy("module", "protein").agg(F.count(F.lit(1)).alias("n_targets"), (F.max("_n") >= min_targets).alias("eligible"), F.avg("effect").alias("mean_effect"),
                                                 F.median("effect").alias("median_effect"), F.count_if("significant").alias("n_significant"))


def geometry_association(pairs: DataFrame, effects: DataFrame, proteins: list[str], n_permutations: int = 999, seed: int = 0, alpha: float = 0.05) -> DataFrame:
    """Joint and per-protein Mantel tests of the RNA pair distances; FDR over the single proteins."""
    joint = mantel(pairs, profile_distances(effects), n_permutations, seed).withColumn("protein", F.lit("all_proteins"))
    single = profile_distances(effects, per_protein=True)
    joint = joint.unionByName(mantel(pairs, single.where(F.col("protein").isin(proteins)), n_permutations, seed + 1, ["protein"]))
    alone = F.col("protein") != "all_proteins"
    out = bh_adjust(joint.withColumn("_p", F.when(alone, F.col("p_permutation"))), "_p", "fdr").drop("_p")
    return out.withColumn("significant", F.coalesce(F.when(alone, F.col("fdr")).otherwise(F.col("p_permutation")) < alpha, F.lit(False))).withColumn("analysis_level", F.lit(PAIR))


def best_protein_text(table: DataFrame) -> DataFrame:
    """Strongest association of each target as text."""
    kept = table.where(F.col("spearman_rho").isNotNull())
    best = kept.groupBy("target").agg(F.max(F.struct(F.round(F.abs("spearman_rho"), 12).alias("r"), "protein", "spearman_rho", "fdr")).alias("_b"))
    return best.select("target", F.format_string("%s rho=%+.2f fdr=%.2g", "_b.protein", "_b.spearman_rho", "_b.fdr").alias("best"))

