"""Perturbation effects on every measured protein."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ordering import bh_adjust, exact_quantiles, running_sums
from ..functions.scalars import ratio
from ..functions.tails import rank_sum_two_sided
from .labels import is_perturbed, is_reference
from .moments import cohen_d


def protein_rows(cells: DataFrame, values: DataFrame, control_classes: Sequence[str], min_cells: int = 10) -> DataFrame:
    """Protein values of perturbed and control cells; targets with too few measured cells are left out."""
    extra = [c for c in ("sample", "guide") if c in cells.columns]
    roles = cells.where(is_perturbed() | is_reference(control_classes)).select("cell_id", F.when(is_perturbed(), F.col("target")).alias("target"), *extra)
    rows = values.where(F.col("value").isNotNull()).select("cell_id", "protein", "value").join(roles, "cell_id")
    enough = rows.where("target IS NOT NULL").groupBy("target").agg(F.countDistinct("cell_id").alias("_n")).where(F.col("_n") >= min_cells)
    return rows.join(enough.select("target"), "target", "left_semi").unionByName(rows.where("target IS NULL"))


def rank_sums(rows: DataFrame) -> DataFrame:
    """U of every (target, protein) against the shared controls, with the tie term.

    Controls are ranked once per protein; an own value only looks up how many
    controls lie below and beside it, so the controls are never copied per target.
    """
    own = F.col("target").isNotNull()
    ladder = rows.groupBy("protein", "value").agg(F.count_if(~own).alias("c"))
    steps = running_sums(ladder, ["protein"], "value", ["c"])
    mine = rows.where(own).groupBy("target", "protein", "value").agg(F.count(F.lit(1)).alias("o"))
    looked = mine.join(steps, ["protein", "value"])
    cube = lambda x: x * x * x - x
    c, o = F.col("c").cast("double"), F.col("o").cast("double")
    base = steps.groupBy("protein").agg(F.sum(cube(c)).alias("_base"))
    out = looked.groupBy("target", "protein").agg(F.sum(o * (F.col("c_below") + c / 2)).alias("u"), F.sum("o").alias("n_first"), F.max("c_total").alias("n_second"), F.sum(cube(c + o) - cube(c)).alias("_add"))
    return out.join(base, "protein").withColumn("ties", F.col("_base") + F.col("_add")).drop("_base", "_add")


def effect_sizes(rows: DataFrame) -> DataFrame:
    """Means, difference, pooled-sd difference and medians per (target, protein)."""
    own = rows.where("target IS NOT NULL")
    control = rows.where("target IS NULL")
    stats = [F.count(F.lit(1)).alias("n"), F.avg("value").alias("m"), F.var_samp("value").alias("v")]
    p = own.groupBy("target", "protein").agg(*stats)
    c = control.groupBy("protein").agg(*stats)
    out = p.join(c.select("protein", *[F.col(x).alias(f"{x}_c") for x in ("n", "m", "v")]), "protein")
    out = out.select("target", "protein", F.col("n").alias("n_perturbed"), F.col("n_c").alias("n_control"), F.col("m").alias("mean_perturbed"), F.col("m_c").alias("mean_control"),
                     (F.col("m") - F.col("m_c")).alias("effect"), cohen_d(F.col("m"), F.col("v"), F.col("n"), F.col("m_c"), F.col("v_c"), F.col("n_c")).alias("cohen_d"))
    med_p = exact_quantiles(own, ["target", "protein"], "value", {"median_perturbed": 0.5})
    med_c = exact_quantiles(control, ["protein"], "value", {"median_control": 0.5})
    return out.join(med_p, ["target", "protein"]).join(med_c, "protein")


def sign_consistency(rows: DataFrame, effects: DataFrame, min_cells: int = 5) -> DataFrame:
    """Samples and guides that agree with the sign of the overall effect."""
    out = effects.select("target", "protein", "effect", "mean_control")
    if "sample" in rows.columns:
        per = rows.groupBy("protein", "sample", "target").agg(F.avg("value").alias("m"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_cells)
        ctrl = per.where("target IS NULL").select("protein", "sample", F.col("m").alias("mc"))
        signs = per.where("target IS NOT NULL").join(ctrl, ["protein", "sample"]).join(effects.select("target", "protein", "effect"), ["target", "protein"])
        same = F.signum(F.col("m") - F.col("mc")) == F.signum("effect")
        out = out.join(signs.groupBy("target", "protein").agg(F.count(F.lit(1)).alias("n_samples_tested"), F.count_if(same).alias("n_samples_same_sign")), ["target", "protein"], "left")
        out = out.na.fill(0, ["n_samples_tested", "n_samples_same_sign"]).withColumn("single_sample_support", F.col("n_samples_tested") <= 1)
    if "guide" in rows.columns:
        per = rows.where("target IS NOT NULL").groupBy("target", "protein", "guide").agg(F.avg("value").alias("m"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_cells)
        signs = per.join(effects.select("target", "protein", "effect", "mean_control"), ["target", "protein"])
        same = F.signum(F.col("m") - F.col("mean_control")) == F.signum("effect")
        out = out.join(signs.groupBy("target", "protein").agg(F.count(F.lit(1)).alias("n_guides_tested"), F.count_if(same).alias("n_guides_same_sign")), ["target", "protein"], "left")
        out = out.na.fill(0, ["n_guides_tested", "n_guides_same_sign"])
    return out.drop("effect", "mean_control")


def protein_effects(cells: DataFrame, values: DataFrame, control_classes: Sequence[str], min_cells: int = 10, alpha: float = 0.05) -> DataFrame:
    """Every (target, protein): effect, standardised effect, two-sided rank-sum p, FDR over all tests, consistency counts."""
    rows = protein_rows(cells, values, control_classes, min_cells)
    sizes = effect_sizes(rows)
    tests = rank_sums(rows).withColumn("p_value", rank_sum_two_sided(F.col("n_first"), F.col("n_second"), F.col("u"), F.col("ties"))).drop("n_first", "n_second", "ties")
    out = bh_adjust(sizes.join(tests, ["target", "protein"]), "p_value", "fdr")
    out = out.join(sign_consistency(rows, sizes), ["target", "protein"], "left")
    return out.withColumn("significant", F.coalesce(F.col("fdr") < alpha, F.lit(False))).withColumn("status", F.when(F.col("n_perturbed") < 30, "low_support(<30 cells)").otherwise("ok"))


def level_panel(rows: DataFrame, level: str, min_cells: int = 5) -> DataFrame:
    """Perturbed minus control mean inside every level with enough cells of both."""
    per = rows.groupBy("protein", level, "target").agg(F.avg("value").alias("m"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_cells)
    ctrl = per.where("target IS NULL").select("protein", level, F.col("m").alias("mc"))
    return per.where("target IS NOT NULL").join(ctrl, ["protein", level]).select("target", "protein", level, (F.col("m") - F.col("mc")).alias("difference"))


def strongest_protein(effects: DataFrame) -> DataFrame:
    """Protein with the largest |standardised effect| per target, and the number of significant ones."""
    best = effects.groupBy("target").agg(F.max(F.struct(F.round(F.abs("cohen_d"), 12).alias("d"), "protein", "effect", "fdr")).alias("_b"), F.count_if("significant").alias("n_proteins_significant"))
    return best.select("target", F.col("_b.protein").alias("strongest_protein"), F.col("_b.effect").alias("strongest_protein_effect"), F.col("_b.fdr").alias("strongest_protein_fdr"), "n_proteins_significant")


def fraction_significant(effects: DataFrame) -> DataFrame:
    return effects.groupBy("protein").agg(ratio(F.count_if("significant"), F.count(F.lit(1))).alias("fraction_significant"))
