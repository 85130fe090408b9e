"""Per-cell perturbation-response score and its quadrants."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordering import exact_quantiles
from ..functions.scalars import ratio
from ..functions.session import cut_lineage
from .genetests import target_vs_control, top_genes
from .grids import complete
from .knockdown import own_gene_counts, target_genes, target_sizes
from .labels import is_perturbed, is_reference
from .moments import cohen_d
from .ranktests import compare_distributions

QUADRANTS = ("successful_knockdown", "escaper", "non_responder", "low_signal")


def signatures(cells: DataFrame, expr: DataFrame, features: DataFrame, control_classes: Sequence[str], top_n: int = 100, min_cells: int = 10, value: str = "lognorm") -> DataFrame:
    """Response genes per target by signed Welch t, with the slope on the group indicator (the mean difference)."""
    tests = target_vs_control(cells, expr, features, control_classes, min_cells, value=value, with_p=False)
    ranked = top_genes(tests, top_n)
    return ranked.select("target", "feature", "rank", F.col("t").alias("t_score"), (F.col("mean_p") - F.col("mean_c")).alias("beta"), "mean_c")


def projections(cells: DataFrame, expr: DataFrame, signature: DataFrame, control_classes: Sequence[str], value: str = "lognorm") -> DataFrame:
    """(cell_id, target, is_target, proj): projection on the signature, centred on the control cells.

    Centring removes every constant, so a cell only needs the sum of value x slope
    over its stored signature genes.
    """
    sig = signature.select("target", "feature", "beta")
    roles = cells.where(is_perturbed() | is_reference(control_classes)).select("cell_id", F.col("target").alias("own"), is_perturbed().alias("_p"))
    rows = expr.select("cell_id", "feature", value).join(roles, "cell_id").join(sig, "feature").where(~F.col("_p") | (F.col("own") == F.col("target")))
    dots = rows.groupBy("cell_id", "target").agg(F.sum(F.col(value) * F.col("beta")).alias("_dot"))
    scored = sig.select("target").distinct()
    perturbed = roles.where("_p").select("cell_id", F.col("own").alias("target"), F.lit(True).alias("is_target")).join(scored, "target", "left_semi").select("cell_id", "target", "is_target")
    control = complete(roles.where("NOT _p").select("cell_id"), scored, "target").select("cell_id", "target", F.lit(False).alias("is_target"))
    constants = signature.groupBy("target").agg(F.sum(F.col("beta") * F.col("beta")).alias("_bb"), F.sum(F.col("beta") * F.col("mean_c")).alias("_base"))
    out = perturbed.unionByName(control).join(dots, ["cell_id", "target"], "left").join(constants, "target")
    return out.select("cell_id", "target", "is_target", F.coalesce(F.try_divide(F.coalesce("_dot", F.lit(0.0)) - F.col("_base"), F.col("_bb")), F.lit(0.0)).alias("proj"))


def response_scores(projected: DataFrame, scale_factor: float = 3.0) -> DataFrame:
    """``raw`` clipped to [0, scale_factor] and ``score`` divided by the target's maximum."""
    raw = projected.withColumn("raw", F.greatest(F.lit(0.0), F.least(F.lit(float(scale_factor)), F.col("proj"))))
    top = raw.groupBy("target").agg(F.max("raw").alias("_max"))
    return raw.join(top, "target").withColumn("score", F.when(F.col("_max") > 0, F.col("raw") / F.col("_max")).otherwise(F.col("raw"))).drop("_max")


def expression_cut(own_counts: DataFrame, method: str = "mean", quantile: float = 0.75, value: str = "lognorm") -> DataFrame:
    """Cut on the target's own expression in control cells, zeros included."""
    if method == "mean":
        return own_counts.groupBy("target").agg(ratio(F.sum(F.col(value) * F.col("n_control_ntc")), F.sum("n_control_ntc")).alias("cut"))
    if method not in ("median", "quantile"):
        raise ValueError(f"unknown expression cut: {method}")
    return exact_quantiles(own_counts.select("target", value, F.col("n_control_ntc").alias("_w")), ["target"], value, {"cut": 0.5 if method == "median" else quantile}, weight="_w")


def quadrant(score: Column, expression: Column, threshold: Column | float, cut: Column) -> Column:
    high, expressed = score >= threshold, expression > cut
    return (F.when(high & ~expressed, QUADRANTS[0]).when(high, QUADRANTS[1]).when(expressed, QUADRANTS[2]).otherwise(QUADRANTS[3]))


def with_quadrants(scores: DataFrame, expr: DataFrame, cuts: DataFrame, genes: DataFrame, threshold: float = 0.5, value: str = "lognorm") -> DataFrame:
    """Quadrant of every scored (cell, target) from the score and the target gene's expression."""
    own = expr.select("cell_id", "feature", F.col(value).alias("_x")).join(genes.select(F.col("gene").alias("feature"), "target"), "feature").drop("feature")
    out = scores.join(cuts, "target").join(own, ["cell_id", "target"], "left")
    return out.withColumn("quadrant", quadrant(F.col("score"), F.coalesce("_x", F.lit(0.0)), threshold, F.col("cut"))).drop("_x")


def response_summary(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row per target over its perturbed cells, with the same quantities in the control cells."""
    own, high, kd = F.col("is_target"), F.col("score") >= threshold, F.col("quadrant") == QUADRANTS[0]
    n_t, n_c = F.count_if(own), F.count_if(~own)
    pick = lambda cond, x: F.when(cond, x)
    aggs = [n_t.alias("n_perturbed_cells"), n_c.alias("n_control_cells"), F.avg(pick(own, F.col("score"))).alias("mean_ps"), F.stddev_samp(pick(own, F.col("score"))).alias("sd_ps"),
            (100 * ratio(F.count_if(own & high), n_t)).alias("pct_high_ps"), F.avg(pick(~own, F.col("score"))).alias("mean_ps_control"), (100 * ratio(F.count_if(~own & high), n_c)).alias("pct_high_ps_control")]
    for name, q in zip(("pct_successful_kd", "pct_escaper", "pct_non_responder", "pct_low_signal"), QUADRANTS):
        aggs.append((100 * ratio(F.count_if(own & (F.col("quadrant") == q)), n_t)).alias(name))
    aggs.append((100 * ratio(F.count_if(~own & kd), n_c)).alias("pct_controls_called_kd"))
    for tag, cond in (("p", own), ("c", ~own)):
        aggs += [F.avg(pick(cond, F.col("proj"))).alias(f"_m{tag}"), F.var_samp(pick(cond, F.col("proj"))).alias(f"_v{tag}")]
    out = scored.groupBy("target").agg(*aggs).withColumn("net_pct_kd", F.col("pct_successful_kd") - F.col("pct_controls_called_kd"))
    d = cohen_d(F.col("_mp"), F.col("_vp"), F.col("n_perturbed_cells"), F.col("_mc"), F.col("_vc"), F.col("n_control_cells"))
    out = out.withColumn("d_vs_control", d).drop("_mp", "_vp", "_mc", "_vc")
    spread = exact_quantiles(scored.where("is_target").select("target", "score"), ["target"], "score", {"q25_ps": 0.25, "median_ps": 0.5, "q75_ps": 0.75})
    counts = scored.groupBy("target", "proj").agg(F.count_if("is_target").alias("n_a"), F.count_if(~F.col("is_target")).alias("n_b"))
    auc = compare_distributions(counts, ["target"], "proj").select("target", F.col("auc").alias("auc_vs_control"))
    return out.join(spread, "target").join(auc, "target").withColumn("warnings", F.when(F.col("n_perturbed_cells") < 30, "low_support(<30 cells)").otherwise(""))


def response_run(cells: DataFrame, expr: DataFrame, features: DataFrame, control_classes: Sequence[str], top_n: int = 100, scale_factor: float = 3.0, threshold: float = 0.5, cut: str = "mean",
                 min_cells: int = 10, value: str = "lognorm") -> DataFrame:
    """Scored and classified (cell, target) rows for every target whose gene is measured."""
    signature = cut_lineage(signatures(cells, expr, features, control_classes, top_n, min_cells, value))
    scores = response_scores(projections(cells, expr, signature, control_classes, value), scale_factor)
    targets = target_genes(target_sizes(cells, control_classes))
    cuts = expression_cut(own_gene_counts(cells, expr, targets, control_classes, value), cut, value=value)
    return cut_lineage(with_quadrants(scores, expr, cuts, targets, threshold, value))
