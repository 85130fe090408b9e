"""Quality metrics and flags of cells, genes and antibodies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordering import exact_quantiles
from ..functions.scalars import ratio

#: fixed value: scales the median absolute deviation to a standard deviation
MAD_SCALE = 1.4826


def gene_flags(features: DataFrame, mito_prefix: str = "MT-", ribo_prefixes: Sequence[str] = ("RPS", "RPL"), hb_pattern: str = "^HB[^(P)]") -> DataFrame:
    """``mt`` / ``ribo`` / ``hb`` flags from the upper-cased gene name."""
    name = F.upper("feature")
    ribo = F.lit(False)
    for prefix in ribo_prefixes:
        ribo = ribo | name.startswith(prefix.upper())
    return features.withColumn("mt", name.startswith(mito_prefix.upper())).withColumn("ribo", ribo).withColumn("hb", name.rlike(hb_pattern))


def cell_rna_qc(cells: DataFrame, expr: DataFrame, features: DataFrame, value: str = "count", logged: bool = False, provided_total: str | None = None) -> DataFrame:
    """Totals, detected genes and class percentages per cell; zero rows for cells without counts.

    With log-normalised input (``logged``) the shares come from expm1 values, and
    totals from ``provided_total`` when the cells carry one.
    """
    amount = F.expm1(F.col(value)) if logged else F.col(value)
    flags = features.select("feature", "mt", "ribo", "hb")
    parts = expr.withColumn("_x", amount).join(flags, "feature").groupBy("cell_id").agg(
        F.sum("_x").alias("_total"), F.count_if(F.col(value) != 0).alias("n_genes_by_counts"),
        *[F.sum(F.when(F.col(k), F.col("_x")).otherwise(0)).alias(f"_{k}") for k in ("mt", "ribo", "hb")])
    out = cells.join(parts, "cell_id", "left")
    total = F.coalesce("_total", F.lit(0))
    out = out.withColumn("total_counts", F.col(provided_total) if logged and provided_total else total)
    out = out.withColumn("n_genes_by_counts", F.coalesce("n_genes_by_counts", F.lit(0)))
    for k in ("mt", "ribo", "hb"):
        out = out.withColumn(f"pct_counts_{k}", F.coalesce(ratio(F.lit(100) * F.col(f"_{k}"), F.col("_total")), F.lit(0.0)))
    return out.drop("_total", "_mt", "_ribo", "_hb")


def gene_qc(expr: DataFrame, n_cells: DataFrame, value: str = "count") -> DataFrame:
    """Detection, total and mean (zeros included) per gene; ``n_cells(n_cells)`` is one row."""
    stats = expr.groupBy("feature").agg(F.count_if(F.col(value) != 0).alias("n_cells_by_counts"), F.sum(value).alias("total_counts"))
    return stats.crossJoin(F.broadcast(n_cells)).withColumn("mean_counts", ratio(F.col("total_counts"), F.col("n_cells"))).drop("n_cells")


def mad_limits(cells: DataFrame, column: str, n_mads: float) -> DataFrame:
    """One row (median, mad, low, high) of log1p values."""
    logged = cells.where(F.col(column).isNotNull()).select(F.log1p(F.col(column).cast("double")).alias("_v"))
    median = exact_quantiles(logged, [], "_v", {"median": 0.5})
    spread = logged.crossJoin(F.broadcast(median)).select(F.abs(F.col("_v") - F.col("median")).alias("_d"))
    mad = exact_quantiles(spread, [], "_d", {"_mad": 0.5}).select((F.col("_mad") * MAD_SCALE).alias("mad"))
    both = median.crossJoin(mad)
    return both.select("median", "mad", (F.col("median") - n_mads * F.col("mad")).alias("low"), (F.col("median") + n_mads * F.col("mad")).alias("high"))


def mad_outliers(cells: DataFrame, column: str, n_mads: float, low: str, high: str) -> DataFrame:
    """Flags of values outside median +- n MADs on the log1p scale; a missing value is never flagged."""
    limits = mad_limits(cells, column, n_mads).select(F.col("low").alias("_lo"), F.col("high").alias("_hi"))
    v = F.log1p(F.col(column).cast("double"))
    out = cells.crossJoin(F.broadcast(limits))  # one row of limits
    return out.withColumn(low, F.coalesce(v < F.col("_lo"), F.lit(False))).withColumn(high, F.coalesce(v > F.col("_hi"), F.lit(False))).drop("_lo", "_hi")


def rna_flags(cells: DataFrame, min_genes: float | None, max_pct_mt: float | None, min_counts: float | None = None) -> DataFrame:
    """Threshold flags and their union; haemoglobin does not enter the union."""
    never = F.lit(False)
    out = cells.withColumn("rna_low_genes", F.col("n_genes_by_counts") < min_genes if min_genes is not None else never)
    out = out.withColumn("rna_high_mt", F.col("pct_counts_mt") >= max_pct_mt if max_pct_mt is not None else never)
    fail = F.col("rna_low_genes") | F.col("rna_high_mt")
    if min_counts is not None:
        out = out.withColumn("rna_low_counts", F.col("total_counts") < min_counts)
        fail = fail | F.col("rna_low_counts")
    return out.withColumn("rna_qc_fail", fail)


def cell_protein_qc(cells: DataFrame, counts: DataFrame, panel: DataFrame) -> DataFrame:
    """Antibody totals, detections and isotype share per cell; NULL for cells without antibody counts."""
    joined = counts.join(panel.select("protein", "is_isotype"), "protein")
    target = ~F.col("is_isotype")
    per_cell = joined.groupBy("cell_id").agg(
        F.sum("count").alias("protein_total_counts"),
        F.sum(F.when(target, F.col("count")).otherwise(0)).alias("protein_total_counts_targeting"),
        F.sum(F.when(F.col("is_isotype"), F.col("count")).otherwise(0)).alias("protein_isotype_counts"),
        F.count_if(target & (F.col("count") > 0)).alias("protein_n_detected"))
    out = cells.join(per_cell, "cell_id", "left").withColumn("has_protein_counts", F.col("protein_total_counts").isNotNull())
    return out.withColumn("protein_pct_isotype", ratio(F.lit(100) * F.col("protein_isotype_counts"), F.col("protein_total_counts")))


def extreme_counts(cells: DataFrame, column: str = "protein_total_counts", fold: float = 10.0, out: str = "protein_extreme_counts") -> DataFrame:
    """Flag totals above ``fold`` times the interpolated 99th percentile."""
    q99 = exact_quantiles(cells.select(F.col(column).cast("double").alias("_v")), [], "_v", {"_q99": 0.99})
    flagged = cells.crossJoin(F.broadcast(q99))
    return flagged.withColumn(out, F.coalesce(F.col(column) > fold * F.col("_q99"), F.lit(False))).drop("_q99")


def protein_flags(cells: DataFrame, min_total: float | None = None, min_detected: float | None = None, max_pct_isotype: float | None = None, remove_extreme: bool = False) -> DataFrame:
    """Each threshold is optional; missing values do not fail."""
    fail: Column = F.lit(False)
    if min_total is not None:
        fail = fail | F.coalesce(F.col("protein_total_counts") < min_total, F.lit(False))
    if min_detected is not None:
        fail = fail | F.coalesce(F.col("protein_n_detected") < min_detected, F.lit(False))
    out = cells
    if max_pct_isotype is not None:
        out = out.withColumn("protein_high_isotype", F.coalesce(F.col("protein_pct_isotype") > max_pct_isotype, F.lit(False)))
        fail = fail | F.col("protein_high_isotype")
    if remove_extreme:
        fail = fail | F.col("protein_extreme_counts")
    return out.withColumn("protein_qc_fail", fail)


def antibody_table(counts: DataFrame, panel: DataFrame, n_cells: DataFrame, value: str = "count", prefix: str = "counts") -> DataFrame:
    """Mean, median, 90th percentile, maximum and zero share per antibody, zeros included.

    ``counts`` holds non-zero rows; ``n_cells(n_cells)`` is the number of cells
    with antibody counts, so the zeros enter as one weighted value.
    """
    stats = counts.where(F.col(value) != 0).groupBy("protein").agg(F.sum(value).alias("_s"), F.count(F.lit(1)).alias("_nz"), F.max(value).alias("_max"))
    base = panel.join(stats, "protein", "left").crossJoin(F.broadcast(n_cells)).na.fill(0, ["_s", "_nz"])
    stored = counts.where(F.col(value) != 0).select("protein", F.col(value).cast("double").alias("_v"), F.lit(1).cast("bigint").alias("_w"))
    zeros = base.select("protein", F.lit(0.0).alias("_v"), (F.col("n_cells") - F.col("_nz")).alias("_w"))
    quantiles = exact_quantiles(stored.unionByName(zeros), ["protein"], "_v", {f"{prefix}_median": 0.5, f"{prefix}_q90": 0.9}, weight="_w")
    out = base.join(quantiles, "protein", "left")
    return (out.withColumn(f"{prefix}_mean", ratio(F.col("_s"), F.col("n_cells")))
            .withColumn(f"{prefix}_max", F.when(F.col("_nz") == F.col("n_cells"), F.col("_max")).otherwise(F.greatest("_max", F.lit(0))).cast("double"))
            .withColumn(f"{prefix}_zero_frac", ratio(F.col("n_cells") - F.col("_nz"), F.col("n_cells")))
            .withColumnRenamed("n_cells", "n_cells_with_counts").drop("_s", "_nz", "_max"))


def above_isotype(counts: DataFrame, panel: DataFrame, cells: DataFrame, isotype_map: Mapping[str, str], min_fraction: float = 0.5) -> DataFrame:
    """Share of cells in which an antibody exceeds its control (the mapped one, else the highest).

    Controls are folded to one row per cell, so no pair of antibodies is formed;
    cells without a stored count carry an implicit zero and can never exceed it.
    """
    names = sorted(set(isotype_map.values()))
    joined = counts.join(panel.select("protein", "is_isotype"), "protein")
    controls = joined.where("is_isotype").groupBy("cell_id").agg(
        F.max("count").alias("_top"), *[F.max(F.when(F.col("protein") == n, F.col("count"))).alias(f"_iso_{i}") for i, n in enumerate(names)])
    matched = F.lit(None).cast("bigint")
    has_map = F.lit(False)
    for antibody, control in isotype_map.items():
        hit = F.col("protein") == antibody
        matched = F.when(hit, F.coalesce(F.col(f"_iso_{names.index(control)}"), F.lit(0))).otherwise(matched)
        has_map = has_map | hit
    level = F.when(has_map, F.coalesce(matched, F.lit(0))).otherwise(F.coalesce("_top", F.lit(0)))
    tests = joined.where(~F.col("is_isotype")).join(controls, "cell_id", "left")
    above = tests.groupBy("protein").agg(F.count_if(F.col("count") > level).alias("_above"))
    out = panel.where(~F.col("is_isotype")).select("protein").join(above, "protein", "left").crossJoin(F.broadcast(cells))
    out = out.withColumn("frac_cells_above_isotype", ratio(F.coalesce("_above", F.lit(0)), F.col("n_cells")))
    return out.withColumn("background_dominated", F.col("frac_cells_above_isotype") < min_fraction).drop("_above", "n_cells")


def qc_summary(cells: DataFrame, group: str | None, metrics: Mapping[str, str], max_levels: int | None = None) -> DataFrame:
    """Medians per level of ``group`` plus an ALL row, rounded to two decimals.

    A level may hold most of the cells, so each median is the exact distributed
    quantile; metrics are stacked to share one pass.  With ``max_levels`` a
    grouping of more levels gives its ALL row only.
    """
    stacked = F.explode(F.array(*[F.struct(F.lit(out).alias("metric"), F.col(src).cast("double").alias("v")) for src, out in metrics.items()]))
    level = F.col(group).cast("string") if group else F.lit("ALL")
    both = F.explode(F.array_distinct(F.array(level, F.lit("ALL"))))
    long = cells.select(both.alias("group"), stacked.alias("_m")).select("group", "_m.metric", "_m.v")
    medians = exact_quantiles(long, ["group", "metric"], "v", {"median": 0.5})
    wide = medians.groupBy("group").agg(*[F.round(F.max(F.when(F.col("metric") == out, F.col("median"))), 2).alias(out) for out in metrics.values()])
    sizes = cells.select(both.alias("group")).groupBy("group").agg(F.count(F.lit(1)).alias("n_cells"))
    out = sizes.join(wide, "group", "left")
    if not group or max_levels is None:
        return out
    levels = sizes.where("group <> 'ALL'").agg(F.count(F.lit(1)).alias("_levels"))
    return out.crossJoin(F.broadcast(levels)).where((F.col("group") == "ALL") | (F.col("_levels") <= max_levels)).drop("_levels")
