"""Audit summaries and the tables behind plots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.ordering import exact_quantiles, running_sums, value_counts
from ..functions.scalars import ratio
from .grids import complete


def guide_statistics(lists: DataFrame, library: DataFrame) -> DataFrame:
    """(statistic, key, n): cells per guide number, per guide and per target."""
    per_cell = lists.select("cell_id", F.size("guides").alias("n")).groupBy(F.col("n").cast("string").alias("key")).agg(F.count(F.lit(1)).alias("n_cells")).withColumn("statistic", F.lit("guides_per_cell"))
    members = lists.select("cell_id", F.explode("guides").alias("guide")).join(library.select("guide", "target"), "guide", "left")
    guides = members.groupBy(F.col("guide").alias("key")).agg(F.count(F.lit(1)).alias("n_cells")).withColumn("statistic", F.lit("cells_per_guide"))
    targets = members.select("cell_id", "target").distinct().groupBy(F.col("target").alias("key")).agg(F.count(F.lit(1)).alias("n_cells")).withColumn("statistic", F.lit("cells_per_target"))
    return per_cell.unionByName(guides).unionByName(targets).select("statistic", "key", "n_cells")


def _stack(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in columns])).alias("_r")).select("_r.column", "_r.v")


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct and empty values, numeric share and range of every metadata column, from one pre-aggregated stack."""
    counts = _stack(df, columns).groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
    number = F.expr("try_cast(v AS DOUBLE)")
    filled = F.col("v").isNotNull() & (F.col("v") != "")
    out = counts.groupBy("column").agg(
        F.sum("n").alias("n_rows"), F.count_if(filled).alias("n_unique"), F.sum(F.when(filled, 0).otherwise(F.col("n"))).alias("n_empty"),
        F.sum(F.when(filled & number.isNotNull(), F.col("n")).otherwise(0)).alias("_num"), F.min(F.when(filled, number)).alias("_min"), F.max(F.when(filled, number)).alias("_max"),
        (F.sum(F.when(filled, number * F.col("n"))) / F.sum(F.when(filled & number.isNotNull(), F.col("n")))).alias("_mean"))
    numeric = ratio(F.col("_num"), F.col("n_rows") - F.col("n_empty")) > 0.9
    out = out.withColumn("is_numeric", F.coalesce(numeric, F.lit(False)))
    return out.select("column", "n_rows", "n_unique", "n_empty", "is_numeric", *[F.when(F.col("is_numeric"), F.col(f"_{c}")).alias(c) for c in ("min", "mean", "max")])


def level_counts(df: DataFrame, columns: Sequence[str], max_levels: int | None = None) -> DataFrame:
    """Counts per value of the columns, or only of those with at most ``max_levels`` values."""
    counts = _stack(df, columns).groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
    if max_levels is None:
        return counts.select("column", F.col("v").alias("level"), "n")
    few = counts.groupBy("column").agg(F.count(F.lit(1)).alias("_l")).where(F.col("_l") <= max_levels)
    return counts.join(few.select("column"), "column", "left_semi").select("column", F.col("v").alias("level"), "n")


def matrix_statistics(expr: DataFrame, n_cells: DataFrame, n_features: DataFrame, value: str = "count") -> DataFrame:
    """Zero share, stored values per cell and value range of a matrix (one row)."""
    per_cell = expr.where(F.col(value) != 0).groupBy("cell_id").agg(F.count(F.lit(1)).alias("nnz"))
    quant = exact_quantiles(per_cell.select(F.col("nnz").cast("double").alias("_v")), [], "_v", {"nnz_q05": 0.05, "nnz_median": 0.5, "nnz_q95": 0.95})
    stats = expr.agg(F.count_if(F.col(value) != 0).alias("n_stored"), F.min(value).alias("min"), F.max(value).alias("max"))
    out = stats.crossJoin(quant).crossJoin(n_cells).crossJoin(n_features)  # one row each
    return out.withColumn("zero_fraction", 1 - F.col("n_stored") / (F.col("n_cells") * F.col("n_features")))


def histogram(df: DataFrame, value: str, n_bins: int = 60, keys: Sequence[str] = ()) -> DataFrame:
    """Counts per equal-width bin (1-based; the maximum falls in the last bin), empty bins left out."""
    keys = list(keys)
    kept = df.where(F.col(value).isNotNull())
    limits = kept.groupBy(*keys).agg(F.min(value).alias("lo"), F.max(value).alias("hi")) if keys else kept.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    joined = kept.join(limits, keys) if keys else kept.crossJoin(F.broadcast(limits))
    width = (F.col("hi") - F.col("lo")) / n_bins
    slot = F.when(width > 0, F.least(F.lit(n_bins), F.floor((F.col(value) - F.col("lo")) / width) + 1)).otherwise(1).cast("int")
    return joined.groupBy(*keys, slot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def cumulative_shares(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Empirical distribution: share of rows at or below each distinct value."""
    runs = running_sums(value_counts(df.where(F.col(value).isNotNull()), keys, value), keys, value, ["n"])
    return runs.select(*keys, value, ((F.col("n_below") + F.col("n")) / F.col("n_total")).alias("share"))


def zscore_columns(table: DataFrame, column: str, value: str) -> DataFrame:
    """z-score of a panel value within its column (population standard deviation)."""
    stats = table.groupBy(column).agg(F.avg(value).alias("_m"), F.stddev_pop(value).alias("_s"))
    return table.join(stats, column).withColumn("z", F.try_divide(F.col(value) - F.col("_m"), F.nullif(F.col("_s"), F.lit(0.0)))).drop("_m", "_s")


def binned_medians(df: DataFrame, x: str, y: str, n_bins: int = 8) -> DataFrame:
    """Median of both axes in quantile bins of x."""
    kept = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    cuts = exact_quantiles(kept, [], x, {f"q{i}": i / n_bins for i in range(1, n_bins)})
    inside = kept.crossJoin(F.broadcast(cuts))
    slot: Column = F.lit(1)
    for i in range(1, n_bins):
        slot = slot + (F.col(x) > F.col(f"q{i}")).cast("int")
    binned = inside.select(slot.alias("bin"), F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    mx, my = exact_quantiles(binned, ["bin"], "_x", {"median_x": 0.5}), exact_quantiles(binned, ["bin"], "_y", {"median_y": 0.5})
    return binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n")).join(mx, "bin").join(my, "bin")


def cluster_positions(vectors: DataFrame, group: str, n_axes: int = 2) -> DataFrame:
    """Median position of every cluster per axis."""
    long = vectors.select(group, F.posexplode(F.slice("vec", 1, n_axes)).alias("axis", "x"))
    return exact_quantiles(long, [group, "axis"], "x", {"median": 0.5})


def cluster_summary(cells: DataFrame, design: Sequence[str], metrics: Sequence[str] = (), share: float = 0.8, global_share: float = 0.5, depth: str | None = None, depth_ratio: float = 1.5) -> DataFrame:
    """Size, fraction, class shares, medians and descriptive flags per cluster.

    Flags: a design level holding most of the cluster but less than half of all
    cells, mostly ambiguous or unassigned cells, and an unusual library size.
    """
    n = cells.agg(F.count(F.lit(1)).alias("_n"))
    unclear = F.col("perturbation_class").isin("ambiguous", "unassigned")
    out = cells.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_cells"), ratio(F.count_if(unclear), F.count(F.lit(1))).alias("frac_ambiguous_or_unassigned")).crossJoin(F.broadcast(n))
    out = out.withColumn("fraction", F.col("n_cells") / F.col("_n")).drop("_n")
    flags = []
    for c in design:
        levels = cells.groupBy("cluster", F.col(c).alias("_lv")).agg(F.count(F.lit(1)).alias("_k"))
        overall = levels.groupBy("_lv").agg(F.sum("_k").alias("_g"))
        top = levels.join(overall, "_lv").groupBy("cluster").agg(F.max(F.struct("_k", "_lv", "_g")).alias("_t"))
        out = out.join(top, "cluster").crossJoin(F.broadcast(n)).withColumn(f"top_{c}", F.col("_t._lv")).withColumn(f"top_{c}_share", F.col("_t._k") / F.col("n_cells")).withColumn("_gs", F.col("_t._g") / F.col("_n"))
        text = F.format_string(f"{c} %s = %.0f%% of cells (vs %.0f%% overall)", F.col(f"top_{c}"), 100 * F.col(f"top_{c}_share"), 100 * F.col("_gs"))
        out = out.withColumn(f"_flag_{c}", F.when((F.col(f"top_{c}_share") >= share) & (F.col("_gs") < global_share), text)).drop("_t", "_n", "_gs")
        flags.append(f"_flag_{c}")
    out = out.withColumn("_flag_unclear", F.when(F.col("frac_ambiguous_or_unassigned") > 0.5, F.format_string("%.0f%% ambiguous/unassigned", 100 * F.col("frac_ambiguous_or_unassigned"))))
    flags.append("_flag_unclear")
    for m in metrics:
        medians = exact_quantiles(cells.select("cluster", F.col(m).cast("double").alias("_v")), ["cluster"], "_v", {f"median_{m}": 0.5})
        out = out.join(medians, "cluster", "left")
        if m == depth:
            whole = exact_quantiles(cells.select(F.col(m).cast("double").alias("_v")), [], "_v", {"_all": 0.5})
            out = out.crossJoin(F.broadcast(whole)).withColumn("depth_ratio_to_overall", ratio(F.col(f"median_{m}"), F.col("_all"))).drop("_all")
            odd = (F.col("depth_ratio_to_overall") >= depth_ratio) | (F.col("depth_ratio_to_overall") <= 1 / depth_ratio)
            out = out.withColumn("_flag_depth", F.when(odd, F.format_string("median library size %.2f x the overall median (possible depth-driven state)", "depth_ratio_to_overall")))
            flags.append("_flag_depth")
    return out.withColumn("flags", F.concat_ws("; ", *flags)).drop(*flags)


def cluster_level_counts(cells: DataFrame, column: str) -> DataFrame:
    """Dense cluster x level counts."""
    counts = cells.groupBy("cluster", column).agg(F.count(F.lit(1)).alias("n_cells"))
    grid = complete(cells.select("cluster").distinct(), cells.select(column), column)
    return grid.join(counts, ["cluster", column], "left").na.fill(0, ["n_cells"])
