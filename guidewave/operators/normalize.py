"""RNA value states: detection, library-size normalisation, count reconstruction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.ordering import exact_quantiles
from ..functions.scalars import ratio


def library_sizes(expr: DataFrame, value: str = "count") -> DataFrame:
    return expr.groupBy("cell_id").agg(F.sum(value).alias("library"))


def normalize_total(expr: DataFrame, target_sum: float | None = 1e4, value: str = "count", state: str = "raw_counts", log: bool = True) -> DataFrame:
    """Add ``lognorm`` = ln(1 + value * target / library); without a target the median positive library is used.

    The library is a window over the cell's own genes (a group never longer than
    the gene list), so values and totals share one shuffle.
    """
    if state != "raw_counts":
        raise ValueError(f"input is {state}; refusing to normalise twice")
    total = F.sum(value).over(W.partitionBy("cell_id"))
    out = expr.withColumn("library", total)
    if target_sum is None:
        sizes = library_sizes(expr, value).where("library > 0").select(F.col("library").cast("double").alias("_v"))
        out = out.crossJoin(F.broadcast(exact_quantiles(sizes, [], "_v", {"_target": 0.5})))  # one row
        scaled = F.col(value) * F.col("_target") / F.col("library")
    else:
        scaled = F.col(value) * F.lit(float(target_sum)) / F.col("library")
    return out.withColumn("lognorm", F.log1p(scaled) if log else scaled).drop("_target")


def detect_value_state(expr: DataFrame, value: str = "count") -> DataFrame:
    """One row (state, is_integer, min, max, log_scale) judged on all cells."""
    seen = expr.where(F.col(value) != 0)
    x = F.col(value).cast("double")
    per_cell = seen.groupBy("cell_id").agg(
        F.min(x).alias("lo"), F.max(x).alias("hi"), F.count_if(F.abs(x - F.rint(x)) > 1e-6).alias("bad"),
        F.sum(F.expm1(F.least(x, F.lit(700.0)))).alias("e"), F.sum(x).alias("s"))
    pos_e, pos_s = F.when(F.col("e") > 0, F.col("e")), F.when(F.col("s") > 0, F.col("s"))
    stats = per_cell.agg(F.count(F.lit(1)).alias("n"), F.min("lo").alias("min"), F.max("hi").alias("max"), F.sum("bad").alias("bad"),
                         ratio(F.stddev_pop(pos_e), F.avg(pos_e)).alias("cv_e"), ratio(F.stddev_pop(pos_s), F.avg(pos_s)).alias("cv_s"))
    scale = exact_quantiles(per_cell.select(pos_e.alias("_v")).where("_v IS NOT NULL"), [], "_v", {"scale": 0.5})
    stats = stats.join(F.broadcast(scale), F.lit(True), "left")  # at most one row
    integer = F.coalesce(F.col("bad"), F.lit(0)) == 0
    logged = F.col("cv_e") < 0.01
    state = (F.when(F.col("n") == 0, "uncertain").when(F.col("min") < 0, "normalized").when(integer, "raw_counts").when(logged, "log_normalized")
             .when((F.col("cv_s") < 0.01) | (F.col("max") < 30), "normalized").otherwise("uncertain"))
    return stats.withColumn("state", state).select(
        "state", (integer & ~(F.coalesce(F.col("min"), F.lit(0.0)) < 0)).alias("is_integer"), F.coalesce("min", F.lit(0.0)).alias("min"),
        F.coalesce("max", F.lit(0.0)).alias("max"), F.when(F.col("state") == "log_normalized", F.col("scale")).alias("log_scale"))


def reconstruct_counts(expr: DataFrame, totals: DataFrame, scale: float, value: str = "lognorm", tolerance: float = 0.05) -> tuple[DataFrame, DataFrame]:
    """Integer counts behind log-normalised values, and one row saying whether they are accepted.

    ``totals(cell_id, total)``; the acceptance row is for the caller to check
    before using the counts.
    """
    raw = F.expm1(F.col(value)) * F.col("total") / F.lit(float(scale))
    counts = expr.join(totals.select("cell_id", "total"), "cell_id", "left").withColumn("_raw", raw).withColumn("count", F.rint("_raw").cast("int"))
    per_cell = counts.groupBy("cell_id").agg(
        F.sum("count").alias("s"), F.max("total").alias("total"), F.count(F.lit(1)).alias("nnz"), F.count_if(F.abs(F.col("_raw") - F.col("count")) > tolerance).alias("bad"),
        F.max(F.abs(F.col("_raw") - F.col("count"))).alias("dev"), F.min("count").alias("lo"), F.count_if(F.col("total").isNull() | (F.col("total") <= 0)).alias("missing"))
    info = per_cell.agg(F.sum("nnz").alias("nnz"), F.sum("bad").alias("bad"), F.max("dev").alias("max_abs_deviation"), F.min("lo").alias("min_nonzero_count"),
                        F.count_if(F.abs(F.col("s") - F.col("total")) <= 0.5).alias("rows_ok"), F.count(F.lit(1)).alias("rows"), F.sum("missing").alias("missing"))
    within = F.lit(1.0) - ratio(F.col("bad"), F.col("nnz"))
    info = info.select("max_abs_deviation", within.alias("frac_entries_within_tolerance"), ratio(F.col("rows_ok"), F.col("rows")).alias("row_sum_matches_total"), "min_nonzero_count",
                       ((F.col("missing") == 0) & (within >= 0.999) & (F.col("min_nonzero_count") >= 1)).alias("accepted"))
    info = info.withColumn("partial_totals", F.col("accepted") & (F.col("row_sum_matches_total") < 0.99))
    return counts.drop("_raw", "total"), info
