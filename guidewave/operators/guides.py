"""Guide calling from guide counts and its comparison with given assignments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ordering import exact_quantiles
from ..functions.scalars import ratio


def call_guides(cells: DataFrame, counts: DataFrame, guides: DataFrame, min_umi: int, dominance_ratio: float, detection_min_umi: int,
                max_second_umi: int | None = None, ambiguous_label: str = "ambiguous", unassigned_label: str = "unassigned") -> DataFrame:
    """Dominant and threshold calls per cell.

    ``counts(cell_id, guide, umi)`` is aggregated to one row per (cell, guide), so
    the list gathered per cell is never longer than the guide library.
    ``guides(guide, pos)`` fixes the feature order.
    """
    summed = counts.groupBy("cell_id", "guide").agg(F.sum("umi").alias("umi")).where("umi > 0").join(guides.select("guide", "pos"), "guide")
    rows = F.collect_list(F.struct((-F.col("umi")).alias("neg"), F.col("pos"), F.col("guide"), F.col("umi")))
    per_cell = summed.groupBy("cell_id").agg(F.sum("umi").alias("guide_total_counts"), F.sort_array(rows).alias("_r"))
    found = F.sort_array(F.transform(F.filter("_r", lambda r: r["umi"] >= detection_min_umi), lambda r: F.struct(r["pos"].alias("pos"), r["guide"].alias("guide"))))
    out = cells.join(per_cell, "cell_id", "left")
    top = F.get("_r", F.lit(0))
    zero = F.lit(0).cast("bigint")
    out = (out
           .withColumn("has_guide_counts", F.col("guide_total_counts").isNotNull())
           .withColumn("guide_total_counts", F.coalesce("guide_total_counts", zero))
           .withColumn("guides_detected", F.coalesce(F.transform(found, lambda r: r["guide"]), F.array().cast("array<string>")))
           .withColumn("n_guides_detected", F.size("guides_detected"))
           .withColumn("guide_top", F.coalesce(top["guide"], F.lit("")))
           .withColumn("guide_top_count", F.coalesce(top["umi"], zero))
           .withColumn("guide_second_count", F.coalesce(F.get("_r", F.lit(1))["umi"], zero))
           .drop("_r"))
    reaches = F.col("guide_top_count") >= min_umi
    dominant = reaches & (F.col("guide_top_count") > F.lit(float(dominance_ratio)) * F.col("guide_second_count"))
    if max_second_umi is not None and max_second_umi >= 0:
        dominant = dominant & (F.col("guide_second_count") <= max_second_umi)
    return (out
            .withColumn("is_dominant", dominant)
            .withColumn("is_ambiguous", reaches & ~F.col("is_dominant"))
            .withColumn("guide_dominant_call", F.when(F.col("is_dominant"), F.col("guide_top")).when(F.col("is_ambiguous"), ambiguous_label).otherwise(unassigned_label)))


def assigned_lists(calls: DataFrame, method: str = "dominant") -> DataFrame:
    """Guide list per cell under the chosen rule."""
    if method == "dominant":
        guides = F.when(F.col("is_dominant"), F.array("guide_top")).otherwise(F.array().cast("array<string>"))
    elif method == "threshold":
        guides = F.col("guides_detected")
    else:
        raise ValueError(f"unknown assignment method: {method}")
    return calls.select("cell_id", guides.alias("guides"))


def guide_table(guides: DataFrame, counts: DataFrame, calls: DataFrame, detection_min_umi: int) -> DataFrame:
    """Totals, detections and dominant cells of every guide in the library."""
    own = calls.select("cell_id")
    summed = counts.join(own, "cell_id", "left_semi").groupBy("cell_id", "guide").agg(F.sum("umi").alias("umi"))
    totals = summed.groupBy("guide").agg(F.sum("umi").alias("total_umis"), F.count_if(F.col("umi") >= detection_min_umi).alias("n_cells_detected"))
    dominant = calls.where("is_dominant").groupBy(F.col("guide_top").alias("guide")).agg(F.count(F.lit(1)).alias("n_cells_dominant"))
    out = guides.join(totals, "guide", "left").join(dominant, "guide", "left")
    return out.na.fill(0, ["total_umis", "n_cells_detected", "n_cells_dominant"])


def calling_summary(calls: DataFrame) -> DataFrame:
    """One row of counts under both rules, and the median guide total of cells with counts."""
    stats = calls.agg(
        F.count_if("has_guide_counts").alias("cells_with_guide_counts"),
        F.count_if(~F.col("has_guide_counts")).alias("cells_without_guide_counts"),
        F.count_if("is_dominant").alias("assigned"),
        F.count_if("is_ambiguous").alias("ambiguous"),
        F.count_if(~F.col("is_dominant") & ~F.col("is_ambiguous")).alias("unassigned"),
        F.count_if(F.col("n_guides_detected") == 0).alias("cells_with_0_guides"),
        F.count_if(F.col("n_guides_detected") == 1).alias("cells_with_1_guide"),
        F.count_if(F.col("n_guides_detected") > 1).alias("cells_with_2plus_guides"),
    )
    totals = calls.where("has_guide_counts").select(F.col("guide_total_counts").cast("double").alias("_v"))
    median = exact_quantiles(totals, [], "_v", {"median_guide_umis_per_cell": 0.5})
    return stats.crossJoin(median)  # one row each


def compare_assignments(given: DataFrame, calls: DataFrame) -> DataFrame:
    """Agreement of provided guide lists with the calls, over cells that have guide counts."""
    empty = F.array().cast("array<string>")
    both = calls.join(given.select("cell_id", F.col("guides").alias("_given")), "cell_id", "left").withColumn("_given", F.coalesce("_given", empty))
    both = both.where("has_guide_counts")
    same = F.array_sort(F.array_distinct("_given")) == F.array_sort(F.array_distinct("guides_detected"))
    has_given, is_guide, ambiguous = F.size("_given") > 0, F.col("is_dominant"), F.col("is_ambiguous")
    comparable = (F.size("_given") == 1) & is_guide
    agree = comparable & (F.get("_given", F.lit(0)) == F.col("guide_dominant_call"))
    out = both.agg(
        F.count(F.lit(1)).alias("cells_compared"),
        F.count_if(same).alias("set_agree"),
        F.count_if(~same).alias("set_disagree"),
        F.count_if(comparable).alias("single_compared"),
        F.count_if(agree).alias("single_agree"),
        F.count_if(comparable & ~agree).alias("single_disagree"),
        F.count_if(has_given & ambiguous).alias("provided_assigned_but_counts_ambiguous"),
        F.count_if(has_given & ~is_guide & ~ambiguous).alias("provided_assigned_but_counts_unassigned"),
        F.count_if(~has_given & is_guide).alias("provided_unassigned_but_counts_assigned"),
    )
    return out.withColumn("fraction_agree", ratio(F.col("set_agree"), F.col("cells_compared")))


def metadata_guide_check(cells: DataFrame, metadata: DataFrame, column: str) -> DataFrame:
    """Single-guide cells compared with a metadata guide column."""
    both = cells.where("guide <> ''").join(metadata.select("cell_id", F.col(column).alias("_m")).where("_m <> ''"), "cell_id")
    return both.agg(F.count(F.lit(1)).alias("metadata_guide_compared"), F.count_if(F.col("_m") != F.col("guide")).alias("metadata_guide_mismatches"))


def singlet_call(cells: DataFrame, counts: DataFrame, tags: DataFrame, min_umi: int = 10, dominance_ratio: float = 3.0) -> DataFrame:
    """Sample tag of a pooled cell: the dominant call with demultiplexing thresholds; '' otherwise."""
    calls = call_guides(cells, counts, tags, min_umi, dominance_ratio, detection_min_umi=1)
    return calls.select("cell_id", "guide_top_count", "guide_second_count", F.when(F.col("is_dominant"), F.col("guide_top")).otherwise("").alias("tag"))
