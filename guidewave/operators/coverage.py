"""Guide, target and condition coverage; flags only, nothing is removed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ordering import exact_quantiles
from ..functions.scalars import ratio
from .labels import CLASS_ORDER


def _class(column: str = "control_class"):
    return F.coalesce(F.nullif(column, F.lit("")), F.lit("targeting"))


def crosstab(df: DataFrame, row: str, column: str, levels: Sequence[str]) -> DataFrame:
    """Dense counts of ``row`` by the given levels of ``column``, named ``<column>=<level>``."""
    return df.groupBy(row).agg(*[F.count_if(F.col(column) == v).alias(f"{column}={v}") for v in levels])


def entity_coverage(cells: DataFrame, key: str, list_column: str, condition: str, levels: Sequence[str], min_cells: int) -> DataFrame:
    """Coverage per guide or target: single-guide cells, any-guide cells, per condition, low-coverage flag.

    ``list_column`` is the ``;``-joined list of all guides or targets of a cell.
    """
    single = cells.where("is_single_guide")
    counts = [F.count_if(F.col(condition) == v).alias(f"{condition}={v}") for v in levels]
    extra = [F.countDistinct("guide").alias("n_guides")] if key == "target" else [F.min("target").alias("target")]
    own = single.groupBy(key).agg(F.min("control_class").alias("control_class"), F.count(F.lit(1)).alias("n_cells_single_guide"), *extra, *counts)
    members = cells.where("n_guides > 0").select(F.explode(F.split(list_column, ";")).alias(key))
    anyhow = members.groupBy(key).agg(F.count(F.lit(1)).alias("n_cells_any"))
    out = anyhow.join(own, key, "left").withColumn("class", _class())
    numeric = ["n_cells_single_guide", *[f"{condition}={v}" for v in levels], *(["n_guides"] if key == "target" else [])]
    out = out.na.fill(0, numeric).withColumn("min_cells_per_condition", F.least(*[F.col(f"`{condition}={v}`") for v in levels]))
    return out.withColumn("low_coverage", F.col("n_cells_single_guide") < min_cells).drop("control_class")


def label_counts(cells: DataFrame, condition: str, levels: Sequence[str]) -> DataFrame:
    """Cells per perturbation label with its class and condition columns."""
    return cells.groupBy("perturbation").agg(F.min("perturbation_class").alias("perturbation_class"), F.count(F.lit(1)).alias("n_cells"),
                                             *[F.count_if(F.col(condition) == v).alias(f"{condition}={v}") for v in levels])


def condition_coverage(cells: DataFrame, key: str, condition: str, levels: Sequence[str], min_cells: int) -> DataFrame:
    """Long (guide or target, condition) counts, zero-filled from one aggregate row per key."""
    single = cells.where("is_single_guide")
    wide = single.groupBy(key).agg(F.min("control_class").alias("control_class"), F.array(*[
        F.struct(F.lit(v).alias(condition), F.count_if(F.col(condition) == v).alias("n_cells")) for v in levels]).alias("_r"))
    long = wide.select(key, _class().alias("class"), F.explode("_r").alias("_r")).select(key, "class", f"_r.{condition}", "_r.n_cells")
    return long.withColumn("low_coverage", F.col("n_cells") < min_cells)


def moi_table(cells: DataFrame, condition: str) -> DataFrame:
    """Guide number by condition with both margins."""
    return cells.cube("n_guides", condition).agg(F.count(F.lit(1)).alias("n_cells")).select(
        F.coalesce(F.col("n_guides").cast("string"), F.lit("All")).alias("n_guides"), F.coalesce(condition, F.lit("All")).alias(condition), "n_cells")


def screen_summary(cells: DataFrame) -> DataFrame:
    """One row: class counts and guide-number fractions (ambiguous cells carry no guide)."""
    n = F.count(F.lit(1))
    out = cells.agg(n.alias("n_cells"), *[F.count_if(F.col("perturbation_class") == c).alias(f"n_{c}") for c in CLASS_ORDER],
                    F.count_if(F.col("n_guides") == 0).alias("_0"), F.count_if(F.col("n_guides") == 1).alias("_1"), F.count_if(F.col("n_guides") > 1).alias("_2"))
    for name, src in (("frac_unassigned", "_0"), ("frac_single_guide", "_1"), ("frac_multi_guide", "_2")):
        out = out.withColumn(name, F.round(ratio(F.col(src), F.col("n_cells")), 4))
    return out.drop("_0", "_1", "_2")


def coverage_bins(table: DataFrame, column: str = "n_cells_single_guide", edges: Sequence[int] = (10, 20, 30, 50)) -> DataFrame:
    """Median, range and counts below fixed edges, over the (library-sized) coverage table."""
    aggs = [F.count(F.lit(1)).alias("n"), F.min(column).alias("min"), F.max(column).alias("max"), F.count_if("low_coverage").alias("n_low_coverage")]
    aggs += [F.count_if(F.col(column) < e).alias(f"n_lt_{e}") for e in edges]
    return table.agg(F.median(F.col(column).cast("double")).alias("median"), *aggs)


def group_summary(cells: DataFrame, key: str, metrics: Mapping[str, str]) -> DataFrame:
    """Cells, class breakdown and exact medians per level of a design column."""
    base = cells.groupBy(key).agg(F.count(F.lit(1)).alias("n_cells"), *[F.count_if(F.col("perturbation_class") == c).alias(f"n_{c}") for c in CLASS_ORDER])
    stacked = F.explode(F.array(*[F.struct(F.lit(out).alias("metric"), F.col(src).cast("double").alias("v")) for src, out in metrics.items()]))
    long = cells.select(key, stacked.alias("_m")).select(key, "_m.metric", "_m.v")
    medians = exact_quantiles(long, [key, "metric"], "v", {"median": 0.5})
    wide = medians.groupBy(key).agg(*[F.max(F.when(F.col("metric") == out, F.col("median"))).alias(out) for out in metrics.values()])
    return base.join(wide, key, "left")


def composition(cells: DataFrame, strata: Sequence[str], selected: DataFrame) -> DataFrame:
    """Eligible and selected cells per stratum."""
    flagged = cells.join(selected.select("cell_id", F.lit(True).alias("_sel")), "cell_id", "left")
    return flagged.groupBy(*strata).agg(F.count(F.lit(1)).alias("n_eligible"), F.count_if(F.col("_sel")).alias("n_selected"))
