"""Prefilter, strict filter and the filter audit."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


@dataclass(frozen=True)
class Step:
    """One cell filter: a name, its category, the threshold text and the failing condition."""

    name: str
    category: str
    threshold: str
    fails: Column


def prefilter_cells(expr: DataFrame, min_genes: int = 200, value: str = "count") -> DataFrame:
    """Cells with at least ``min_genes`` detected genes."""
    return expr.where(F.col(value) != 0).groupBy("cell_id").agg(F.count(F.lit(1)).alias("n_genes")).where(F.col("n_genes") >= min_genes)


def prefilter_genes(expr: DataFrame, min_cells: int = 3, value: str = "count") -> DataFrame:
    """Genes detected in at least ``min_cells`` of the given cells."""
    return expr.where(F.col(value) != 0).groupBy("feature").agg(F.count(F.lit(1)).alias("n_cells")).where(F.col("n_cells") >= min_cells)


def prefilter(expr: DataFrame, min_genes: int = 200, min_cells: int = 3) -> DataFrame:
    """Cells first, then genes among the kept cells."""
    kept = expr.join(prefilter_cells(expr, min_genes).select("cell_id"), "cell_id", "left_semi")
    return kept.join(prefilter_genes(kept, min_cells).select("feature"), "feature", "left_semi")


@dataclass(frozen=True)
class Limit:
    """A configurable limit on one cell metric: its option, step name, category, metric, label and what a kept cell satisfies."""

    option: str
    step: str
    category: str
    metric: str
    label: str
    keeps: str

    def apply(self, bound) -> Step:
        value = F.col(self.metric)
        broken = {">=": value < bound, "<": value >= bound, "<=": value > bound, "==": value != bound}[self.keeps]
        # a cell without the metric has broken nothing
        return Step(self.step, self.category, f"{self.label} {self.keeps} {bound}", F.coalesce(broken, F.lit(False)))


# fixed values: step names, categories and labels of the audit, in the order of the filter
LIMITS = (
    Limit("min_genes", "rna_min_genes", "rna", "n_genes_by_counts", "genes detected", ">="),
    Limit("min_counts", "rna_min_counts", "rna", "total_counts", "total counts", ">="),
    Limit("max_pct_mt", "rna_max_pct_mt", "rna", "pct_counts_mt", "% mitochondrial", "<"),
    Limit("max_pct_hb", "rna_max_pct_hb", "rna", "pct_counts_hb", "% haemoglobin", "<"),
    Limit("protein_min_total", "protein_min_total_counts", "protein", "protein_total_counts", "total ADT", ">="),
    Limit("protein_min_detected", "protein_min_proteins_detected", "protein", "protein_n_detected", "proteins detected", ">="),
    Limit("max_pct_isotype", "protein_max_pct_isotype", "protein", "protein_pct_isotype", "% isotype", "<="),
)
CELL_MODES = {
    "all": None,
    "assigned": (Limit("cells", "perturbation_assigned_only", "perturbation", "n_guides", "n_guides", ">="), 1),
    "single_guide": (Limit("cells", "perturbation_single_guide", "perturbation", "n_guides", "n_guides", "=="), 1),
}


def strict_steps(remove_extreme: bool = False, extreme_fold: float = 10.0, cells: str = "all", **bounds: float | None) -> list[Step]:
    """Steps of the given bounds (an option of ``LIMITS`` each) in the order of the table, the extreme-count flag, then the cell mode."""
    unknown = bounds.keys() - {limit.option for limit in LIMITS}
    if unknown:
        raise TypeError(f"unknown limits: {sorted(unknown)}")
    steps = [limit.apply(bounds[limit.option]) for limit in LIMITS if bounds.get(limit.option) is not None]
    if remove_extreme:
        flag = F.coalesce(F.col("protein_extreme_counts"), F.lit(False))
        steps.append(Step("protein_remove_extreme_counts", "protein", f"total ADT <= {extreme_fold} x q99", flag))
    return steps + perturbation_mode(cells)


def perturbation_mode(cells: str) -> list[Step]:
    """``all`` keeps every cell, ``assigned`` those with a guide, ``single_guide`` those with exactly one."""
    if cells not in CELL_MODES:
        raise ValueError(f"unknown cell mode: {cells}")
    mode = CELL_MODES[cells]
    return [mode[0].apply(mode[1])] if mode else []


def label_removed(cells: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """``removed_by``: name of the first failing step, NULL for kept cells."""
    return cells.withColumn("removed_by", F.coalesce(F.lit(None).cast("string"), *[F.when(s.fails, F.lit(s.name)) for s in steps]))


def kept_cells(labelled: DataFrame) -> DataFrame:
    return labelled.where(F.col("removed_by").isNull())


def audit_cells(labelled: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """Before / after / removed per step, from one aggregate over the cells and a lag over the steps."""
    removed = F.col("removed_by")
    counts = labelled.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(removed == s.name).alias(f"_r{i}") for i, s in enumerate(steps)])
    rows = [F.struct(F.lit(0).alias("step_order"), F.lit("input").alias("step"), F.lit("input").alias("category"), F.lit("-").alias("threshold"), F.col("_n").alias("cells_after"))]
    left = F.col("_n")
    for i, s in enumerate(steps):
        left = left - F.col(f"_r{i}")
        rows.append(F.struct(F.lit(i + 1).alias("step_order"), F.lit(s.name).alias("step"), F.lit(s.category).alias("category"), F.lit(s.threshold).alias("threshold"), left.alias("cells_after")))
    rows.append(F.struct(F.lit(len(steps) + 1).alias("step_order"), F.lit("final").alias("step"), F.lit("final").alias("category"), F.lit("-").alias("threshold"), left.alias("cells_after")))
    table = counts.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")
    return chain_audit(table)


def chain_audit(steps: DataFrame) -> DataFrame:
    """Each step starts where the previous one ended (the step table has a handful of rows)."""
    before = F.lag("cells_after").over(W.orderBy("step_order"))
    out = steps.withColumn("cells_before", F.coalesce(before, F.col("cells_after")))
    return out.withColumn("cells_removed", F.col("cells_before") - F.col("cells_after"))


def gene_step(expr: DataFrame, kept: DataFrame, min_cells: int) -> DataFrame:
    """Gene filter after the cell filters: genes before, after and removed (one row)."""
    survivors = expr.join(kept.select("cell_id"), "cell_id", "left_semi")
    before = expr.agg(F.countDistinct("feature").alias("genes_before"))
    after = prefilter_genes(survivors, min_cells).agg(F.count(F.lit(1)).alias("genes_after"))
    return before.crossJoin(after).withColumn("genes_removed", F.col("genes_before") - F.col("genes_after"))
