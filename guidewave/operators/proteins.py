"""Antibody representations, feature annotation and isotype checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.scalars import any_regex, feature_base_name
from .grids import complete, dense_panel

#: fixed values: the antibody annotation columns
ANNOTATIONS = ["antibody_name", "protein_name", "gene_symbol", "clone", "feature_type", "isotype", "isotype_control"]


def clr(cells: DataFrame, counts: DataFrame, panel: DataFrame, axis: str = "features") -> DataFrame:
    """Centred log-ratio of the targeting antibodies, zeros included.

    ``cells`` are those with antibody counts.  Over features the centre is a window
    on the cell's own panel; over cells it is one aggregate per antibody.
    """
    targets = panel.where(~F.col("is_isotype"))
    dense = dense_panel(cells.select("cell_id"), counts.join(targets.select("protein"), "protein", "left_semi"), targets, "count")
    logged = dense.select("cell_id", "protein", F.log1p(F.col("count").cast("double")).alias("_l"))
    if axis == "features":
        return logged.withColumn("clr", F.col("_l") - F.avg("_l").over(W.partitionBy("cell_id"))).drop("_l")
    centre = logged.groupBy("protein").agg(F.avg("_l").alias("_c"))
    return logged.join(centre, "protein").withColumn("clr", F.col("_l") - F.col("_c")).drop("_l", "_c")


def log1p_protein(cells: DataFrame, counts: DataFrame, panel: DataFrame) -> DataFrame:
    targets = panel.where(~F.col("is_isotype"))
    dense = dense_panel(cells.select("cell_id"), counts.join(targets.select("protein"), "protein", "left_semi"), targets, "count")
    return dense.select("cell_id", "protein", F.log1p(F.col("count").cast("double")).alias("log1p"))


def isotype_ratio(cells: DataFrame, counts: DataFrame, panel: DataFrame, isotype_map: Mapping[str, str]) -> DataFrame:
    """max(0, ln((x + 1) / (control + 1))) for every mapped antibody; both values come from the cell's own map."""
    dense = dense_panel(cells.select("cell_id"), counts, panel, "count")
    control = F.element_at(F.create_map(*[F.lit(x) for kv in isotype_map.items() for x in kv]), F.col("protein"))
    mapped = dense.withColumn("_control", control).where(F.col("_control").isNotNull())
    level = F.coalesce(F.element_at("_m", F.col("_control")), F.lit(0))
    value = F.greatest(F.lit(0.0), F.log((F.col("count") + 1) / (level + 1)))
    return mapped.select("cell_id", "protein", value.alias("isotype_ratio"))


def infer_isotypes(normalized: DataFrame, counts: DataFrame, panel: DataFrame, value: str = "value", tolerance: float = 1e-4) -> DataFrame:
    """For each antibody the control whose ratio transform best explains a given normalised matrix.

    The largest error of every (antibody, control) pair is a running maximum, so
    cells are aggregated map-side; pairs are limited by the panel.
    """
    entry = F.map_from_entries(F.collect_list(F.struct("protein", "count")))
    maps = counts.groupBy("cell_id").agg(entry.alias("_m"))
    controls = panel.where("is_isotype").select(F.col("protein").alias("control"))
    rows = complete(normalized.join(maps, "cell_id"), controls, "control")
    x = F.coalesce(F.element_at("_m", F.col("protein")), F.lit(0))
    c = F.coalesce(F.element_at("_m", F.col("control")), F.lit(0))
    error = F.abs(F.greatest(F.lit(0.0), F.log((x + 1) / (c + 1))) - F.col(value))
    worst = rows.groupBy("protein", "control").agg(F.max(error).alias("err"))
    best = worst.groupBy("protein").agg(F.min(F.struct("err", "control")).alias("_b"))
    return best.select("protein", F.col("_b.control").alias("isotype_control"), F.col("_b.err").alias("max_abs_diff"), (F.col("_b.err") < tolerance).alias("reproduced"))


def protein_roles(panel: DataFrame, in_primary: DataFrame, in_embedding: DataFrame, use_isotypes_for_qc: bool = True) -> DataFrame:
    """Role of every antibody: target or control, and where it is used."""
    flag = F.lit(True)
    out = panel.join(in_primary.select("protein").distinct().withColumn("in_primary_matrix", flag), "protein", "left")
    out = out.join(in_embedding.select("protein").distinct().withColumn("used_in_embedding", flag), "protein", "left").na.fill(False, ["in_primary_matrix", "used_in_embedding"])
    out = out.withColumn("role", F.when(F.col("is_isotype"), "isotype_control").otherwise("target"))
    return out.withColumn("used_in_qc", F.lit(use_isotypes_for_qc) | ~F.col("is_isotype"))


def normalize_protein(cells: DataFrame, counts: DataFrame | None, panel: DataFrame, provided: DataFrame | None = None, method: str = "auto",
                      isotype_map: Mapping[str, str] | None = None, clr_axis: str = "features") -> tuple[DataFrame, str]:
    """Primary representation (cell_id, protein, value) and the method used.

    ``auto`` keeps a provided normalised matrix, else computes CLR; isotype
    controls never enter the primary matrix.
    """
    if method == "auto":
        method = "provided" if provided is not None else "clr"
    if method in ("provided", "none"):
        if provided is None:
            raise ValueError("no provided normalised protein matrix")
        return provided.join(panel.where(~F.col("is_isotype")).select("protein"), "protein", "left_semi").select("cell_id", "protein", "value"), method
    if counts is None:
        raise ValueError(f"protein normalisation {method} needs raw counts")
    if method == "clr":
        return clr(cells, counts, panel, clr_axis).withColumnRenamed("clr", "value"), method
    if method == "log1p":
        return log1p_protein(cells, counts, panel).withColumnRenamed("log1p", "value"), method
    if method == "isotype_ratio":
        if not isotype_map:
            raise ValueError("isotype_ratio needs an isotype map")
        return isotype_ratio(cells, counts, panel, isotype_map).withColumnRenamed("isotype_ratio", "value"), method
    raise ValueError(f"unknown protein normalisation: {method}")


def annotate_features(panel: DataFrame, input_features: DataFrame | None = None, user_table: DataFrame | None = None) -> DataFrame:
    """Annotation columns from the input features and a user table, the latter winning; ``annotation_source`` names both."""
    out = panel
    for name, table in (("_input", input_features), ("_user", user_table)):
        if table is None:
            out = out.withColumn(f"{name}_hit", F.lit(False))
            continue
        have = [c for c in ANNOTATIONS if c in table.columns]
        picked = table.dropDuplicates(["protein"]).select("protein", *[F.nullif(F.trim(c), F.lit("")).alias(f"{name}_{c}") for c in have], F.lit(True).alias(f"{name}_hit"))
        out = out.join(picked, "protein", "left").na.fill(False, [f"{name}_hit"])
    for c in ANNOTATIONS:
        sources = [F.col(f"{n}_{c}") for n in ("_user", "_input") if f"{n}_{c}" in out.columns]
        sources += [F.col(c)] if c in panel.columns else []
        out = out.withColumn(f"_out_{c}", F.coalesce(*sources, F.lit("")))
    origin = F.concat_ws("+", F.when(F.col("_input_hit"), "input_features"), F.when(F.col("_user_hit"), "feature_table"))
    base = [c for c in panel.columns if c not in ANNOTATIONS]
    return out.select(*base, *[F.col(f"_out_{c}").alias(c) for c in ANNOTATIONS], F.when(origin == "", "none").otherwise(origin).alias("annotation_source"))


def canonical_names(features: DataFrame, suffix: str | None, rename: Mapping[str, str] | None, isotype_patterns: Sequence[str]) -> DataFrame:
    """``protein`` without suffix and after renaming, plus the isotype flag."""
    out = features.withColumn("protein", feature_base_name(F.col("name"), suffix, rename))
    return out.withColumn("is_isotype", any_regex(F.col("protein"), isotype_patterns))
