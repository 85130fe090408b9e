"""Perturbation labels of cells and the cell groups every test uses."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import control_class_of, split_list, target_from_guide

TARGETING, CONTROL = "single_targeting", "single_control"
#: fixed values: the perturbation classes in reporting order
CLASS_ORDER = ["single_targeting", "single_control", "multi_targeting", "multi_control", "mixed_control_targeting", "ambiguous", "unassigned"]


def _lookup(table: Mapping[str, str] | None, guide: Column) -> Column:
    if not table:
        return F.lit(None).cast("string")
    return F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), guide)


def parse_target(guide: Column, pattern: str | None, table: Mapping[str, str] | None = None) -> Column:
    """Target of a guide: explicit table, then pattern, then the guide id itself."""
    return F.coalesce(_lookup(table, guide), target_from_guide(guide, pattern))


def annotate_guides(guides: DataFrame, pattern: str | None, classes: Mapping[str, Sequence[str]], table: Mapping[str, str] | DataFrame | None = None) -> DataFrame:
    """Guide dimension table with ``target`` and ``control_class`` ('' for targeting guides).

    ``table`` gives explicit targets, as a dictionary or, at any size, as a
    DataFrame (entry, mapped) that is joined.
    """
    if isinstance(table, DataFrame):
        found = guides.join(table, F.col("guide") == F.col("entry"), "left")
        out = found.withColumn("target", F.coalesce("mapped", target_from_guide(F.col("guide"), pattern))).drop("entry", "mapped")
    else:
        out = guides.withColumn("target", parse_target(F.col("guide"), pattern, table))
    cls = control_class_of(F.col("target"), classes)
    return out.withColumn("control_class", F.when(cls == "targeting", "").otherwise(cls)).withColumn("is_control", cls != "targeting")


def guide_lists(cells: DataFrame, assignments: DataFrame | None = None, metadata_guide: str | None = None, metadata_perturbation: str | None = None) -> DataFrame:
    """``guides ARRAY`` per cell from the preferred source: lists, metadata guide, metadata label."""
    if assignments is not None:
        out = cells.join(assignments.select("cell_id", F.col("guides").alias("_g")), "cell_id", "left")
        guides = F.coalesce(F.col("_g"), F.array().cast("array<string>"))
        return out.withColumn("guides", guides).drop("_g")
    if metadata_guide is not None:
        return cells.withColumn("guides", split_list(F.col(metadata_guide), ";"))
    if metadata_perturbation is not None:
        value = F.coalesce(F.col(metadata_perturbation), F.lit(""))
        return cells.withColumn("guides", F.filter(F.array(value), lambda v: v != ""))
    return cells.withColumn("guides", F.array().cast("array<string>"))


def label_cells(lists: DataFrame, pattern: str | None, classes: Mapping[str, Sequence[str]], table: Mapping[str, str] | None = None,
                metadata_target: str | None = None, multi_label: str = "multi", unassigned_label: str = "unassigned") -> DataFrame:
    """The twelve label columns of a cell, computed row by row from its guide list (no shuffle)."""
    guides = F.col("guides")
    n = F.size(guides)
    parsed = F.transform(guides, lambda g: parse_target(g, pattern, table))
    if metadata_target is not None:
        given = F.nullif(F.col(metadata_target), F.lit(""))
        parsed = F.when((n == 1) & given.isNotNull(), F.array(given)).otherwise(parsed)
    df = lists.withColumn("_parsed", parsed).withColumn("_targets", F.array_distinct("_parsed"))
    df = df.withColumn("_cls", F.transform("_targets", lambda t: control_class_of(t, classes)))
    n_control = F.size(F.filter("_cls", lambda c: c != "targeting"))
    has_control, has_target = n_control > 0, F.size("_cls") > n_control
    single = n == 1
    pclass = (F.when(n == 0, "unassigned")
              .when(single & has_control, CONTROL).when(single, TARGETING)
              .when(has_control & has_target, "mixed_control_targeting")
              .when(has_control, "multi_control").otherwise("multi_targeting"))
    target = F.when(single, F.element_at("_parsed", 1)).otherwise("")
    first_class = F.element_at("_cls", 1)
    return (df
            .withColumn("n_guides", n)
            .withColumn("targets", F.array_join("_targets", ";"))
            .withColumn("n_targets", F.size("_targets"))
            .withColumn("guide", F.when(single, F.element_at(guides, 1)).otherwise(""))
            .withColumn("target", target)
            .withColumn("control_class", F.when(single & (first_class != "targeting"), first_class).otherwise(""))
            .withColumn("perturbation", F.when(single, F.element_at("_parsed", 1)).when(n == 0, unassigned_label).otherwise(multi_label))
            .withColumn("perturbation_class", pclass)
            .withColumn("is_control", F.col("perturbation_class") == CONTROL)
            .withColumn("is_targeting", F.col("perturbation_class") == TARGETING)
            .withColumn("is_single_guide", single)
            .withColumn("guides", F.array_join(guides, ";"))
            .drop("_parsed", "_targets", "_cls"))


def mark_ambiguous(cells: DataFrame, ambiguous: str = "is_ambiguous", label: str = "ambiguous") -> DataFrame:
    """Cells whose dominant call was ambiguous keep no guide but are labelled as such."""
    for column in ("perturbation", "perturbation_class"):
        cells = cells.withColumn(column, F.when(F.col(ambiguous), label).otherwise(F.col(column)))
    return cells


def is_perturbed() -> Column:
    return F.col("perturbation_class") == TARGETING


def is_reference(control_classes: Sequence[str]) -> Column:
    """Cells of the configured control classes."""
    return (F.col("perturbation_class") == CONTROL) & F.col("control_class").isin(list(control_classes))


def with_roles(cells: DataFrame, control_classes: Sequence[str]) -> DataFrame:
    """``role``: perturbed / control / NULL for cells that enter neither group."""
    return cells.withColumn("role", F.when(is_perturbed(), "perturbed").when(is_reference(control_classes), "control"))


def cell_groups(cells: DataFrame, control_classes: Sequence[str], min_cells: int, min_control: int = 1) -> DataFrame:
    """Targets with cell counts, eligibility and the reason of a skip.

    Too few control cells make every target ineligible and add a ``*`` row.
    """
    counts = cells.where(is_perturbed()).groupBy("target").agg(F.count(F.lit(1)).alias("n_cells"))
    control = cells.agg(F.count_if(is_reference(control_classes)).alias("n_control"))
    joined = counts.crossJoin(F.broadcast(control))  # one row: the control count
    small = F.col("n_cells") < min_cells
    joined = joined.withColumn("reason", F.when(small, f"fewer than {min_cells} single-guide targeting cells"))
    joined = joined.withColumn("eligible", ~small & (F.col("n_control") >= min_control))
    none = control.where(F.col("n_control") < min_control).select(
        F.lit("*").alias("target"), F.col("n_control").alias("n_cells"), "n_control",
        F.lit(f"fewer than {min_control} control cells ({', '.join(control_classes)})").alias("reason"), F.lit(False).alias("eligible"))
    return joined.unionByName(none)


def build_cell_table(cells: DataFrame, metadata: DataFrame, columns: Mapping[str, str], numeric: Mapping[str, str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Attach metadata under standard names: text columns as they are, numeric ones coerced to NULL on failure."""
    picked = [F.col("cell_id")]
    picked += [F.col(src).cast("string").alias(dst) for dst, src in columns.items() if src in metadata.columns]
    picked += [F.expr(f"try_cast(`{src}` AS DOUBLE)").alias(dst) for dst, src in (numeric or {}).items() if src in metadata.columns]
    taken = set(columns) | set(numeric or {})
    picked += [F.col(c) for c in keep if c in metadata.columns and c not in taken]
    return cells.join(metadata.select(*picked), "cell_id", "left")


def keep_cells(cells: DataFrame, drop_multi: bool = False, drop_unassigned: bool = False) -> DataFrame:
    """Optional removal of multi-guide or guide-less cells before quality control."""
    if drop_multi:
        cells = cells.where("n_guides <= 1")
    if drop_unassigned:
        cells = cells.where("n_guides >= 1")
    return cells
