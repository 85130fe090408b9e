"""Cell alignment across modalities."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class AlignmentError(ValueError):
    """The modalities cannot be aligned as configured."""


def required_modalities(required: Sequence[str], loaded: Sequence[str]) -> list[str]:
    """``protein`` is also satisfied by ``protein_counts`` when only counts were loaded."""
    swap = "protein" not in loaded and "protein_counts" in loaded
    return ["protein_counts" if m == "protein" and swap else m for m in required]


def modality_cells(id_sets: Mapping[str, DataFrame]) -> DataFrame:
    """Long table of distinct (modality, cell_id)."""
    parts = [df.select(F.lit(name).alias("modality"), F.col("cell_id").cast("string")) for name, df in id_sets.items()]
    return reduce(DataFrame.unionByName, parts)


def membership(id_sets: Mapping[str, DataFrame]) -> DataFrame:
    """One row per cell with the number of rows it has in every modality: a single shuffle for all set questions."""
    counts = [F.count_if(F.col("modality") == name).alias(f"in_{name}") for name in id_sets]
    return modality_cells(id_sets).groupBy("cell_id").agg(*counts)


def align_cells(id_sets: Mapping[str, DataFrame], required: Sequence[str], policy: str = "intersection", reference: str = "rna") -> DataFrame:
    """Retained cells with the reference position.

    Each modality DataFrame has ``cell_id``; the base one (the reference, or
    ``metadata`` under that policy) also has ``pos``.
    """
    need = required_modalities(required, list(id_sets))
    missing = [m for m in need if m not in id_sets]
    if missing:
        raise AlignmentError(f"cannot align without {missing}: no such input was given")
    if policy == "metadata":
        if "metadata" not in id_sets:
            raise AlignmentError("policy metadata takes its cells from a metadata table, which is absent")
        base = id_sets["metadata"]
    else:
        if reference not in id_sets:
            reference = need[0] if need else next(iter(id_sets))
        base = id_sets[reference]
    kept = base.groupBy("cell_id").agg(F.min("pos").alias("pos"))
    if policy != "metadata":
        for name in need:
            if id_sets[name] is not base:
                kept = kept.join(id_sets[name].select("cell_id"), "cell_id", "left_semi")
    return kept


def alignment_report(id_sets: Mapping[str, DataFrame], required: Sequence[str]) -> DataFrame:
    """Per modality: rows, duplicates, cells only there, retained cells it lacks."""
    need = required_modalities(required, list(id_sets))
    table = membership(id_sets)
    kept = reduce(lambda a, b: a & b, [F.col(f"in_{m}") > 0 for m in need], F.lit(True))
    names = list(id_sets)
    aggs = []
    for name in names:
        here = F.col(f"in_{name}")
        elsewhere = reduce(lambda a, b: a | b, [F.col(f"in_{m}") > 0 for m in names if m != name], F.lit(False))
        aggs.append(F.struct(
            F.lit(name).alias("modality"),
            F.coalesce(F.sum(here), F.lit(0)).alias("cells_before"),
            F.coalesce(F.sum(F.greatest(here - 1, F.lit(0))), F.lit(0)).alias("duplicates"),
            F.count_if((here > 0) & ~elsewhere).alias("only_here"),
            F.count_if(kept & (here == 0)).alias("kept_but_missing"),
            F.count_if(kept).alias("cells_kept"),
        ))
    return table.agg(F.array(*aggs).alias("_r")).select(F.explode("_r").alias("_r")).select("_r.*")


def check_alignment(report: DataFrame, required: Sequence[str], policy: str = "intersection", reference: str = "rna", fail_on_duplicates: bool = True, min_overlap: float = 0.5) -> None:
    """Raise when duplicates, lacking cells or a small overlap break the policy (reads a few summary rows)."""
    rows = {r["modality"]: r for r in report.collect()}
    need = required_modalities(required, list(rows))
    if fail_on_duplicates:
        bad = [m for m, r in rows.items() if r["duplicates"]]
        if bad:
            raise AlignmentError(f"ids occur twice in {bad}")
    if policy == "metadata":
        meta = rows["metadata"]
        lacking = [m for m in need if rows[m]["cells_kept"] < meta["cells_before"] - meta["duplicates"]]
        if lacking:
            raise AlignmentError(f"{lacking} do not hold every cell of the metadata")
    ref = rows.get(reference) or next(iter(rows.values()))
    unique = max(1, ref["cells_before"] - ref["duplicates"])
    if ref["cells_kept"] == 0:
        raise AlignmentError("the inputs have no cell in common")
    if ref["cells_kept"] / unique < min_overlap:
        raise AlignmentError(f"the common cells are {ref['cells_kept']} of {unique} in {reference}, a share below {min_overlap}")


def lacking_cells(base: DataFrame, other: DataFrame) -> DataFrame:
    """Cells of ``base`` that ``other`` does not have."""
    return base.select("cell_id").distinct().join(other.select("cell_id"), "cell_id", "left_anti")


def attach_modality(cells: DataFrame, table: DataFrame, flag: str) -> DataFrame:
    """Left join of an optional per-cell table with a presence flag."""
    return cells.join(table.withColumn(flag, F.lit(True)), "cell_id", "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def id_overlap(id_sets: Mapping[str, DataFrame]) -> DataFrame:
    """Every ordered pair of modalities: shared cells, cells only in the first, share of the first."""
    table = membership(id_sets)
    aggs = []
    for a in id_sets:
        for b in id_sets:
            if a == b:
                continue
            in_a, in_b = F.col(f"in_{a}") > 0, F.col(f"in_{b}") > 0
            aggs.append(F.struct(F.lit(a).alias("first"), F.lit(b).alias("second"), F.count_if(in_a & in_b).alias("shared"),
                                 F.count_if(in_a & ~in_b).alias("only_first"), F.count_if(in_a).alias("n_first")))
    out = table.agg(F.array(*aggs).alias("_r")).select(F.explode("_r").alias("_r")).select("_r.*")
    return out.withColumn("pct_of_first", F.try_divide(F.lit(100.0) * F.col("shared"), F.col("n_first")))


def id_patterns(ids: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    """Share of ids matching each named pattern."""
    stats = ids.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("cell_id").rlike(p)).alias(k) for k, p in patterns.items()])
    pairs = F.array(*[F.struct(F.lit(k).alias("pattern"), F.col(k).alias("n_matching"), F.try_divide(F.col(k), F.col("n")).alias("fraction")) for k in patterns])
    return stats.select(F.explode(pairs).alias("_r")).select("_r.*")
