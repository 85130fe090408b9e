"""Completion of sparse tables with implicit zeros."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def complete(base: DataFrame, levels: DataFrame, level: str) -> DataFrame:
    """Every row of ``base`` once per value of ``level`` (a panel or target list, gathered into one array row)."""
    listed = levels.select(level).distinct().agg(F.sort_array(F.collect_list(level)).alias("_levels"))
    return base.crossJoin(F.broadcast(listed)).withColumn(level, F.explode("_levels")).drop("_levels")  # one broadcast row


def dense_panel(cells: DataFrame, counts: DataFrame, panel: DataFrame, value: str = "count") -> DataFrame:
    """(cell_id, protein, value) for all given cells and a small panel, zeros filled in.

    The stored counts of a cell become one map, so filling needs a single shuffle
    and no join on (cell, protein).
    """
    entry = F.struct("protein", F.col(value).alias("v"))
    maps = counts.groupBy("cell_id").agg(F.map_from_entries(F.collect_list(entry)).alias("_m"))  # at most one entry per antibody
    full = complete(cells.join(maps, "cell_id", "left"), panel, "protein")
    return full.withColumn(value, F.coalesce(F.element_at("_m", F.col("protein")), F.lit(0)))


def sparse_to_wide(df: DataFrame, key: str, column: str, value: str, levels: Sequence[str], prefix: str = "") -> DataFrame:
    """Presentation pivot over known levels."""
    return df.groupBy(key).agg(*[F.max(F.when(F.col(column) == v, F.col(value))).alias(f"{prefix}{v}") for v in levels])
