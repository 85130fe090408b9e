"""Lanes, modalities and the canonical input bundle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import LANE_SEPARATOR, lane_cell_id
from .text import InputError


@dataclass
class ScreenInputs:
    """Lazy tables of one screen: long matrices by modality, features, assignments, metadata, lanes."""

    matrices: dict[str, DataFrame]
    features: DataFrame | None = None
    assignments: DataFrame | None = None
    metadata: DataFrame | None = None
    lanes: DataFrame | None = None
    provenance: dict[str, str] = field(default_factory=dict)


def concat_lanes(parts: Sequence[tuple[str, DataFrame]], check: bool = True, features: Sequence[tuple[str, DataFrame]] = ()) -> tuple[DataFrame, DataFrame]:
    """(long matrix with ``<barcode>__<lane>`` ids, lane table).

    Lane ids must be unique and free of the separator; ids repeated after
    suffixing are an error.  With the lanes' feature tables (pos, feature_id),
    lanes that list other features or another order are an error too; stored
    values alone cannot tell, as zeros are not stored.
    """
    if check and features and not lane_features_differ(features).isEmpty():
        raise InputError("the lanes do not list the same features in the same order")
    ids = [lane for lane, _ in parts]
    if len(set(ids)) != len(ids):
        raise InputError(f"lane ids must be unique: {ids}")
    if any(LANE_SEPARATOR in lane for lane in ids):
        raise InputError(f"lane ids must not contain {LANE_SEPARATOR}")
    merged = reduce(DataFrame.unionByName, [df.withColumn("barcode_original", F.col("cell_id")).withColumn("lane_id", F.lit(lane)) for lane, df in parts])
    merged = merged.withColumn("cell_id", lane_cell_id(F.col("barcode_original"), F.col("lane_id")))
    if check and not repeated_entries(merged).isEmpty():
        raise InputError("cell and feature pairs repeat inside a lane")
    table = merged.select("cell_id", "barcode_original", "lane_id").distinct()
    return merged.drop("barcode_original", "lane_id"), table


def repeated_entries(expr: DataFrame) -> DataFrame:
    return expr.groupBy("cell_id", "feature").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def lane_features_differ(features: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Features not listed by every lane at the same position; empty when the lanes share one reference."""
    all_rows = reduce(DataFrame.unionByName, [df.select("pos", F.col("feature_id")).withColumn("lane_id", F.lit(lane)) for lane, df in features])
    return all_rows.groupBy("pos", "feature_id").agg(F.count(F.lit(1)).alias("n_lanes")).where(F.col("n_lanes") < len(features))


def attach_lane_sheet(lanes: DataFrame, sheet: DataFrame, check: bool = True) -> DataFrame:
    """Sample-sheet columns on the lane table: unique rows, every lane present, no column clash."""
    clash = (set(sheet.columns) & set(lanes.columns)) - {"lane_id"}
    if clash:
        raise InputError(f"sample sheet repeats columns {sorted(clash)}")
    if check:
        if not sheet.groupBy("lane_id").count().where("count > 1").isEmpty():
            raise InputError("sample sheet lists a lane twice")
        if not lanes.select("lane_id").distinct().join(sheet, "lane_id", "left_anti").isEmpty():
            raise InputError("a lane is missing from the sample sheet")
    return lanes.join(sheet, "lane_id", "left")


def unclaimed_types(features: DataFrame, wanted: Mapping[str, Sequence[str]]) -> DataFrame:
    """Feature types present in the data but listed under no modality."""
    listed = [t for labels in wanted.values() for t in labels]
    return features.where(~F.col("feature_type").isin(listed)).groupBy("feature_type").agg(F.count(F.lit(1)).alias("n_features"))


def split_feature_types(expr: DataFrame, features: DataFrame, wanted: Mapping[str, Sequence[str]], check: bool = True) -> DataFrame:
    """Combined matrix with a ``modality`` column from the feature type."""
    if check:
        left = [r["feature_type"] for r in unclaimed_types(features, wanted).limit(20).collect()]
        if left:
            raise InputError(f"feature types assigned to no modality: {left}")
    modality = None
    for name, labels in wanted.items():
        if labels:
            cond = F.col("feature_type").isin(list(labels))
            modality = F.when(cond, name) if modality is None else modality.when(cond, name)
    typed = features.select(F.col("feature_id").alias("feature"), modality.alias("modality")).where("modality IS NOT NULL")
    return expr.join(typed, "feature")


def keep_types(expr: DataFrame, features: DataFrame, types: Sequence[str]) -> DataFrame:
    return expr.join(features.where(F.col("feature_type").isin(list(types))).select(F.col("feature_id").alias("feature")), "feature", "left_semi")


def first_cells(expr: DataFrame, cells: DataFrame, n: int) -> DataFrame:
    """Entries of the first ``n`` cells in file order (``cells(cell_id, pos)``)."""
    return expr.join(cells.where(F.col("pos") < n).select("cell_id"), "cell_id", "left_semi")


def read_slot(spark: SparkSession, root: str, slot: str, key: str = "") -> DataFrame:
    """One matrix of a slot-partitioned table set; a missing slot is an error."""
    df = spark.read.parquet(root).where((F.col("slot") == slot) & (F.col("key") == (key or "-")))
    if df.isEmpty():
        raise InputError(f"slot {slot} with key {key!r} is not in {root}")
    return df.select("cell_id", "feature", "value")


def write_slot(expr: DataFrame, root: str, slot: str, key: str = "") -> None:
    expr.select("cell_id", "feature", F.col("value").cast("double").alias("value"), F.lit(slot).alias("slot"), F.lit(key or "-").alias("key")).write.mode("append").partitionBy("slot", "key").parquet(root)


def load_inputs(matrices: Mapping[str, DataFrame], combined: tuple[DataFrame, DataFrame, Mapping[str, Sequence[str]]] | None = None, assignments: DataFrame | None = None,
                metadata: DataFrame | None = None, lanes: DataFrame | None = None) -> ScreenInputs:
    """Canonical bundle; a modality given both on its own and inside the combined matrix is an error."""
    found = dict(matrices)
    features = None
    origin = {name: "own matrix" for name in matrices}
    if combined is not None:
        expr, features, wanted = combined
        tagged = split_feature_types(expr, features, wanted)
        for name in (m for m, labels in wanted.items() if labels):
            if name in found:
                raise InputError(f"{name} is declared twice")
            found[name] = tagged.where(F.col("modality") == name).drop("modality")
            origin[name] = "combined matrix"
    return ScreenInputs(found, features, assignments, metadata, lanes, origin)


def map_entries(df: DataFrame, key: str, value: str) -> DataFrame:
    """(entry, mapped) of a guide-to-target or antibody map, of any size; a key that is listed twice is an error when it is read."""
    entries = df.groupBy(F.col(key).alias("entry")).agg(F.first(value).alias("mapped"), F.count(F.lit(1)).alias("_times"))
    twice = F.raise_error(F.concat(F.lit(f"{key} is repeated in the map table: "), F.col("entry").cast("string")))
    return entries.select("entry", F.when(F.col("_times") == 1, F.col("mapped")).otherwise(twice).alias("mapped"))
