"""Text layouts: dense matrices, coordinate triplets, positional lists, tables."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.scalars import split_list


class InputError(ValueError):
    """An input file does not have the declared layout."""


def separator_for(path: str, separator: str = "auto") -> str:
    """Separator from the setting or the file name (a trailing ``.gz`` is ignored)."""
    if separator != "auto":
        return {"tab": "\t", "\\t": "\t", "comma": ","}.get(separator, separator)
    name = path.lower().rstrip("/").removesuffix(".gz")
    return "," if name.endswith(".csv") else "\t"


def _lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return spark.read.text(paths if isinstance(paths, str) else list(paths)).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("_id"))


def numbered_lines(spark: SparkSession, paths: str | Sequence[str], across_files: bool = False) -> DataFrame:
    """(file, pos, value) with the 0-based line number, per file or over the files of a folder in name order.

    Lines are numbered inside their file block (a split of bounded size) and
    shifted by the line counts of the earlier blocks, so no task sees a whole file.
    """
    rows = _lines(spark, paths).withColumn("_k", F.row_number().over(W.partitionBy("file", "block").orderBy("_id")))
    counts = _lines(spark, paths).groupBy("file", "block").agg(F.count(F.lit(1)).alias("_n"))
    # one row per file block
    earlier = (W.orderBy("file", "block") if across_files else W.partitionBy("file").orderBy("block")).rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("file", "block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_o"))
    return rows.join(offsets, ["file", "block"]).select("file", (F.col("_o") + F.col("_k") - 1).alias("pos"), "value")


def _parts(separator: str):
    cells = F.split(F.regexp_replace("value", "\r$", ""), re.escape(separator), -1)
    return F.transform(cells, lambda c: F.regexp_replace(c, '^"|"$', ""))


def read_dense_matrix(spark: SparkSession, paths: str | Sequence[str], orientation: str = "features_x_cells", separator: str = "auto") -> DataFrame:
    """expr(cell_id, feature, value) from wide text; non-zero values only.

    The header is one axis, the first column the other.  The header becomes a
    position table joined to the exploded values, so a file with many thousand
    columns never turns into a schema.
    """
    first = paths if isinstance(paths, str) else paths[0]
    lines = numbered_lines(spark, paths).withColumn("_p", _parts(separator_for(first, separator)))
    header = lines.where("pos = 0").select("file", F.posexplode("_p").alias("col", "column")).where("col > 0")
    body = lines.where("pos > 0 AND value <> ''").select("file", F.element_at("_p", 1).alias("row"), F.posexplode("_p").alias("col", "text")).where("col > 0")
    values = body.withColumn("value", F.expr("try_cast(text AS DOUBLE)")).where("value <> 0")
    long = values.join(header, ["file", "col"])
    cell, feature = ("column", "row") if orientation == "features_x_cells" else ("row", "column")
    return long.select(F.col(cell).alias("cell_id"), F.col(feature).alias("feature"), "value")


def feature_axis(spark: SparkSession, paths: Sequence[str], orientation: str = "features_x_cells", separator: str = "auto") -> DataFrame:
    """(file, pos, feature) of every file."""
    lines = numbered_lines(spark, paths).withColumn("_p", _parts(separator_for(paths[0], separator)))
    if orientation == "features_x_cells":
        return lines.where("pos > 0 AND value <> ''").select("file", "pos", F.element_at("_p", 1).alias("feature"))
    return lines.where("pos = 0").select("file", F.posexplode("_p").alias("pos", "feature")).where("pos > 0").withColumn("pos", F.col("pos").cast("bigint"))


def axis_differences(axis: DataFrame) -> DataFrame:
    """(pos, feature) entries that are not in every file; empty when the axes agree."""
    files = axis.select("file").distinct().agg(F.count(F.lit(1)).alias("_n"))
    seen = axis.groupBy("pos", "feature").agg(F.count(F.lit(1)).alias("n_files"))
    return seen.crossJoin(F.broadcast(files)).where(F.col("n_files") < F.col("_n")).drop("_n")


def read_dense_files(spark: SparkSession, paths: Sequence[str], orientation: str = "features_x_cells", separator: str = "auto") -> DataFrame:
    """Several cell partitions of one matrix; their feature axes must agree in set and order."""
    if not axis_differences(feature_axis(spark, paths, orientation, separator)).isEmpty():
        raise InputError("the files do not share one feature axis")
    return read_dense_matrix(spark, paths, orientation, separator)


def positional_list(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """Tab-separated rows with their 0-based position."""
    parts = F.split("value", "\t", -1)
    rows = numbered_lines(spark, path, across_files=True).where("value <> ''")
    return rows.select("pos", *[F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)])


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """features(pos, feature_id, feature_name, feature_type); two-column files are gene expression."""
    df = positional_list(spark, path, ["feature_id", "feature_name", "feature_type"])
    return df.withColumn("feature_type", F.coalesce("feature_type", F.lit("Gene Expression")))


def read_triplets(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(entries(row, col, value) with 0-based indices and duplicates summed, one row of declared dimensions)."""
    lines = _lines(spark, path).where("trim(value) <> ''")
    num = lambda i, t: F.element_at(F.split(F.trim("value"), "\\s+"), i).cast(t)
    # only the first block of the file that opens with the banner can hold the dimension line
    order = W.partitionBy("file").orderBy("_id")
    head = lines.where("block = 0").withColumn("_banner", F.max(F.startswith("value", F.lit("%%MatrixMarket"))).over(W.partitionBy("file")))
    head = head.where("NOT startswith(value, '%')").withColumn("_dims", F.col("_banner") & (F.row_number().over(order) == 1))
    dims = head.where("_dims").select(num(1, "bigint").alias("n_features"), num(2, "bigint").alias("n_cells"), num(3, "bigint").alias("n_entries"))
    data = head.where("NOT _dims").select("value").unionByName(lines.where("block > 0 AND NOT startswith(value, '%')").select("value"))
    entries = data.select((num(1, "bigint") - 1).alias("row"), (num(2, "bigint") - 1).alias("col"), num(3, "double").alias("value"))
    return entries.groupBy("row", "col").agg(F.sum("value").alias("value")).where("value <> 0"), dims


def read_triplet_directory(spark: SparkSession, root: str, suffix: str = "", check: bool = True) -> tuple[DataFrame, DataFrame]:
    """(expr(cell_id, feature, value), features) of a features x cells triplet directory."""
    barcodes = positional_list(spark, f"{root}/barcodes.tsv{suffix}", ["barcode"])
    features = read_features(spark, f"{root}/features.tsv{suffix}")
    entries, dims = read_triplets(spark, f"{root}/matrix.mtx{suffix}")
    if check:
        d = dims.first()
        n_f, n_c = features.count(), barcodes.count()
        if (d["n_features"], d["n_cells"]) != (n_f, n_c):
            raise InputError(f"matrix is {d['n_features']} x {d['n_cells']} but there are {n_f} features and {n_c} barcodes")
    long = entries.join(features.select(F.col("pos").alias("row"), F.col("feature_id").alias("feature")), "row").join(barcodes.select(F.col("pos").alias("col"), F.col("barcode").alias("cell_id")), "col")
    return long.select("cell_id", "feature", "value"), features


def unique_names(features: DataFrame, column: str = "feature_name") -> DataFrame:
    """``feature``: repeated names get -1, -2, ..., skipping names that exist already.

    Names are those of a feature list (one row per gene).  A taken suffix shifts
    every later one of the same name; the rounds end when nothing collides.
    """
    order = W.partitionBy("_base").orderBy("pos")
    df = features.withColumn("_base", F.col(column)).withColumn("_n", F.row_number().over(order) - 1)
    taken = df.where("_n = 0").select(F.col("_base").alias("name"))
    numbered = df.where("_n > 0")
    # suffix numbers already used as plain names of the same base
    pattern = taken.select(F.regexp_extract("name", r"^(.*)-(\d+)$", 1).alias("_base"), F.regexp_extract("name", r"^(.*)-(\d+)$", 2).alias("_k")).where("_k <> '' AND _k NOT LIKE '0%'")
    used = pattern.groupBy("_base").agg(F.sort_array(F.collect_set(F.col("_k").cast("int"))).alias("_used"))
    shifted = numbered.join(used, "_base", "left").withColumn("_used", F.coalesce("_used", F.array().cast("array<int>")))
    free = F.aggregate("_used", F.col("_n"), lambda acc, k: F.when(k <= acc, acc + 1).otherwise(acc))
    renamed = shifted.withColumn("feature", F.concat("_base", F.lit("-"), free.cast("string"))).drop("_used")
    return df.where("_n = 0").withColumn("feature", F.col("_base")).unionByName(renamed).drop("_base", "_n")


def read_table(spark: SparkSession, path: str, separator: str = "auto", index: str | None = None, type_row: str = "auto") -> DataFrame:
    """Metadata table, every column a string; the second line of a file is dropped if it starts with TYPE.

    ``type_row="always"`` drops every second line, ``"never"`` none.  Without
    such a line the file is read as plain CSV; with one, its numbered lines are
    parsed, so that a later row named TYPE stays.
    """
    sep = separator_for(path, separator)
    options = {"sep": sep, "emptyValue": ""}
    df = spark.read.csv(path, header=True, inferSchema=False, nullValue=None, **options).na.fill("")
    if index is not None and index not in df.columns:
        raise InputError(f"column {index} not found (columns: {df.columns[:10]})")
    if type_row == "never":
        return df
    lines = numbered_lines(spark, path)
    second = F.col("pos") == 1 if type_row == "always" else (F.col("pos") == 1) & (F.upper(F.element_at(_parts(sep), 1)) == "TYPE")
    if lines.where(second).isEmpty():
        return df
    ddl = ", ".join(f"`{c.replace('`', '``')}` string" for c in df.columns)
    body = lines.where((F.col("pos") > 0) & ~second & (F.col("value") != ""))
    return body.select(F.from_csv("value", ddl, options).alias("_row")).select("_row.*").na.fill("")


def read_guide_assignments(spark: SparkSession, path: str, cell: str = "Cell", guides: str = "sgRNAs", list_separator: str = ",", separator: str = "auto") -> DataFrame:
    """(cell_id, guides ARRAY): trimmed members, empties removed."""
    df = read_table(spark, path, separator)
    for name in (cell, guides):
        if name not in df.columns:
            raise InputError(f"column {name} not found in the assignment file")
    return df.select(F.col(cell).alias("cell_id"), split_list(F.col(guides), list_separator).alias("guides"))


def read_embedding(spark: SparkSession, path: str, columns: Sequence[str], index: str = "NAME", separator: str = "auto") -> DataFrame:
    """(cell_id, vec) from named columns; a missing column is an error."""
    df = read_table(spark, path, separator, index)
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise InputError(f"embedding lacks columns {missing}")
    return df.select(F.col(index).alias("cell_id"), F.array(*[F.col(c).cast("double") for c in columns]).alias("vec"))
