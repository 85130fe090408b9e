"""File inventory of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import numbered_lines, separator_for

#: fixed values: file name endings of candidate inputs
TABULAR_ENDINGS = (".csv", ".tsv", ".txt", ".tab", ".csv.gz", ".tsv.gz", ".txt.gz", ".mtx", ".mtx.gz")


def discover(spark: SparkSession, root: str, endings: tuple[str, ...] = TABULAR_ENDINGS) -> DataFrame:
    """(path, bytes, gzipped) of candidate files below ``root``, from file metadata only."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", F.col("length").alias("bytes"))
    name = F.lower("path")
    keep = F.lit(False)
    for e in endings:
        keep = keep | name.endswith(e)
    hidden = F.element_at(F.split("path", "/"), -1).startswith(".")
    return files.where(keep & ~hidden).withColumn("gzipped", name.endswith(".gz"))


def inspect_text(spark: SparkSession, paths: list[str], separator: str = "auto") -> DataFrame:
    """(file, n_lines, n_columns, first_column) per text file."""
    lines = numbered_lines(spark, paths)
    parts = F.split("value", separator_for(paths[0], separator))
    header = lines.where("pos = 0").select("file", F.size(parts).alias("n_columns"), F.element_at(parts, 1).alias("first_column"))
    return lines.groupBy("file").agg(F.count(F.lit(1)).alias("n_lines")).join(header, "file")


def fingerprints(spark: SparkSession, root: str) -> DataFrame:
    """SHA-256 of every file's content by relative path, for byte comparison of two preparations."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("digest"), F.col("length").alias("bytes"))
