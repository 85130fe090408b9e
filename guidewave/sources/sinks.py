"""Result tables, processed table sets, manifests and subsets in the input layout."""

from __future__ import annotations

import json
from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def result_catalog(tables: Mapping[str, DataFrame | None]) -> dict[str, DataFrame]:
    """Named results that exist and have rows (only the first row of each is looked at)."""
    return {name: df for name, df in tables.items() if df is not None and not df.isEmpty()}


def write_results(tables: Mapping[str, DataFrame], root: str, fmt: str = "csv", cell_tables: tuple[str, ...] = ()) -> dict[str, str]:
    """One folder per table under ``tables/``; CSV cell tables are gzipped."""
    paths = {}
    for name, df in tables.items():
        path = f"{root}/tables/{name}"
        writer = df.write.mode("overwrite")
        if fmt == "csv":
            writer.option("header", True).option("compression", "gzip" if name in cell_tables else "none").csv(path)
        else:
            writer.parquet(path)
        paths[name] = path
    return paths


def write_processed(slots: Mapping[str, DataFrame], root: str, content: Mapping[str, str] | None = None, prefilter: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Processed table set: one Parquet table per slot, optional pre-filter variants, and a schema table."""
    spark = next(iter(slots.values())).sparkSession
    rows = []
    for status, group in (("final", slots), ("prefilter", prefilter or {})):
        for name, df in group.items():
            path = f"{root}/{name}" if status == "final" else f"{root}/prefilter/{name}"
            df.write.mode("overwrite").parquet(path)
            rows.append((name, spark.read.parquet(path).count(), ", ".join(f"{c} {t}" for c, t in df.dtypes), (content or {}).get(name, ""), status))
    schema = spark.createDataFrame(rows, "name string, n_rows bigint, columns string, content string, status string")
    schema.write.mode("overwrite").parquet(f"{root}/schema")
    return schema


def run_manifest(spark: SparkSession, info: Mapping[str, object], path: str | None = None) -> DataFrame:
    """Run information as (key, value) rows, nested keys joined by dots; optionally written as JSON."""
    flat: list[tuple[str, str]] = []

    def walk(prefix: str, value: object) -> None:
        if isinstance(value, Mapping):
            for k in value:
                walk(f"{prefix}.{k}" if prefix else str(k), value[k])
        else:
            flat.append((prefix, json.dumps(value, default=str)))

    walk("", info)
    df = spark.createDataFrame(flat, "key string, value string")
    if path:
        df.write.mode("overwrite").json(path)
    return df


def write_triplets(expr: DataFrame, cells: DataFrame, features: DataFrame, root: str) -> None:
    """Chosen cells in the triplet layout: barcodes, features and 1-based coordinates.

    ``cells(cell_id, pos)`` and ``features(feature_id, feature_name, feature_type, pos)``
    give the axes; new indices are dense positions found per range of the old ones.
    """
    c, f = dense_positions(cells, "pos"), dense_positions(features, "pos")
    entries = expr.join(c.select("cell_id", F.col("new_pos").alias("col")), "cell_id").join(f.select(F.col("feature_id").alias("feature"), F.col("new_pos").alias("row")), "feature")
    entries = entries.where("value <> 0").select("row", "col", "value")
    dims = entries.agg(F.count(F.lit(1)).alias("n")).crossJoin(f.agg(F.count(F.lit(1)).alias("nf"))).crossJoin(c.agg(F.count(F.lit(1)).alias("nc")))  # one row each
    head = dims.select(F.array(F.lit("%%MatrixMarket matrix coordinate integer general"), F.concat_ws(" ", "nf", "nc", "n")).alias("_l")).select(F.posexplode("_l").alias("pos", "value"))
    # two header lines in a file of their own, the entries beside it in parallel parts
    head.orderBy("pos").coalesce(1).select("value").write.mode("overwrite").text(f"{root}/matrix.mtx")
    line = F.concat_ws(" ", (F.col("row") + 1).cast("string"), (F.col("col") + 1).cast("string"), F.col("value").cast("bigint").cast("string"))
    entries.select(line.alias("value")).write.mode("append").text(f"{root}/matrix.mtx")
    c.orderBy("new_pos").select(F.col("cell_id").cast("string").alias("value")).write.mode("overwrite").text(f"{root}/barcodes.tsv")
    f.orderBy("new_pos").select(F.concat_ws("\t", "feature_id", "feature_name", "feature_type").alias("value")).write.mode("overwrite").text(f"{root}/features.tsv")


def write_typed_table(table: DataFrame, types: Mapping[str, str], path: str) -> None:
    """CSV with a line of column types after the header of every file; one file per partition, so no task holds the table."""
    table = table.select(*[F.col(c).cast("string").alias(c) for c in types])

    def with_types(batches):
        first = True
        for batch in batches:
            if first and batch.num_rows:
                first = False
                yield pa.RecordBatch.from_arrays([pa.array([t], f.type) for t, f in zip(types.values(), batch.schema)], schema=batch.schema)
            yield batch

    # the writer must not split a partition: the line of types stands once in it
    table.mapInArrow(with_types, table.schema).write.option("header", True).option("maxRecordsPerFile", 0).option("emptyValue", "").csv(path)


def dense_positions(df: DataFrame, order: str) -> DataFrame:
    """``new_pos``: 0-based rank by ``order``, computed per value range and shifted by the earlier ranges."""
    width = 1 << 16
    rows = df.withColumn("_b", F.floor(F.col(order) / width))
    counts = rows.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    earlier = W.orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("_b", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_o"))
    inside = F.row_number().over(W.partitionBy("_b").orderBy(order))
    return rows.join(offsets, "_b").withColumn("new_pos", F.col("_o") + inside - 1).drop("_b", "_o")
