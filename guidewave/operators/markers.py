"""Markers by multinomial regression: one coefficient per (cluster, gene), fitted on sparse vectors inside Spark."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ..functions.session import shared_path


def sparse_rows(cells: DataFrame, expr: DataFrame, genes: DataFrame, label: str, value: str) -> DataFrame:
    """(cell_id, label, features): a sparse vector per cell over ``genes(feature, pos)``, a cell without values is empty.

    The vectors are assembled as plain structs, written once, and read back as vectors.
    """
    size = genes.count()
    stored = expr.join(F.broadcast(genes.select("feature", F.col("pos").cast("int").alias("pos"))), "feature").where(F.col(value) != 0)
    rows = stored.groupBy("cell_id").agg(F.array_sort(F.collect_list(F.struct("pos", F.col(value).cast("double").alias("x")))).alias("_r"))  # at most one entry a gene
    full = cells.join(rows, "cell_id", "left")
    none = F.array().cast("array<struct<pos:int,x:double>>")
    entries = F.coalesce("_r", none)
    vector = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), F.transform(entries, lambda r: r["pos"]).alias("indices"), F.transform(entries, lambda r: r["x"]).alias("values"))
    path = shared_path(cells.sparkSession, "vectors")
    full.select("cell_id", F.col(label).cast("double").alias("label"), vector.alias("features")).write.parquet(path)
    kinds = T.StructType([cells.schema["cell_id"], T.StructField("label", T.DoubleType()), T.StructField("features", VectorUDT())])
    return cells.sparkSession.read.schema(kinds).parquet(path)


def regression_markers(cells: DataFrame, expr: DataFrame, features: DataFrame, strength: float = 1.0, cluster: str = "cluster", value: str = "lognorm", max_iter: int = 1000, tolerance: float = 1e-10) -> tuple[DataFrame, DataFrame]:
    """(markers, gradient) of a multinomial regression of the cluster on all genes.

    The penalty is ``1 / (2 strength)`` times the squared coefficients beside the summed
    log loss; intercepts are free and genes are not rescaled.  ``markers(cluster, feature,
    coefficient, rank)``: genes by falling coefficient, ties by name.  ``gradient(cluster,
    feature, gradient)``: the derivative per cell of the objective by every coefficient
    (feature null: the intercept) at the result, summed anew from the cells; it is 0 at
    the optimum.
    """
    spark = cells.sparkSession
    names = cells.select(F.col(cluster).cast("string").alias("cluster")).distinct().withColumn("no", F.row_number().over(W.orderBy("cluster")) - 1)  # one row per cluster
    genes = features.select("feature").distinct().withColumn("pos", F.row_number().over(W.orderBy("feature")) - 1)  # one row per gene
    numbered = cells.select("cell_id", F.col(cluster).cast("string").alias("cluster")).join(F.broadcast(names), "cluster")
    rows = sparse_rows(numbered, expr, genes, "no", value)
    n = rows.count()
    penalty = 1.0 / (strength * n)
    model = LogisticRegression(family="multinomial", regParam=penalty, elasticNetParam=0.0, standardization=False, maxIter=max_iter, tol=tolerance).fit(rows)
    weights = model.coefficientMatrix.toArray()  # clusters x genes
    ordered, labels = [r["feature"] for r in genes.orderBy("pos").collect()], [r["cluster"] for r in names.orderBy("no").collect()]
    table = [(labels[c], ordered[g], float(weights[c, g])) for c in range(len(labels)) for g in range(len(ordered))]
    found = spark.createDataFrame(table, "cluster string, feature string, coefficient double")
    rank = F.row_number().over(W.partitionBy("cluster").orderBy(F.desc("coefficient"), "feature"))  # the gene table of a cluster
    return found.withColumn("rank", rank), _gradient(model.transform(rows), expr.select("cell_id", "feature", F.col(value).alias("x")).join(F.broadcast(genes.select("feature")), "feature", "left_semi"), names, found, penalty, n, len(labels))


def _gradient(fitted: DataFrame, stored: DataFrame, names: DataFrame, found: DataFrame, penalty: float, n: int, n_clusters: int) -> DataFrame:
    """Mean of (probability - membership) x value over the cells, plus the penalty's share; stored values only are met."""
    residual = F.transform(vector_to_array("probability"), lambda q, c: q - F.when(c == F.col("label"), 1.0).otherwise(0.0))
    rows = fitted.select("cell_id", residual.alias("residual"))
    mean = lambda weight: F.array(*[F.sum(F.col("residual")[c] * weight) / n for c in range(n_clusters)]).alias("part")
    sums = rows.join(stored, "cell_id").groupBy("feature").agg(mean(F.col("x")))
    each = lambda df: df.select(*[c for c in df.columns if c != "part"], F.posexplode("part").alias("no", "part")).join(F.broadcast(names), "no").drop("no")
    slopes = found.join(each(sums), ["cluster", "feature"], "left").select("cluster", "feature", (F.coalesce("part", F.lit(0.0)) + penalty * F.col("coefficient")).alias("gradient"))
    free = each(rows.agg(mean(F.lit(1.0)))).select("cluster", F.lit(None).cast("string").alias("feature"), F.col("part").alias("gradient"))
    return slopes.unionByName(free)
