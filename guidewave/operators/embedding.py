"""Variable genes, scaling, principal components and joint spaces."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.session import cut_lineage

#: fixed value: MAD of a normal sample relative to its standard deviation
_MAD_NORMAL = 0.6744897501960817


def gene_dispersion(expr: DataFrame, n_cells: DataFrame, value: str = "lognorm") -> DataFrame:
    """Mean and dispersion of de-logged values per gene, zeros included; ``n_cells(n_cells)`` is one row."""
    e = F.expm1(F.col(value))
    sums = expr.groupBy("feature").agg(F.sum(e).alias("_s"), F.sum(e * e).alias("_q"))
    n = F.col("n_cells").cast("double")
    mean = F.col("_s") / n
    var = F.greatest(F.lit(0.0), (F.col("_q") / n - mean * mean) * n / F.greatest(n - 1, F.lit(1.0)))
    out = sums.crossJoin(F.broadcast(n_cells)).withColumn("mean", F.when(mean == 0, 1e-12).otherwise(mean)).withColumn("var", var)
    return out.withColumn("dispersion", F.col("var") / F.col("mean")).drop("_s", "_q", "n_cells")


def variable_genes(expr: DataFrame, n_cells: DataFrame, n_top: int = 2000, flavor: str = "seurat", n_bins: int = 20, value: str = "lognorm") -> DataFrame:
    """Genes with their normalised dispersion and the ``highly_variable`` flag of the n largest.

    The gene table has one row per gene; its windows are over mean bins.  It is
    written once: bin edges are genes' own means, and a second evaluation may
    differ in the last bit and move such a gene to the next bin.
    """
    genes = cut_lineage(gene_dispersion(expr, n_cells, value))
    if flavor == "seurat":
        genes = genes.withColumn("dispersion", F.when(F.col("dispersion") > 0, F.log("dispersion"))).withColumn("mean", F.log1p("mean"))
        span = genes.agg(F.min("mean").alias("_lo"), F.max("mean").alias("_hi"))
        width = (F.col("_hi") - F.col("_lo")) / n_bins
        # right-closed equal-width bins
        bin_no = F.when(width > 0, F.greatest(F.lit(1), F.ceil((F.col("mean") - F.col("_lo")) / width))).otherwise(1)
        genes = genes.crossJoin(F.broadcast(span)).withColumn("bin", F.least(F.lit(n_bins), bin_no).cast("int")).drop("_lo", "_hi")
        w = W.partitionBy("bin")
        single = F.count("dispersion").over(w) == 1
        centre = F.when(single, 0.0).otherwise(F.avg("dispersion").over(w))
        spread = F.when(single, F.avg("dispersion").over(w)).otherwise(F.stddev_samp("dispersion").over(w))
    elif flavor == "cell_ranger":
        cuts = [q / 100 for q in range(10, 101, 5)]
        edges = genes.agg(F.percentile("mean", F.array(*[F.lit(q) for q in cuts])).alias("_cuts"))  # the gene table
        genes = genes.crossJoin(F.broadcast(edges)).withColumn("bin", F.size(F.filter("_cuts", lambda c: c < F.col("mean")))).drop("_cuts")
        w = W.partitionBy("bin")
        centre = F.median("dispersion").over(w)
        genes = genes.withColumn("_centre", centre)
        spread = F.median(F.abs(F.col("dispersion") - F.col("_centre"))).over(w) / _MAD_NORMAL
        centre = F.col("_centre")
    else:
        raise ValueError(f"unknown flavor: {flavor}")
    genes = genes.withColumn("_c", centre).withColumn("_s", spread).withColumn("dispersion_norm", F.try_divide(F.col("dispersion") - F.col("_c"), F.col("_s")))
    order = W.orderBy(F.col("dispersion_norm").desc_nulls_last(), F.col("feature"))
    return genes.withColumn("hvg_rank", F.row_number().over(order)).withColumn("highly_variable", F.col("hvg_rank") <= n_top).drop("_c", "_s", "_centre")


def scale_moments(expr: DataFrame, genes: DataFrame, n_cells: DataFrame, value: str = "lognorm") -> DataFrame:
    """``genes`` with their mean and unbiased standard deviation over all cells (a constant gene scales by 1)."""
    sums = expr.join(genes.select("feature"), "feature", "left_semi").groupBy("feature").agg(F.sum(value).alias("_s"), F.sum(F.col(value) * F.col(value)).alias("_q"))
    n = F.col("n_cells").cast("double")
    out = genes.join(sums, "feature", "left").na.fill(0, ["_s", "_q"]).crossJoin(F.broadcast(n_cells))
    mu = F.col("_s") / n
    sd = F.sqrt(F.greatest(F.lit(0.0), (F.col("_q") / n - mu * mu) * n / F.greatest(n - 1, F.lit(1.0))))
    return out.withColumn("mu", mu).withColumn("sd", F.when(sd > 0, sd).otherwise(1.0)).drop("_s", "_q", "n_cells")


def scaled_vectors(cells: DataFrame, expr: DataFrame, moments: DataFrame, clip: float | None = 10.0, scale: bool = True, value: str = "lognorm") -> DataFrame:
    """Dense scaled vector per cell over an ordered gene list (``moments`` has pos, mu, sd).

    A cell's stored genes travel as index and value arrays (bounded by the gene
    list) and are scattered to a dense row in Arrow batches.
    """
    table = moments.orderBy("pos").select("mu", "sd").toPandas()  # the selected genes, a few thousand numbers
    mu = table["mu"].to_numpy()
    sd = table["sd"].to_numpy() if scale else np.ones(len(table))

    @F.pandas_udf("array<double>")
    def densify(index: pd.Series, values: pd.Series) -> pd.Series:
        block = np.zeros((len(index), len(mu)))
        for row, (i, v) in enumerate(zip(index, values)):
            if i is not None:
                block[row, np.asarray(i)] = v
        block = (block - mu) / sd
        if clip is not None and scale:
            np.clip(block, -clip, clip, out=block)
        return pd.Series(list(block))

    stored = expr.join(moments.select("feature", "pos"), "feature").groupBy("cell_id").agg(F.collect_list(F.struct("pos", value)).alias("_r"))
    rows = cells.select("cell_id").join(stored, "cell_id", "left")
    return rows.select("cell_id", densify(F.col("_r.pos"), F.col(f"_r.{value}")).alias("vec"))


def principal_components(vectors: DataFrame, n_components: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(scores(cell_id, vec), loadings(pos, pc, value), variance(pc, ratio)).

    The covariance is summed on the executors; the sign of each axis is fixed by
    its largest loading.
    """
    spark = vectors.sparkSession
    ready = cut_lineage(vectors.withColumn("_v", array_to_vector("vec")))
    model = PCA(k=n_components, inputCol="_v", outputCol="_pc").fit(ready)
    axes = model.pc.toArray()
    signs = np.sign(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])])
    axes = axes * np.where(signs == 0, 1.0, signs)
    shares = model.explainedVariance.toArray()
    offset = _column_means(ready) @ axes

    @F.pandas_udf("array<double>")
    def project(vec: pd.Series) -> pd.Series:
        return pd.Series(list(np.stack([np.asarray(v) for v in vec]) @ axes - offset))

    scores = ready.select("cell_id", project("vec").alias("vec"))
    loadings = spark.createDataFrame([(i, j + 1, float(axes[i, j])) for i in range(axes.shape[0]) for j in range(axes.shape[1])], "pos int, pc int, value double")
    variance = spark.createDataFrame([(j + 1, float(v)) for j, v in enumerate(shares)], "pc int, ratio double")
    return scores, loadings, variance


def _column_means(vectors: DataFrame) -> np.ndarray:
    from pyspark.ml.stat import Summarizer

    return vectors.select(Summarizer.mean(F.col("_v")).alias("m")).first()["m"].toArray()


def rna_pca(cells: DataFrame, expr: DataFrame, genes: DataFrame, n_cells: DataFrame, n_components: int = 50, clip: float | None = 10.0, scale: bool = True, value: str = "lognorm"):
    """PCA of the selected genes (``genes(feature, pos)``)."""
    moments = scale_moments(expr, genes, n_cells, value)
    return principal_components(scaled_vectors(cells, expr, moments, clip, scale, value), n_components)


def protein_pca(values: DataFrame, panel: DataFrame, n_components: int = 10, value: str = "value"):
    """PCA of a protein representation without isotype controls; cells with a missing value are left out."""
    targets = panel.where(~F.col("is_isotype")).select("protein")
    order = targets.agg(F.sort_array(F.collect_list("protein")).alias("_o"))  # the panel
    rows = values.join(targets, "protein", "left_semi").groupBy("cell_id").agg(F.sort_array(F.collect_list(F.struct("protein", value))).alias("_r"))
    full = rows.crossJoin(F.broadcast(order)).where(F.size("_r") == F.size("_o")).where(~F.exists("_r", lambda r: r[value].isNull()))
    vectors = full.select("cell_id", F.transform("_r", lambda r: r[value]).alias("vec"))
    return principal_components(standardise(vectors), n_components)


def standardise(vectors: DataFrame) -> DataFrame:
    """Zero mean, unit (unbiased) variance per axis; a constant axis scales by 1."""
    from pyspark.ml.feature import StandardScaler

    ready = cut_lineage(vectors.withColumn("_v", array_to_vector("vec")))
    model = StandardScaler(withMean=True, withStd=True, inputCol="_v", outputCol="_s").fit(ready)
    return model.transform(ready).select("cell_id", vector_to_array("_s").alias("vec"))


def block_scale(vectors: DataFrame) -> DataFrame:
    """Divide a block by the square root of its total (population) variance."""
    axes = vectors.select(F.posexplode("vec").alias("axis", "x")).groupBy("axis").agg(F.var_pop("x").alias("v"))
    total = axes.agg(F.sum("v").alias("_t"))
    scale = F.when(F.col("_t") > 0, F.sqrt("_t")).otherwise(1.0)
    return vectors.crossJoin(F.broadcast(total)).withColumn("_f", scale).withColumn("vec", F.transform("vec", lambda x: x / F.col("_f"))).drop("_t", "_f")


def joint_space(first: DataFrame, second: DataFrame, weight: float = 1.0) -> DataFrame:
    """Concatenate two block-scaled spaces; cells missing from the second get no joint vector."""
    a = block_scale(first)
    b = block_scale(second).select("cell_id", F.transform("vec", lambda x: x * F.lit(float(weight))).alias("_b"))
    return a.join(b, "cell_id", "left").select("cell_id", F.when(F.col("_b").isNotNull(), F.concat("vec", "_b")).alias("vec"))


def component_correlations(scores: DataFrame, covariates: DataFrame, columns: dict[str, str], n_components: int = 5) -> DataFrame:
    """|Pearson| of the first components with each covariate, rounded to three digits."""
    joined = scores.join(covariates, "cell_id")
    aggs = [F.round(F.abs(F.corr(F.element_at("vec", i + 1), F.col(src).cast("double"))), 3).alias(f"{name}|{i + 1}") for name, src in columns.items() for i in range(n_components)]
    wide = joined.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(name).alias("covariate"), F.lit(i + 1).alias("pc"), F.col(f"`{name}|{i + 1}`").alias("abs_r")) for name in columns for i in range(n_components)])
    return wide.select(F.explode(rows).alias("_r")).select("_r.*")
