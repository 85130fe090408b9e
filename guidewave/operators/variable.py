"""Variable genes from counts (variance over a fitted trend) and over batches."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.session import cut_lineage
from .embedding import variable_genes

#: share of the genes in a local fit
SPAN = 0.3


def local_quadratic(x: np.ndarray, y: np.ndarray, at: np.ndarray, span: float = SPAN) -> np.ndarray:
    """Fitted values at the points ``at``: quadratic least squares over the nearest share of points, tricube weights.

    Where the points near ``at`` do not determine a parabola (equal x), the least-norm fit counts.
    """
    order = np.argsort(x, kind="stable")
    x, y = x[order], y[order]
    q = max(1, min(len(x), math.floor(span * len(x) + 1e-5)))
    fitted = np.empty(len(at))
    for i, centre in enumerate(at):
        # the q nearest points are neighbours in the order of x
        middle = np.searchsorted(x, centre)
        low = max(0, middle - q)
        window = np.arange(low, min(len(x), middle + q))
        distance = np.abs(x[window] - centre)
        chosen = window[np.argsort(distance, kind="stable")[:q]]
        d = np.abs(x[chosen] - centre)
        reach = d.max()
        weight = np.clip(1 - (d / reach) ** 3, 0, None) ** 3 if reach > 0 else np.ones(len(d))
        root = np.sqrt(weight)
        u = x[chosen] - centre
        basis = np.stack([np.ones_like(u), u, u * u], axis=1)
        fitted[i] = np.linalg.lstsq(basis * root[:, None], y[chosen] * root, rcond=None)[0][0]
    return fitted


def count_moments(counts: DataFrame, cells: DataFrame, features: DataFrame, value: str = "count") -> DataFrame:
    """(batch, feature, n, mean, var): unbiased moments of counts over all cells of a batch, zeros included."""
    sizes = cells.groupBy("batch").agg(F.count("*").cast("double").alias("n"))  # one row per batch
    x = F.col(value).cast("double")
    sums = counts.join(cells.select("cell_id", "batch"), "cell_id").groupBy("batch", "feature").agg(F.sum(x).alias("_s"), F.sum(x * x).alias("_q"))
    grid = features.select("feature").distinct().crossJoin(F.broadcast(sizes)).join(sums, ["batch", "feature"], "left").na.fill(0.0, ["_s", "_q"])
    mean = F.col("_s") / F.col("n")
    var = F.greatest(F.lit(0.0), (F.col("_q") - F.col("n") * mean * mean) / F.greatest(F.col("n") - 1, F.lit(1.0)))
    return grid.select("batch", "feature", "n", mean.alias("mean"), var.alias("var"))


def fitted_trend(moments: DataFrame, span: float = SPAN) -> DataFrame:
    """``moments`` with ``expected_sd``: the trend of log variance over log mean of a batch, fitted over its varying genes.

    A batch's gene table (three numbers a gene) is one group.
    """
    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        varying = rows["var"].to_numpy() > 0
        x, y = np.log10(rows["mean"].to_numpy()[varying]), np.log10(rows["var"].to_numpy()[varying])
        trend = np.zeros(len(rows))
        if varying.any():
            trend[varying] = local_quadratic(x, y, x, span)
        return rows.assign(expected_sd=np.sqrt(10.0**trend))

    return moments.groupBy("batch").applyInPandas(fit, f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in moments.schema.fields)}, expected_sd double")


def variable_genes_by_trend(counts: DataFrame, cells: DataFrame, features: DataFrame, n_top: int = 2000, span: float = SPAN, value: str = "count") -> DataFrame:
    """Genes by the variance of standardised counts: (feature, variance_norm, median_rank, n_batches, highly_variable).

    ``cells(cell_id, batch)``.  In each batch counts are clipped at the mean plus root-n
    expected deviations before the variance over the expected one is taken (a second pass
    over the stored counts); the ``n_top`` genes of a batch have ranks from 0, and genes
    are ordered by the median of their ranks, then by the batches that rank them, then
    by name.  ``variance_norm`` is the mean over batches.
    """
    table = cut_lineage(fitted_trend(count_moments(counts, cells, features, value), span))
    limit = F.col("mean") + F.col("expected_sd") * F.sqrt("n")
    stored = counts.join(cells.select("cell_id", "batch"), "cell_id").join(F.broadcast(table), ["batch", "feature"]).withColumn("_x", F.least(F.col(value).cast("double"), limit))
    sums = stored.groupBy("batch", "feature").agg(F.sum("_x").alias("_s"), F.sum(F.col("_x") * F.col("_x")).alias("_q"))
    scaled = (F.col("n") * F.col("mean") * F.col("mean") + F.col("_q") - 2 * F.col("_s") * F.col("mean")) / ((F.col("n") - 1) * F.col("expected_sd") * F.col("expected_sd"))
    genes = table.join(sums, ["batch", "feature"], "left").na.fill(0.0, ["_s", "_q"]).withColumn("variance_norm", scaled)
    order = W.partitionBy("batch").orderBy(F.desc("variance_norm"), "feature")  # the gene table of a batch
    ranked = genes.withColumn("_r", F.row_number().over(order) - 1).withColumn("_r", F.when(F.col("_r") < n_top, F.col("_r")))
    merged = ranked.groupBy("feature").agg(F.avg("variance_norm").alias("variance_norm"), F.median("_r").alias("median_rank"), F.count("_r").alias("n_batches"))
    place = F.row_number().over(W.orderBy(F.col("median_rank").asc_nulls_last(), F.desc("n_batches"), "feature"))  # the gene table
    return merged.withColumn("highly_variable", place <= n_top)


def variable_genes_over_batches(expr: DataFrame, cells: DataFrame, features: DataFrame, n_top: int = 2000, flavor: str = "seurat", n_bins: int = 20, value: str = "lognorm") -> DataFrame:
    """Genes by the batches in which they are variable: (feature, dispersion_norm, n_batches, highly_variable).

    ``cells(cell_id, batch)``; each batch is judged on its own genes, a gene without values
    counts 0 there.  Genes are ordered by the number of batches, then by the mean of their
    normalised dispersion over all batches, then by name.
    """
    batches = cells.groupBy("batch").agg(F.count("*").alias("n_cells")).collect()  # one row per batch
    parts = []
    for r in batches:
        own = expr.join(cells.where(F.col("batch").eqNullSafe(F.lit(r["batch"]))).select("cell_id"), "cell_id", "left_semi")
        size = cells.sparkSession.createDataFrame([(r["n_cells"],)], "n_cells long")
        parts.append(variable_genes(own, size, n_top, flavor, n_bins, value).select("feature", "dispersion_norm", "highly_variable"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    total = found.groupBy("feature").agg((F.sum(F.coalesce("dispersion_norm", F.lit(0.0))) / len(batches)).alias("dispersion_norm"), F.count_if("highly_variable").alias("n_batches"))
    whole = features.select("feature").distinct().join(total, "feature", "left").na.fill(0, ["dispersion_norm", "n_batches"])
    place = F.row_number().over(W.orderBy(F.desc("n_batches"), F.desc("dispersion_norm"), "feature"))  # the gene table
    return whole.withColumn("highly_variable", place <= n_top)
