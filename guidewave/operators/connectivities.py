"""Neighbour graphs with connectivity weights: kernel widths per point and the fuzzy union of both directions."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.session import cut_lineage
from .embedding import joint_space
from .neighbors import knn

#: halvings of the interval of a kernel width, and its least value as a share of a point's mean distance
STEPS, LEAST_SHARE = 64, 1e-3


def kernel_weights(distances: np.ndarray, overall: float, k: int) -> np.ndarray:
    """Weights of the neighbours in each row (missing ones NaN): exp(-(d - nearest) / width), 1 up to the nearest.

    The width of a row makes its weights add up to log2 k; ``k`` counts the point itself,
    which stands at distance 0 in the mean that bounds the width from below.
    """
    known = ~np.isnan(distances)
    d = np.where(known, distances, 0.0)
    nearest = np.min(np.where(known & (d > 0), d, np.inf), axis=1)
    nearest[~np.isfinite(nearest)] = 0.0
    beyond = np.maximum(d - nearest[:, None], 0.0)
    target = math.log2(k)

    def total(width: np.ndarray) -> np.ndarray:
        return np.where(known, np.exp(-beyond / width[:, None]), 0.0).sum(1)

    low, high, width = np.zeros(len(d)), np.full(len(d), np.inf), np.ones(len(d))
    for _ in range(STEPS):
        over = total(width) > target
        high = np.where(over, width, high)
        low = np.where(over, low, width)
        width = np.where(np.isinf(high), width * 2, (low + high) / 2)
    mean = d.sum(1) / (known.sum(1) + 1)
    width = np.maximum(width, LEAST_SHARE * np.where(nearest > 0, mean, overall))
    weight = np.where(beyond > 0, np.exp(-beyond / np.where(width > 0, width, 1.0)[:, None]), 1.0)
    return np.where(known, weight, np.nan)


def connectivities(edges: DataFrame, k: int) -> DataFrame:
    """(src, dst, weight) with src < dst: the union a + b - a b of the directed kernel weights of ``edges(src, dst, dist)``.

    ``k`` is the neighbourhood size with the point itself, so a row has k - 1 edges at most.
    """
    overall = edges.agg((F.sum("dist") / (F.count("*") + F.count_distinct("src"))).alias("m"))
    rows = edges.groupBy("src").agg(F.array_sort(F.collect_list(F.struct("dist", "dst"))).alias("_n")).crossJoin(F.broadcast(overall))  # k - 1 entries a row

    @F.pandas_udf("array<double>")
    def weigh(dist: pd.Series, m: pd.Series) -> pd.Series:
        block = np.full((len(dist), max(map(len, dist), default=1)), np.nan)
        for row, own in enumerate(dist):
            block[row, : len(own)] = own
        weight = kernel_weights(block, float(m.iloc[0]), k)
        return pd.Series([w[: len(own)] for w, own in zip(weight, dist)])

    weighed = rows.select("src", F.explode(F.arrays_zip(F.col("_n.dst").alias("dst"), weigh(F.col("_n.dist"), F.col("m")).alias("weight"))).alias("_e"))
    directed = weighed.select("src", F.col("_e.dst").alias("dst"), F.col("_e.weight").alias("weight"))
    pairs = directed.groupBy(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
    both = pairs.agg(F.sum("weight").alias("_s"), F.min("weight").alias("_a"), F.max("weight").alias("_b"), F.count("*").alias("_c"))
    return both.select("src", "dst", (F.col("_s") - F.when(F.col("_c") == 2, F.col("_a") * F.col("_b")).otherwise(0.0)).alias("weight"))


def neighbor_graph(vectors: DataFrame, n_neighbors: int = 15) -> tuple[DataFrame, DataFrame]:
    """(edges, connectivities) of a space ``vectors(cell_id, vec)``; cells without a vector are left out."""
    # read three times: for the overall mean, by the weights and by the caller
    edges = cut_lineage(knn(vectors.where(F.col("vec").isNotNull()).select("cell_id", "vec"), n_neighbors - 1))
    return edges, connectivities(edges, n_neighbors)


def modality_graphs(rna: DataFrame, protein: DataFrame | None, n_neighbors: int = 15, protein_weight: float = 1.0) -> dict[str, DataFrame]:
    """Connectivities of the RNA space and, where there are proteins, of the protein and the joint space.

    Cells without protein values are in the RNA graph only.
    """
    spaces = {"rna": rna}
    if protein is not None:
        complete = protein.where(F.col("vec").isNotNull())
        spaces |= {"protein": complete, "joint": joint_space(rna, complete, protein_weight)}
    return {name: neighbor_graph(space, n_neighbors)[1] for name, space in spaces.items()}
