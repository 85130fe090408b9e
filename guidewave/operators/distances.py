"""Distances between groups of cells: energy distance, MMD, permutation test, pair space.

All cells of a group are compared, in blocks of bounded size (see
:mod:`pairblocks`); their work still grows with the product of the two sizes, so
callers with very large groups may pass a limit, which draws a reproducible
sample; nothing is sampled unasked.  The vectors travel in Arrow.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.ordering import bh_adjust
from ..functions.scalars import seed_from_text
from ..functions.session import cut_lineage
from .labels import is_perturbed, is_reference
from .grouping import agglomerate, cut_tree, default_module_count
from .neighbors import _matrix
from .pairblocks import block_size, energy_distances, mean_distances, mmd_distances, numbered_cells, permutation_tests
from .sampling import bounded_sample

_PERMUTATION_BATCH = 64
#: cells of the largest target for which MMD compares whole targets
SMALL_TARGET = 2048
#: blocks aimed at per group of a test, and the number of the control group among the targets
_BLOCKS_OF_GROUP, _CONTROL = 6, -1


def _refined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distance block; what is zero up to the rounding of the expanded square is exactly zero."""
    size = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :]
    square = size - 2.0 * (a @ b.T)
    square[square <= 1e-12 * size] = 0.0
    return np.sqrt(square)


def energy_statistic(x: np.ndarray, y: np.ndarray) -> float:
    """2 E|X-Y| - E|X-X'| - E|Y-Y'| over full distance blocks, never negative."""
    if not len(x) or not len(y):
        return float("nan")
    return max(2.0 * _refined(x, y).mean() - _refined(x, x).mean() - _refined(y, y).mean(), 0.0)


def mmd_statistic(x: np.ndarray, y: np.ndarray) -> float:
    """Squared MMD with a Gaussian kernel whose width is the median positive squared distance."""
    if not len(x) or not len(y):
        return float("nan")
    blocks = [_refined(x, x) ** 2, _refined(y, y) ** 2, _refined(x, y) ** 2]
    stacked = np.concatenate([b.ravel() for b in blocks])
    positive = stacked[stacked > 0]
    gamma = 1.0 / max(float(np.median(positive)) if positive.size else 1.0, 1e-6)
    xx, yy, xy = (np.exp(-gamma * b).mean() for b in blocks)
    return max(float(xx + yy - 2.0 * xy), 0.0)


def permutation_p(x: np.ndarray, y: np.ndarray, n_permutations: int, seed: int) -> tuple[float, float]:
    """Energy statistic and its label-permutation p-value.

    Memberships of a batch of permutations form a 0/1 matrix, so all their
    within-group sums come from one matrix product with the pooled distances.
    """
    n, m = len(x), len(y)
    pooled = np.vstack([x, y])
    d = _refined(pooled, pooled)
    rows = d.sum(1)
    total = rows.sum()

    def statistic(member: np.ndarray) -> np.ndarray:
        sx = ((member @ d) * member).sum(1)
        rx = member @ rows
        return 2.0 * (rx - sx) / (n * m) - sx / (n * n) - (total + sx - 2.0 * rx) / (m * m)

    observed = np.zeros((1, n + m))
    observed[0, :n] = 1.0
    stat = max(float(statistic(observed)[0]), 0.0)
    if n_permutations <= 0:
        return stat, float("nan")
    rng = np.random.default_rng(seed)
    hits = 0
    for start in range(0, n_permutations, _PERMUTATION_BATCH):
        member = np.zeros((min(_PERMUTATION_BATCH, n_permutations - start), n + m))
        for row in member:
            row[rng.permutation(n + m)[:n]] = 1.0
        hits += int((statistic(member) >= stat - 1e-12).sum())
    return stat, (1.0 + hits) / (1.0 + n_permutations)


def choose_control(cells: DataFrame, control_classes: Sequence[str], primary: str = "ntc", min_cells: int = 30) -> str | None:
    """Control arm with enough cells: the primary, then ntc, then other; failing that any non-empty one (reads one row)."""
    row = cells.agg(F.count_if(is_reference(control_classes)).alias("ntc"), F.count_if(is_perturbed()).alias("other")).first()
    order = [primary, "ntc", "other"]
    for need in (min_cells, 1):
        for arm in order:
            if row[arm] >= need:
                return arm
    return None


def target_index(cells: DataFrame) -> DataFrame:
    """All targets in name order with their 0-based index and cell count (library-sized window)."""
    sizes = cells.where(is_perturbed()).groupBy("target").agg(F.count(F.lit(1)).alias("n_cells"))
    return sizes.withColumn("target_no", F.row_number().over(W.orderBy("target")) - 1)


def _sampled_targets(cells: DataFrame, min_cells: int, max_cells: int | None, seed: int, stratum: str | None) -> tuple[DataFrame, DataFrame]:
    index = target_index(cells)
    own = cells.where(is_perturbed()).join(index.where(F.col("n_cells") >= min_cells).select("target"), "target", "left_semi")
    keep = ["target", "cell_id", "vec", *([stratum] if stratum else [])]
    return index, bounded_sample(own.select(*keep), ["target"], max_cells, seed, stratum=stratum)


def perturbation_distance(cells: DataFrame, control_classes: Sequence[str], primary: str = "ntc", min_cells: int = 30, max_target: int | None = None, max_control: int | None = None,
                          n_permutations: int = 1000, seed: int = 123, alpha: float = 0.05, secondary: str | None = "mmd", stratum: str | None = None) -> DataFrame:
    """Energy distance of every target from the control cells, permutation p, optional MMD, FDR.

    Targets below ``min_cells`` are kept with their skip reason.  The control
    cells (``max_control`` of them, if given) are sent once to each target.
    """
    arm = choose_control(cells, control_classes, primary, min_cells)
    if arm is None:
        raise ValueError("no control cells available")
    index, targets = _sampled_targets(cells, min_cells, max_target, seed, stratum)
    pool = cells.where(is_reference(control_classes) if arm == "ntc" else is_perturbed())
    control = bounded_sample(pool.select("cell_id", "vec", *([stratum] if stratum else [])), [], max_control, seed, stratum=stratum)
    index = cut_lineage(index)
    info = index.where(F.col("n_cells") >= min_cells).select("target", F.col("target_no").cast("bigint").alias("a"), seed_from_text(F.concat_ws("_", F.lit(str(seed)), F.col("target_no").cast("string"), "target")).alias("seed"))
    own = targets.join(info, "target").select(F.col("a").alias("grp"), "cell_id", "vec")
    numbered = numbered_cells(own.unionByName(control.select(F.lit(_CONTROL).cast("bigint").alias("grp"), "cell_id", "vec")))
    sizes = numbered.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    sizes = cut_lineage(info.join(sizes.withColumnRenamed("grp", "a"), "a").crossJoin(F.broadcast(sizes.where(F.col("grp") == _CONTROL).select(F.col("n").alias("m")))))  # one row per target
    items = sizes.select(F.col("a").alias("item"), "a", F.lit(_CONTROL).cast("bigint").alias("b"), "n", "m", "seed")
    largest = items.agg(F.greatest(F.max("n"), F.max("m"))).first()[0] or 0
    if n_permutations > 0:
        found = permutation_tests(numbered, items, n_permutations, block_size(largest, _BLOCKS_OF_GROUP))
    else:
        energy = energy_distances(mean_distances(numbered, control=_CONTROL))
        found = energy.select(F.col("b").alias("item"), F.col("distance").alias("statistic"), F.lit(None).cast("double").alias("p_value"))
    mmd = mmd_distances(numbered, items, block_size(largest, _BLOCKS_OF_GROUP)) if secondary == "mmd" else items.select("item", F.lit(None).cast("double").alias("mmd"))
    tested = found.join(mmd, "item").join(sizes.withColumnRenamed("a", "item"), "item").join(index.select("target", "n_cells"), "target").select(
        "target", "n_cells", F.col("m").alias("n_control"), F.col("statistic").alias("energy_distance"), "p_value", F.col("mmd").alias("mmd_distance"))
    tested = bh_adjust(tested, "p_value", "fdr")
    skipped = index.where(F.col("n_cells") < min_cells).select("target", "n_cells", F.format_string(f"fewer than {min_cells} cells (%d)", "n_cells").alias("reason"))
    out = tested.withColumn("significant", F.coalesce(F.col("fdr") < alpha, F.lit(False))).withColumn("reason", F.lit(None).cast("string"))
    return out.unionByName(skipped, allowMissingColumns=True)


def pair_distances(cells: DataFrame, min_cells: int = 30, max_cells: int | None = None, metric: str = "edistance", seed: int = 123, stratum: str | None = None, block: int = 16) -> DataFrame:
    """(target_a, target_b, distance) for a < b.

    Mean distances come from blocks of bounded size.  MMD needs all distances of a
    pair for its median: targets of at most SMALL_TARGET cells are cut into blocks
    of ``block`` targets, and block pairs meet by an equi-join on the two block
    numbers; with a larger target every pair is selected over blocks of cells.
    """
    index, rows = _sampled_targets(cells, min_cells, max_cells, seed, stratum)
    index = cut_lineage(index.where(F.col("n_cells") >= min_cells))
    names = index.select("target", F.col("target_no").cast("bigint").alias("grp"))
    if metric == "edistance" or (index.agg(F.max("n_cells")).first()[0] or 0) > SMALL_TARGET:
        numbered = numbered_cells(rows.join(names, "target"))
        if metric == "edistance":
            found = energy_distances(mean_distances(numbered))
        else:
            sizes = cut_lineage(numbered.groupBy("grp").agg(F.count(F.lit(1)).alias("n")))
            both = sizes.select(F.col("grp").alias("a"), "n").join(sizes.select(F.col("grp").alias("b"), F.col("n").alias("m")), F.col("a") < F.col("b"))
            items = cut_lineage(both.withColumn("item", F.col("a") * F.lit(2**31) + F.col("b")))
            largest = sizes.agg(F.max("n")).first()[0] or 0
            found = mmd_distances(numbered, items.select("item", "a", "b", "n", "m"), block_size(largest, _BLOCKS_OF_GROUP)).join(items, "item").select("a", "b", F.col("mmd").alias("distance"))
        first, second = names.select(F.col("grp").alias("a"), F.col("target").alias("target_a")), names.select(F.col("grp").alias("b"), F.col("target").alias("target_b"))
        return found.join(first, "a").join(second, "b").select("target_a", "target_b", "distance")
    eligible = index.select("target", (F.floor((F.row_number().over(W.orderBy("target")) - 1) / block)).cast("int").alias("blk"))
    last = eligible.agg(F.max("blk").alias("_last"))
    placed = rows.join(eligible, "target").crossJoin(F.broadcast(last)).select("target", "cell_id", "vec", "blk", "_last")
    left = placed.select(F.col("blk").alias("i"), F.explode(F.sequence("blk", "_last")).alias("j"), "target", "cell_id", "vec")
    right = placed.select(F.explode(F.sequence(F.lit(0), F.col("blk"))).alias("ri"), F.col("blk").alias("rj"), F.col("target").alias("r_target"), F.col("cell_id").alias("r_cell_id"), F.col("vec").alias("r_vec"))

    def groups(table: pa.Table, prefix: str) -> dict[str, np.ndarray]:
        table = table.sort_by([(f"{prefix}target", "ascending"), (f"{prefix}cell_id", "ascending")])
        names = np.asarray(table.column(f"{prefix}target").to_pandas())
        matrix = _matrix(table.column(f"{prefix}vec"))
        return {t: matrix[names == t] for t in pd.unique(names)}

    def compare(a: pa.Table, b: pa.Table) -> pa.Table:
        out: list[tuple[str, str, float]] = []
        if a.num_rows and b.num_rows:
            first, second = groups(a, ""), groups(b, "r_")
            for s, x in first.items():
                for t, y in second.items():
                    if s < t:
                        out.append((s, t, mmd_statistic(x, y)))
        return pa.table({"target_a": pa.array([o[0] for o in out], pa.string()), "target_b": pa.array([o[1] for o in out], pa.string()), "distance": pa.array([o[2] for o in out], pa.float64())})

    return left.groupBy("i", "j").cogroup(right.groupBy("ri", "rj")).applyInArrow(compare, "target_a string, target_b string, distance double")


def both_directions(pairs: DataFrame) -> DataFrame:
    """Every unordered pair as two rows (a, b, distance)."""
    a = pairs.select(F.col("target_a").alias("a"), F.col("target_b").alias("b"), "distance")
    return a.unionByName(a.select(F.col("b").alias("a"), F.col("a").alias("b"), "distance"))


def nearest_targets(pairs: DataFrame, k: int = 10) -> DataFrame:
    """The k closest targets of each target (ties by name)."""
    order = W.partitionBy("a").orderBy("distance", "b")
    ranked = both_directions(pairs).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("a").alias("target"), F.col("b").alias("neighbor"), "distance", "rank")


def centred_products(pairs: DataFrame) -> DataFrame:
    """Double-centred -d^2/2 as long (a, b, value), diagonal included."""
    both = both_directions(pairs).select("a", "b", (F.col("distance") * F.col("distance")).alias("d2"))
    names = both.select("a").distinct()
    full = both.unionByName(names.select("a", F.col("a").alias("b"), F.lit(0.0).alias("d2")))
    rows = full.groupBy("a").agg(F.avg("d2").alias("_ra"))
    grand = rows.agg(F.avg("_ra").alias("_g"))
    out = full.join(rows, "a").join(rows.select(F.col("a").alias("b"), F.col("_ra").alias("_rb")), "b").crossJoin(F.broadcast(grand))
    return out.select("a", "b", (-0.5 * (F.col("d2") - F.col("_ra") - F.col("_rb") + F.col("_g"))).alias("value"))


def principal_coordinates(pairs: DataFrame, n_components: int = 10) -> tuple[DataFrame, DataFrame]:
    """(coordinates(target, axis, value), eigenvalues(axis, value)) of the target distances.

    The centred product matrix is a distributed row matrix; its signed eigenvalues
    follow from the singular triplets, since a negative one has opposite singular
    vectors.  Only strictly positive ones are kept; each axis points to its
    largest coordinate.
    """
    from pyspark.mllib.linalg import DenseVector
    from pyspark.mllib.linalg.distributed import IndexedRow, IndexedRowMatrix

    spark = pairs.sparkSession
    products = cut_lineage(centred_products(pairs))
    names = products.select("a").distinct().withColumn("no", F.row_number().over(W.orderBy("a")) - 1)  # one row per target
    rows = products.join(names.select(F.col("a").alias("b"), F.col("no").alias("_j")), "b").groupBy("a").agg(F.sort_array(F.collect_list(F.struct("_j", "value"))).alias("_r"))
    numbered = rows.join(names, "a").select("no", F.transform("_r", lambda r: r["value"]).alias("vec")).cache()
    k = numbered.count()
    matrix = IndexedRowMatrix(numbered.rdd.map(lambda r: IndexedRow(r["no"], DenseVector(r["vec"]))), k, k)
    svd = matrix.computeSVD(k, computeU=True, rCond=1e-12)
    v = svd.V.toArray()
    values = np.asarray(svd.s.toArray())
    signs = svd.U.rows.map(lambda r: np.asarray(r.vector.toArray()) * v[r.index]).sum()
    numbered.unpersist()
    # singular values come from the squared matrix: below this they are rounding
    floor = max(1e-10, 1e-7 * float(values.max(initial=0.0)))
    keep = [i for i in range(len(values)) if signs[i] > 0 and values[i] > floor][:n_components]
    axes = v[:, keep] * np.sqrt(values[keep])
    if axes.size:
        axes = axes * np.sign(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])])
    table = spark.createDataFrame([(int(i), j + 1, float(axes[i, j])) for i in range(axes.shape[0]) for j in range(axes.shape[1])], "no int, axis int, value double")
    eigen = spark.createDataFrame([(j + 1, float(values[i])) for j, i in enumerate(keep)], "axis int, value double")
    return table.join(names.withColumnRenamed("a", "target"), "no").select("target", "axis", "value"), eigen


def distance_space(cells: DataFrame, min_cells: int = 30, n_components: int = 10, n_neighbors: int = 10, n_modules: int | None = None, linkage: str = "average", metric: str = "edistance",
                   seed: int = 123, max_cells: int | None = None, stratum: str | None = None) -> dict[str, DataFrame]:
    """The whole space of targets: pairs, coordinates, eigenvalues, neighbors, modules and skipped targets.

    Phenotype modules cut the tree of the pair distances.  With fewer than two
    targets of ``min_cells`` cells all tables but ``skipped`` are empty.
    """
    spark = cells.sparkSession
    index = target_index(cells)
    skipped = index.where(F.col("n_cells") < min_cells).select("target", "n_cells", F.format_string(f"fewer than {min_cells} cells (%d)", "n_cells").alias("reason"))
    eligible = index.where(F.col("n_cells") >= min_cells).select(F.col("target").alias("item"))
    n = eligible.count()
    if n < 2:
        layout = {"pairs": "target_a string, target_b string, distance double", "coordinates": "target string, axis int, value double", "eigenvalues": "axis int, value double",
                  "neighbors": "target string, neighbor string, distance double, rank int", "modules": "target string, phenotype_module string"}
        return {name: spark.createDataFrame([], ddl) for name, ddl in layout.items()} | {"skipped": skipped}
    pairs = cut_lineage(pair_distances(cells, min_cells, max_cells, metric, seed, stratum))
    coordinates, eigenvalues = principal_coordinates(pairs, n_components)
    merges = agglomerate(pairs.select(F.col("target_a").alias("a"), F.col("target_b").alias("b"), "distance"), linkage)
    modules = cut_tree(eligible, merges, n_modules or default_module_count(n))
    return {"pairs": pairs, "coordinates": coordinates, "eigenvalues": eigenvalues, "neighbors": nearest_targets(pairs, n_neighbors),
            "modules": modules.select(F.col("item").alias("target"), F.col("module").alias("phenotype_module")), "skipped": skipped}
