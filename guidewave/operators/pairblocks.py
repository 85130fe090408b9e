"""Sums over all pairs of cells of two groups, in blocks of bounded size.

A group of any size is cut into blocks of consecutive cells (by id), small
groups share a block, and two blocks meet in one task, which walks through their
distances in tiles.  A task thus holds two blocks and one tile, however large
the groups are; the sums of the blocks are added by Spark.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.session import cut_lineage
from .neighbors import _matrix

#: cells of a block, at least and at most, and blocks aimed at in between
MIN_BLOCK, MAX_BLOCK, BLOCKS = 1024, 16_384, 24
#: small groups of one block, at most
GROUPS_OF_BLOCK = 512
#: cells on each side of a distance tile
TILE = 512
#: cells of a sorted partition while cells are numbered
_NUMBERED_AT_ONCE = 50_000
#: bits of a squared distance that one selection pass settles, and passes until all 64 are
_BITS, _PASSES = 16, 4


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances; what is zero up to the rounding of the expanded square is exactly zero."""
    size = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :]
    square = a @ b.T
    square *= -2.0
    square += size
    size *= 1e-12
    square[square <= size] = 0.0
    return square


def block_size(n: int, blocks: int = BLOCKS) -> int:
    return min(MAX_BLOCK, max(MIN_BLOCK, math.ceil(n / blocks)))


def numbered_cells(cells: DataFrame) -> DataFrame:
    """``cells(grp, cell_id, vec)`` with ``pos``, the 0-based place of a cell in its group by id; written once."""
    parts = max(1, math.ceil(cells.count() / _NUMBERED_AT_ONCE))
    ordered = cells.select("grp", "cell_id", "vec").repartitionByRange(parts, "grp", "cell_id").sortWithinPartitions("grp", "cell_id")
    ordered = cut_lineage(ordered.withColumn("_id", F.monotonically_increasing_id())).withColumn("_part", F.shiftright("_id", 33))
    runs = ordered.groupBy("grp", "_part").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # one row per group and partition
    earlier = W.partitionBy("grp").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = runs.select("grp", "_part", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    return ordered.join(offsets, ["grp", "_part"]).select("grp", "cell_id", "vec", (F.col("_id") + F.col("_shift")).alias("pos"))


def _sorted(table: pa.Table, prefix: str = "") -> pa.Table:
    return table.sort_by([(f"{prefix}grp", "ascending"), (f"{prefix}pos", "ascending")])


def _starts(codes: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])


def _group_sums(x: np.ndarray, gx: np.ndarray, y: np.ndarray, gy: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Groups of the rows, groups of the columns, and the sum of distances of each two; rows and columns sorted by group."""
    names_x, codes_x = np.unique(gx, return_inverse=True)
    names_y, codes_y = np.unique(gy, return_inverse=True)
    out = np.zeros((len(names_x), len(names_y)))
    for a in range(0, len(x), TILE):
        cx = codes_x[a : a + TILE]
        sx = _starts(cx)
        for b in range(0, len(y), TILE):
            cy = codes_y[b : b + TILE]
            sy = _starts(cy)
            tile = _squares(x[a : a + TILE], y[b : b + TILE])
            np.sqrt(tile, out=tile)
            out[np.ix_(cx[sx], cy[sy])] += np.add.reduceat(np.add.reduceat(tile, sx, axis=0), sy, axis=1)
    return names_x, names_y, out


def mean_distances(cells: DataFrame, control: int | None = None, block: int | None = None) -> DataFrame:
    """(a, b, mean, n_a, n_b) for groups a <= b of ``numbered_cells``: the mean distance over all pairs of their cells.

    With a ``control`` group only the pairs inside a group and those with the
    control are compared.  Each block is shipped once per block that it meets.
    """
    sizes = cut_lineage(cells.groupBy("grp").agg(F.count(F.lit(1)).alias("n")))
    block = block or block_size(sizes.agg(F.sum("n")).first()[0] or 0)
    # one row per group: a large one has blocks of its own, small ones fill shared blocks in order
    large = F.col("n") > block
    before = W.orderBy("grp").rowsBetween(W.unboundedPreceding, -1)
    own = F.when(large, F.ceil(F.col("n") / block)).otherwise(0)
    share = F.when(large, 0).otherwise(F.greatest(F.col("n"), F.lit(max(1, block // GROUPS_OF_BLOCK))))
    plan = sizes.withColumns({"_own": own, "_base": F.coalesce(F.sum(own).over(before), F.lit(0)), "_pack": F.floor(F.coalesce(F.sum(share).over(before), F.lit(0)) / block)})
    plan = plan.withColumn("_step", F.when(large, F.ceil(F.col("n") / F.col("_own"))))
    plan = cut_lineage(plan.select("grp", "n", "_own", "_base", "_pack", "_step"))
    number = F.when(F.col("_own") > 0, F.col("_base") + F.floor(F.col("pos") / F.col("_step"))).otherwise(-1 - F.col("_pack")).cast("bigint")
    placed = cells.join(plan, "grp").select(number.alias("blk"), "grp", "pos", "vec")
    of_group = F.when(F.col("_own") > 0, F.sequence(F.col("_base"), F.col("_base") + F.col("_own") - 1)).otherwise(F.array(-1 - F.col("_pack")))
    held = plan.select("grp", F.explode(of_group.cast("array<bigint>")).alias("blk"))
    i, j = F.least("_x", "_y").alias("i"), F.greatest("_x", "_y").alias("j")
    every = held.select(F.col("blk").alias("_y")).distinct()
    if control is None:
        met = every.select(F.col("_y").alias("_x")).crossJoin(every)
    else:
        inside = held.select("grp", F.col("blk").alias("_x")).join(held.select("grp", F.col("blk").alias("_y")), "grp").select("_x", "_y")
        met = inside.unionByName(held.where(F.col("grp") == control).select(F.col("blk").alias("_x")).crossJoin(every))
    met = cut_lineage(met.select(i, j).distinct())
    left = placed.join(met, F.col("blk") == F.col("i")).select("i", "j", "grp", "pos", "vec")
    right = placed.join(met.where("i < j"), F.col("blk") == F.col("j")).select(*[F.col(c).alias(f"r_{c}") for c in ("i", "j", "grp", "pos", "vec")])

    def compare(x: pa.Table, y: pa.Table) -> pa.Table:
        first = _sorted(x)
        same = first.column("i")[0].as_py() == first.column("j")[0].as_py()
        second, prefix = (first, "") if same else (_sorted(y, "r_"), "r_")
        gx, gy, sums = _group_sums(_matrix(first.column("vec")), np.asarray(first.column("grp")), _matrix(second.column(f"{prefix}vec")), np.asarray(second.column(f"{prefix}grp")))
        a, b = np.broadcast_to(gx[:, None], sums.shape), np.broadcast_to(gy[None, :], sums.shape)
        keep = (a <= b) if same else np.ones(sums.shape, bool)
        if control is not None:
            keep &= (a == b) | (a == control) | (b == control)
        # a pair of cells of one group in two blocks counts in both orders
        sums = sums * np.where((a == b) & (not same), 2.0, 1.0)
        return pa.table({"a": np.minimum(a, b)[keep], "b": np.maximum(a, b)[keep], "total": sums[keep]})

    parts = left.groupBy("i", "j").cogroup(right.groupBy("r_i", "r_j")).applyInArrow(compare, "a bigint, b bigint, total double")
    n = sizes.select("grp", "n")
    # one row per pair of groups; callers read it several times, the cells are compared once
    total = cut_lineage(parts.groupBy("a", "b").agg(F.sum("total").alias("_t")))
    out = total.join(n.select(F.col("grp").alias("a"), F.col("n").alias("n_a")), "a").join(n.select(F.col("grp").alias("b"), F.col("n").alias("n_b")), "b")
    return out.select("a", "b", (F.col("_t") / (F.col("n_a").cast("double") * F.col("n_b"))).alias("mean"), "n_a", "n_b")


def energy_distances(means: DataFrame) -> DataFrame:
    """(a, b, distance) for a < b from ``mean_distances``, never negative."""
    inside = means.where("a = b")
    pairs = means.where("a < b").join(inside.select("a", F.col("mean").alias("_aa")), "a").join(inside.select("b", F.col("mean").alias("_bb")), "b")
    return pairs.select("a", "b", F.greatest(2.0 * F.col("mean") - F.col("_aa") - F.col("_bb"), F.lit(0.0)).alias("distance"))


def _met_blocks(cells: DataFrame, items: DataFrame, extra: list[str], block: int) -> tuple[DataFrame, DataFrame]:
    """Both sides of every block pair of every item: its first group's cells, then its second's, numbered through.

    ``items(item, a, b, n, m)`` with the ``extra`` columns, which travel with the rows.
    """
    first = items.join(cells.withColumnRenamed("grp", "a"), "a").select("item", "n", "m", *extra, "pos", "vec", F.lit(0).alias("side"), F.floor(F.col("pos") / block).alias("blk"))
    second = items.join(cells.withColumnRenamed("grp", "b"), "b").select(
        "item", "n", "m", *extra, (F.col("pos") + F.col("n")).alias("pos"), "vec", F.lit(1).alias("side"), (F.ceil(F.col("n") / block) + F.floor(F.col("pos") / block)).alias("blk"))
    rows = first.unionByName(second).withColumn("blk", F.col("blk").cast("bigint"))
    last = (F.ceil(F.col("n") / block) + F.ceil(F.col("m") / block) - 1).cast("bigint")
    left = rows.select("item", F.col("blk").alias("i"), F.explode(F.sequence("blk", last)).alias("j"), "n", "m", *extra, "pos", "side", "vec")
    right = rows.where("blk > 0").select(F.col("item").alias("r_item"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blk") - 1)).alias("r_i"), F.col("blk").alias("r_j"),
                                         F.col("pos").alias("r_pos"), F.col("side").alias("r_side"), F.col("vec").alias("r_vec"))
    return left, right


def _over_blocks(cells: DataFrame, items: DataFrame, extra: list[str], block: int, work: Callable, schema: str) -> DataFrame:
    """``work(values, x, px, y, py, same, sides)`` of every block pair; it gives a dictionary of columns beside the item."""
    left, right = _met_blocks(cells, items, extra, block)

    def task(a: pa.Table, b: pa.Table) -> pa.Table:
        a = a.sort_by("pos")
        values = {c: a.column(c)[0].as_py() for c in ("item", "i", "j", "n", "m", "side", *extra)}
        x, px = _matrix(a.column("vec")), np.asarray(a.column("pos"))
        if values["i"] == values["j"]:
            found = work(values, x, px, x, px, True, (values["side"], values["side"]))
        else:
            b = b.sort_by("r_pos")
            found = work(values, x, px, _matrix(b.column("r_vec")), np.asarray(b.column("r_pos")), False, (values["side"], b.column("r_side")[0].as_py()))
        rows = len(next(iter(found.values())))
        return pa.table({"item": pa.array([values["item"]] * rows, pa.int64()), **found})

    return left.groupBy("item", "i", "j").cogroup(right.groupBy("r_item", "r_i", "r_j")).applyInArrow(task, f"item bigint, {schema}")


def _memberships(values: dict, n_permutations: int, *places: np.ndarray) -> list[np.ndarray]:
    """0/1 rows of the observed labels and of all seeded permutations at the given places of the pooled cells."""
    n, size = values["n"], values["n"] + values["m"]
    out = [np.zeros((n_permutations + 1, len(p)), bool) for p in places]
    rng, member = np.random.default_rng(values["seed"]), np.zeros(size, bool)
    for k in range(n_permutations + 1):
        member[:] = False
        if k:
            member[rng.permutation(size)[:n]] = True
        else:
            member[:n] = True
        for rows, p in zip(out, places):
            rows[k] = member[p]
    return out


def permutation_tests(cells: DataFrame, items: DataFrame, n_permutations: int, block: int) -> DataFrame:
    """(item, statistic, p_value): energy statistic of the item's two groups and its label-permutation p-value.

    ``items(item, a, b, n, m, seed)``.  The labels of a permutation are drawn again
    from the item's seed by every task, so only its two sums leave a task: those
    over pairs inside the labelled cells, and over pairs with any labelled cell.
    """
    def sums(values: dict, x: np.ndarray, px: np.ndarray, y: np.ndarray, py: np.ndarray, same: bool, sides: tuple[int, int]) -> dict:
        mx, my = _memberships(values, n_permutations, px, py)
        inside, touched, total = np.zeros(len(mx)), np.zeros(len(mx)), 0.0
        for b in range(0, len(y), TILE):
            member_y = my[:, b : b + TILE].astype(float)
            across, columns = np.zeros(member_y.shape), np.zeros(member_y.shape[1])
            for a in range(0, len(x), TILE):
                tile = _squares(x[a : a + TILE], y[b : b + TILE])
                np.sqrt(tile, out=tile)
                member_x = mx[:, a : a + TILE].astype(float)
                across += member_x @ tile
                columns += tile.sum(0)
            inside += (across * member_y).sum(1)
            touched += across.sum(1) if same else across.sum(1) + member_y @ columns
            total += columns.sum()
        # the pairs of two blocks count in both orders
        weight = 1.0 if same else 2.0
        return {"k": np.arange(len(mx), dtype="int32"), "inside": inside * weight, "touched": touched, "total": np.full(len(mx), total * weight)}

    parts = _over_blocks(cells, items, ["seed"], block, sums, "k int, inside double, touched double, total double")
    by_draw = parts.groupBy("item", "k").agg(*[F.sum(c).alias(c) for c in ("inside", "touched", "total")]).join(items.select("item", "n", "m"), "item")
    n, m = F.col("n").cast("double"), F.col("m").cast("double")
    value = 2.0 * (F.col("touched") - F.col("inside")) / (n * m) - F.col("inside") / (n * n) - (F.col("total") + F.col("inside") - 2.0 * F.col("touched")) / (m * m)
    drawn = cut_lineage(by_draw.select("item", "k", value.alias("_s")))
    observed = drawn.where("k = 0").select("item", F.greatest("_s", F.lit(0.0)).alias("statistic"))
    hits = drawn.where("k > 0").join(observed, "item").groupBy("item").agg(F.count_if(F.col("_s") >= F.col("statistic") - 1e-12).alias("_h"))
    p = (1.0 + F.col("_h")) / (1.0 + n_permutations)
    return observed.join(hits, "item", "left").select("item", "statistic", (p if n_permutations > 0 else F.lit(None).cast("double")).alias("p_value"))


def _tiles(x: np.ndarray, y: np.ndarray):
    for a in range(0, len(x), TILE):
        for b in range(0, len(y), TILE):
            yield _squares(x[a : a + TILE], y[b : b + TILE])


def mmd_distances(cells: DataFrame, items: DataFrame, block: int) -> DataFrame:
    """(item, mmd): squared MMD of the item's groups, its Gaussian kernel as wide as the median positive squared distance.

    ``items(item, a, b, n, m)``.  The exact median is selected in passes: each
    counts the squares by the next 16 bits of their binary form, which rises with the number,
    among those that share the bits found before.
    """
    def weight(same: bool, sides: tuple[int, int]) -> int:
        return 2 if not same and sides[0] == sides[1] else 1

    # lower and upper median: the bits found and the rank left among the squares that share them
    state = None
    for step in range(_PASSES):
        shift = 64 - _BITS * (step + 1)

        def count(values: dict, x: np.ndarray, px: np.ndarray, y: np.ndarray, py: np.ndarray, same: bool, sides: tuple[int, int], step: int = step, shift: int = shift) -> dict:
            wanted = [0] if step == 0 else sorted({values["low"], values["high"]})
            counts = {w: np.zeros(1 << _BITS, np.int64) for w in wanted}
            for tile in _tiles(x, y):
                bits = tile[tile > 0].view(np.int64) >> shift
                for w in wanted:
                    chosen = bits if step == 0 else bits[(bits >> _BITS) == w]
                    counts[w] += np.bincount(chosen & ((1 << _BITS) - 1), minlength=1 << _BITS)
            found = [(w, np.flatnonzero(c), c) for w, c in counts.items()]
            return {"found": np.concatenate([np.full(len(at), w, np.int64) for w, at, _ in found]), "bin": np.concatenate([at for _, at, _ in found]).astype(np.int64),
                    "c": np.concatenate([c[at] for _, at, c in found]) * weight(same, sides)}

        asked = items if state is None else items.join(state, "item")
        parts = _over_blocks(cells, asked, [] if state is None else ["low", "high"], block, count, "found bigint, bin bigint, c bigint")
        table = cut_lineage(parts.groupBy("item", "found", "bin").agg(F.sum("c").alias("c")))
        # at most 2^16 rows of each item and prefix
        one = W.partitionBy("item", "found")
        runs = table.withColumn("_upto", F.sum("c").over(one.orderBy("bin"))).withColumn("_all", F.sum("c").over(one))
        if state is None:
            ranks = runs.withColumns({"low_rank": F.expr("(_all - 1) div 2"), "high_rank": F.expr("_all div 2"), "low": F.lit(0).cast("bigint"), "high": F.lit(0).cast("bigint")})
        else:
            ranks = runs.join(state, "item")
        below = F.col("_upto") - F.col("c")
        chosen = {}
        for side in ("low", "high"):
            hit = (F.col("found") == F.col(side)) & (below <= F.col(f"{side}_rank")) & (F.col(f"{side}_rank") < F.col("_upto"))
            chosen[side] = F.max(F.when(hit, F.shiftleft(F.col("found"), _BITS) + F.col("bin"))).alias(side)
            chosen[f"{side}_rank"] = F.max(F.when(hit, F.col(f"{side}_rank") - below)).alias(f"{side}_rank")
        state = cut_lineage(ranks.groupBy("item").agg(*chosen.values()))

    def kernel(values: dict, x: np.ndarray, px: np.ndarray, y: np.ndarray, py: np.ndarray, same: bool, sides: tuple[int, int]) -> dict:
        # an item without a positive distance has no median
        median = 1.0 if values["low"] is None else float(np.array([values["low"], values["high"]], np.int64).view(np.float64).mean())
        gamma = 1.0 / max(median, 1e-6)
        total = sum(float(np.exp(-gamma * tile).sum()) for tile in _tiles(x, y))
        return {"side": np.array([sides[0] + sides[1]], np.int32), "total": np.array([total * weight(same, sides)])}

    parts = _over_blocks(cells, items.join(state, "item", "left"), ["low", "high"], block, kernel, "side int, total double")
    n, m = F.col("n").cast("double"), F.col("m").cast("double")
    sums = parts.groupBy("item").agg(*[F.sum(F.when(F.col("side") == s, F.col("total"))).alias(name) for s, name in ((0, "_aa"), (1, "_ab"), (2, "_bb"))]).join(items.select("item", "n", "m"), "item")
    return sums.select("item", F.greatest(F.col("_aa") / (n * n) + F.col("_bb") / (m * m) - 2.0 * F.col("_ab") / (n * m), F.lit(0.0)).alias("mmd"))
