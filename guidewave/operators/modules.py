"""Gene programs, perturbation modules and what is read from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.scalars import ratio
from ..functions.session import cut_lineage
from .grids import complete
from .grouping import agglomerate, cut_tree


#: rows of a panel in one block of a Gram product
BLOCK_ITEMS = 256


def correlation_matrix(table: DataFrame, row: str, column: str, value: str, method: str = "pearson", block_items: int = BLOCK_ITEMS) -> DataFrame:
    """Correlation r of every pair of rows a < b over their shared columns; null where fewer than two are shared or one row is constant there.

    Rows are a panel (targets, genes, proteins).  They are centred, packed in blocks as
    dense matrices with a mask of the values that are there, and every pair of blocks is
    a few matrix products, so what moves is each block once per other block, not
    a row per pair and column.
    """
    x = table.select(F.col(row).alias("_row"), F.col(column).alias("_col"), F.col(value).cast("double").alias("_v")).where("_v IS NOT NULL")
    if method == "spearman":
        w = W.partitionBy("_row").orderBy("_v")  # one row of a panel: as long as its column list
        x = x.withColumn("_v", F.rank().over(w) + (F.count(F.lit(1)).over(W.partitionBy("_row", "_v")) - 1) / 2.0)
    x = cut_lineage(x)
    rows = x.groupBy("_row").agg(F.avg("_v").alias("_mean")).withColumn("_i", F.row_number().over(W.orderBy("_row")) - 1)  # the panel
    columns = x.select("_col").distinct().withColumn("_j", F.row_number().over(W.orderBy("_col")) - 1)  # the other panel
    width = columns.count()
    last = (rows.count() - 1) // block_items
    placed = x.join(rows, "_row").join(columns, "_col").select(F.floor(F.col("_i") / block_items).cast("int").alias("block"), (F.col("_i") % block_items).cast("int").alias("i"), F.col("_j").cast("int").alias("j"), F.col("_row").alias("name"), (F.col("_v") - F.col("_mean")).alias("v"))
    name_type = x.schema["_row"].dataType.simpleString()

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        n = int(part["i"].max()) + 1
        block, mask = np.zeros((n, width)), np.zeros((n, width), np.uint8)
        block[part["i"], part["j"]] = part["v"]
        mask[part["i"], part["j"]] = 1
        names = part.drop_duplicates("i").sort_values("i")["name"].tolist()
        return pd.DataFrame({"block": [part["block"].iloc[0]], "names": [names], "x": [block.tobytes()], "mask": [np.packbits(mask).tobytes()]})

    blocks = cut_lineage(placed.groupBy("block").applyInPandas(pack, f"block int, names array<{name_type}>, x binary, mask binary"))

    def side(own: str, other: str, partners: Column) -> DataFrame:
        return blocks.select(F.col("block").alias(own), F.explode(partners).alias(other), *[F.col(c).alias(f"{c}_{own}") for c in ("names", "x", "mask")])

    pairs = side("a", "b", F.sequence(F.col("block"), F.lit(last))).join(side("b", "a", F.sequence(F.lit(0), F.col("block"))), ["a", "b"])

    def unpack(x: bytes, mask: bytes) -> tuple[np.ndarray, np.ndarray]:
        block = np.frombuffer(x).reshape(-1, width)
        return block, np.unpackbits(np.frombuffer(mask, np.uint8), count=block.size).reshape(block.shape).astype(float)

    def products(parts):
        for part in parts:
            for r in part.itertuples(index=False):
                (x, p), (y, q) = unpack(r.x_a, r.mask_a), unpack(r.x_b, r.mask_b)
                n, sx, sy, sxx, syy = p @ q.T, x @ q.T, p @ y.T, (x * x) @ q.T, p @ (y * y).T
                with np.errstate(divide="ignore", invalid="ignore"):
                    xx, yy = sxx - sx * sx / n, syy - sy * sy / n
                    corr = (x @ y.T - sx * sy / n) / np.sqrt(xx * yy)
                    flat = ~((xx > 1e-12 * sxx) & (yy > 1e-12 * syy) & (n > 1))
                corr = np.where(flat, np.nan, np.clip(corr, -1.0, 1.0))
                i, j = np.nonzero(n > 0)
                if r.a == r.b:
                    i, j = i[i < j], j[i < j]
                yield pd.DataFrame({"a": np.asarray(r.names_a)[i], "b": np.asarray(r.names_b)[j], "r": corr[i, j]})

    found = pairs.mapInPandas(products, f"a {name_type}, b {name_type}, r double")
    return found.select("a", "b", F.when(~F.isnan("r"), F.col("r")).alias("r"))


def correlation_distance(correlations: DataFrame) -> DataFrame:
    """1 - r, a missing correlation counting as 1, never negative."""
    r = F.col("r")
    return correlations.select("a", "b", F.greatest(F.lit(0.0), F.when(r.isNull() | F.isnan(r), 1.0).otherwise(1.0 - r)).alias("distance"))


def cluster_axis(table: DataFrame, row: str, column: str, value: str, method: str, n_clusters: int | None, prefix: str, linkage: str = "average", height: float | None = None) -> DataFrame:
    """Modules of the rows of a panel on 1 - correlation: (item, module)."""
    merges = agglomerate(correlation_distance(correlation_matrix(table, row, column, value, method)), linkage)
    items = table.select(F.col(row).alias("item")).distinct()
    return cut_tree(items, merges, None if n_clusters is None else max(2, n_clusters), height, prefix)


def module_program_strength(effects: DataFrame, modules: DataFrame, programs: DataFrame) -> DataFrame:
    """Mean log2 fold change per (module, program)."""
    rows = effects.join(modules.withColumnRenamed("item", "target"), "target").join(programs.select(F.col("item").alias("feature"), F.col("module").alias("program")), "feature")
    return rows.groupBy("module", "program").agg(F.avg("log2fc").alias("strength"))


def target_program_effects(effects: DataFrame, programs: DataFrame) -> DataFrame:
    """Mean log2 fold change and differentially expressed share per (target, program)."""
    rows = effects.join(programs.select(F.col("item").alias("feature"), F.col("module").alias("program")), "feature")
    de = F.count_if("de") if "de" in effects.columns else F.lit(0).cast("bigint")
    return rows.groupBy("target", "program").agg(F.count(F.lit(1)).alias("n_genes"), F.avg("log2fc").alias("mean_log2fc"), de.alias("n_de")).withColumn("frac_de", ratio(F.col("n_de"), F.col("n_genes")))


def strongest_program(program_effects: DataFrame) -> DataFrame:
    best = program_effects.groupBy("target").agg(F.max(F.struct(F.round(F.abs("mean_log2fc"), 12).alias("m"), "program", "mean_log2fc")).alias("_b"))
    return best.select("target", F.col("_b.program").alias("strongest_gene_program"), F.col("_b.mean_log2fc").alias("gene_program_effect"))


def module_connectivity(edges: DataFrame, modules: DataFrame) -> DataFrame:
    """Regulatory edges between modules over the product of their sizes, zeros filled."""
    sizes = modules.groupBy("module").agg(F.count(F.lit(1)).alias("n"))
    placed = edges.join(modules.select(F.col("item").alias("source"), F.col("module").alias("from_module")), "source").join(modules.select(F.col("item").alias("regulated"), F.col("module").alias("to_module")), "regulated")
    counts = placed.groupBy("from_module", "to_module").agg(F.count(F.lit(1)).alias("n_edges"))
    grid = complete(sizes.select(F.col("module").alias("from_module"), F.col("n").alias("_i")), sizes.select(F.col("module").alias("to_module")), "to_module")
    grid = grid.join(sizes.select(F.col("module").alias("to_module"), F.col("n").alias("_j")), "to_module").join(counts, ["from_module", "to_module"], "left").na.fill(0, ["n_edges"])
    return grid.select("from_module", "to_module", "n_edges", (F.col("n_edges") / (F.col("_i") * F.col("_j"))).alias("connectivity"))


def flow_shares(strength: DataFrame) -> DataFrame:
    """|strength| as a share of the total, with its sign."""
    total = strength.agg(F.sum(F.abs("strength")).alias("_t"))
    return strength.crossJoin(F.broadcast(total)).select("module", "program", ratio(F.abs("strength"), F.col("_t")).alias("share"), F.signum("strength").alias("sign"))


def zscore_activity(cells: DataFrame, expr: DataFrame, programs: DataFrame, value: str = "lognorm") -> DataFrame:
    """Mean z-scored expression of a program's genes per cell, zeros included.

    A cell's sum over stored genes is corrected by the constant that absent genes
    contribute, so the cells x genes block is never filled.
    """
    genes = programs.select(F.col("item").alias("feature"), F.col("module").alias("program"))
    n = cells.agg(F.count(F.lit(1)).alias("_n"))
    own = expr.select("cell_id", "feature", value).join(cells.select("cell_id"), "cell_id", "left_semi").join(genes, "feature")
    moments = own.groupBy("feature", "program").agg(F.sum(value).alias("_s"), F.sum(F.col(value) * F.col(value)).alias("_q")).crossJoin(F.broadcast(n))
    mu = F.col("_s") / F.col("_n")
    sd = F.sqrt(F.greatest(F.lit(0.0), F.col("_q") / F.col("_n") - mu * mu))
    moments = genes.join(moments.select("feature", mu.alias("mu"), F.when(sd > 0, sd).otherwise(1.0).alias("sd")), "feature", "left").na.fill(0.0, ["mu"]).na.fill(1.0, ["sd"])
    base = moments.groupBy("program").agg(F.count(F.lit(1)).alias("_g"), F.sum(F.col("mu") / F.col("sd")).alias("_base"))
    sums = own.join(moments.select("feature", "sd"), "feature").groupBy("cell_id", "program").agg(F.sum(F.col(value) / F.col("sd")).alias("_x"))
    grid = complete(cells.select("cell_id"), base, "program").join(base, "program").join(sums, ["cell_id", "program"], "left")
    return grid.select("cell_id", "program", ((F.coalesce("_x", F.lit(0.0)) - F.col("_base")) / F.col("_g")).alias("activity"))


def control_genes(expr: DataFrame, features: DataFrame, n_cells: DataFrame, programs: DataFrame, ctrl_size: int = 50, n_bins: int = 25, seed: int = 0, value: str = "lognorm") -> DataFrame:
    """Expression-matched control genes of every program.

    Genes are binned by the rank of their mean; in each bin holding a program gene
    the first ``ctrl_size`` genes in hash order are drawn, program genes excluded.
    """
    sums = expr.groupBy("feature").agg(F.sum(value).alias("_s"))
    means = features.select("feature").distinct().join(sums, "feature", "left").na.fill(0.0, ["_s"]).crossJoin(F.broadcast(n_cells)).withColumn("mean", F.col("_s") / F.col("n_cells"))
    # the gene table: one row per gene
    size = F.count(F.lit(1)).over(W.partitionBy())
    rank = F.rank().over(W.orderBy("mean")) - 1
    binned = means.withColumn("bin", F.floor(rank / F.greatest(F.lit(1.0), F.round(size / F.lit(float(n_bins - 1))))).cast("int")).select("feature", "bin")
    own = programs.select(F.col("item").alias("feature"), F.col("module").alias("program"))
    wanted = own.join(binned, "feature").select("program", "bin").distinct()
    digest = F.sha2(F.concat_ws("|", F.lit(str(seed)), "feature"), 256)
    drawn = binned.withColumn("_k", F.row_number().over(W.partitionBy("bin").orderBy(digest, "feature"))).where(F.col("_k") <= ctrl_size)
    return wanted.join(drawn, "bin").select("program", "feature").join(own, ["program", "feature"], "left_anti")


def program_activity(cells: DataFrame, expr: DataFrame, features: DataFrame, n_cells: DataFrame, programs: DataFrame, ctrl_size: int = 50, n_bins: int = 25, seed: int = 0, value: str = "lognorm") -> DataFrame:
    """Mean expression of a program's genes minus that of its matched control genes, per cell."""
    own = programs.select(F.col("module").alias("program"), F.col("item").alias("feature"), F.lit(1).alias("sign"))
    ctrl = control_genes(expr, features, n_cells, programs, ctrl_size, n_bins, seed, value).withColumn("sign", F.lit(-1))
    members = own.unionByName(ctrl)
    weights = members.groupBy("program", "sign").agg(F.count(F.lit(1)).alias("_n"))
    weighted = members.join(weights, ["program", "sign"]).select("program", "feature", (F.col("sign") / F.col("_n")).alias("w"))
    sums = expr.select("cell_id", "feature", value).join(weighted, "feature").groupBy("cell_id", "program").agg(F.sum(F.col(value) * F.col("w")).alias("activity"))
    grid = complete(cells.select("cell_id"), own, "program").join(sums, ["cell_id", "program"], "left")
    return grid.na.fill(0.0, ["activity"])


def activity_by_group(activity: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    return activity.join(groups.select("cell_id", key), "cell_id").groupBy("program", key).agg(F.avg("activity").alias("mean_activity"))


def hubs(effects: DataFrame, modules: DataFrame) -> DataFrame:
    """Differentially expressed genes per target with its module."""
    counts = effects.groupBy("target").agg(F.count_if("de").alias("n_de_genes"))
    return counts.join(modules.select(F.col("item").alias("target"), "module"), "target", "left")


def module_run(effects: DataFrame, n_programs: int | None = 4, n_modules: int | None = 9, program_method: str = "pearson", module_method: str = "spearman", linkage: str = "average",
               min_perturbations: int = 5, min_genes: int = 10, height: float = 0.7) -> tuple[DataFrame, DataFrame]:
    """(gene programs, perturbation modules) of an effect matrix; too small a matrix is an error."""
    n = effects.agg(F.countDistinct("target").alias("t"), F.countDistinct("feature").alias("g")).first()
    if n["t"] < min_perturbations or n["g"] < min_genes:
        raise ValueError(f"{n['t']} perturbations and {n['g']} genes are too few")
    programs = cluster_axis(effects, "feature", "target", "log2fc", program_method, n_programs, "P", linkage, height)
    return programs, cluster_axis(effects, "target", "feature", "log2fc", module_method, n_modules, "M", linkage, height)


#: which gene panels are tried for a wanted one, in order
PANEL_ORDER = {"cluster_markers": ("cluster_markers", "variable"), "response": ("response", "variable"), "variable": ("variable",)}


def choose_panel(wanted: str, panels: Mapping[str, DataFrame], expressed: DataFrame, min_genes: int = 10) -> tuple[DataFrame, str]:
    """(feature) of the first panel in the order of ``wanted`` that has ``min_genes`` expressed genes, and its name."""
    for name in PANEL_ORDER[wanted]:
        if name in panels:
            genes = panels[name].select("feature").distinct().join(expressed.select("feature"), "feature", "left_semi")
            if genes.count() >= min_genes:
                return genes, name
    raise ValueError(f"no panel for {wanted} has {min_genes} expressed genes")


def module_tables(effects: DataFrame, panels: Mapping[str, DataFrame], expressed: DataFrame, wanted: str = "cluster_markers", min_genes: int = 10, **options) -> dict[str, DataFrame]:
    """The module stage from panel to result tables: panel, programs, modules, program_effects and hubs.

    ``effects(target, feature, log2fc, de)`` is cut to the chosen panel; the
    hubs count all differential genes.  Further options go to ``module_run``.
    """
    panel, used = choose_panel(wanted, panels, expressed, min_genes)
    own = effects.join(panel, "feature", "left_semi")
    programs, modules = module_run(own, min_genes=min_genes, **options)
    by_program = target_program_effects(own, programs).join(modules.select(F.col("item").alias("target"), "module"), "target", "left")
    return {"panel": panel.withColumn("panel", F.lit(used)), "programs": programs, "modules": modules, "program_effects": by_program, "hubs": hubs(effects, modules)}


def partition_agreement(labels: DataFrame, first: str, second: str) -> DataFrame:
    """Adjusted Rand index and normalised mutual information from the contingency table (one row)."""
    table = labels.groupBy(first, second).agg(F.count(F.lit(1)).alias("c"))
    r = table.groupBy(first).agg(F.sum("c").alias("c"))
    k = table.groupBy(second).agg(F.sum("c").alias("c"))
    two = lambda c: F.sum(F.col(c) * (F.col(c) - 1) / 2.0)
    xlx = lambda c: F.sum(F.col(c) * F.log(F.col(c).cast("double")))
    t = table.agg(two("c").alias("t2"), xlx("c").alias("tx"), F.sum("c").alias("n"))
    s = t.crossJoin(r.agg(two("c").alias("r2"), xlx("c").alias("rx"))).crossJoin(k.agg(two("c").alias("k2"), xlx("c").alias("kx")))  # one row each
    n = F.col("n").cast("double")
    expected = F.col("r2") * F.col("k2") / (n * (n - 1) / 2)
    ari = F.try_divide(F.col("t2") - expected, (F.col("r2") + F.col("k2")) / 2 - expected)
    hr, hk = F.log(n) - F.col("rx") / n, F.log(n) - F.col("kx") / n
    mi = F.log(n) + (F.col("tx") - F.col("rx") - F.col("kx")) / n
    return s.select(F.coalesce(ari, F.lit(1.0)).alias("ari"), F.coalesce(F.try_divide(mi, (hr + hk) / 2), F.lit(1.0)).alias("nmi"))


def similarity_order(labels: DataFrame) -> DataFrame:
    """Row order of a matrix: by module, then by name (a table as long as the row axis)."""
    return labels.withColumn("position", F.row_number().over(W.orderBy(F.length("module"), "module", "item")))
