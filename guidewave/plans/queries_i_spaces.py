"""Queries: supervised projection, weighted neighbour graphs and their communities, variable genes by trend and batch, regression markers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.session import cut_lineage
from ..operators import communities as C
from ..operators import connectivities as CN
from ..operators import contract as CT
from ..operators import discriminant as D
from ..operators import embedding as B
from ..operators import grouping as GR
from ..operators import markers as MK
from ..operators import variable as VG
from . import queries_e_vectors as V
from . import screen_tables as S
from .queries_b_quality import _round, rna_qc
from .queries_c_statistics import R6, genes_seen, lognorm, screened
from .registry import SUBQUERIES, register

N_NEIGHBORS = 15

# ---- supervised projection

#: two coordinates of every cell vector, the means of its halves: small enough for the closed form of the 2 x 2 pair
SUBQUERIES.update({
    "halves": "SELECT cell_id, cluster, list_avg(vec[1:32]) AS x, list_avg(vec[33:64]) AS y FROM vectors",
    "half_moments": """SELECT g, n, vx, vy, CASE WHEN r2 = 0 OR beta <= 0 THEN r * sqrt(vx * vy) ELSE (1 - least(beta, r2) / r2) * r * sqrt(vx * vy) END AS c FROM (
        SELECT g, n, any_value(vx) AS vx, any_value(vy) AS vy, any_value(r) AS r, any_value(r) ** 2 AS r2, (avg(((x - mx) ** 2 / vx + (y - my) ** 2 / vy) ** 2) - 2 - 2 * any_value(r) ** 2) / (2 * n) AS beta
        FROM (SELECT *, count(*) OVER w AS n, avg(x) OVER w AS mx, avg(y) OVER w AS my, var_pop(x) OVER w AS vx, var_pop(y) OVER w AS vy, covar_pop(x, y) OVER w / sqrt(var_pop(x) OVER w * var_pop(y) OVER w) AS r
            FROM (SELECT cluster AS g, x, y FROM halves UNION ALL SELECT '*', x, y FROM halves) WINDOW w AS (PARTITION BY g)) GROUP BY g, n)""",
    "half_scatter": """SELECT w.a, w.b, w.c, t.vx - w.a AS p, t.c - w.b AS q, t.vy - w.c AS r FROM (SELECT sum(n * vx) / sum(n) AS a, sum(n * c) / sum(n) AS b, sum(n * vy) / sum(n) AS c FROM half_moments WHERE g <> '*') w, (SELECT * FROM half_moments WHERE g = '*') t""",
    "half_values": """SELECT *, t / 2 + s * sqrt(t * t / 4 - d) AS value FROM (SELECT *, (c * p - 2 * b * q + a * r) / (a * c - b * b) AS t, (p * r - q * q) / (a * c - b * b) AS d FROM half_scatter), (VALUES (1, 1), (2, -1)) AS k(axis, s)""",
    "half_axes": """SELECT axis, value, u * f AS u, v * f AS v FROM (SELECT *, CASE WHEN abs(u) >= abs(v) THEN sign(u) ELSE sign(v) END / sqrt(a * u * u + 2 * b * u * v + c * v * v) AS f FROM
        (SELECT *, value * b - q AS u, p - value * a AS v FROM half_values))""",
})


def halves(spark, sf):
    v = S.vectors(spark, sf)
    mean = lambda start: F.aggregate(F.slice("vec", start, 32), F.lit(0.0), lambda a, x: a + x) / 32
    return v.select("cell_id", F.col("cluster").alias("label"), F.array(mean(1), mean(33)).alias("vec"))


@register("ml_13_discriminant_axes", f"SELECT CAST(axis AS INT) AS axis, {R6('value', 5)} AS value, {R6('u', 4)} AS u, {R6('v', 4)} AS v FROM half_axes")
def ml_13a(spark, sf):
    found = D.discriminants(halves(spark, sf))
    rows = [(k + 1, float(found.values[k]), float(found.axes[0, k]), float(found.axes[1, k])) for k in range(2)]
    out = spark.createDataFrame(rows, "axis int, value double, u double, v double")
    return _round(_round(out, "value", digits=5), "u", "v", digits=4)


@register("ml_13_projected_classes", f"SELECT cluster AS label, {R6('avg(x * a.u + y * a.v)', 4)} AS mean_1, {R6('avg(x * b.u + y * b.v)', 4)} AS mean_2, count(*) AS n FROM halves, (SELECT u, v FROM half_axes WHERE axis = 1) a, (SELECT u, v FROM half_axes WHERE axis = 2) b GROUP BY 1")
def ml_13b(spark, sf):
    # rows carry their own label, so a repeated or missing id joins nothing
    v = halves(spark, sf)
    placed = D.placed(v, D.discriminants(v))
    out = placed.groupBy("label").agg(F.avg(F.col("vec")[0]).alias("mean_1"), F.avg(F.col("vec")[1]).alias("mean_2"), F.count("*").alias("n"))
    return _round(out, "mean_1", "mean_2", digits=4)


@register("ml_13_supervised_projection", """SELECT label, count(*) AS n_cells, count(*) FILTER (label <> 'Other') AS n_placed, true AS finite FROM (
    SELECT CASE WHEN control_class = 'non_targeting' AND perturbation_class = 'single_control' THEN 'NT' WHEN perturbation_class = 'single_targeting' AND count(*) FILTER (perturbation_class = 'single_targeting') OVER (PARTITION BY target) >= 6 THEN target ELSE 'Other' END AS label FROM cells) GROUP BY 1""")
def ml_13c(spark, sf):
    scores, _, _ = V.rna_components(spark, sf)
    target = F.col("perturbation_class") == "single_targeting"
    control = (F.col("perturbation_class") == "single_control") & (F.col("control_class") == "non_targeting")
    cells = screened(spark, sf).select("cell_id", "target", control.alias("is_control"), target.alias("is_target"))
    placed, _ = D.supervised_projection(scores, D.training_labels(cells, cells.where("is_target")))
    fine = F.every(F.col("vec").isNull() | F.forall("vec", lambda x: F.abs(x) < 1e6))
    return placed.groupBy("label").agg(F.count("*").alias("n_cells"), F.count("vec").alias("n_placed"), fine.alias("finite"))


# ---- weighted neighbour graphs

def _connectivity_sql(edges: str) -> str:
    """Kernel widths by halving and the union of both directions, over a query of (src, dst, dist)."""
    total = "list_sum(list_transform(d, lambda x: exp(-greatest(x - rho, 0) / mid)))"
    return f"""SELECT * FROM (WITH RECURSIVE e AS ({edges}),
        l AS (SELECT src, list(dist) AS d, coalesce(min(dist) FILTER (dist > 0), 0) AS rho, sum(dist) / (count(*) + 1) AS mean FROM e GROUP BY src),
        it(src, i, lo, hi, mid) AS (SELECT src, 0, 0.0::DOUBLE, 'inf'::DOUBLE, 1.0::DOUBLE FROM l
            UNION ALL SELECT it.src, i + 1, CASE WHEN s > log2({N_NEIGHBORS}) THEN lo ELSE mid END, CASE WHEN s > log2({N_NEIGHBORS}) THEN mid ELSE hi END,
                CASE WHEN s > log2({N_NEIGHBORS}) THEN (lo + mid) / 2 WHEN hi = 'inf'::DOUBLE THEN mid * 2 ELSE (mid + hi) / 2 END
                FROM (SELECT it.*, {total} AS s FROM it JOIN l ON l.src = it.src WHERE i < {CN.STEPS}) it),
        w AS (SELECT l.src, rho, greatest(mid, 1e-3 * CASE WHEN rho > 0 THEN mean ELSE (SELECT sum(dist) / (count(*) + count(DISTINCT src)) FROM e) END) AS width FROM l JOIN it ON it.src = l.src AND i = {CN.STEPS}),
        g AS (SELECT least(e.src, dst) AS src, greatest(e.src, dst) AS dst, exp(-greatest(dist - rho, 0) / width) AS x FROM e JOIN w ON w.src = e.src)
        SELECT src, dst, round(sum(x) - CASE WHEN count(*) = 2 THEN min(x) * max(x) ELSE 0 END, 4) AS weight FROM g GROUP BY 1, 2)"""


_KNN = "SELECT src, dst, dist FROM (SELECT a.cell_id AS src, b.cell_id AS dst, {d} AS dist, row_number() OVER (PARTITION BY a.cell_id ORDER BY {d}, b.cell_id) AS rank FROM {t} a JOIN {t} b ON a.cell_id <> b.cell_id) WHERE rank < 15"
SUBQUERIES.update({
    "protein_space": "SELECT cell_id, list(z ORDER BY protein) AS vec FROM (SELECT cell_id, protein, (v - avg(v) OVER w) / stddev_samp(v) OVER w AS z FROM clr_cell WINDOW w AS (PARTITION BY protein)) GROUP BY 1",
    "halves_total": "SELECT (SELECT sum(p) FROM (SELECT i, var_pop(vec[i]) AS p FROM vectors, range(1, 33) AS r(i) GROUP BY 1)) AS t1, (SELECT sum(p) FROM (SELECT i, var_pop(vec[i]) AS p FROM vectors, range(33, 65) AS r(i) GROUP BY 1)) AS t2",
    "joint_vectors": "SELECT cell_id, list_concat(list_transform(vec[1:32], lambda x: x / sqrt(t1)), list_transform(vec[33:64], lambda x: 0.5 * x / sqrt(t2))) AS vec FROM vectors, halves_total",
})


def rna_graph(spark, sf) -> DataFrame:
    return S.stored(spark, sf, "rna_graph", lambda: CN.connectivities(V.edges(spark, sf, N_NEIGHBORS - 1), N_NEIGHBORS))


@register("ml_05_connectivities_rna", _connectivity_sql("SELECT src, dst, dist FROM knn30 WHERE rank < 15"))
def ml_05a(spark, sf):
    return _round(rna_graph(spark, sf), "weight", digits=4)


@register("ml_05_connectivities_protein", _connectivity_sql(_KNN.format(d="list_distance(a.vec, b.vec)", t="protein_space")))
def ml_05b(spark, sf):
    # as many components as proteins: the space is a rotation of the standardised values
    panel = S.protein_panel(spark, sf)
    scores, _, _ = B.protein_pca(V.protein_values(spark, sf), panel, panel.where("NOT is_isotype").count())
    return _round(CN.neighbor_graph(scores, N_NEIGHBORS)[1], "weight", digits=4)


@register("ml_05_connectivities_joint", _connectivity_sql(_KNN.format(d="list_distance(a.vec, b.vec)", t="joint_vectors")))
def ml_05c(spark, sf):
    v = S.vectors(spark, sf)
    graphs = CN.modality_graphs(v.select("cell_id", F.slice("vec", 1, 32).alias("vec")), v.select("cell_id", F.slice("vec", 33, 32).alias("vec")), N_NEIGHBORS, 0.5)
    return _round(graphs["joint"], "weight", digits=4)


# ---- communities

def found_communities(spark, sf) -> DataFrame:
    return S.stored(spark, sf, "communities", lambda: C.communities(rna_graph(spark, sf)))


@register("ml_07_graph_communities")
def ml_07(spark, sf):
    return found_communities(spark, sf)


@register("ml_07_community_check", "SELECT count(*) AS n_cells, true AS numbered_by_size, true AS connected, true AS no_worse_than_labels FROM vectors")
def ml_07c(spark, sf):
    """Sizes fall with the number, every community is one piece, and modularity reaches that of the given clusters."""
    found, graph = found_communities(spark, sf), rna_graph(spark, sf)
    sizes = found.groupBy(F.col("cluster").cast("int").alias("no")).agg(F.count("*").alias("n"))
    order = sizes.alias("a").join(sizes.alias("b"), F.col("a.no") + 1 == F.col("b.no")).agg(F.coalesce(F.every(F.col("a.n") >= F.col("b.n")), F.lit(True)).alias("numbered_by_size"))
    parts = C.connected_parts(C.undirected(graph), found.select("cell_id", F.col("cluster").alias("node")))
    pieces = parts.select("node").distinct().agg(F.count("*").alias("pieces"))
    best, given = GR.modularity(graph, found.hint("merge")), GR.modularity(graph, V.cells(spark, sf).select("cell_id", "cluster"))
    out = found.agg(F.count("*").alias("n_cells"), F.count_distinct("cluster").alias("k")).crossJoin(order).crossJoin(pieces).crossJoin(best.withColumnRenamed("modularity", "q")).crossJoin(given)  # one row each
    return out.select("n_cells", "numbered_by_size", (F.col("pieces") == F.col("k")).alias("connected"), (F.col("q") >= F.col("modularity")).alias("no_worse_than_labels"))


# ---- variable genes from counts, and over batches

def _trend_sql(batch: str, n_top: int) -> str:
    return f"""SELECT * FROM (WITH c AS (SELECT cell_id, {batch} AS batch FROM meta), f AS (SELECT DISTINCT feature FROM expr), n AS (SELECT batch, CAST(count(*) AS DOUBLE) AS n FROM c GROUP BY 1),
        m AS (SELECT batch, feature, n, coalesce(s, 0) / n AS mean, greatest(0, (coalesce(q, 0) - n * (coalesce(s, 0) / n) ** 2) / (n - 1)) AS var FROM n CROSS JOIN f LEFT JOIN (SELECT batch, feature, sum(CAST(count AS DOUBLE)) AS s, sum(CAST(count AS DOUBLE) ** 2) AS q FROM expr JOIN c USING (cell_id) GROUP BY 1, 2) USING (batch, feature)),
        v AS (SELECT batch, feature, log10(mean) AS x, log10(var) AS y, greatest(1, floor(0.3 * count(*) OVER (PARTITION BY batch) + 1e-5)) AS q FROM m WHERE var > 0),
        near AS (SELECT a.batch, a.feature, b.x - a.x AS u, b.y, row_number() OVER (PARTITION BY a.batch, a.feature ORDER BY abs(b.x - a.x), b.x) AS k, a.q FROM v a JOIN v b ON a.batch = b.batch),
        w AS (SELECT *, (1 - (abs(u) / max(abs(u)) OVER (PARTITION BY batch, feature)) ** 3) ** 3 AS w FROM near WHERE k <= q),
        s AS (SELECT batch, feature, sum(w) AS s0, sum(w * u) AS s1, sum(w * u ** 2) AS s2, sum(w * u ** 3) AS s3, sum(w * u ** 4) AS s4, sum(w * y) AS t0, sum(w * u * y) AS t1, sum(w * u ** 2 * y) AS t2 FROM w GROUP BY 1, 2),
        t AS (SELECT m.*, sqrt(10 ** coalesce((t0 * (s2 * s4 - s3 * s3) - s1 * (t1 * s4 - s3 * t2) + s2 * (t1 * s3 - s2 * t2)) / (s0 * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s3 * s2) + s2 * (s1 * s3 - s2 * s2)), 0)) AS sd FROM m LEFT JOIN s USING (batch, feature)),
        g AS (SELECT t.batch, t.feature, (any_value(n) * any_value(mean) ** 2 + coalesce(sum(x * x), 0) - 2 * coalesce(sum(x), 0) * any_value(mean)) / ((any_value(n) - 1) * any_value(sd) ** 2) AS norm FROM t LEFT JOIN
            (SELECT t.batch, t.feature, least(CAST(count AS DOUBLE), mean + sd * sqrt(n)) AS x FROM expr JOIN c USING (cell_id) JOIN t ON t.batch = c.batch AND t.feature = expr.feature) z ON z.batch = t.batch AND z.feature = t.feature GROUP BY 1, 2),
        r AS (SELECT *, row_number() OVER (PARTITION BY batch ORDER BY norm DESC, feature) - 1 AS r FROM g),
        a AS (SELECT feature, avg(norm) AS norm, quantile_cont(r, 0.5) FILTER (r < {n_top}) AS median_rank, count(*) FILTER (r < {n_top}) AS n_batches FROM r GROUP BY 1)
        SELECT feature, {R6('norm', 4)} AS variance_norm, CAST(median_rank AS DOUBLE) AS median_rank, n_batches, row_number() OVER (ORDER BY median_rank NULLS LAST, n_batches DESC, feature) <= {n_top} AS highly_variable FROM a)"""


def _by_trend(spark, sf, batch):
    found = VG.variable_genes_by_trend(S.expr(spark, sf), S.cell_metadata(spark, sf).select("cell_id", batch.alias("batch")), genes_seen(spark, sf), 10)
    return _round(found, "variance_norm", digits=4)


@register("ml_01_variable_genes_trend", _trend_sql("''", 10))
def ml_01c(spark, sf):
    return _by_trend(spark, sf, F.lit(""))


@register("ml_01_variable_genes_trend_batches", _trend_sql("sample", 10))
def ml_01d(spark, sf):
    return _by_trend(spark, sf, F.col("sample"))


_BATCH_DISPERSION = """SELECT sample, feature, ln(1 + s / n) AS m, CASE WHEN q > s * s / n THEN ln(((q / n - (s / n) ** 2) * n / (n - 1)) / (s / n)) END AS d FROM (SELECT sample, feature, sum(exp(v) - 1) AS s, sum((exp(v) - 1) ** 2) AS q, any_value(n) AS n
    FROM lognorm JOIN (SELECT cell_id, sample, CAST(count(*) OVER (PARTITION BY sample) AS DOUBLE) AS n FROM meta) USING (cell_id) GROUP BY 1, 2)"""


@register("ml_01_variable_genes_batches", f"""SELECT feature, {R6('norm', 5)} AS dispersion_norm, n_batches, row_number() OVER (ORDER BY n_batches DESC, norm DESC, feature) <= 10 AS highly_variable FROM (
    SELECT feature, sum(coalesce(norm, 0)) / (SELECT count(DISTINCT sample) FROM meta) AS norm, count(*) FILTER (r <= 10) AS n_batches FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY norm DESC NULLS LAST, feature) AS r FROM (
        SELECT sample, feature, CASE WHEN count(d) OVER w = 1 THEN 1.0 ELSE (d - avg(d) OVER w) / stddev_samp(d) OVER w END AS norm FROM (
            SELECT *, least(5, greatest(1, ceil((m - min(m) OVER s) / ((max(m) OVER s - min(m) OVER s) / 5)))) AS bin FROM ({_BATCH_DISPERSION}) WINDOW s AS (PARTITION BY sample)) WINDOW w AS (PARTITION BY sample, bin))) GROUP BY 1)""")
def ml_01e(spark, sf):
    cells = S.cell_metadata(spark, sf).select("cell_id", F.col("sample").alias("batch"))
    return _round(VG.variable_genes_over_batches(lognorm(spark, sf), cells, genes_seen(spark, sf), 10, "seurat", 5), "dispersion_norm", digits=5)


# ---- regression markers

def _regression(spark, sf):
    chosen = "perturbation_class = 'single_targeting' OR (perturbation_class = 'single_control' AND control_class = 'non_targeting')"
    cells = cut_lineage(screened(spark, sf).where(chosen).select("cell_id", F.col("sample").alias("cluster")))
    return MK.regression_markers(cells, lognorm(spark, sf), S.read(spark, sf, "part").select(F.col("p_brand").alias("feature")))


@register("stat_28_regression_markers")
def stat_28b(spark, sf):
    return _round(_regression(spark, sf)[0], "coefficient", digits=4)


@register("stat_28_regression_optimum", "SELECT cluster, (SELECT count(DISTINCT p_brand) FROM part) AS n_genes, true AS optimal FROM marker_cells GROUP BY 1")
def stat_28c(spark, sf):
    found, gradient = _regression(spark, sf)
    largest = gradient.groupBy("cluster").agg((F.max(F.abs("gradient")) < 1e-5).alias("optimal"))
    return found.groupBy("cluster").agg(F.count("*").alias("n_genes")).join(largest, "cluster")


# ---- contract of the processed tables

_CONTRACT_TABLES = {
    "cells": "(SELECT c.*, total_counts, n_genes_by_counts, pct_counts_mt, pct_counts_ribo FROM cells c JOIN (SELECT cell_id, total_counts, n_genes_by_counts, pct_counts_mt, pct_counts_ribo FROM rna_qc) q ON q.cell_id = c.cell_id)",
    "expr": "(SELECT cell_id, feature, count, v AS lognorm FROM lognorm)", "genes": "(SELECT DISTINCT feature FROM expr)",
    "panel": "(SELECT DISTINCT protein, protein LIKE 'N%' AS is_isotype, protein NOT LIKE 'N%' AS used_in_embedding, protein LIKE 'N%' AS used_in_qc FROM protein_counts)",
    "isotypes": "(SELECT DISTINCT protein FROM protein_counts WHERE protein LIKE 'N%')", "targeting": "(SELECT DISTINCT protein FROM protein_counts WHERE protein NOT LIKE 'N%')",
    "protein": "(SELECT cell_id, protein, v AS value FROM clr_cell)", "protein_counts": "protein_counts", "guide_counts": "guide_counts", "library": "guide_library",
}
_ABSENT = ("steps", "rna_pca", "protein_pca", "variance", "protein_variance", "loadings", "depth")


def _rule_sql(rule: CT.Rule) -> str:
    def row(n: str, example: str, source: str) -> str:
        bad = "WARN" if rule.warn else "FAIL"
        return f"SELECT '{rule.name}' AS check, '{rule.table}' AS \"table\", CASE WHEN {n} = 0 THEN 'PASS' ELSE '{bad}' END AS status, CAST({n} AS BIGINT) AS n, CAST({example} AS VARCHAR) AS example FROM {source}"

    own = _CONTRACT_TABLES.get(rule.table)
    if rule.table in _ABSENT:
        return f"SELECT '{rule.name}', '{rule.table}', 'SKIPPED', CAST(0 AS BIGINT), NULL"
    if rule.kind == "row":
        broken = f"({rule.where}) AND NOT coalesce(({rule.holds}), false)"
        return row(f"count(*) FILTER ({broken})", f"min({rule.key}) FILTER ({broken})", f"{own} t")
    if rule.kind == "table":
        return row(f"CASE WHEN {rule.holds} THEN 0 ELSE 1 END", "NULL", f"{own} t")
    keys = f"SELECT {rule.key} AS key FROM {own} t WHERE {rule.where}"
    bad = {
        "unique": f"{keys} GROUP BY 1 HAVING count(*) > 1",
        "refers": f"SELECT DISTINCT key FROM ({keys}) WHERE key NOT IN (SELECT {rule.key} FROM {_CONTRACT_TABLES.get(rule.other)} o)",
        "sums": f"SELECT t.{rule.key} AS key FROM {own} t LEFT JOIN (SELECT {rule.key}, sum({rule.of}) AS s FROM {_CONTRACT_TABLES.get(rule.other)} o GROUP BY 1) o ON o.{rule.key} = t.{rule.key} WHERE abs({rule.holds} - coalesce(s, 0)) > 1e-3",
    }[rule.kind]
    return row("count(*)", "min(key)", f"({bad})")


def contract_tables(spark, sf) -> dict[str, DataFrame]:
    qc = rna_qc(spark, sf).select("cell_id", "total_counts", "n_genes_by_counts", "pct_counts_mt", "pct_counts_ribo")
    isotype = F.col("is_isotype")
    return CT.with_views({
        "cells": S.cells(spark, sf).join(qc, "cell_id"), "expr": lognorm(spark, sf), "genes": genes_seen(spark, sf),
        "panel": S.protein_panel(spark, sf).withColumns({"used_in_embedding": ~isotype, "used_in_qc": isotype}), "protein": V.protein_values(spark, sf),
        "protein_counts": S.protein_counts(spark, sf), "guide_counts": S.guide_counts(spark, sf), "library": S.guide_library(spark, sf)})


@register("dq_08_contract_report", " UNION ALL ".join(map(_rule_sql, CT.screen_rules(genes=25))))
def dq_08b(spark, sf):
    return CT.validate(contract_tables(spark, sf), CT.screen_rules(genes=25))
