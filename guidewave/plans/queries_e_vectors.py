"""Queries: neighbours, local enrichment, variable genes, components, joint spaces."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import embedding as B
from ..operators import neighborhood as H
from ..operators import neighbors as KN
from ..operators import proteins as P
from . import screen_tables as S
from .queries_b_quality import _round, rna_qc, protein_qc
from .queries_c_statistics import R6, antibody_cells, genes_seen, lognorm
from .registry import SUBQUERIES, register

CLASSES = ["non_targeting"]
K = 30
N_PERMUTATIONS = 1000

SUBQUERIES.update({
    "knn30": "SELECT src, dst, dist, rank FROM (SELECT a.cell_id AS src, b.cell_id AS dst, list_distance(a.vec, b.vec) AS dist, row_number() OVER (PARTITION BY a.cell_id ORDER BY list_distance(a.vec, b.vec), b.cell_id) AS rank FROM vectors a JOIN vectors b ON a.cell_id <> b.cell_id) WHERE rank <= 30",
    "cubes": "SELECT cell_id, list_transform(vec, lambda x: x * x * x) AS cube FROM vectors",
    "loch": """SELECT t.target, v.cell_id, v.target AS own, v.cluster, v.sample, coalesce(c.n, 0) / 30.0 / (t.n / (SELECT count(*) FROM vectors)) - 1 AS score, t.n AS n_cells FROM (SELECT target, count(*) AS n FROM vectors GROUP BY 1) t CROSS JOIN vectors v
        LEFT JOIN (SELECT src, target, count(*) AS n FROM knn30 JOIN vectors ON dst = cell_id GROUP BY 1, 2) c ON c.src = v.cell_id AND c.target = t.target""",
})


def edges(spark, sf, k=K):
    return S.stored(spark, sf, f"knn{k}", lambda: KN.knn(S.vectors(spark, sf), k))


def cells(spark, sf):
    return S.vectors(spark, sf).drop("vec")


@register("join_15_exact_knn", f"SELECT src, dst, {R6('dist', 4)} AS dist, CAST(rank AS INT) AS rank FROM knn30")
def join_15(spark, sf):
    return _round(edges(spark, sf), "dist", digits=4)


@register("win_09_neighbor_rank", "SELECT src, dst AS nearest FROM knn30 WHERE rank = 1")
def win_09(spark, sf):
    return edges(spark, sf, 1).select("src", F.col("dst").alias("nearest"))


@register("ml_05_neighbor_graph", "SELECT dst AS cell_id, count(*) AS in_degree FROM knn30 WHERE rank <= 14 GROUP BY 1")
def ml_05(spark, sf):
    k = H.stored_neighbors(15, 10**6)
    return edges(spark, sf, k).groupBy(F.col("dst").alias("cell_id")).agg(F.count(F.lit(1)).alias("in_degree"))


_SECOND = "SELECT src, dst FROM (SELECT a.cell_id AS src, b.cell_id AS dst, row_number() OVER (PARTITION BY a.cell_id ORDER BY list_distance(a.cube, b.cube), b.cell_id) AS rank FROM cubes a JOIN cubes b ON a.cell_id <> b.cell_id) WHERE rank <= 10"


@register("join_16_knn_overlap", f"SELECT count(*) AS n_cells, round(avg(n) / 10, 6) AS overlap_mean, round(10.0 / ((SELECT count(*) FROM vectors) - 1), 6) AS overlap_expected FROM (SELECT v.cell_id, count(b.dst) AS n FROM vectors v LEFT JOIN (SELECT * FROM knn30 WHERE rank <= 10) a ON a.src = v.cell_id LEFT JOIN ({_SECOND}) b ON a.src = b.src AND a.dst = b.dst GROUP BY 1)")
def join_16(spark, sf):
    v = S.vectors(spark, sf)
    part = v.select("cell_id", F.transform("vec", lambda x: x * x * x).alias("vec"))
    return _round(KN.knn_overlap(KN.knn(v, 10), KN.knn(part, 10), 10, v.count()), "overlap_mean", "overlap_expected")


@register("ml_08_local_enrichment_scores", "SELECT cell_id, CASE WHEN target = 'NT' THEN '*control*' ELSE target END AS target, round(score, 6) AS score FROM loch WHERE score > -1")
def ml_08(spark, sf):
    return _round(H.cell_scores(cells(spark, sf), edges(spark, sf), K, CLASSES), "score")


@register("ml_08_own_label_scores", "SELECT cell_id, CASE WHEN target = 'NT' THEN '*control*' ELSE target END AS label, round(score, 6) AS score FROM loch WHERE own = target")
def ml_08b(spark, sf):
    return _round(H.own_scores(cells(spark, sf), edges(spark, sf), K, CLASSES).select("cell_id", "label", "score"), "score")


@register("agg_33_local_enrichment_summary", f"""SELECT target, max(n_cells) AS n_cells, round(100.0 * max(n_cells) / count(*), 6) AS overall_fraction_pct, {R6('avg(score)')} AS mean_all_cells, {R6('avg(score) FILTER (own = target)')} AS mean_in_own_cells,
    {R6('quantile_cont(score, 0.5) FILTER (own = target)')} AS median_in_own_cells, round(max(score), 6) AS max_score, round(100.0 * count(*) FILTER (score > 0.5) / count(*), 6) AS pct_cells_enriched,
    round(100.0 * count(*) FILTER (score > 0.5 AND own = target) / count(*) FILTER (own = target), 6) AS pct_own_cells_enriched, {R6("avg(score) FILTER (own = 'NT')")} AS mean_in_control_cells,
    {R6("avg(score) FILTER (own = target) - avg(score) FILTER (own = 'NT')")} AS delta_own_vs_control FROM loch WHERE target <> 'NT' GROUP BY 1""")
def agg_33(spark, sf):
    out = H.summary(cells(spark, sf), edges(spark, sf), K, CLASSES)
    return _round(out, *[c for c in out.columns if c not in ("target", "n_cells")])


@register("agg_34_local_enrichment_by_cluster", f"SELECT target, cluster, {R6('avg(score)')} AS mean_score FROM loch WHERE target <> 'NT' GROUP BY 1, 2")
def agg_34(spark, sf):
    return _round(H.by_cluster(cells(spark, sf), edges(spark, sf), K, CLASSES), "mean_score")


@register("agg_34_top_cluster", f"SELECT target, arg_max(cluster, (round(s, 9), cluster)) AS top_cluster, {R6('max(s)')} AS top_cluster_mean FROM (SELECT target, cluster, avg(score) AS s FROM loch WHERE target <> 'NT' GROUP BY 1, 2) GROUP BY 1")
def agg_34b(spark, sf):
    return _round(H.top_cluster(H.by_cluster(cells(spark, sf), edges(spark, sf), K, CLASSES)), "top_cluster_mean")


@register("agg_34_sample_support", "SELECT target, count(*) AS n_samples, round(max(n) / sum(n), 6) AS max_sample_share FROM (SELECT target, sample, count(*) AS n FROM vectors WHERE target <> 'NT' GROUP BY 1, 2) GROUP BY 1")
def agg_34c(spark, sf):
    return _round(H.sample_support(H.by_sample(cells(spark, sf), edges(spark, sf), K, CLASSES)), "max_sample_share")


_FIELD = "CAST(('0x' || substr(sha256({}), 1, 13)) AS BIGINT) % 2147483647"
_NULL = f"""WITH g AS (SELECT i AS perm, {_FIELD.format("'0|' || i || '|0'")} AS a, {_FIELD.format("'0|' || i || '|1'")} AS b, {_FIELD.format("'0|' || i || '|2'")} AS c, {_FIELD.format("'0|' || i || '|3'")} AS d FROM range(1, {N_PERMUTATIONS + 1}) AS r(i)),
    x AS (SELECT cell_id, {_FIELD.format("CAST(cell_id AS VARCHAR)")} AS x FROM vectors),
    ranks AS (SELECT perm, cell_id, rank() OVER (PARTITION BY perm ORDER BY v) AS draw FROM (SELECT perm, cell_id, (((a * x + b) % 2147483647 * x + c) % 2147483647 * x + d) % 2147483647 AS v FROM g, x)),
    e AS (SELECT a.perm, greatest(a.draw, b.draw) AS m FROM knn30 k JOIN ranks a ON a.cell_id = k.src JOIN ranks b ON b.cell_id = k.dst AND b.perm = a.perm),
    t AS (SELECT target, count(*) AS n, count(*) / (SELECT count(*) FROM vectors) AS share FROM vectors WHERE target <> 'NT' GROUP BY 1),
    nul AS (SELECT target, perm, count(*) FILTER (m <= n) / 30.0 / max(n) / max(share) - 1 AS s FROM e CROSS JOIN t GROUP BY 1, 2), obs AS (SELECT target, avg(score) AS o FROM loch WHERE own = target GROUP BY 1),
    st AS (SELECT target, max(o) AS observed, avg(s) AS null_mean, stddev_samp(s) AS null_sd, (1 + count(*) FILTER (s >= o - 1e-12)) / (1 + count(*)) AS p FROM nul JOIN obs USING (target) GROUP BY 1),
    rk AS (SELECT *, p * count(*) OVER () / rank_hi AS raw FROM (SELECT *, count(*) OVER (ORDER BY p) AS rank_hi FROM st))
    SELECT target, round(observed, 6) AS observed, round(null_mean, 6) AS null_mean, round(null_sd, 6) AS null_sd, round((observed - null_mean) / null_sd, 5) AS z_score, round(p, 6) AS p_empirical, round(least(1.0, min(raw) OVER (ORDER BY p DESC)), 6) AS fdr FROM rk"""


@register("stat_26_permutation_null", f"SELECT * FROM ({_NULL})")
def stat_26(spark, sf):
    out = H.permutation_null(cells(spark, sf), edges(spark, sf), K, CLASSES, N_PERMUTATIONS)
    return _round(_round(out, "observed", "null_mean", "null_sd", "p_empirical", "fdr"), "z_score", digits=5)


# ---- variable genes and components

def n_cells(spark, sf):
    return S.cell_metadata(spark, sf).agg(F.count(F.lit(1)).alias("n_cells"))


SUBQUERIES["gene_disp"] = """SELECT feature, s / n AS mean0, greatest(0, (q / n - (s / n) ** 2) * n / (n - 1)) / (s / n) AS disp0 FROM (SELECT feature, sum(exp(v) - 1) AS s, sum((exp(v) - 1) ** 2) AS q, CAST((SELECT count(*) FROM meta) AS DOUBLE) AS n FROM lognorm GROUP BY 1)"""
_SEURAT = """SELECT feature, bin, d, CASE WHEN count(d) OVER w = 1 THEN 1.0 ELSE (d - avg(d) OVER w) / stddev_samp(d) OVER w END AS norm FROM (SELECT feature, CASE WHEN disp0 > 0 THEN ln(disp0) END AS d, ln(1 + mean0) AS m,
    CAST(least(5, greatest(1, ceil((ln(1 + mean0) - min(ln(1 + mean0)) OVER ()) / ((max(ln(1 + mean0)) OVER () - min(ln(1 + mean0)) OVER ()) / 5)))) AS INT) AS bin FROM gene_disp) WINDOW w AS (PARTITION BY bin)"""


@register("ml_01_variable_genes_seurat", f"SELECT feature, bin, {R6('norm', 5)} AS dispersion_norm, row_number() OVER (ORDER BY norm DESC, feature) <= 10 AS highly_variable FROM ({_SEURAT})")
def ml_01(spark, sf):
    out = B.variable_genes(lognorm(spark, sf), n_cells(spark, sf), 10, "seurat", 5)
    return _round(out.select("feature", "bin", "dispersion_norm", "highly_variable"), "dispersion_norm", digits=5)


_RANGER = """SELECT feature, disp0 AS d, CAST(len(list_filter((SELECT quantile_cont(mean0, [0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95, 1.0]) FROM gene_disp), lambda x: x < mean0)) AS INT) AS bin FROM gene_disp"""


@register("ml_01_variable_genes_cell_ranger", f"""SELECT feature, g.bin, CASE WHEN mad > 0 THEN {R6('(d - med) / (mad / 0.6744897501960817)', 5)} END AS dispersion_norm FROM ({_RANGER}) g JOIN (SELECT bin, med, quantile_cont(abs(d - med), 0.5) AS mad FROM ({_RANGER}) JOIN (SELECT bin, quantile_cont(d, 0.5) AS med FROM ({_RANGER}) GROUP BY 1) USING (bin) GROUP BY 1, 2) m ON g.bin = m.bin""")
def ml_01b(spark, sf):
    out = B.variable_genes(lognorm(spark, sf), n_cells(spark, sf), 10, "cell_ranger")
    return _round(out.select("feature", "bin", "dispersion_norm"), "dispersion_norm", digits=5)


@register("top_06_top_variable_genes", f"SELECT feature, CAST(r AS BIGINT) AS hvg_rank FROM (SELECT feature, row_number() OVER (ORDER BY norm DESC, feature) AS r FROM ({_SEURAT})) WHERE r <= 10")
def top_06(spark, sf):
    out = B.variable_genes(lognorm(spark, sf), n_cells(spark, sf), 10, "seurat", 5).where("highly_variable")
    return out.select("feature", F.col("hvg_rank").cast("bigint").alias("hvg_rank"))


def ordered_genes(spark, sf):
    return genes_seen(spark, sf).withColumn("pos", (F.expr("cast(substring(feature, 7) AS int)") - 1))


@register("ml_02_scaled_values", f"""SELECT cell_id, feature, {R6('greatest(-2.0, least(2.0, (x - avg(x) OVER w) / stddev_samp(x) OVER w))', 5)} AS scaled FROM (SELECT m.cell_id, g.feature, coalesce(l.v, 0) AS x FROM meta m CROSS JOIN (SELECT DISTINCT feature FROM expr) g
    LEFT JOIN lognorm l ON l.cell_id = m.cell_id AND l.feature = g.feature) WINDOW w AS (PARTITION BY feature)""")
def ml_02(spark, sf):
    genes = ordered_genes(spark, sf)
    moments = B.scale_moments(lognorm(spark, sf), genes, n_cells(spark, sf))
    v = B.scaled_vectors(S.cell_metadata(spark, sf), lognorm(spark, sf), moments, 2.0)
    long = v.select("cell_id", F.posexplode("vec").alias("pos", "scaled")).select("cell_id", F.concat(F.lit("Brand#"), (F.col("pos") + 1).cast("string")).alias("feature"), "scaled")
    return _round(long, "scaled", digits=5)


def rna_components(spark, sf):
    # three small results of one fit
    return B.rna_pca(S.cell_metadata(spark, sf), lognorm(spark, sf), ordered_genes(spark, sf), n_cells(spark, sf), 10)


@register("ml_03_rna_components")
def ml_03(spark, sf):
    scores, _, _ = rna_components(spark, sf)
    return scores.select("cell_id", *[F.round(F.element_at("vec", i), 4).alias(f"pc{i}") for i in range(1, 6)])


@register("ml_03_component_variance")
def ml_03b(spark, sf):
    return _round(rna_components(spark, sf)[2], "ratio")


def protein_values(spark, sf):
    return P.clr(antibody_cells(spark, sf), S.protein_counts(spark, sf), S.protein_panel(spark, sf)).withColumnRenamed("clr", "value")


@register("ml_04_protein_components")
def ml_04(spark, sf):
    scores, _, _ = B.protein_pca(protein_values(spark, sf), S.protein_panel(spark, sf), 3)
    return scores.select("cell_id", *[F.round(F.element_at("vec", i), 4).alias(f"pc{i}") for i in range(1, 4)])


@register("ml_06_joint_space", f"""SELECT v.cell_id, a.axis, {R6('CASE WHEN a.axis <= 32 THEN v.vec[a.axis] / sqrt(a1.t) ELSE 0.5 * v.vec[a.axis] / sqrt(a2.t) END', 5)} AS x FROM vectors v CROSS JOIN range(1, 65) AS a(axis),
    (SELECT sum(p) AS t FROM (SELECT i, var_pop(vec[i]) AS p FROM vectors, range(1, 33) AS r(i) GROUP BY 1)) a1, (SELECT sum(p) AS t FROM (SELECT i, var_pop(vec[i]) AS p FROM vectors, range(33, 65) AS r(i) GROUP BY 1)) a2""")
def ml_06(spark, sf):
    v = S.vectors(spark, sf)
    joint = B.joint_space(v.select("cell_id", F.slice("vec", 1, 32).alias("vec")), v.select("cell_id", F.slice("vec", 33, 32).alias("vec")), 0.5)
    return _round(joint.select("cell_id", F.posexplode("vec").alias("axis", "x")).withColumn("axis", (F.col("axis") + 1).cast("bigint")), "x", digits=5)


@register("agg_43_component_covariate_correlation", "SELECT 'length' AS covariate, CAST(pc AS INT) AS pc, round(abs(corr(vec[pc], ln(1 + vec_norm))), 3) AS abs_r FROM (SELECT vec, list_sum(list_transform(vec, lambda x: abs(x))) AS vec_norm FROM vectors), range(1, 6) AS r(pc) GROUP BY 2")
def agg_43(spark, sf):
    v = S.vectors(spark, sf).select("cell_id", "vec")
    size = F.log1p(F.aggregate(F.transform("vec", F.abs), F.lit(0.0), lambda a, x: a + x))
    return B.component_correlations(v, v.select("cell_id", size.alias("length")), {"length": "length"})


@register("ml_15_modality_diagnostics")
def ml_15(spark, sf):
    scores, _, _ = rna_components(spark, sf)
    qc = protein_qc(spark, sf, rna_qc(spark, sf)).withColumn("log_total", F.log1p("total_counts"))
    return B.component_correlations(scores, qc.select("cell_id", "log_total", "pct_counts_mt", "protein_pct_isotype"), {"log_total_counts": "log_total", "pct_mt": "pct_counts_mt", "pct_isotype": "protein_pct_isotype"})
