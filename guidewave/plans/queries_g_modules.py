"""Queries: protein effects, concordance, geometry, modules, communities, master tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import concordance as CO
from ..operators import distances as D
from ..operators import effects as EF
from ..operators import enrichment as E
from ..operators import genetests as GT
from ..operators import grouping as GR
from ..operators import knockdown as K
from ..operators import master as MT
from ..operators import modules as MO
from ..operators import neighborhood as H
from ..operators import ranktests as R
from . import queries_e_vectors as V
from . import queries_f_response as QF
from . import screen_tables as S
from .queries_b_quality import _round
from .queries_c_statistics import R6, effects, genes_seen, lognorm, markers, own_counts, screened
from .registry import SUBQUERIES, register

SUBQUERIES.update({
    "prows": "SELECT p.cell_id, p.protein, p.v AS value, CASE WHEN role = 'perturbed' THEN target END AS target, sample, guide FROM clr_cell p JOIN screened s ON p.cell_id = s.cell_id WHERE role = 'control' OR target IN (SELECT target FROM targets WHERE n_perturbed >= 10)",
    "peff": """SELECT o.target, o.protein, o.n AS n_perturbed, c.n AS n_control, o.m AS mean_perturbed, c.m AS mean_control, o.m - c.m AS effect, (o.m - c.m) / sqrt(((o.n - 1) * o.v + (c.n - 1) * c.v) / (o.n + c.n - 2)) AS cohen_d, o.md AS median_perturbed, c.md AS median_control
        FROM (SELECT target, protein, count(*) AS n, avg(value) AS m, var_samp(value) AS v, quantile_cont(value, 0.5) AS md FROM prows WHERE target IS NOT NULL GROUP BY 1, 2) o
        JOIN (SELECT protein, count(*) AS n, avg(value) AS m, var_samp(value) AS v, quantile_cont(value, 0.5) AS md FROM prows WHERE target IS NULL GROUP BY 1) c ON o.protein = c.protein""",
})


def protein_values(spark, sf):
    return S.stored(spark, sf, "clr", lambda: V.protein_values(spark, sf))


def prows(spark, sf):
    return EF.protein_rows(screened(spark, sf), protein_values(spark, sf), S.CONTROLS)


def peff(spark, sf):
    return S.stored(spark, sf, "protein_effects", lambda: EF.protein_effects(screened(spark, sf), protein_values(spark, sf), S.CONTROLS))


@register("agg_36_protein_effects", f"SELECT target, protein, n_perturbed, n_control, {', '.join(f'{R6(c)} AS {c}' for c in ('mean_perturbed', 'mean_control', 'effect', 'cohen_d', 'median_perturbed', 'median_control'))} FROM peff")
def agg_36(spark, sf):
    return _round(EF.effect_sizes(prows(spark, sf)), "mean_perturbed", "mean_control", "effect", "cohen_d", "median_perturbed", "median_control")


@register("stat_30_protein_rank_sums", "SELECT target, protein, count(*) FILTER (a.value > c.value) + count(*) FILTER (a.value = c.value) / 2.0 AS u FROM (SELECT * FROM prows WHERE target IS NOT NULL) a JOIN (SELECT protein AS cp, value FROM prows WHERE target IS NULL) c ON a.protein = c.cp GROUP BY 1, 2")
def stat_30b(spark, sf):
    return EF.rank_sums(prows(spark, sf)).select("target", "protein", "u")


@register("stat_30_protein_effect_tests")
def stat_30(spark, sf):
    return _round(peff(spark, sf).drop("median_perturbed", "median_control"), "mean_perturbed", "mean_control", "effect", "cohen_d", "p_value", "fdr")


@register("agg_37_sign_consistency", """SELECT e.target, e.protein, coalesce(s.t, 0) AS n_samples_tested, coalesce(s.k, 0) AS n_samples_same_sign, coalesce(s.t, 0) <= 1 AS single_sample_support, coalesce(g.t, 0) AS n_guides_tested, coalesce(g.k, 0) AS n_guides_same_sign FROM peff e
    LEFT JOIN (SELECT a.target, a.protein, count(*) AS t, count(*) FILTER (sign(a.m - c.m) = sign(e.effect)) AS k FROM (SELECT target, protein, sample, avg(value) AS m FROM prows WHERE target IS NOT NULL GROUP BY 1, 2, 3 HAVING count(*) >= 5) a
        JOIN (SELECT protein, sample, avg(value) AS m FROM prows WHERE target IS NULL GROUP BY 1, 2 HAVING count(*) >= 5) c ON a.protein = c.protein AND a.sample = c.sample JOIN peff e ON e.target = a.target AND e.protein = a.protein GROUP BY 1, 2) s ON s.target = e.target AND s.protein = e.protein
    LEFT JOIN (SELECT a.target, a.protein, count(*) AS t, count(*) FILTER (sign(a.m - e.mean_control) = sign(e.effect)) AS k FROM (SELECT target, protein, guide, avg(value) AS m FROM prows WHERE target IS NOT NULL GROUP BY 1, 2, 3 HAVING count(*) >= 5) a
        JOIN peff e ON e.target = a.target AND e.protein = a.protein GROUP BY 1, 2) g ON g.target = e.target AND g.protein = e.protein""")
def agg_37(spark, sf):
    rows = prows(spark, sf)
    return EF.sign_consistency(rows, EF.effect_sizes(rows))


@register("agg_47_level_panels", f"SELECT a.target, a.protein, a.sample, {R6('a.m - c.m')} AS difference FROM (SELECT target, protein, sample, avg(value) AS m FROM prows WHERE target IS NOT NULL GROUP BY 1, 2, 3 HAVING count(*) >= 5) a JOIN (SELECT protein, sample, avg(value) AS m FROM prows WHERE target IS NULL GROUP BY 1, 2 HAVING count(*) >= 5) c ON a.protein = c.protein AND a.sample = c.sample")
def agg_47(spark, sf):
    return _round(EF.level_panel(prows(spark, sf), "sample"), "difference")


# ---- concordance

_RANKS = "rank() OVER (PARTITION BY {k} ORDER BY {v}) + (count(*) OVER (PARTITION BY {k}, {v}) - 1) / 2.0"


def _spearman_sql(keys: str, x: str, y: str, src: str, n: str) -> str:
    return f"SELECT {keys}, count(*) AS {n}, round(corr(rx, ry), 5) AS spearman_rho FROM (SELECT {keys}, {_RANKS.format(k=keys, v=x)} AS rx, {_RANKS.format(k=keys, v=y)} AS ry FROM ({src})) GROUP BY {keys}"


def own_scores(spark, sf):
    scored = S.stored(spark, sf, "response", lambda: QF.run(spark, sf))
    return scored.where("is_target").select("cell_id", "target", "score")


@register("stat_19_response_protein", _spearman_sql("target, protein", "score", "v", "SELECT s.target, p.protein, round(s.score, 9) AS score, round(p.v, 9) AS v FROM scored s JOIN clr_cell p ON s.cell_id = p.cell_id WHERE is_target", "n_cells"))
def stat_19(spark, sf):
    values = protein_values(spark, sf).withColumn("value", F.round("value", 9))
    out = CO.score_protein(own_scores(spark, sf).withColumn("score", F.round("score", 9)), values).where("scope = 'within_target'")
    return _round(out.select("target", "protein", "n_cells", "spearman_rho"), "spearman_rho", digits=5)


@register("stat_19_response_protein_tests")
def stat_19b(spark, sf):
    return _round(CO.score_protein(own_scores(spark, sf), protein_values(spark, sf)), "spearman_rho", "p_value", "fdr")


def vec_proteins(spark, sf):
    # eight proteins, the means of eight neighbouring components each, so that all 64 are read
    means = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.aggregate(F.slice("vec", i * 8 + 1, F.lit(8)), F.lit(0.0).cast("double"), lambda total, x: total + x) / 8)
    v = S.vectors(spark, sf).select("cell_id", F.posexplode(means).alias("i", "value"))
    return v.select("cell_id", F.concat(F.lit("p"), (F.col("i") + 1).cast("string")).alias("protein"), "value")


_VP = "SELECT cell_id, 'p' || i AS protein, list_sum(vec[8 * i - 7:8 * i]) / 8 AS value FROM vectors, range(1, 9) AS r(i)"


@register("stat_20_local_enrichment_protein_cells", _spearman_sql("target, protein", "score", "value", f"SELECT l.target, p.protein, round(l.score, 9) AS score, p.value FROM loch l JOIN ({_VP}) p ON l.cell_id = p.cell_id WHERE l.own = l.target AND l.target <> 'NT'", "n_cells"))
def stat_20(spark, sf):
    own = H.own_scores(V.cells(spark, sf), V.edges(spark, sf), V.K, V.CLASSES).where("label <> '*control*'").select("cell_id", F.col("label").alias("target"), F.round("score", 9).alias("score"))
    return _round(CO.score_protein(own, vec_proteins(spark, sf), pooled=False).select("target", "protein", "n_cells", "spearman_rho"), "spearman_rho", digits=5)


SUBQUERIES["vec_eff"] = f"SELECT v.target, p.protein, avg(p.value) - (SELECT avg(q.value) FROM ({_VP}) q JOIN vectors w ON w.cell_id = q.cell_id WHERE w.target = 'NT' AND q.protein = p.protein) AS effect FROM vectors v JOIN ({_VP}) p ON v.cell_id = p.cell_id WHERE v.target <> 'NT' GROUP BY 1, 2"


def vec_effects(spark, sf):
    rows = EF.protein_rows(V.cells(spark, sf), vec_proteins(spark, sf), V.CLASSES)
    return EF.effect_sizes(rows).select("target", "protein", "effect")


@register("stat_20_local_enrichment_protein_targets", f"SELECT s.protein, s.n_targets, s.spearman_rho AS rho_signed, a.spearman_rho AS rho_abs FROM ({_spearman_sql('protein', 'x', 'y', 'SELECT e.protein, e.effect AS y, l.x FROM vec_eff e JOIN (SELECT target, avg(score) AS x FROM loch WHERE own = target GROUP BY 1) l ON e.target = l.target', 'n_targets')}) s JOIN ({_spearman_sql('protein', 'x', 'y', 'SELECT e.protein, abs(e.effect) AS y, l.x FROM vec_eff e JOIN (SELECT target, avg(score) AS x FROM loch WHERE own = target GROUP BY 1) l ON e.target = l.target', 'n_targets')}) a ON s.protein = a.protein")
def stat_20b(spark, sf):
    own = H.own_scores(V.cells(spark, sf), V.edges(spark, sf), V.K, V.CLASSES).where("label <> '*control*'").groupBy(F.col("label").alias("target")).agg(F.avg("score").alias("x"))
    return _round(CO.target_association(own, vec_effects(spark, sf)).select("protein", "n_targets", "rho_signed", "rho_abs"), "rho_signed", "rho_abs", digits=5)


def vec_pairs(spark, sf):
    return S.stored(spark, sf, "pairs", lambda: D.pair_distances(S.vectors(spark, sf)))


def vec_distance(spark, sf):
    return S.stored(spark, sf, "distance", lambda: D.perturbation_distance(S.vectors(spark, sf), V.CLASSES, n_permutations=999))


_EDIST = "SELECT p.x AS target, 2 * p.d - xx.d - yy.d AS x FROM m p JOIN m xx ON xx.x = p.x AND xx.y = p.x JOIN m yy ON yy.x = 'NT' AND yy.y = 'NT' WHERE p.y = 'NT' AND p.x <> 'NT'"
SUBQUERIES["vec_edist"] = f"WITH m AS ({QF._MEANS}) {_EDIST}"


@register("stat_18_distance_protein", f"SELECT s.protein, s.n_targets, s.spearman_rho AS rho_signed, a.spearman_rho AS rho_abs FROM ({_spearman_sql('protein', 'x', 'y', 'SELECT e.protein, e.effect AS y, l.x FROM vec_eff e JOIN vec_edist l ON e.target = l.target', 'n_targets')}) s JOIN ({_spearman_sql('protein', 'x', 'y', 'SELECT e.protein, abs(e.effect) AS y, l.x FROM vec_eff e JOIN vec_edist l ON e.target = l.target', 'n_targets')}) a ON s.protein = a.protein")
def stat_18(spark, sf):
    d = vec_distance(spark, sf).where("reason IS NULL").select("target", F.col("energy_distance").alias("x"))
    return _round(CO.target_association(d, vec_effects(spark, sf)).select("protein", "n_targets", "rho_signed", "rho_abs"), "rho_signed", "rho_abs", digits=5)


_PROFILE = "SELECT a.target AS target_a, b.target AS target_b, sqrt(sum((a.effect - b.effect) ** 2)) AS d FROM vec_eff a JOIN vec_eff b ON a.protein = b.protein AND a.target < b.target GROUP BY 1, 2"


@register("stat_15_profile_distances", f"SELECT target_a, target_b, {R6('d', 5)} AS distance FROM ({_PROFILE})")
def stat_15(spark, sf):
    return _round(CO.profile_distances(vec_effects(spark, sf)), "distance", digits=5)


_MANTEL = f"""WITH b AS (SELECT p.target_a, p.target_b, rank() OVER (ORDER BY r.d) AS r1, rank() OVER (ORDER BY p.d) AS r2 FROM ({_PROFILE}) p JOIN pair_dist r ON r.a = p.target_a AND r.b = p.target_b), t AS (SELECT target_a AS t FROM b UNION SELECT target_b FROM b),
    num AS (SELECT t, row_number() OVER (ORDER BY t) AS i FROM t), sh AS (SELECT k AS perm, t, row_number() OVER (PARTITION BY k ORDER BY sha256('0|' || k || '|' || t)) AS i FROM t, range(1, 1000) AS g(k)), map AS (SELECT perm, num.t AS o, sh.t AS n FROM num JOIN sh ON num.i = sh.i),
    perm AS (SELECT x.perm, corr(b.r1, c.r2) AS rho FROM b JOIN map x ON x.o = b.target_a JOIN map y ON y.o = b.target_b AND y.perm = x.perm JOIN b c ON c.target_a = least(x.n, y.n) AND c.target_b = greatest(x.n, y.n) GROUP BY 1)
    SELECT (SELECT count(*) FROM b) AS n_pairs, round((SELECT corr(r1, r2) FROM b), 5) AS mantel_rho, round((1 + count(*) FILTER (rho >= (SELECT corr(r1, r2) FROM b) - 1e-12)) / (1 + count(*)), 6) AS p_permutation FROM perm"""


@register("stat_31_distance_space")
def stat_31(spark, sf):
    space = D.distance_space(S.vectors(spark, sf), n_components=3, n_neighbors=1)
    near = space["neighbors"].select("target", F.col("neighbor").alias("nearest"), "distance")
    axes = space["coordinates"].groupBy("target").agg(*[F.max(F.when(F.col("axis") == k, F.col("value"))).alias(f"axis_{k}") for k in (1, 2, 3)])
    found = _round(space["modules"].join(near, "target").join(axes, "target", "left"), "distance", "axis_1", "axis_2", "axis_3", digits=5)
    return found.withColumn("reason", F.lit(None).cast("string")).unionByName(space["skipped"].drop("n_cells"), allowMissingColumns=True)


@register("stat_14_mantel", f"SELECT * FROM ({_MANTEL})")
def stat_14(spark, sf):
    return _round(_round(CO.mantel(vec_pairs(spark, sf), CO.profile_distances(vec_effects(spark, sf)), 999), "mantel_rho", digits=5), "p_permutation")


@register("stat_16_geometry_association")
def stat_16(spark, sf):
    return _round(CO.geometry_association(vec_pairs(spark, sf), vec_effects(spark, sf), [f"p{i}" for i in range(1, 9)], 999), "mantel_rho", "p_permutation", "fdr")


_MOD = "SELECT target, CASE WHEN CAST(substr(target, 7) AS INT) % 3 = 0 THEN 'A' WHEN CAST(substr(target, 7) AS INT) % 3 = 1 THEN 'B' ELSE 'C' END AS module FROM (SELECT DISTINCT target FROM peff)"


def fixed_modules(spark, sf):
    key = F.expr("cast(substring(target, 7) AS int) % 3")
    return peff(spark, sf).select("target").distinct().withColumn("module", F.when(key == 0, "A").when(key == 1, "B").otherwise("C"))


@register("agg_44_module_protein_means", f"SELECT module, protein, count(*) AS n_targets, count(*) >= 3 AS eligible, {R6('avg(effect)')} AS mean_effect, {R6('quantile_cont(effect, 0.5)')} AS median_effect FROM peff JOIN ({_MOD}) USING (target) GROUP BY 1, 2")
def agg_44(spark, sf):
    return _round(CO.module_means(peff(spark, sf), fixed_modules(spark, sf)).drop("n_significant"), "mean_effect", "median_effect")


@register("stat_16_module_association", f"""SELECT protein, max(n) AS n_targets, count(*) AS n_modules_eligible, round(12 / (max(n) * (max(n) + 1.0)) * sum(r * r / c) - 3 * (max(n) + 1), 5) AS statistic FROM (SELECT protein, module, count(*) AS c, sum(rk) AS r, max(n) AS n FROM
    (SELECT protein, module, rank() OVER (PARTITION BY protein ORDER BY effect) AS rk, count(*) OVER (PARTITION BY protein) AS n FROM peff JOIN ({_MOD}) USING (target)) GROUP BY 1, 2) GROUP BY 1""")
def stat_16b(spark, sf):
    return _round(CO.module_association(peff(spark, sf), fixed_modules(spark, sf)).select("protein", "n_targets", "n_modules_eligible", "statistic"), "statistic", digits=5)


@register("rel_32_support_labels", "SELECT target, protein, CASE WHEN n_perturbed < 40 THEN 'insufficient_support' WHEN abs(effect) < 0.02 THEN 'significant' ELSE 'not_significant' END AS status FROM peff")
def rel_32(spark, sf):
    e = EF.effect_sizes(prows(spark, sf))
    return e.select("target", "protein", CO.support(F.col("n_perturbed"), F.col("effect"), F.abs("effect"), 0.02, 40).alias("status"))


# ---- correlation matrices, programs and modules

@register("stat_23_target_correlations", "SELECT a.target AS a, b.target AS b, round(corr(a.log2fc, b.log2fc), 5) AS r FROM own_vs_control a JOIN own_vs_control b ON a.feature = b.feature AND a.target < b.target GROUP BY 1, 2")
def stat_23(spark, sf):
    return _round(MO.correlation_matrix(fx(spark, sf), "target", "feature", "log2fc"), "r", digits=5)


@register("stat_23_gene_rank_correlations", "SELECT a.feature AS a, b.feature AS b, round(corr(a.rk, b.rk), 5) AS r FROM (SELECT *, rank() OVER (PARTITION BY feature ORDER BY log2fc) AS rk FROM own_vs_control) a JOIN (SELECT *, rank() OVER (PARTITION BY feature ORDER BY log2fc) AS rk FROM own_vs_control) b ON a.target = b.target AND a.feature < b.feature GROUP BY 1, 2")
def stat_23b(spark, sf):
    return _round(MO.correlation_matrix(fx(spark, sf), "feature", "target", "log2fc", "spearman"), "r", digits=5)


@register("stat_23_phenocopy_similarity", "SELECT substr(a.\"group\", 8) AS a, substr(b.\"group\", 8) AS b, round(corr(a.pct, b.pct), 5) AS r FROM comp a JOIN comp b ON a.cluster = b.cluster AND a.\"group\" < b.\"group\" WHERE a.\"group\" LIKE 'target:%' AND b.\"group\" LIKE 'target:%' GROUP BY 1, 2")
def stat_23c(spark, sf):
    comp = E.composition(V.cells(spark, sf), V.CLASSES).where("`group` LIKE 'target:%'").withColumn("target", F.expr("substring(`group`, 8)"))
    return _round(MO.correlation_matrix(comp, "target", "cluster", "pct"), "r", digits=5)


def fx(spark, sf):
    return S.stored(spark, sf, "effects", lambda: effects(spark, sf, False))


def programs_modules(spark, sf):
    """(gene programs, perturbation modules), each clustered once."""
    e = fx(spark, sf)
    programs = S.stored(spark, sf, "programs", lambda: MO.cluster_axis(e, "feature", "target", "log2fc", "pearson", 4, "P"))
    return programs, S.stored(spark, sf, "modules", lambda: MO.cluster_axis(e, "target", "feature", "log2fc", "spearman", 9, "M"))


@register("ml_11_gene_programs")
def ml_11(spark, sf):
    return programs_modules(spark, sf)[0]


@register("ml_11_perturbation_modules")
def ml_11b(spark, sf):
    return programs_modules(spark, sf)[1]


@register("ml_16_module_run")
def ml_16(spark, sf):
    found = markers(spark, sf)
    panels = {"cluster_markers": GT.marker_panel(found, 10), "variable": found.select("feature").distinct()}
    expressed = GT.expressed_genes(lognorm(spark, sf), screened(spark, sf), 1.0)
    e = fx(spark, sf).withColumn("de", F.abs("log2fc") > 0.1)
    tables = MO.module_tables(e, panels, expressed)
    return _round(tables["program_effects"].crossJoin(F.broadcast(tables["panel"].agg(F.first("panel").alias("panel"), F.count(F.lit(1)).alias("n_panel")))), "mean_log2fc", "frac_de")  # one row


@register("ml_11_merge_table")
def ml_11c(spark, sf):
    d = MO.correlation_distance(MO.correlation_matrix(fx(spark, sf), "target", "feature", "log2fc"))
    return _round(GR.agglomerate(d, "complete"), "height")


@register("ml_14_similarity_order")
def ml_14(spark, sf):
    return MO.similarity_order(programs_modules(spark, sf)[1])


_PROG = "SELECT feature, CASE WHEN CAST(substr(feature, 7) AS INT) % 2 = 0 THEN 'P1' ELSE 'P2' END AS program FROM (SELECT DISTINCT feature FROM own_vs_control)"
_TMOD = "SELECT target, CASE WHEN CAST(substr(target, 7) AS INT) % 3 = 0 THEN 'M1' ELSE 'M2' END AS module FROM (SELECT DISTINCT target FROM own_vs_control)"


def given_programs(spark, sf):
    f = fx(spark, sf).select(F.col("feature").alias("item")).distinct()
    return f.withColumn("module", F.when(F.expr("cast(substring(item, 7) AS int) % 2") == 0, "P1").otherwise("P2"))


def given_modules(spark, sf):
    t = fx(spark, sf).select(F.col("target").alias("item")).distinct()
    return t.withColumn("module", F.when(F.expr("cast(substring(item, 7) AS int) % 3") == 0, "M1").otherwise("M2"))


@register("agg_30_module_program_strength", f"SELECT module, program, {R6('avg(log2fc)')} AS strength FROM own_vs_control JOIN ({_PROG}) USING (feature) JOIN ({_TMOD}) USING (target) GROUP BY 1, 2")
def agg_30(spark, sf):
    return _round(MO.module_program_strength(fx(spark, sf), given_modules(spark, sf), given_programs(spark, sf)), "strength")


@register("agg_30_target_program_effects", f"SELECT target, program, count(*) AS n_genes, {R6('avg(log2fc)')} AS mean_log2fc, count(*) FILTER (abs(log2fc) > 0.1) AS n_de, round(count(*) FILTER (abs(log2fc) > 0.1) / count(*), 6) AS frac_de FROM own_vs_control JOIN ({_PROG}) USING (feature) GROUP BY 1, 2")
def agg_30b(spark, sf):
    e = fx(spark, sf).withColumn("de", F.abs("log2fc") > 0.1)
    return _round(MO.target_program_effects(e, given_programs(spark, sf)), "mean_log2fc", "frac_de")


@register("agg_31_module_connectivity", f"""WITH e AS (SELECT a.module AS f, b.module AS t FROM own_vs_control o JOIN ({_TMOD}) a ON a.target = o.target JOIN ({_TMOD}) b ON b.target = o.feature WHERE abs(log2fc) > 0.1 AND o.target <> o.feature), s AS (SELECT module, count(*) AS n FROM ({_TMOD}) GROUP BY 1)
    SELECT x.module AS from_module, y.module AS to_module, count(e.f) AS n_edges, round(count(e.f) / (x.n * y.n), 6) AS connectivity FROM s x CROSS JOIN s y LEFT JOIN e ON e.f = x.module AND e.t = y.module GROUP BY x.module, y.module, x.n, y.n""".replace("WITH e AS", "SELECT * FROM (WITH e AS", 1) + ")")
def agg_31(spark, sf):
    from ..operators.genetests import regulatory_edges

    e = regulatory_edges(fx(spark, sf).withColumn("de", F.abs("log2fc") > 0.1))
    return _round(MO.module_connectivity(e, given_modules(spark, sf)), "connectivity")


@register("agg_31_hubs", f"SELECT target, count(*) FILTER (abs(log2fc) > 0.1) AS n_de_genes, module FROM own_vs_control JOIN ({_TMOD}) USING (target) GROUP BY 1, 3")
def agg_31b(spark, sf):
    return MO.hubs(fx(spark, sf).withColumn("de", F.abs("log2fc") > 0.1), given_modules(spark, sf))


@register("agg_49_flow_shares", f"SELECT module, program, round(abs(s) / sum(abs(s)) OVER (), 6) AS share, CAST(sign(s) AS DOUBLE) AS sign FROM (SELECT module, program, avg(log2fc) AS s FROM own_vs_control JOIN ({_PROG}) USING (feature) JOIN ({_TMOD}) USING (target) GROUP BY 1, 2)")
def agg_49(spark, sf):
    return _round(MO.flow_shares(MO.module_program_strength(fx(spark, sf), given_modules(spark, sf), given_programs(spark, sf))), "share")


_Z = f"""SELECT cell_id, program, avg(z) AS activity FROM (SELECT m.cell_id, g.program, (coalesce(l.v, 0) - avg(coalesce(l.v, 0)) OVER w) / stddev_pop(coalesce(l.v, 0)) OVER w AS z FROM meta m CROSS JOIN ({_PROG}) g LEFT JOIN lognorm l ON l.cell_id = m.cell_id AND l.feature = g.feature WINDOW w AS (PARTITION BY g.feature)) GROUP BY 1, 2"""


def activity(spark, sf):
    return MO.zscore_activity(screened_all(spark, sf), lognorm(spark, sf), given_programs(spark, sf))


def screened_all(spark, sf):
    return S.cell_metadata(spark, sf).select("cell_id", "condition")


@register("ml_12_zscore_activity", f"SELECT cell_id, program, {R6('activity', 5)} AS activity FROM ({_Z})")
def ml_12(spark, sf):
    return _round(activity(spark, sf), "activity", digits=5)


@register("ml_12_matched_control_activity")
def ml_12b(spark, sf):
    out = MO.program_activity(screened_all(spark, sf), lognorm(spark, sf), genes_seen(spark, sf), V.n_cells(spark, sf), given_programs(spark, sf), ctrl_size=5, n_bins=5)
    return _round(out, "activity", digits=5)


@register("agg_32_activity_by_group", f"SELECT program, condition, {R6('avg(activity)', 5)} AS mean_activity FROM ({_Z}) JOIN meta USING (cell_id) GROUP BY 1, 2")
def agg_32(spark, sf):
    return _round(MO.activity_by_group(activity(spark, sf), screened_all(spark, sf), "condition"), "mean_activity", digits=5)


@register("stat_21_program_protein_targets", _spearman_sql("program, protein", "x", "y", f"SELECT a.program, e.protein, round(a.x, 9) AS x, round(e.effect, 9) AS y FROM (SELECT target, program, avg(log2fc) AS x FROM own_vs_control JOIN ({_PROG}) USING (feature) GROUP BY 1, 2) a JOIN peff e ON e.target = a.target", "n_targets"))
def stat_21(spark, sf):
    pe = MO.target_program_effects(fx(spark, sf), given_programs(spark, sf)).withColumn("mean_log2fc", F.round("mean_log2fc", 9))
    out = CO.program_protein_targets(pe, peff(spark, sf).withColumn("effect", F.round("effect", 9)))
    return _round(out.select("program", "protein", "n_targets", "spearman_rho"), "spearman_rho", digits=5)


@register("stat_21_program_protein_cells")
def stat_21b(spark, sf):
    out = CO.program_protein_cells(activity(spark, sf).withColumn("activity", F.round("activity", 6)), protein_values(spark, sf))
    return _round(out, "spearman_rho", "p_value", "fdr", digits=5)


@register("stat_25_partition_agreement", """WITH t AS (SELECT cluster, target, count(*) AS c FROM vectors GROUP BY 1, 2), r AS (SELECT sum(c) AS c FROM t GROUP BY cluster), k AS (SELECT sum(c) AS c FROM t GROUP BY target), s AS (SELECT (SELECT sum(c * (c - 1) / 2.0) FROM t) AS t2, (SELECT sum(c * (c - 1) / 2.0) FROM r) AS r2, (SELECT sum(c * (c - 1) / 2.0) FROM k) AS k2,
    (SELECT sum(c * ln(c)) FROM t) AS tx, (SELECT sum(c * ln(c)) FROM r) AS rx, (SELECT sum(c * ln(c)) FROM k) AS kx, (SELECT count(*) FROM vectors) AS n) SELECT round((t2 - r2 * k2 / (n * (n - 1) / 2.0)) / ((r2 + k2) / 2 - r2 * k2 / (n * (n - 1) / 2.0)), 6) AS ari, round((ln(n) + (tx - rx - kx) / n) / ((2 * ln(n) - rx / n - kx / n) / 2), 6) AS nmi FROM s""".replace("WITH t AS", "SELECT * FROM (WITH t AS", 1) + ")")
def stat_25(spark, sf):
    return _round(MO.partition_agreement(V.cells(spark, sf), "cluster", "target"), "ari", "nmi")


def graph(spark, sf):
    return V.edges(spark, sf, 14).select("src", "dst", F.lit(1.0).alias("weight"))


@register("ml_07_modularity", """WITH e AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM knn30 WHERE rank <= 14), j AS (SELECT x.cluster AS ca, y.cluster AS cb FROM e JOIN vectors x ON x.cell_id = e.a JOIN vectors y ON y.cell_id = e.b), k AS (SELECT c, count(*) AS k FROM (SELECT ca AS c FROM j UNION ALL SELECT cb FROM j) GROUP BY 1)
    SELECT round((SELECT count(*) FILTER (ca = cb) / count(*) FROM j) - (SELECT sum(k * k) FROM k) / (4.0 * (SELECT count(*) FROM j) ** 2), 6) AS modularity""".replace("WITH e AS", "SELECT * FROM (WITH e AS", 1) + ")")
def ml_07b(spark, sf):
    return _round(GR.modularity(graph(spark, sf), V.cells(spark, sf)), "modularity")


# ---- integration

def _loch(spark, sf):
    return H.summary(V.cells(spark, sf), V.edges(spark, sf), V.K, V.CLASSES)


@register("join_13_master_table", f"""SELECT target, n AS n_cells, {R6('avg(score) FILTER (own = target)', 5)} AS lochness_mean, {R6('max(score)', 5)} AS lochness_peak, round(max(x), 5) AS energy_distance FROM loch l JOIN vec_edist USING (target) JOIN (SELECT target, count(*) AS n FROM vectors GROUP BY 1) USING (target) GROUP BY 1, 2""")
def join_13(spark, sf):
    tables = {"local": MT.neighborhood_columns(_loch(spark, sf)), "distance": MT.distance_columns(vec_distance(spark, sf))}
    out = MT.master_table(tables).select("target", "n_cells", "lochness_mean", "lochness_peak", "energy_distance")
    return _round(out, "lochness_mean", "lochness_peak", "energy_distance", digits=5)


def screen_master(spark, sf):
    strength = S.stored(spark, sf, "strength", lambda: K.perturbation_strength(screened(spark, sf), lognorm(spark, sf), genes_seen(spark, sf), S.CONTROLS))
    response = S.stored(spark, sf, "response_summary", lambda: QF.PS.response_summary(S.stored(spark, sf, "response", lambda: QF.run(spark, sf))))
    modules = programs_modules(spark, sf)[1].select(F.col("item").alias("target"), F.col("module").alias("cofunctional_module"))
    best = MO.strongest_program(MO.target_program_effects(fx(spark, sf), programs_modules(spark, sf)[0]))
    return MT.master_table({"strength": MT.strength_columns(strength), "response": MT.response_columns(response), "modules": modules, "program": best, "protein": EF.strongest_protein(peff(spark, sf))})


@register("join_21_master_tables")
def join_21(spark, sf):
    out = screen_master(spark, sf)
    return _round(out, *[f for f, t in out.dtypes if t == "double"], digits=5)


@register("join_14_master_protein_table")
def join_14(spark, sf):
    cell = CO.score_protein(own_scores(spark, sf), protein_values(spark, sf))
    out = MT.protein_table(peff(spark, sf), screen_master(spark, sf), {"ps_protein": cell})
    return _round(out, *[f for f, t in out.dtypes if t == "double"], digits=5)


@register("join_12_target_summary", f"SELECT o.target, o.n_perturbed AS n_cells, p.protein AS strongest_protein, {R6('p.effect')} AS strongest_protein_effect FROM targets o LEFT JOIN (SELECT target, arg_max(protein, round(abs(cohen_d), 9)) AS protein, arg_max(effect, round(abs(cohen_d), 9)) AS effect FROM peff GROUP BY 1) p ON p.target = o.target")
def join_12(spark, sf):
    sizes = K.target_sizes(screened(spark, sf), S.CONTROLS).select("target", F.col("n_perturbed").alias("n_cells"))
    best = EF.strongest_protein(EF.effect_sizes(prows(spark, sf)).withColumn("fdr", F.lit(1.0)).withColumn("significant", F.lit(False)))
    out = MT.combine_targets({"sizes": sizes, "protein": best.select("target", "strongest_protein", "strongest_protein_effect")})
    return _round(out, "strongest_protein_effect")


@register("join_19_enrichment_vs_local", f"SELECT e.target, count(*) FILTER (e.fdr < 0.9) AS n_clusters_significant, max(l.m) AS lochness_own_mean FROM enriched e JOIN (SELECT target, {R6('avg(score)')} AS m FROM loch WHERE own = target GROUP BY 1) l ON e.target = l.target WHERE e.control = 'other' GROUP BY 1")
def join_19(spark, sf):
    t = E.cluster_enrichment(V.cells(spark, sf), V.CLASSES, "other", 20, 10, 5, alpha=0.9)
    return _round(MT.compare_local_enrichment(t, _loch(spark, sf)).select("target", "n_clusters_significant", "lochness_own_mean"), "lochness_own_mean")


@register("stat_22_concordance_summary")
def stat_22(spark, sf):
    cell = CO.score_protein(own_scores(spark, sf), protein_values(spark, sf), pooled=False)
    base = K.target_sizes(screened(spark, sf), S.CONTROLS).select("target", F.col("n_perturbed").alias("n_cells"))
    return base.join(CO.best_protein_text(cell).withColumnRenamed("best", "ps_protein_best"), "target", "left")


@register("top_01_ordered_results", f"SELECT target, protein, {R6('effect')} AS effect FROM peff ORDER BY effect DESC, target, protein")
def top_01(spark, sf):
    out = EF.effect_sizes(prows(spark, sf)).orderBy(F.col("effect").desc_nulls_last(), "target", "protein")
    return _round(out.select("target", "protein", "effect"), "effect")


@register("top_08_largest_shifts", f"SELECT target, protein, {R6('effect')} AS effect FROM peff ORDER BY round(abs(effect), 9) DESC, target, protein LIMIT 12")
def top_08(spark, sf):
    e = EF.effect_sizes(prows(spark, sf))
    return _round(e.orderBy(F.round(F.abs("effect"), 9).desc(), "target", "protein").limit(12).select("target", "protein", "effect"), "effect")
