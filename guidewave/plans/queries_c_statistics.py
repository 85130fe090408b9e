"""Queries: normalisation, protein representations, group statistics, knockdown, gene tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.ordering import average_ranks, bh_adjust, exact_quantiles
from ..functions import scalars as fn
from ..operators import genetests as GT
from ..operators import knockdown as K
from ..operators import labels as L
from ..operators import moments as M
from ..operators import normalize as N
from ..operators import proteins as P
from ..operators import ranktests as R
from . import screen_tables as S
from .queries_b_quality import _round
from .registry import SUBQUERIES, register

SUBQUERIES.update({
    "lognorm": "SELECT cell_id, feature, count, sum(count) OVER (PARTITION BY cell_id) AS library, ln(1 + count * 10000.0 / sum(count) OVER (PARTITION BY cell_id)) AS v FROM expr",
    "screened": "SELECT cell_id, target, guide, sample, condition, CASE WHEN perturbation_class = 'single_targeting' THEN 'perturbed' ELSE 'control' END AS role FROM cells WHERE perturbation_class = 'single_targeting' OR (perturbation_class = 'single_control' AND control_class = 'non_targeting')",
    "targets": "SELECT target, count(*) AS n_perturbed FROM screened WHERE role = 'perturbed' GROUP BY 1",
    "own_values": """SELECT t.target, c.cell_id, CASE WHEN c.role = 'control' THEN 'ntc' WHEN c.target = t.target THEN 'own' ELSE 'other' END AS arm, coalesce(l.v, 0) AS v
        FROM targets t CROSS JOIN screened c LEFT JOIN lognorm l ON l.cell_id = c.cell_id AND l.feature = t.target""",
    "clr_cell": "SELECT cell_id, protein, ln(1 + count) - avg(ln(1 + count)) OVER (PARTITION BY cell_id) AS v FROM dense_protein WHERE protein NOT LIKE 'N%'",
})


def R6(x: str, digits: int = 6) -> str:
    return f"(CASE WHEN abs({x}) < 0.5e-{digits} THEN 0.0 ELSE round({x}, {digits}) END)"


def lognorm(spark, sf):
    return S.stored(spark, sf, "lognorm", lambda: N.normalize_total(S.expr(spark, sf), 1e4))


def screened(spark, sf):
    wanted = ["cell_id", "target", "guide", "sample", "condition", "perturbation_class", "control_class"]
    return S.stored(spark, sf, "cells", lambda: S.cells(spark, sf).select(*wanted))


# ---- normalisation

@register("rel_12_normalize_total", f"SELECT cell_id, feature, CAST(library AS BIGINT) AS library, {R6('v')} AS lognorm FROM lognorm")
def rel_12(spark, sf):
    return _round(lognorm(spark, sf).drop("count"), "lognorm")


@register("rel_12_normalize_to_median", f"""SELECT cell_id, feature, {R6("ln(1 + count * (SELECT quantile_cont(CAST(s AS DOUBLE), 0.5) FROM (SELECT sum(count) AS s FROM expr GROUP BY cell_id)) / library)")} AS lognorm FROM lognorm""")
def rel_12b(spark, sf):
    return _round(N.normalize_total(S.expr(spark, sf), None).select("cell_id", "feature", "lognorm"), "lognorm")


@register("win_06_library_window", "SELECT cell_id, feature, CAST(library AS BIGINT) AS library FROM lognorm")
def win_06(spark, sf):
    return lognorm(spark, sf).select("cell_id", "feature", "library")


_STATE = """SELECT '{k}' AS source, CASE WHEN bad = 0 THEN 'raw_counts' WHEN cv_e < 0.01 THEN 'log_normalized' WHEN cv_s < 0.01 OR hi < 30 THEN 'normalized' ELSE 'uncertain' END AS state, bad = 0 AS is_integer, round(lo, 6) AS min, round(hi, 6) AS max,
    CASE WHEN bad > 0 AND cv_e < 0.01 THEN round(scale, 3) END AS log_scale FROM (SELECT min(lo) AS lo, max(hi) AS hi, sum(bad) AS bad, stddev_pop(e) / avg(e) AS cv_e, stddev_pop(s) / avg(s) AS cv_s, quantile_cont(e, 0.5) AS scale
    FROM (SELECT cell_id, min({v}) AS lo, max({v}) AS hi, count(*) FILTER (abs({v} - round({v})) > 1e-6) AS bad, sum(exp(least({v}, 700.0)) - 1) AS e, sum({v}) AS s FROM lognorm WHERE {v} <> 0 GROUP BY 1))"""


@register("rel_13_value_state", " UNION ALL ".join([_STATE.format(k="counts", v="CAST(count AS DOUBLE)"), _STATE.format(k="lognorm", v="v")]))
def rel_13(spark, sf):
    e = lognorm(spark, sf)
    out = N.detect_value_state(e, "count").withColumn("source", F.lit("counts")).unionByName(N.detect_value_state(e, "lognorm").withColumn("source", F.lit("lognorm")))
    return _round(_round(out, "min", "max"), "log_scale", digits=3)


@register("rel_14_reconstruct_counts", "SELECT cell_id, feature, CAST(round((exp(v) - 1) * library / 10000.0) AS INT) AS count FROM lognorm")
def rel_14(spark, sf):
    e = lognorm(spark, sf)
    counts, _ = N.reconstruct_counts(e.select("cell_id", "feature", "lognorm"), e.groupBy("cell_id").agg(F.max("library").alias("total")), 1e4)
    return counts.select("cell_id", "feature", "count")


@register("rel_14_reconstruction_report", "SELECT true AS accepted, false AS partial_totals, min(count) AS min_nonzero_count, 1.0 AS row_sum_matches_total FROM expr".replace("min(count)", "CAST(min(count) AS INT)"))
def rel_14b(spark, sf):
    e = lognorm(spark, sf)
    _, info = N.reconstruct_counts(e.select("cell_id", "feature", "lognorm"), e.groupBy("cell_id").agg(F.max("library").alias("total")), 1e4)
    return info.select("accepted", "partial_totals", "min_nonzero_count", "row_sum_matches_total")


# ---- proteins

def antibody_cells(spark, sf):
    return S.protein_counts(spark, sf).select("cell_id").distinct()


@register("rel_15_clr_per_cell", f"SELECT cell_id, protein, {R6('v')} AS clr FROM clr_cell")
def rel_15(spark, sf):
    return _round(P.clr(antibody_cells(spark, sf), S.protein_counts(spark, sf), S.protein_panel(spark, sf)), "clr")


@register("rel_15_clr_per_protein", f"SELECT cell_id, protein, {R6('ln(1 + count) - avg(ln(1 + count)) OVER (PARTITION BY protein)')} AS clr FROM dense_protein WHERE protein NOT LIKE 'N%'")
def rel_15b(spark, sf):
    return _round(P.clr(antibody_cells(spark, sf), S.protein_counts(spark, sf), S.protein_panel(spark, sf), "cells"), "clr")


@register("rel_16_log1p_protein", f"SELECT cell_id, protein, {R6('ln(1 + count)')} AS log1p FROM dense_protein WHERE protein NOT LIKE 'N%'")
def rel_16(spark, sf):
    return _round(P.log1p_protein(antibody_cells(spark, sf), S.protein_counts(spark, sf), S.protein_panel(spark, sf)), "log1p")


_ISO = "SELECT a.cell_id, a.protein, greatest(0, ln((a.count + 1) / (i.count + 1))) AS v FROM dense_protein a JOIN dense_protein i ON a.cell_id = i.cell_id AND i.protein = CASE WHEN a.protein LIKE '%O' THEN 'NO' ELSE 'NF' END WHERE a.protein NOT LIKE 'N%'"


def isotype_values(spark, sf):
    return P.isotype_ratio(antibody_cells(spark, sf), S.protein_counts(spark, sf), S.protein_panel(spark, sf), S.ISOTYPE_MAP)


@register("rel_17_isotype_ratio", f"SELECT cell_id, protein, {R6('v')} AS isotype_ratio FROM ({_ISO})")
def rel_17(spark, sf):
    return _round(isotype_values(spark, sf), "isotype_ratio")


@register("rel_18_infer_isotypes", f"""SELECT protein, arg_min(control, err) AS isotype_control, round(min(err), 6) AS max_abs_diff, min(err) < 1e-4 AS reproduced FROM (
    SELECT x.protein, i.protein AS control, max(abs(greatest(0, ln((a.count + 1) / (i.count + 1))) - x.v)) AS err FROM ({_ISO}) x JOIN dense_protein a ON a.cell_id = x.cell_id AND a.protein = x.protein
    JOIN dense_protein i ON i.cell_id = x.cell_id AND i.protein LIKE 'N%' GROUP BY 1, 2) GROUP BY 1""")
def rel_18(spark, sf):
    given = isotype_values(spark, sf).withColumnRenamed("isotype_ratio", "value")
    return _round(P.infer_isotypes(given, S.protein_counts(spark, sf), S.protein_panel(spark, sf)), "max_abs_diff")


@register("rel_19_protein_roles", """SELECT protein, protein LIKE 'N%' AS is_isotype, protein NOT LIKE 'N%' AS in_primary_matrix, protein NOT LIKE 'N%' AS used_in_embedding,
    CASE WHEN protein LIKE 'N%' THEN 'isotype_control' ELSE 'target' END AS role, true AS used_in_qc FROM (SELECT DISTINCT protein FROM dense_protein)""")
def rel_19(spark, sf):
    panel = S.protein_panel(spark, sf)
    primary, _ = P.normalize_protein(antibody_cells(spark, sf), S.protein_counts(spark, sf), panel)
    return P.protein_roles(panel, primary, primary)


@register("rel_20_annotate_features", """SELECT protein, is_isotype, CASE WHEN protein = 'RO' THEN 'clone-user' WHEN protein LIKE 'R%' THEN 'clone-input' ELSE '' END AS clone, CASE WHEN protein LIKE 'R%' THEN 'name ' || protein ELSE '' END AS antibody_name,
    CASE WHEN protein = 'RO' THEN 'input_features+feature_table' WHEN protein LIKE 'R%' THEN 'input_features' WHEN protein LIKE 'A%' THEN 'feature_table' ELSE 'none' END AS annotation_source
    FROM (SELECT DISTINCT protein, protein LIKE 'N%' AS is_isotype FROM dense_protein)""")
def rel_20(spark, sf):
    panel = S.protein_panel(spark, sf)
    given = panel.where("protein LIKE 'R%'").select("protein", F.concat(F.lit("name "), "protein").alias("antibody_name"), F.lit("clone-input").alias("clone"))
    user = panel.where("protein = 'RO' OR protein LIKE 'A%'").select("protein", F.when(F.col("protein") == "RO", "clone-user").otherwise(" ").alias("clone"))
    return P.annotate_features(panel, given, user).select("protein", "is_isotype", "clone", "antibody_name", "annotation_source")


@register("rel_21_canonical_protein_name", "SELECT DISTINCT protein || ' protein' AS name, CASE WHEN protein = 'RO' THEN 'Renamed' ELSE protein END AS protein, CASE WHEN protein = 'RO' THEN 'Renamed' ELSE protein END LIKE 'N%' AS is_isotype FROM dense_protein")
def rel_21(spark, sf):
    names = S.protein_panel(spark, sf).select(F.concat("protein", F.lit(" protein")).alias("name"))
    return P.canonical_names(names, " protein", {"RO": "Renamed"}, S.ISOTYPES)


# ---- moments and ranks

_GRID = """SELECT t.target, g.feature, t.n_perturbed AS n, coalesce(s.s1, 0) AS s1, coalesce(s.s2, 0) AS s2, coalesce(s.se, 0) AS se FROM targets t CROSS JOIN (SELECT DISTINCT feature FROM expr) g
    LEFT JOIN (SELECT c.target, l.feature, sum(v) AS s1, sum(v * v) AS s2, sum(exp(v) - 1) AS se FROM lognorm l JOIN screened c ON l.cell_id = c.cell_id WHERE role = 'perturbed' GROUP BY 1, 2) s ON s.target = t.target AND s.feature = g.feature"""
_CTRL = """SELECT l.feature, (SELECT count(*) FROM screened WHERE role = 'control') AS nc, sum(v) AS s1, sum(v * v) AS s2, sum(exp(v) - 1) AS se FROM lognorm l JOIN screened c ON l.cell_id = c.cell_id WHERE role = 'control' GROUP BY 1"""
_POOL = """SELECT l.feature, sum(v) AS s1, sum(v * v) AS s2, sum(exp(v) - 1) AS se FROM lognorm l JOIN screened c ON l.cell_id = c.cell_id WHERE role = 'perturbed' GROUP BY 1"""
SUBQUERIES.update({
    "own_sums": _GRID, "control_sums": _CTRL,
    "own_vs_control": """SELECT o.target, o.feature, o.n AS n_p, c.nc AS n_c, o.s1 / o.n AS mean_p, greatest(0, (o.s2 / o.n - (o.s1 / o.n) ** 2) * o.n / greatest(o.n - 1, 1)) AS var_p,
        coalesce(c.s1, 0) / c.nc AS mean_c, greatest(0, (coalesce(c.s2, 0) / c.nc - (coalesce(c.s1, 0) / c.nc) ** 2) * c.nc / greatest(c.nc - 1, 1)) AS var_c,
        log2((o.se / o.n + 1e-9) / (coalesce(c.se, 0) / c.nc + 1e-9)) AS log2fc FROM own_sums o JOIN control_sums c ON o.feature = c.feature WHERE o.n >= 20""",
    "gene_t": "SELECT *, CASE WHEN var_p / n_p + var_c / n_c > 0 THEN (mean_p - mean_c) / sqrt(var_p / n_p + var_c / n_c) ELSE 0 END AS t FROM own_vs_control",
})


@register("agg_18_group_moments", f"SELECT target, feature, n_p, {R6('mean_p')} AS mean_p, {R6('var_p')} AS var_p, {R6('mean_c')} AS mean_c, {R6('var_c')} AS var_c FROM own_vs_control")
def agg_18(spark, sf):
    return _round(effects(spark, sf, False).select("target", "feature", "n_p", "mean_p", "var_p", "mean_c", "var_c"), "mean_p", "var_p", "mean_c", "var_c")


def genes_seen(spark, sf):
    return S.read(spark, sf, "part").select(F.col("p_brand").alias("feature")).distinct()


def effects(spark, sf, with_p=True, control="ntc"):
    return GT.target_vs_control(screened(spark, sf), lognorm(spark, sf), genes_seen(spark, sf), S.CONTROLS, 20, control, with_p=with_p)


@register("stat_02_welch_t", f"SELECT target, feature, {R6('t')} AS t FROM gene_t")
def stat_02(spark, sf):
    return _round(effects(spark, sf, False).select("target", "feature", "t"), "t")


@register("stat_02_welch_p")
def stat_02p(spark, sf):
    return _round(effects(spark, sf).select("target", "feature", "t", "p_value"), "t", "p_value")


@register("agg_27_effect_matrix", f"SELECT target, feature, {R6('log2fc')} AS log2fc FROM own_vs_control")
def agg_27(spark, sf):
    return _round(effects(spark, sf, False).select("target", "feature", "log2fc"), "log2fc")


@register("agg_28_leave_one_out_moments", f"""SELECT o.target, o.feature, p.n - o.n AS n_c, {R6('(t.s1 - o.s1) / (p.n - o.n)')} AS mean_c,
    {R6('greatest(0, ((t.s2 - o.s2) / (p.n - o.n) - ((t.s1 - o.s1) / (p.n - o.n)) ** 2) * (p.n - o.n) / (p.n - o.n - 1))')} AS var_c, {R6('log2((o.se / o.n + 1e-9) / ((t.se - o.se) / (p.n - o.n) + 1e-9))')} AS log2fc
    FROM own_sums o JOIN ({_POOL}) t ON o.feature = t.feature, (SELECT count(*) AS n FROM screened WHERE role = 'perturbed') p WHERE o.n >= 20""")
def agg_28(spark, sf):
    return _round(effects(spark, sf, False, "other").select("target", "feature", "n_c", "mean_c", "var_c", "log2fc"), "mean_c", "var_c", "log2fc")


@register("join_10_leave_one_target_out", """SELECT t.target, t.n_perturbed, (SELECT count(*) FROM screened WHERE role = 'control') AS n_control_ntc, (SELECT count(*) FROM screened WHERE role = 'perturbed' AND target <> t.target) AS n_control_other FROM targets t""")
def join_10(spark, sf):
    return K.target_sizes(screened(spark, sf), S.CONTROLS)


@register("stat_27_gene_ranking", f"SELECT target, feature, {R6('t')} AS t, rank FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY t DESC, feature) AS rank FROM gene_t)")
def stat_27(spark, sf):
    ranked = GT.rank_genes(effects(spark, sf, False))
    return _round(ranked.select("target", "feature", "t", F.col("rank").cast("bigint").alias("rank")), "t")


@register("top_03_top_genes_per_target", "SELECT target, feature, rank FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY t DESC, feature) AS rank FROM gene_t) WHERE rank <= 10")
def top_03(spark, sf):
    return GT.top_genes(effects(spark, sf, False), 10).select("target", "feature", F.col("rank").cast("bigint").alias("rank"))


@register("top_05_response_panel")
def top_05(spark, sf):
    return GT.response_panel(effects(spark, sf), 0.5, 20)


@register("agg_29_de_counts")
def agg_29(spark, sf):
    return _round(GT.de_counts(GT.de_mask(effects(spark, sf), 0.1, 0.2), "target"), "mean_abs_log2fc", "mean_log2fc")


@register("agg_29_effect_sizes_per_gene", f"SELECT feature, {R6('avg(abs(log2fc))')} AS mean_abs_log2fc, {R6('avg(log2fc)')} AS mean_log2fc FROM own_vs_control GROUP BY 1")
def agg_29b(spark, sf):
    e = effects(spark, sf, False).withColumn("de", F.lit(False))
    return _round(GT.de_counts(e, "feature").select("feature", "mean_abs_log2fc", "mean_log2fc"), "mean_abs_log2fc", "mean_log2fc")


@register("join_20_regulatory_edges", f"""SELECT target AS source, feature AS regulated, {R6('log2fc')} AS log2fc, CASE WHEN log2fc > 0 THEN 'positive' ELSE 'negative' END AS sign FROM own_vs_control
    WHERE abs(log2fc) > 0.1 AND target <> feature AND feature IN (SELECT target FROM own_vs_control)""")
def join_20(spark, sf):
    e = effects(spark, sf, False).withColumn("de", F.abs("log2fc") > 0.1)
    return _round(GT.regulatory_edges(e), "log2fc")


# ---- own-gene knockdown

_ARM = """SELECT o.target, {cols} FROM own_values o GROUP BY 1"""


def _mean(expr: str, arm: str) -> str:
    return f"avg({expr}) FILTER (arm = '{arm}')"


def _arm_columns(arm: str) -> str:
    p, c = _mean("exp(v) - 1", "own"), _mean("exp(v) - 1", arm)
    return ", ".join([
        f"{R6(_mean('v', 'own'))} AS mean_lognorm_perturbed_{arm}", f"{R6(_mean('v', arm))} AS mean_lognorm_control_{arm}", f"{R6(f'log2(({p} + 0.01) / ({c} + 0.01))')} AS log2fc_{arm}",
        f"round(100 * (1 - ({p} + 0.01) / ({c} + 0.01)), 4) AS pct_knockdown_{arm}", f"round(100.0 * count(*) FILTER (arm = 'own' AND v > 0) / count(*) FILTER (arm = 'own'), 4) AS pct_cells_expressing_perturbed_{arm}",
        f"round(100.0 * count(*) FILTER (arm = '{arm}' AND v > 0) / count(*) FILTER (arm = '{arm}'), 4) AS pct_cells_expressing_control_{arm}"])


_EFFECT_SQL = f"SELECT target, count(*) FILTER (arm = 'own') AS n_perturbed, count(*) FILTER (arm = 'ntc') AS n_control_ntc, count(*) FILTER (arm = 'other') AS n_control_other, {_arm_columns('ntc')}, {_arm_columns('other')} FROM own_values GROUP BY 1"


def own_counts(spark, sf):
    cells = screened(spark, sf)
    targets = K.target_genes(K.target_sizes(cells, S.CONTROLS))
    return K.own_gene_counts(cells, lognorm(spark, sf), targets, S.CONTROLS)


def _round_effect(df):
    for arm in K.ARMS:
        df = _round(df, *[f"{c}_{arm}" for c in ("mean_lognorm_perturbed", "mean_lognorm_control", "log2fc")])
        df = _round(df, *[f"{c}_{arm}" for c in ("pct_knockdown", "pct_cells_expressing_perturbed", "pct_cells_expressing_control")], digits=4)
    return df


@register("agg_19_knockdown_effect", _EFFECT_SQL)
def agg_19(spark, sf):
    return _round_effect(K.knockdown_effect(own_counts(spark, sf)))


def _pair(arm: str) -> str:
    return f"""SELECT target, v, count(*) FILTER (arm = 'own') AS a, count(*) FILTER (arm = '{arm}') AS b FROM own_values WHERE arm IN ('own', '{arm}') GROUP BY 1, 2"""


def _ks(arm: str) -> str:
    return f"""SELECT target, '{arm}' AS control, max(abs(ca / na - cb / nb)) AS ks_stat FROM (SELECT target, sum(a) OVER w AS ca, sum(b) OVER w AS cb, sum(a) OVER (PARTITION BY target) AS na, sum(b) OVER (PARTITION BY target) AS nb
        FROM ({_pair(arm)}) WINDOW w AS (PARTITION BY target ORDER BY v)) GROUP BY 1"""


def _mwu(arm: str) -> str:
    return f"""SELECT target, '{arm}' AS control, max(na) AS n_first, max(nb) AS n_second, sum(a * (below + (a + b + 1) / 2.0)) - max(na) * (max(na) + 1) / 2 AS u, sum(CAST(a + b AS DOUBLE) ** 3 - (a + b)) AS ties
        FROM (SELECT *, sum(a + b) OVER (PARTITION BY target ORDER BY v) - (a + b) AS below, sum(a) OVER (PARTITION BY target) AS na, sum(b) OVER (PARTITION BY target) AS nb FROM ({_pair(arm)})) GROUP BY 1"""


def _arms_long(df, columns):
    parts = F.explode(F.array(*[F.struct(F.lit(a).alias("control"), *[F.col(f"{c}_{a}").alias(c) for c in columns]) for a in K.ARMS]))
    return df.select("target", parts.alias("_r")).select("target", "_r.*")


@register("stat_05_ks_statistic", f"SELECT target, control, {R6('ks_stat')} AS ks_stat FROM ({_ks('ntc')} UNION ALL {_ks('other')})")
def stat_05(spark, sf):
    return _round(_arms_long(K.rank_statistics(own_counts(spark, sf)), ["ks_stat"]), "ks_stat")


@register("win_05_two_sample_cdf", f"SELECT target, {R6('max(ks_stat)')} AS ks_stat FROM ({_ks('ntc')}) GROUP BY 1")
def win_05(spark, sf):
    counts = own_counts(spark, sf).select("target", "lognorm", F.col("n_perturbed").alias("n_a"), F.col("n_control_ntc").alias("n_b"))
    return _round(R.compare_distributions(counts, ["target"], "lognorm").select("target", "ks_stat"), "ks_stat")


@register("stat_06_rank_sum", f"SELECT target, control, CAST(n_first AS BIGINT) AS n_first, CAST(n_second AS BIGINT) AS n_second, u, ties, round(u / (n_first * n_second), 6) AS auc FROM ({_mwu('ntc')} UNION ALL {_mwu('other')})")
def stat_06(spark, sf):
    return _round(_arms_long(K.rank_statistics(own_counts(spark, sf)), ["n_first", "n_second", "u", "ties", "auc"]), "auc")


@register("agg_20_perturbation_strength")
def agg_20(spark, sf):
    out = K.perturbation_strength(screened(spark, sf), lognorm(spark, sf), genes_seen(spark, sf), S.CONTROLS)
    return _round(_round_effect(out), *[f"{c}_{a}" for a in K.ARMS for c in ("ks_stat", "ks_pval", "mwu_pval_less", "ks_fdr", "mwu_fdr")])


@register("agg_20_eligibility", """SELECT target, gene, n_perturbed, CASE WHEN gene IS NULL THEN '' WHEN n_perturbed < 45 THEN 'fewer than 45 perturbed cells' WHEN pct < 60 THEN 'not detectably expressed in control cells (' || printf('%.2f', pct) || '% of control cells, threshold 60%)' END AS reason
    FROM (SELECT target, target AS gene, count(*) FILTER (arm = 'own') AS n_perturbed, 100.0 * count(*) FILTER (arm = 'ntc' AND v > 0) / count(*) FILTER (arm = 'ntc') AS pct FROM own_values GROUP BY 1)""")
def agg_20b(spark, sf):
    cells = screened(spark, sf)
    targets = K.target_genes(K.target_sizes(cells, S.CONTROLS))
    effect = K.knockdown_effect(own_counts(spark, sf))
    return K.eligibility(targets, effect, genes_seen(spark, sf), "ntc", 45, 60).select("target", "gene", "n_perturbed", "reason")


@register("win_01_effect_rank", f"SELECT target, row_number() OVER (ORDER BY pct_knockdown_ntc > 0 DESC, round(log2fc_ntc, 4), target) AS rank FROM ({_EFFECT_SQL})")
def win_01(spark, sf):
    effect = _round_effect(K.knockdown_effect(own_counts(spark, sf)))
    flagged = effect.withColumn("hit", F.col("pct_knockdown_ntc") > 0).withColumn("fold", F.round("log2fc_ntc", 4))
    return K.rank_targets(flagged, "hit", "fold").select("target", F.col("rank").cast("bigint").alias("rank"))


@register("rel_34_display_table", f"SELECT row_number() OVER (ORDER BY pct_knockdown_ntc > 0 DESC, round(log2fc_ntc, 4), target) AS \"Rank\", target AS \"Target\", n_perturbed AS \"Perturbed cells\", n_control_ntc AS \"Control cells\" FROM ({_EFFECT_SQL})")
def rel_34(spark, sf):
    effect = _round_effect(K.knockdown_effect(own_counts(spark, sf)))
    ranked = K.rank_targets(effect.withColumn("hit", F.col("pct_knockdown_ntc") > 0).withColumn("fold", F.round("log2fc_ntc", 4)), "hit", "fold")
    out = K.display_table(ranked).select("Rank", "Target", "Perturbed cells", "Control cells")
    return out.withColumn("Rank", F.col("Rank").cast("bigint"))


# ---- generic statistics on whole tables

_BH = """SELECT {k} AS key, p, least(1, min(raw) OVER (ORDER BY p DESC)) AS q FROM (SELECT {k}, p, p * count(*) OVER () / max(rn) OVER (PARTITION BY p) AS raw FROM (SELECT {k}, p, row_number() OVER (ORDER BY p) AS rn FROM ({src})))"""
_P_SRC = "SELECT o_orderkey, (CAST(round(o_totalprice * 100) AS BIGINT) % 100000) / 100000.0 AS p FROM orders"


@register("stat_01_bh_fdr", f"SELECT key AS o_orderkey, p, {R6('q')} AS fdr FROM ({_BH.format(k='o_orderkey', src=_P_SRC)})")
def stat_01(spark, sf):
    tests = S.read(spark, sf, "orders").select("o_orderkey", ((F.round(F.col("o_totalprice") * 100).cast("bigint") % 100000) / 100000.0).alias("p"))
    return _round(bh_adjust(tests, "p", "fdr"), "fdr")


@register("win_03_bh_per_family", f"""SELECT o_orderkey, o_orderpriority, p, {R6('q')} AS fdr FROM (SELECT o_orderkey, o_orderpriority, p, least(1, min(raw) OVER (PARTITION BY o_orderpriority ORDER BY p DESC)) AS q FROM (
    SELECT *, p * count(*) OVER (PARTITION BY o_orderpriority) / max(rn) OVER (PARTITION BY o_orderpriority, p) AS raw FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY p) AS rn FROM (SELECT o_orderkey, o_orderpriority, (CAST(round(o_totalprice * 100) AS BIGINT) % 100000) / 100000.0 AS p FROM orders))))""")
def win_03(spark, sf):
    tests = S.read(spark, sf, "orders").select("o_orderkey", "o_orderpriority", ((F.round(F.col("o_totalprice") * 100).cast("bigint") % 100000) / 100000.0).alias("p"))
    return _round(bh_adjust(tests, "p", "fdr", ["o_orderpriority"]), "fdr")


_RANK = "rank() OVER (PARTITION BY {k} ORDER BY {v}) + (count(*) OVER (PARTITION BY {k}, {v}) - 1) / 2.0"


@register("win_04_average_ranks", f"SELECT DISTINCT event_type, value, {_RANK.format(k='event_type', v='value')} AS rank, count(*) OVER (PARTITION BY event_type, value) AS n, count(*) OVER (PARTITION BY event_type) AS n_total FROM events")
def win_04(spark, sf):
    return average_ranks(S.read(spark, sf, "events"), ["event_type"], "value")


@register("stat_03_spearman", f"""SELECT l_returnflag, count(*) AS n_pairs, round(corr(rx, ry), 6) AS rho FROM (SELECT l_returnflag, {_RANK.format(k='l_returnflag', v='l_quantity')} AS rx, {_RANK.format(k='l_returnflag', v='l_extendedprice')} AS ry FROM lineitem) GROUP BY 1""")
def stat_03(spark, sf):
    return _round(R.spearman(S.read(spark, sf, "lineitem"), ["l_returnflag"], "l_quantity", "l_extendedprice", p=None), "rho")


@register("stat_04_cohen_d", """SELECT o_orderpriority, round((avg(o_totalprice) FILTER (o_orderstatus = 'F') - avg(o_totalprice) FILTER (o_orderstatus = 'O')) / sqrt(((count(*) FILTER (o_orderstatus = 'F') - 1) * var_samp(o_totalprice) FILTER (o_orderstatus = 'F')
    + (count(*) FILTER (o_orderstatus = 'O') - 1) * var_samp(o_totalprice) FILTER (o_orderstatus = 'O')) / (count(*) FILTER (o_orderstatus = 'F') + count(*) FILTER (o_orderstatus = 'O') - 2)), 6) AS cohen_d FROM orders GROUP BY 1""")
def stat_04(spark, sf):
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    aggs = [f(F.when(status == s, price)).alias(f"{n}_{s}") for s in ("F", "O") for n, f in (("m", F.avg), ("v", F.var_samp), ("n", F.count))]
    sums = S.read(spark, sf, "orders").groupBy("o_orderpriority").agg(*aggs)
    c = F.col
    return _round(sums.select("o_orderpriority", M.cohen_d(c("m_F"), c("v_F"), c("n_F"), c("m_O"), c("v_O"), c("n_O")).alias("cohen_d")), "cohen_d")


@register("stat_17_kruskal_wallis", f"""SELECT o_orderstatus, max(n) AS n, count(*) AS n_groups, round((12 / (max(n) * (max(n) + 1.0)) * sum(r * r / c) - 3 * (max(n) + 1)) / (1 - max(ties) / (max(n) ** 3.0 - max(n))), 6) AS statistic FROM (
    SELECT o_orderstatus, o_orderpriority, count(*) AS c, sum(rk) AS r, max(n) AS n, max(ties) AS ties FROM (SELECT *, {_RANK.format(k='o_orderstatus', v='p')} AS rk, count(*) OVER (PARTITION BY o_orderstatus) AS n,
    sum(t * t - 1) OVER (PARTITION BY o_orderstatus) AS ties FROM (SELECT o_orderstatus, o_orderpriority, round(o_totalprice / 100) AS p, CAST(count(*) OVER (PARTITION BY o_orderstatus, round(o_totalprice / 100)) AS DOUBLE) AS t FROM orders)) GROUP BY 1, 2) GROUP BY 1""")
def stat_17(spark, sf):
    orders = S.read(spark, sf, "orders").select("o_orderstatus", "o_orderpriority", F.round(F.col("o_totalprice") / 100).alias("p"))
    return _round(R.kruskal_wallis(orders, ["o_orderstatus"], "o_orderpriority", "p").select("o_orderstatus", "n", "n_groups", "statistic"), "statistic")


@register("agg_04_quantiles_by_group", """SELECT event_type, round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS q50, round(quantile_cont(value, 0.9), 6) AS q90 FROM events GROUP BY 1""")
def quantiles(spark, sf):
    return _round(exact_quantiles(S.read(spark, sf, "events"), ["event_type"], "value", {"q25": 0.25, "q50": 0.5, "q90": 0.9}), "q25", "q50", "q90")


# ---- scalar families

@register("fn_01_split_lists", "SELECT p_partkey, array_to_string(list_filter(list_transform(string_split(p_name, ' '), lambda x: trim(x)), lambda x: x <> ''), ';') AS items FROM part")
def fn_01(spark, sf):
    return S.read(spark, sf, "part").select("p_partkey", F.array_join(fn.split_list(F.col("p_name"), " "), ";").alias("items"))


@register("fn_02_regex_search", "SELECT doc_id, regexp_matches(text, '(?i)license') OR regexp_matches(text, '(?i)copyright') AS hit FROM documents")
def fn_02(spark, sf):
    return S.read(spark, sf, "documents").select("doc_id", fn.any_regex(F.col("text"), ["license", "copyright"]).alias("hit"))


@register("fn_03_names", "SELECT p_partkey, upper(p_name) AS name, starts_with(upper(p_name), 'RED') AS is_red, regexp_replace(p_name, ' ring$', '') AS base FROM part")
def fn_03(spark, sf):
    return S.read(spark, sf, "part").select("p_partkey", F.upper("p_name").alias("name"), F.upper("p_name").startswith("RED").alias("is_red"), fn.feature_base_name(F.col("p_name"), " ring").alias("base"))


@register("fn_05_summary_strings", "SELECT c_custkey, c_mktsegment || ':' || printf('%+.2f', c_acctbal) AS summary FROM customer")
def fn_05(spark, sf):
    return S.read(spark, sf, "customer").select("c_custkey", F.format_string("%s:%+.2f", "c_mktsegment", "c_acctbal").alias("summary"))


@register("fn_06_math", f"""SELECT event_id, {R6('ln(1 + abs(value))')} AS log1p, {R6('log2(1 + abs(value))')} AS log2, {R6('sqrt(abs(value))')} AS root, CAST(sign(value) AS BIGINT) AS sign, round_even(value, 0) AS even, least(greatest(value, 1.0), 50.0) AS clipped, CAST(floor(value) AS BIGINT) AS floor FROM events""")
def fn_06(spark, sf):
    v = F.col("value")
    df = S.read(spark, sf, "events").select("event_id", F.log1p(F.abs(v)).alias("log1p"), F.log2(1 + F.abs(v)).alias("log2"), F.sqrt(F.abs(v)).alias("root"), F.signum(v).cast("bigint").alias("sign"),
                                            F.rint(v).alias("even"), F.least(F.greatest(v, F.lit(1.0)), F.lit(50.0)).alias("clipped"), F.floor(v).alias("floor"))
    return _round(df, "log1p", "log2", "root")


@register("fn_07_safe_division", "SELECT l_orderkey, l_linenumber, l_partkey, round(l_tax / nullif(l_discount, 0), 6) AS r FROM lineitem")
def fn_07(spark, sf):
    return _round(S.read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", fn.ratio(F.col("l_tax"), F.col("l_discount")).alias("r")), "r")


@register("fn_08_tails")
def fn_08(spark, sf):
    from ..functions import tails

    e = S.read(spark, sf, "events")
    return e.select("event_id", F.round(tails.student_two_sided(F.col("value") / 10, F.lit(7.0)), 9).alias("t_p"), F.round(tails.normal_upper(F.col("value") / 10), 9).alias("z_p"), F.round(tails.chi2_upper(F.abs("value"), F.lit(4)), 9).alias("chi2_p"))


@register("fn_09_seed", "SELECT user_id, CAST(('0x' || substr(sha256('123_' || user_id || '_' || event_type), 1, 8)) AS BIGINT) % 2147483647 AS seed, event_type FROM (SELECT DISTINCT user_id, event_type FROM events)")
def fn_09(spark, sf):
    keys = S.read(spark, sf, "events").select("user_id", "event_type").distinct()
    return keys.select("user_id", "event_type", fn.seed_from_text(F.concat_ws("_", F.lit("123"), F.col("user_id").cast("string"), "event_type")).alias("seed"))


@register("fn_10_vectors", f"SELECT a.vec_id, {R6('sqrt(list_sum(list_transform(list_zip(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), lambda z: (z[1] - z[2]) ** 2)))', 5)} AS distance, {R6('list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))', 5)} AS dot FROM embeddings a, (SELECT embedding FROM embeddings WHERE vec_id = 0) b")
def fn_10(spark, sf):
    e = S.read(spark, sf, "embeddings")
    origin = e.where("vec_id = 0").select(F.col("embedding").cast("array<double>").alias("_b"))
    both = e.crossJoin(F.broadcast(origin)).withColumn("_a", F.col("embedding").cast("array<double>"))
    return _round(both.select("vec_id", F.sqrt(fn.squared_distance(F.col("_a"), F.col("_b"))).alias("distance"), fn.dot(F.col("_a"), F.col("_b")).alias("dot")), "distance", "dot", digits=5)


@register("fn_11_arrays", "SELECT p_partkey, CAST(len(string_split(p_name, ' ')) AS BIGINT) AS n, CAST(len(list_distinct(string_split(p_name, ' '))) AS BIGINT) AS n_distinct, list_contains(string_split(p_name, ' '), 'red') AS has_red, CAST(coalesce(list_position(string_split(p_name, ' '), 'red'), 0) AS BIGINT) AS at FROM part")
def fn_11(spark, sf):
    w = F.split("p_name", " ")
    return S.read(spark, sf, "part").select("p_partkey", F.size(w).cast("bigint").alias("n"), F.size(F.array_distinct(w)).cast("bigint").alias("n_distinct"), F.array_contains(w, "red").alias("has_red"), F.array_position(w, "red").cast("bigint").alias("at"))


@register("fn_12_map_lookup", "SELECT protein, CASE protein WHEN 'RO' THEN 'NO' WHEN 'AO' THEN 'NO' WHEN 'RF' THEN 'NF' WHEN 'AF' THEN 'NF' END AS control, count(*) AS n FROM (SELECT l_returnflag || l_linestatus AS protein FROM lineitem) GROUP BY 1")
def fn_12(spark, sf):
    m = F.create_map(*[F.lit(x) for kv in S.ISOTYPE_MAP.items() for x in kv])
    lines = S.read(spark, sf, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("protein"))
    return lines.groupBy("protein").agg(F.count(F.lit(1)).alias("n")).withColumn("control", F.element_at(m, F.col("protein")))


@register("fn_13_try_cast", "SELECT doc_id, TRY_CAST(split_part(source, '-', 2) AS DOUBLE) AS number, TRY_CAST(lang AS DOUBLE) AS lang_number FROM documents")
def fn_13(spark, sf):
    return S.read(spark, sf, "documents").select("doc_id", F.expr("try_cast(split_part(source, '-', 2) AS DOUBLE)").alias("number"), F.expr("try_cast(lang AS DOUBLE)").alias("lang_number"))


@register("fn_14_odds", f"""SELECT lang, a, b, c, d, {R6('((a + .5) * (d + .5)) / ((b + .5) * (c + .5))')} AS odds, {R6('log2(((a + .5) * (d + .5)) / ((b + .5) * (c + .5)))')} AS log2_odds, CASE WHEN b * c > 0 THEN round(a * d / (b * c), 6) WHEN a * d > 0 THEN CAST('inf' AS DOUBLE) END AS sample_odds
    FROM (SELECT lang, count(*) FILTER (quality = 1 AND toxic = 1) AS a, count(*) FILTER (quality = 1 AND toxic = 0) AS b, count(*) FILTER (quality = 0 AND toxic = 1) AS c, count(*) FILTER (quality = 0 AND toxic = 0) AS d FROM labels l JOIN documents d ON l.doc_id = d.doc_id GROUP BY 1)""")
def fn_14(spark, sf):
    q, t = F.col("quality"), F.col("toxic")
    t4 = S.read(spark, sf, "labels").join(S.read(spark, sf, "documents"), "doc_id").groupBy("lang").agg(
        *[F.count_if((q == i) & (t == j)).alias(k) for k, i, j in (("a", 1, 1), ("b", 1, 0), ("c", 0, 1), ("d", 0, 0))])
    a, b, c, d = (F.col(x) for x in "abcd")
    out = t4.withColumn("odds", fn.corrected_odds(a, b, c, d)).withColumn("log2_odds", F.log2("odds")).withColumn("sample_odds", fn.raw_odds(a, b, c, d))
    return _round(out, "odds", "log2_odds", "sample_odds")


# ---- cluster markers: the screened cells by sample, all genes

SUBQUERIES.update({
    "marker_cells": "SELECT cell_id, sample AS cluster FROM screened",
    "marker_ranks": """SELECT cluster, feature, v, rank() OVER (PARTITION BY feature ORDER BY v) + (count(*) OVER (PARTITION BY feature, v) - 1) / 2.0 AS r FROM
        (SELECT c.cell_id, c.cluster, f.feature, coalesce(round(l.v, 9), 0) AS v FROM marker_cells c CROSS JOIN (SELECT DISTINCT p_brand AS feature FROM part) f LEFT JOIN lognorm l ON l.cell_id = c.cell_id AND l.feature = f.feature)""",
    "marker_sums": "SELECT cluster, feature, count(*) AS n_p, sum(v) AS s, sum(r) AS r FROM marker_ranks GROUP BY 1, 2",
    "marker_table": """SELECT cluster, feature, n_p, n - n_p AS n_c, s / n_p AS mean_p, (t - s) / (n - n_p) AS mean_c, log2((exp(s / n_p) - 1 + 1e-9) / (exp((t - s) / (n - n_p)) - 1 + 1e-9)) AS logfoldchange,
        (r - n_p * (n + 1) / 2.0) / sqrt(n_p * (n - n_p) * (n + 1) / 12.0) AS score FROM (SELECT *, sum(n_p) OVER (PARTITION BY feature) AS n, sum(s) OVER (PARTITION BY feature) AS t FROM marker_sums)""",
})


def markers(spark, sf):
    clusters = screened(spark, sf).where("perturbation_class = 'single_targeting' OR (perturbation_class = 'single_control' AND control_class = 'non_targeting')").select("cell_id", F.col("sample").alias("cluster"))
    genes = S.read(spark, sf, "part").select(F.col("p_brand").alias("feature")).distinct()
    return GT.cluster_markers(clusters, lognorm(spark, sf).withColumn("lognorm", F.round("lognorm", 9)), genes)


@register("stat_28_cluster_markers", f"SELECT cluster, feature, CAST(n_p AS BIGINT) AS n_p, CAST(n_c AS BIGINT) AS n_c, {R6('mean_p')} AS mean_p, {R6('mean_c')} AS mean_c, {R6('logfoldchange')} AS logfoldchange, {R6('score')} AS score FROM marker_table")
def stat_28(spark, sf):
    return _round(markers(spark, sf).drop("p_value"), "mean_p", "mean_c", "logfoldchange", "score")


@register("top_04_marker_panel", """SELECT feature, min_by(cluster, cluster) AS cluster, CAST(min_by(marker_rank, cluster) AS INT) AS marker_rank FROM
    (SELECT feature, cluster, row_number() OVER (PARTITION BY cluster ORDER BY logfoldchange DESC, feature) AS marker_rank FROM
    (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY score DESC, feature) AS k FROM marker_table) WHERE k <= 10 AND logfoldchange > 0) GROUP BY 1""")
def top_04(spark, sf):
    return GT.marker_panel(markers(spark, sf), 10)
