"""Queries: response scores, bounded samples, distances between groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import distances as D
from ..operators import response as PS
from ..operators.sampling import bounded_sample
from . import screen_tables as S
from .queries_b_quality import _round
from .queries_c_statistics import R6, genes_seen, lognorm, own_counts, screened
from .registry import SUBQUERIES, register

CLASSES = ["non_targeting"]
N_SIG = 10

SUBQUERIES.update({
    "psig": f"SELECT target, feature, t, mean_p - mean_c AS beta, mean_c, row_number() OVER (PARTITION BY target ORDER BY t DESC, feature) AS rank FROM gene_t QUALIFY rank <= {N_SIG}",
    "proj": """SELECT s.target, c.cell_id, c.role = 'perturbed' AS is_target, (coalesce(sum(l.v * s.beta), 0) - max(k.base)) / max(k.bb) AS proj FROM psig s JOIN screened c ON c.role = 'control' OR c.target = s.target LEFT JOIN lognorm l ON l.cell_id = c.cell_id AND l.feature = s.feature
        JOIN (SELECT target, sum(beta * mean_c) AS base, sum(beta * beta) AS bb FROM psig GROUP BY 1) k ON k.target = s.target GROUP BY 1, 2, 3""",
    "scored": "SELECT *, CASE WHEN max(raw) OVER (PARTITION BY target) > 0 THEN raw / max(raw) OVER (PARTITION BY target) ELSE raw END AS score FROM (SELECT *, greatest(0, least(3, proj)) AS raw FROM proj)",
    "quadrants": """SELECT s.*, CASE WHEN score >= 0.5 THEN CASE WHEN coalesce(l.v, 0) > k.cut THEN 'escaper' ELSE 'successful_knockdown' END ELSE CASE WHEN coalesce(l.v, 0) > k.cut THEN 'non_responder' ELSE 'low_signal' END END AS quadrant
        FROM scored s JOIN (SELECT target, avg(v) AS cut FROM own_values WHERE arm = 'ntc' GROUP BY 1) k ON k.target = s.target LEFT JOIN lognorm l ON l.cell_id = s.cell_id AND l.feature = s.target""",
})


def sig(spark, sf):
    return PS.signatures(screened(spark, sf), lognorm(spark, sf), genes_seen(spark, sf), S.CONTROLS, N_SIG, 20)


def proj(spark, sf):
    return PS.projections(screened(spark, sf), lognorm(spark, sf), sig(spark, sf), S.CONTROLS)


def run(spark, sf, **kw):
    return PS.response_run(screened(spark, sf), lognorm(spark, sf), genes_seen(spark, sf), S.CONTROLS, N_SIG, min_cells=20, **kw)



@register("ml_09_signatures", f"SELECT target, feature, CAST(rank AS INT) AS rank, {R6('t')} AS t_score, {R6('beta')} AS beta FROM psig")
def ml_09a(spark, sf):
    return _round(sig(spark, sf).drop("mean_c"), "t_score", "beta")


@register("ml_09_response_scores", f"SELECT target, cell_id, is_target, {R6('raw', 5)} AS raw, {R6('score', 5)} AS score FROM scored")
def ml_09b(spark, sf):
    return _round(PS.response_scores(proj(spark, sf)).select("target", "cell_id", "is_target", "raw", "score"), "raw", "score", digits=5)


@register("rel_30_quadrants", "SELECT target, quadrant, is_target, count(*) AS n FROM quadrants GROUP BY 1, 2, 3")
def rel_30(spark, sf):
    return run(spark, sf).groupBy("target", "quadrant", "is_target").agg(F.count(F.lit(1)).alias("n"))


@register("rel_31_expression_cut", "SELECT target, round(avg(v), 6) AS mean_cut, round(quantile_cont(v, 0.5), 6) AS median_cut, round(quantile_cont(v, 0.75), 6) AS quantile_cut FROM own_values WHERE arm = 'ntc' GROUP BY 1")
def rel_31(spark, sf):
    counts = own_counts(spark, sf)
    out = PS.expression_cut(counts).withColumnRenamed("cut", "mean_cut")
    for name in ("median", "quantile"):
        out = out.join(PS.expression_cut(counts, name).withColumnRenamed("cut", f"{name}_cut"), "target")
    return _round(out, "mean_cut", "median_cut", "quantile_cut")


def _pct(cond: str, of: str) -> str:
    return f"round(100.0 * count(*) FILTER ({cond}) / count(*) FILTER ({of}), 4)"


_Q = {"pct_successful_kd": "successful_knockdown", "pct_escaper": "escaper", "pct_non_responder": "non_responder", "pct_low_signal": "low_signal"}


_SUMMARY = f"""SELECT target, count(*) FILTER (is_target) AS n_perturbed_cells, count(*) FILTER (NOT is_target) AS n_control_cells, round(avg(score) FILTER (is_target), 5) AS mean_ps, round(quantile_cont(score, 0.5) FILTER (is_target), 5) AS median_ps,
    {_pct('is_target AND score >= 0.5', 'is_target')} AS pct_high_ps, {", ".join(f"{_pct(f'is_target AND quadrant = {v!r}', 'is_target')} AS {k}" for k, v in _Q.items())}, {_pct("NOT is_target AND quadrant = 'successful_knockdown'", 'NOT is_target')} AS pct_controls_called_kd,
    {_pct("NOT is_target AND score >= 0.5", 'NOT is_target')} AS pct_high_ps_control, round(avg(score) FILTER (NOT is_target), 5) AS mean_ps_control, round(quantile_cont(score, 0.25) FILTER (is_target), 5) AS q25_ps, round(quantile_cont(score, 0.75) FILTER (is_target), 5) AS q75_ps,
    round(stddev_samp(score) FILTER (is_target), 5) AS sd_ps FROM quadrants GROUP BY 1"""


def summary(spark, sf):
    return PS.response_summary(run(spark, sf))


@register("agg_35_response_summary", _SUMMARY)
def agg_35(spark, sf):
    out = summary(spark, sf).drop("auc_vs_control", "d_vs_control", "warnings", "net_pct_kd")
    out = _round(out, "mean_ps", "median_ps", "mean_ps_control", "q25_ps", "q75_ps", "sd_ps", digits=5)
    return _round(out, *[c for c in out.columns if c.startswith("pct_")], digits=4)


@register("agg_35_separation_from_control", """SELECT target, round((sum(a * (below + (a + b + 1) / 2.0)) - max(na) * (max(na) + 1) / 2) / (max(na) * max(nb)), 5) AS auc_vs_control FROM (SELECT *, sum(a + b) OVER (PARTITION BY target ORDER BY p) - (a + b) AS below, sum(a) OVER (PARTITION BY target) AS na, sum(b) OVER (PARTITION BY target) AS nb
    FROM (SELECT target, round(proj, 10) AS p, count(*) FILTER (is_target) AS a, count(*) FILTER (NOT is_target) AS b FROM proj GROUP BY 1, 2)) GROUP BY 1""")
def agg_35b(spark, sf):
    return _round(summary(spark, sf).select("target", "auc_vs_control"), "auc_vs_control", digits=5)


@register("join_11_response_vs_strength", f"""SELECT p.target, p.mean_ps, e.log2fc_ntc FROM ({_SUMMARY}) p JOIN (SELECT target, {R6("log2((avg(exp(v) - 1) FILTER (arm = 'own') + 0.01) / (avg(exp(v) - 1) FILTER (arm = 'ntc') + 0.01))")} AS log2fc_ntc FROM own_values GROUP BY 1) e ON p.target = e.target""")
def join_11(spark, sf):
    from ..operators import knockdown as K

    strength = _round(K.knockdown_effect(own_counts(spark, sf)).select("target", "log2fc_ntc"), "log2fc_ntc")
    return _round(summary(spark, sf).select("target", "mean_ps"), "mean_ps", digits=5).join(strength, "target")


# ---- bounded samples

@register("stat_24_bounded_sample", "SELECT target, cell_id FROM (SELECT target, cell_id, row_number() OVER (PARTITION BY target ORDER BY sha256('123|' || cell_id)) AS r FROM vectors) WHERE r <= 40")
def stat_24(spark, sf):
    return bounded_sample(S.vectors(spark, sf).select("target", "cell_id"), ["target"], 40, 123)


@register("stat_24_stratified_sample", """SELECT event_type, event_id AS cell_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY first, h) AS r FROM (SELECT *, CASE WHEN n <= 300 OR rs <= greatest(1, round_even(300.0 * ns / n, 0)) THEN 0 ELSE 1 END AS first FROM (
    SELECT event_type, event_id, u, sha256('7|' || event_id) AS h, row_number() OVER (PARTITION BY event_type, u ORDER BY sha256('7|' || event_id)) AS rs, count(*) OVER (PARTITION BY event_type, u) AS ns, count(*) OVER (PARTITION BY event_type) AS n
    FROM (SELECT *, user_id % 4 AS u FROM events)))) WHERE r <= 300""")
def stat_24b(spark, sf):
    events = S.read(spark, sf, "events").select("event_type", F.col("event_id").alias("cell_id"), (F.col("user_id") % 4).alias("u"))
    return bounded_sample(events, ["event_type"], 300, 7, stratum="u").select("event_type", "cell_id")


# ---- distances

_E = """SELECT t.target, {expr} AS energy_distance FROM (SELECT DISTINCT target FROM vectors WHERE target <> 'NT') t"""
_MEAN = "(SELECT avg(list_distance(a.vec, b.vec)) FROM vectors a, vectors b WHERE a.target = {x} AND b.target = {y})"
_MEANS = "SELECT a.target AS x, b.target AS y, avg(list_distance(a.vec, b.vec)) AS d FROM vectors a, vectors b GROUP BY 1, 2"


@register("stat_10_energy_distance", f"WITH m AS ({_MEANS}) SELECT * FROM (SELECT p.x AS target, round(2 * p.d - xx.d - yy.d, 5) AS energy_distance FROM m p JOIN m xx ON xx.x = p.x AND xx.y = p.x JOIN m yy ON yy.x = 'NT' AND yy.y = 'NT' WHERE p.y = 'NT' AND p.x <> 'NT')".replace("WITH m AS", "SELECT * FROM (WITH m AS") + ")")
def stat_10(spark, sf):
    out = D.perturbation_distance(S.vectors(spark, sf), CLASSES, n_permutations=0, secondary=None)
    return _round(out.where("reason IS NULL").select("target", "energy_distance"), "energy_distance", digits=5)


@register("stat_11_distance_test")
def stat_11(spark, sf):
    out = D.perturbation_distance(S.vectors(spark, sf), CLASSES, n_permutations=999, secondary=None)
    return _round(out.select("target", "n_cells", "n_control", "energy_distance", "p_value"), "energy_distance", "p_value")


_D2 = "SELECT a.target AS x, b.target AS y, list_distance(a.vec, b.vec) ** 2 AS d2 FROM vectors a, vectors b"


@register("stat_12_mmd", f"""SELECT * FROM (WITH p AS ({_D2}), u AS (SELECT t.target, p.x, p.y, p.d2 FROM (SELECT DISTINCT target FROM vectors WHERE target <> 'NT') t JOIN p ON (p.x = t.target AND p.y = t.target) OR (p.x = 'NT' AND p.y = 'NT') OR (p.x = t.target AND p.y = 'NT')),
    g AS (SELECT target, 1 / quantile_cont(d2, 0.5) AS gamma FROM u WHERE d2 > 0 GROUP BY 1) SELECT u.target, round(avg(exp(-gamma * d2)) FILTER (x = u.target AND y = u.target) + avg(exp(-gamma * d2)) FILTER (x = 'NT' AND y = 'NT') - 2 * avg(exp(-gamma * d2)) FILTER (x = u.target AND y = 'NT'), 6) AS mmd_distance
    FROM u JOIN g ON u.target = g.target GROUP BY 1)""")
def stat_12(spark, sf):
    out = D.perturbation_distance(S.vectors(spark, sf), CLASSES, n_permutations=0)
    return _round(out.where("reason IS NULL").select("target", "mmd_distance"), "mmd_distance")


@register("stat_13_perturbation_distance")
def stat_13(spark, sf):
    out = D.perturbation_distance(S.vectors(spark, sf), CLASSES, n_permutations=999)
    return _round(out, "energy_distance", "p_value", "mmd_distance", "fdr")


SUBQUERIES["pair_dist"] = f"SELECT p.x AS a, p.y AS b, greatest(0, 2 * p.d - xx.d - yy.d) AS d FROM ({_MEANS}) p JOIN ({_MEANS}) xx ON xx.x = p.x AND xx.y = p.x JOIN ({_MEANS}) yy ON yy.x = p.y AND yy.y = p.y WHERE p.x <> 'NT' AND p.y <> 'NT'"


@register("join_17_target_pairs", "SELECT a AS target_a, b AS target_b, round(d, 5) AS distance FROM pair_dist WHERE a < b")
def join_17(spark, sf):
    return _round(D.pair_distances(S.vectors(spark, sf), block=2), "distance", digits=5)


@register("join_18_nearest_targets", "SELECT a AS target, b AS neighbor, round(d, 5) AS distance, CAST(row_number() OVER (PARTITION BY a ORDER BY d, b) AS INT) AS rank FROM pair_dist WHERE a <> b QUALIFY rank <= 3")
def join_18(spark, sf):
    return _round(D.nearest_targets(D.pair_distances(S.vectors(spark, sf)), 3), "distance", digits=5)


@register("ml_10_centred_products", "SELECT a, b, round(-0.5 * (d * d - avg(d * d) OVER (PARTITION BY a) - avg(d * d) OVER (PARTITION BY b) + avg(d * d) OVER ()), 6) AS value FROM (SELECT a, b, CASE WHEN a = b THEN 0 ELSE d END AS d FROM pair_dist)")
def ml_10(spark, sf):
    return _round(D.centred_products(D.pair_distances(S.vectors(spark, sf))), "value")


@register("ml_10_principal_coordinates")
def ml_10b(spark, sf):
    coords, _ = D.principal_coordinates(D.pair_distances(S.vectors(spark, sf)), 3)
    return _round(coords, "value", digits=4)
