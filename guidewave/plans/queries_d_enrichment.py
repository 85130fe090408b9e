"""Queries: perturbation by cluster enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import enrichment as E
from . import screen_tables as S
from .queries_b_quality import _round
from .queries_c_statistics import R6
from .registry import SUBQUERIES, register

CLASSES = ["non_targeting"]
MIN_T, MIN_K, MIN_REF = 20, 10, 5


def cells(spark, sf):
    return S.vectors(spark, sf).drop("vec")


SUBQUERIES.update({
    "vec_targets": f"SELECT target, count(*) AS n FROM vectors WHERE target <> 'NT' GROUP BY 1 HAVING count(*) >= {MIN_T}",
    "vec_clusters": f"SELECT cluster FROM vectors GROUP BY 1 HAVING count(*) >= {MIN_K}",
    "pairs": """SELECT t.target, k.cluster, 'ntc' AS control, count(*) FILTER (v.target = t.target AND v.cluster = k.cluster) AS a, count(*) FILTER (v.target = t.target AND v.cluster <> k.cluster) AS b,
            count(*) FILTER (v.target = 'NT' AND v.cluster = k.cluster) AS c, count(*) FILTER (v.target = 'NT' AND v.cluster <> k.cluster) AS d FROM vec_targets t CROSS JOIN vec_clusters k CROSS JOIN vectors v GROUP BY 1, 2
        UNION ALL SELECT t.target, k.cluster, 'other', count(*) FILTER (v.target = t.target AND v.cluster = k.cluster), count(*) FILTER (v.target = t.target AND v.cluster <> k.cluster),
            count(*) FILTER (v.target NOT IN ('NT', t.target) AND v.cluster = k.cluster), count(*) FILTER (v.target NOT IN ('NT', t.target) AND v.cluster <> k.cluster) FROM vec_targets t CROSS JOIN vec_clusters k CROSS JOIN vectors v GROUP BY 1, 2""",
    "pair_hyper": """SELECT target, cluster, control, a, b, c, d, x, lgamma(a + c + 1) - lgamma(x + 1) - lgamma(a + c - x + 1) + lgamma(b + d + 1) - lgamma(a + b - x + 1) - lgamma(b + d - a - b + x + 1) AS lp,
            lgamma(a + c + 1) - lgamma(a + 1) - lgamma(c + 1) + lgamma(b + d + 1) - lgamma(b + 1) - lgamma(d + 1) AS lobs, lgamma(a + b + c + d + 1) - lgamma(a + b + 1) - lgamma(c + d + 1) AS lall
        FROM (SELECT *, unnest(range(CAST(greatest(0, a + c - (c + d)) AS BIGINT), CAST(least(a + b, a + c) + 1 AS BIGINT))) AS x FROM pairs)""",
    "fisher": "SELECT target, cluster, control, a, b, c, d, least(1.0, sum(CASE WHEN lp <= lobs + 1e-7 THEN exp(lp - lall) ELSE 0 END)) AS p FROM pair_hyper GROUP BY ALL",
    "fisher_rank": "SELECT *, row_number() OVER (PARTITION BY control ORDER BY round(p, 12)) AS rn, count(*) OVER (PARTITION BY control) AS m FROM fisher",
    "fisher_fdr": """SELECT target, cluster, control, a, b, c, d, p, least(1.0, min(raw) OVER (PARTITION BY control ORDER BY rn DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS q0 FROM (SELECT *, p * m / rn AS raw FROM fisher_rank)""",
    "enriched": """SELECT f.*, min(q0) OVER (PARTITION BY control, round(p, 12)) AS fdr, 100.0 * a / (a + b) AS pct_of_target, 100.0 * c / (c + d) AS pct_of_reference, ((a + .5) * (d + .5)) / ((b + .5) * (c + .5)) AS odds FROM fisher_fdr f""",
})


@register("agg_23_pair_counts", f"""SELECT target, cluster, control, a, b, c, d, round(100.0 * a / (a + b), 6) AS pct_of_target, round(100.0 * c / (c + d), 6) AS pct_of_reference,
    {R6('log2(((a + .5) * (d + .5)) / ((b + .5) * (c + .5)))')} AS log2_odds_ratio, CASE WHEN 100.0 * a / (a + b) > 100.0 * c / (c + d) THEN 'enriched' ELSE 'depleted' END AS direction, c < {MIN_REF} AS low_power FROM pairs""")
def agg_23(spark, sf):
    t = E.pair_columns(E.contingency(cells(spark, sf), CLASSES, MIN_T, MIN_K), 0.5, MIN_REF)
    return _round(t.select("target", "cluster", "control", "a", "b", "c", "d", "pct_of_target", "pct_of_reference", "log2_odds_ratio", "direction", "low_power"), "pct_of_target", "pct_of_reference", "log2_odds_ratio")


@register("stat_07_fisher_exact", "SELECT target, cluster, control, round(p, 6) AS pval_fisher FROM fisher")
def stat_07(spark, sf):
    t = E.fisher_exact(E.contingency(cells(spark, sf), CLASSES, MIN_T, MIN_K))
    return _round(t.select("target", "cluster", "control", "pval_fisher"), "pval_fisher")


@register("stat_07_fisher_labels", """SELECT lang, round(least(1.0, sum(CASE WHEN lp <= lobs + 1e-7 THEN exp(lp - lall) ELSE 0 END)), 6) AS pval_fisher FROM (SELECT *, lgamma(a + c + 1) - lgamma(x + 1) - lgamma(a + c - x + 1) + lgamma(b + d + 1) - lgamma(a + b - x + 1) - lgamma(d - a + x + 1) AS lp,
    lgamma(a + c + 1) - lgamma(a + 1) - lgamma(c + 1) + lgamma(b + d + 1) - lgamma(b + 1) - lgamma(d + 1) AS lobs, lgamma(a + b + c + d + 1) - lgamma(a + b + 1) - lgamma(c + d + 1) AS lall
    FROM (SELECT *, unnest(range(greatest(0, a - d), least(a + b, a + c) + 1)) AS x FROM (SELECT lang, count(*) FILTER (quality = 1 AND toxic = 1) AS a, count(*) FILTER (quality = 1 AND toxic = 0) AS b, count(*) FILTER (quality = 0 AND toxic = 1) AS c, count(*) FILTER (quality = 0 AND toxic = 0) AS d
    FROM labels l JOIN documents d ON l.doc_id = d.doc_id GROUP BY 1))) GROUP BY 1""")
def stat_07b(spark, sf):
    q, t = F.col("quality"), F.col("toxic")
    tables = S.read(spark, sf, "labels").join(S.read(spark, sf, "documents"), "doc_id").groupBy("lang").agg(
        *[F.count_if((q == i) & (t == j)).alias(k) for k, i, j in (("a", 1, 1), ("b", 1, 0), ("c", 0, 1), ("d", 0, 0))])
    return _round(E.fisher_exact(tables).select("lang", "pval_fisher"), "pval_fisher")


_STRATA = """SELECT source, lang, CAST(count(*) FILTER (quality = 1 AND toxic = 1) AS DOUBLE) AS a, CAST(count(*) FILTER (quality = 1 AND toxic = 0) AS DOUBLE) AS b, CAST(count(*) FILTER (quality = 0 AND toxic = 1) AS DOUBLE) AS c,
    CAST(count(*) FILTER (quality = 0 AND toxic = 0) AS DOUBLE) AS d, count(*) AS n FROM labels l JOIN documents x ON l.doc_id = x.doc_id GROUP BY 1, 2"""


@register("stat_08_stratified_odds", f"""SELECT lang, round(sum(a * d / n) / sum(b * c / n), 6) AS cmh_odds_ratio, round(sum(a - (a + b) * (a + c) / n) ** 2 / sum((a + b) * (c + d) * (a + c) * (b + d) / (n * n * (n - 1))), 6) AS cmh_statistic, count(*) AS cmh_n_strata
    FROM ({_STRATA}) WHERE a + b > 0 AND c + d > 0 AND a + c > 0 AND b + d > 0 GROUP BY 1""")
def stat_08(spark, sf):
    q, t = F.col("quality"), F.col("toxic")
    tables = S.read(spark, sf, "labels").join(S.read(spark, sf, "documents"), "doc_id").groupBy("source", "lang").agg(
        *[F.count_if((q == i) & (t == j)).alias(k) for k, i, j in (("a", 1, 1), ("b", 1, 0), ("c", 0, 1), ("d", 0, 0))])
    out = E.cochran_mantel_haenszel(tables, ["lang"]).select("lang", "cmh_odds_ratio", "cmh_statistic", "cmh_n_strata")
    return _round(out, "cmh_odds_ratio", "cmh_statistic")


_GROUPS = "SELECT 'reference:ntc' AS g, * FROM vectors WHERE target = 'NT' UNION ALL SELECT 'reference:other', * FROM vectors WHERE target <> 'NT' UNION ALL SELECT 'target:' || target, * FROM vectors WHERE target <> 'NT'"
SUBQUERIES["comp"] = f"""SELECT k.g AS "group", c.cluster, count(v.cell_id) AS n_cells, 100.0 * count(v.cell_id) / k.n AS pct FROM (SELECT g, count(*) AS n FROM ({_GROUPS}) GROUP BY 1) k CROSS JOIN (SELECT DISTINCT cluster FROM vectors) c
    LEFT JOIN ({_GROUPS}) v ON v.g = k.g AND v.cluster = c.cluster GROUP BY 1, 2, k.n"""


@register("agg_24_composition", 'SELECT "group", cluster, n_cells, round(pct, 6) AS pct FROM comp')
def agg_24(spark, sf):
    return _round(E.composition(cells(spark, sf), CLASSES), "pct")


@register("agg_25_effect_magnitude", """SELECT substr(o."group", 8) AS target, round(sum(abs(o.pct - r.pct)) / 2, 6) AS composition_shift_pct, max(s.n) AS n_significant_clusters, max(t.n) AS n_cells FROM comp o JOIN comp r ON o.cluster = r.cluster AND r."group" = 'reference:other'
    JOIN (SELECT target, count(*) FILTER (fdr < 0.9 AND control = 'other') AS n FROM enriched GROUP BY 1) s ON s.target = substr(o."group", 8) JOIN vec_targets t ON t.target = s.target WHERE o."group" LIKE 'target:%' GROUP BY 1""")
def agg_25(spark, sf):
    c = cells(spark, sf)
    table = E.cluster_enrichment(c, CLASSES, "other", MIN_T, MIN_K, MIN_REF, alpha=0.9)
    return _round(E.effect_magnitude(table, E.composition(c, CLASSES)), "composition_shift_pct")


@register("stat_29_cluster_enrichment", f"""SELECT e.target, e.cluster, e.control, a, b, c, d, {R6('odds')} AS odds_ratio, round(p, 6) AS pval, round(fdr, 6) AS fdr, fdr < 0.9 AND control = 'other' AS significant, g.tested AS guides_tested, g.agree AS guides_concordant
    FROM enriched e LEFT JOIN (SELECT target, cluster, count(*) AS tested, count(*) FILTER (CASE WHEN up THEN share > ref ELSE share < ref END) AS agree FROM (
        SELECT e.target, e.cluster, v.guide, e.pct_of_target > e.pct_of_reference AS up, e.pct_of_reference / 100 AS ref, count(*) FILTER (v.cluster = e.cluster) / count(*) AS share FROM enriched e JOIN vectors v ON v.target = e.target
        WHERE e.control = 'other' AND e.fdr < 0.9 GROUP BY ALL HAVING count(*) >= 5) GROUP BY 1, 2) g ON g.target = e.target AND g.cluster = e.cluster AND e.control = 'other'""")
def stat_29(spark, sf):
    t = E.cluster_enrichment(cells(spark, sf), CLASSES, "other", MIN_T, MIN_K, MIN_REF, alpha=0.9)
    return _round(t.select("target", "cluster", "control", "a", "b", "c", "d", "odds_ratio", "pval", "fdr", "significant", "guides_tested", "guides_concordant"), "odds_ratio", "pval", "fdr")


@register("agg_26_guide_concordance", """SELECT target, cluster, control, count(*) AS guides_tested, count(*) FILTER (CASE WHEN up THEN share > ref ELSE share < ref END) AS guides_concordant FROM (SELECT e.target, e.cluster, e.control, v.guide, e.pct_of_target > e.pct_of_reference AS up,
    e.pct_of_reference / 100 AS ref, count(*) FILTER (v.cluster = e.cluster) / count(*) AS share FROM enriched e JOIN vectors v ON v.target = e.target GROUP BY ALL HAVING count(*) >= 5) GROUP BY ALL""")
def agg_26(spark, sf):
    c = cells(spark, sf)
    return E.guide_concordance(c, E.pair_columns(E.contingency(c, CLASSES, MIN_T, MIN_K)), 5)


@register("stat_29_stratified_enrichment")
def stat_29b(spark, sf):
    t = E.cluster_enrichment(cells(spark, sf), CLASSES, "other", MIN_T, MIN_K, MIN_REF, stratify_by="sample")
    return _round(t.select("target", "cluster", "control", "cmh_odds_ratio", "cmh_n_strata", "pval", "fdr"), "cmh_odds_ratio", "pval", "fdr")


_CHI = """SELECT round(sum((o - e) ** 2 / e), 6) AS chi2, round(100.0 * count(*) FILTER (e < 5) / count(*), 6) AS pct_expected_below_5, count(DISTINCT target) AS n_rows, count(DISTINCT cluster) AS n_cols, (count(DISTINCT target) - 1) * (count(DISTINCT cluster) - 1) AS dof
    FROM (SELECT t.target, k.cluster, count(v.cell_id) AS o, CAST(max(t.n) AS DOUBLE) * max(k.n) / (SELECT count(*) FROM vectors WHERE target <> 'NT') AS e FROM (SELECT target, count(*) AS n FROM vectors WHERE target <> 'NT' GROUP BY 1) t
    CROSS JOIN (SELECT cluster, count(*) AS n FROM vectors WHERE target <> 'NT' GROUP BY 1) k LEFT JOIN vectors v ON v.target = t.target AND v.cluster = k.cluster GROUP BY 1, 2)"""


@register("stat_09_omnibus_chi2", _CHI)
def stat_09(spark, sf):
    return _round(E.omnibus_chi2(cells(spark, sf)).drop("p_chi2"), "chi2", "pct_expected_below_5")


_PERM = """WITH t AS (SELECT target, count(*) AS r FROM vectors WHERE target <> 'NT' GROUP BY 1), k AS (SELECT cluster, count(*) AS c, sum(count(*)) OVER (ORDER BY cluster) / sum(count(*)) OVER () AS hi FROM vectors WHERE target <> 'NT' GROUP BY 1),
    obs AS (SELECT sum(o * o / (r * c)) AS q FROM (SELECT target, cluster, CAST(count(*) AS DOUBLE) AS o FROM vectors WHERE target <> 'NT' GROUP BY 1, 2) x JOIN t USING (target) JOIN k USING (cluster)),
    draws AS (SELECT perm, target, (SELECT min(cluster) FROM k WHERE hi > u) AS cluster FROM (SELECT i AS perm, target, CAST(('0x' || substr(sha256('0|' || i || '|' || cell_id), 1, 12)) AS BIGINT) / 281474976710656.0 AS u FROM vectors, range(1, 1001) AS g(i) WHERE target <> 'NT')),
    sim AS (SELECT perm, target, cluster, CAST(count(*) AS DOUBLE) AS o FROM draws GROUP BY ALL), q AS (SELECT perm, sum(o * o / (r * c)) AS q FROM sim JOIN t USING (target) JOIN (SELECT perm, cluster, sum(o) AS c FROM sim GROUP BY 1, 2) USING (perm, cluster) GROUP BY 1)
    SELECT count(*) FILTER (q.q >= obs.q) AS n_ge, count(*) AS n_permutations, (count(*) FILTER (q.q >= obs.q) + 1) / (count(*) + 1) AS p_permutation FROM q, obs"""


@register("stat_09_omnibus_permutation", "SELECT * FROM (" + _PERM + ")")
def stat_09b(spark, sf):
    return E.omnibus_permutation(cells(spark, sf), 1000)


@register("agg_22_cluster_counts", "SELECT cluster, sample, count(*) AS n_cells FROM vectors GROUP BY 1, 2")
def agg_22(spark, sf):
    return cells(spark, sf).groupBy("cluster", "sample").agg(F.count(F.lit(1)).alias("n_cells"))


@register("agg_38_enrichment_matrix", "SELECT target, " + ", ".join(f"max(CASE WHEN cluster = '{k}' THEN {R6('log2(odds)')} END) AS k{k}" for k in range(10)) + " FROM enriched WHERE control = 'other' GROUP BY 1")
def agg_38(spark, sf):
    from ..operators.grids import sparse_to_wide

    t = E.pair_columns(E.contingency(cells(spark, sf), CLASSES, MIN_T, MIN_K)).where("control = 'other'")
    return sparse_to_wide(_round(t, "log2_odds_ratio").withColumn("k", F.concat(F.lit("k"), "cluster")), "target", "k", "log2_odds_ratio", [f"k{i}" for i in range(10)])


@register("top_07_strongest_pairs", "SELECT target, cluster FROM enriched WHERE control = 'other' AND fdr < 1.01 ORDER BY round(abs(log2(odds)), 9) DESC, target, cluster LIMIT 5")
def top_07(spark, sf):
    t = E.cluster_enrichment(cells(spark, sf), CLASSES, "other", MIN_T, MIN_K, MIN_REF, alpha=1.01)
    return E.strongest_pairs(t, 5).select("target", "cluster")


@register("top_02_best_cluster_per_target", "SELECT target, arg_min(cluster, round(p, 9)) AS cluster, round(min(p), 6) AS pval FROM (SELECT * FROM fisher WHERE control = 'other' ORDER BY cluster) GROUP BY 1")
def top_02(spark, sf):
    t = E.fisher_exact(E.contingency(cells(spark, sf), CLASSES, MIN_T, MIN_K)).where("control = 'other'")
    best = t.groupBy("target").agg(F.min(F.struct(F.round("pval_fisher", 9).alias("p"), "cluster", F.col("pval_fisher").alias("v"))).alias("_b"))
    return best.select("target", F.col("_b.cluster").alias("cluster"), F.round("_b.v", 6).alias("pval"))
