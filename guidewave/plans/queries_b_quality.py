"""Queries: quality metrics, filters, coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import coverage as C
from ..operators import filtering as X
from ..operators import quality as Q
from . import screen_tables as S
from .registry import SUBQUERIES, register

_FLAGS = "starts_with(upper(feature), 'BRAND#1') AS mt, starts_with(upper(feature), 'BRAND#3') OR starts_with(upper(feature), 'BRAND#4') AS ribo, regexp_matches(upper(feature), '^BRAND#2$') AS hb"
CONDITIONS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

SUBQUERIES.update({
    "genes": f"SELECT feature, {_FLAGS} FROM (SELECT DISTINCT p_brand AS feature FROM part)",
    "rna_qc": """SELECT m.cell_id, m.condition, m.sample, coalesce(total, 0) AS total_counts, coalesce(n, 0) AS n_genes_by_counts, coalesce(100.0 * mt / total, 0) AS pct_counts_mt,
        coalesce(100.0 * ribo / total, 0) AS pct_counts_ribo, coalesce(100.0 * hb / total, 0) AS pct_counts_hb
        FROM meta m LEFT JOIN (SELECT cell_id, CAST(sum(count) AS DOUBLE) AS total, count(*) FILTER (count <> 0) AS n, coalesce(sum(count) FILTER (g.mt), 0) AS mt, coalesce(sum(count) FILTER (g.ribo), 0) AS ribo,
            coalesce(sum(count) FILTER (g.hb), 0) AS hb FROM expr e JOIN genes g ON e.feature = g.feature GROUP BY cell_id) q ON m.cell_id = q.cell_id""",
    "protein_qc": """SELECT m.cell_id, m.condition, total AS protein_total_counts, tgt AS protein_total_counts_targeting, iso AS protein_isotype_counts, det AS protein_n_detected, total IS NOT NULL AS has_protein_counts,
        100.0 * iso / total AS protein_pct_isotype FROM meta m LEFT JOIN (SELECT cell_id, CAST(sum(count) AS BIGINT) AS total, CAST(coalesce(sum(count) FILTER (protein NOT LIKE 'N%'), 0) AS BIGINT) AS tgt,
            CAST(coalesce(sum(count) FILTER (protein LIKE 'N%'), 0) AS BIGINT) AS iso, count(*) FILTER (protein NOT LIKE 'N%' AND count > 0) AS det FROM protein_counts GROUP BY cell_id) p ON m.cell_id = p.cell_id""",
})


def genes(spark, sf):
    names = S.read(spark, sf, "part").select(F.col("p_brand").alias("feature")).distinct()
    return Q.gene_flags(names, S.MITO_PREFIX, S.RIBO_PREFIXES, S.HB_PATTERN)


def rna_qc(spark, sf, base=None):
    base = S.cell_metadata(spark, sf).select("cell_id", "condition", "sample") if base is None else base
    return Q.cell_rna_qc(base, S.expr(spark, sf), genes(spark, sf))


def protein_qc(spark, sf, base=None):
    base = S.cell_metadata(spark, sf).select("cell_id", "condition") if base is None else base
    return Q.cell_protein_qc(base, S.protein_counts(spark, sf), S.protein_panel(spark, sf))


def _round(df, *columns, digits=6):
    for c in columns:
        df = df.withColumn(c, F.round(c, digits))
    return df


@register("rel_07_gene_class_flags", "SELECT * FROM genes")
def gene_flags(spark, sf):
    return genes(spark, sf)


@register("agg_01_cell_rna_qc", """SELECT cell_id, CAST(total_counts AS BIGINT) AS total_counts, n_genes_by_counts, round(pct_counts_mt, 6) AS pct_counts_mt, round(pct_counts_ribo, 6) AS pct_counts_ribo, round(pct_counts_hb, 6) AS pct_counts_hb FROM rna_qc""")
def agg_01(spark, sf):
    return _round(rna_qc(spark, sf).drop("condition", "sample"), "pct_counts_mt", "pct_counts_ribo", "pct_counts_hb")


@register("agg_02_gene_qc", "SELECT feature, count(*) FILTER (count <> 0) AS n_cells_by_counts, CAST(sum(count) AS BIGINT) AS total_counts, round(sum(count) / (SELECT count(*) FROM meta), 6) AS mean_counts FROM expr GROUP BY 1")
def agg_02(spark, sf):
    n = S.cell_metadata(spark, sf).agg(F.count(F.lit(1)).alias("n_cells"))
    return _round(Q.gene_qc(S.expr(spark, sf), n), "mean_counts")


@register("agg_03_cell_protein_qc", "SELECT cell_id, protein_total_counts, protein_total_counts_targeting, protein_isotype_counts, protein_n_detected, has_protein_counts, round(protein_pct_isotype, 6) AS protein_pct_isotype FROM protein_qc")
def agg_03(spark, sf):
    return _round(protein_qc(spark, sf).drop("condition"), "protein_pct_isotype")


_PANEL = "(SELECT DISTINCT l_returnflag || l_linestatus AS protein FROM lineitem)"
_DENSE_P = f"SELECT m.cell_id, p.protein, coalesce(c.count, 0) AS count FROM (SELECT cell_id FROM protein_qc WHERE has_protein_counts) m CROSS JOIN {_PANEL} p LEFT JOIN protein_counts c ON c.cell_id = m.cell_id AND c.protein = p.protein"
SUBQUERIES["dense_protein"] = _DENSE_P


def _with_counts(spark, sf):
    return S.protein_counts(spark, sf).agg(F.countDistinct("cell_id").alias("n_cells"))


@register("agg_04_antibody_table", """SELECT protein, protein LIKE 'N%' AS is_isotype, count(*) AS n_cells_with_counts, round(avg(count), 6) AS counts_mean, quantile_cont(CAST(count AS DOUBLE), 0.5) AS counts_median,
    round(quantile_cont(CAST(count AS DOUBLE), 0.9), 6) AS counts_q90, CAST(max(count) AS DOUBLE) AS counts_max, round(count(*) FILTER (count = 0) / count(*), 6) AS counts_zero_frac FROM dense_protein GROUP BY 1""")
def agg_04(spark, sf):
    out = Q.antibody_table(S.protein_counts(spark, sf), S.protein_panel(spark, sf), _with_counts(spark, sf))
    return _round(out, "counts_mean", "counts_q90", "counts_zero_frac")


@register("agg_05_above_isotype", """SELECT a.protein, round(count(*) FILTER (a.count > i.count) / count(*), 6) AS frac_cells_above_isotype, count(*) FILTER (a.count > i.count) / count(*) < 0.5 AS background_dominated
    FROM dense_protein a JOIN dense_protein i ON a.cell_id = i.cell_id AND i.protein = CASE WHEN a.protein LIKE '%O' THEN 'NO' ELSE 'NF' END WHERE a.protein NOT LIKE 'N%' GROUP BY 1""")
def agg_05(spark, sf):
    out = Q.above_isotype(S.protein_counts(spark, sf), S.protein_panel(spark, sf), _with_counts(spark, sf), S.ISOTYPE_MAP)
    return _round(out, "frac_cells_above_isotype")


@register("agg_06_qc_summary", """SELECT coalesce(condition, 'ALL') AS "group", count(*) AS n_cells, round(quantile_cont(CAST(n_genes_by_counts AS DOUBLE), 0.5), 2) AS median_genes, round(quantile_cont(CAST(total_counts AS DOUBLE), 0.5), 2) AS median_counts,
    round(quantile_cont(pct_counts_mt, 0.5), 2) AS median_pct_mt FROM rna_qc GROUP BY ROLLUP(condition)""")
def agg_06(spark, sf):
    return Q.qc_summary(rna_qc(spark, sf), "condition", {"n_genes_by_counts": "median_genes", "total_counts": "median_counts", "pct_counts_mt": "median_pct_mt"})


_MAD = "(SELECT med, 1.4826 * quantile_cont(abs(v - med), 0.5) AS mad FROM (SELECT ln(1 + total_counts) AS v FROM rna_qc), (SELECT quantile_cont(ln(1 + total_counts), 0.5) AS med FROM rna_qc) GROUP BY med)"


@register("rel_08_mad_outliers", f"SELECT cell_id, ln(1 + total_counts) < med - 2 * mad AS outlier_low, ln(1 + total_counts) > med + 2 * mad AS outlier_high FROM rna_qc, {_MAD}")
def rel_08(spark, sf):
    return Q.mad_outliers(rna_qc(spark, sf), "total_counts", 2.0, "outlier_low", "outlier_high").select("cell_id", "outlier_low", "outlier_high")


@register("rel_09_threshold_flags", """SELECT cell_id, n_genes_by_counts < 21 AS rna_low_genes, pct_counts_mt >= 50 AS rna_high_mt, total_counts < 800 AS rna_low_counts,
    n_genes_by_counts < 21 OR pct_counts_mt >= 50 OR total_counts < 800 AS rna_qc_fail FROM rna_qc""")
def rel_09(spark, sf):
    return Q.rna_flags(rna_qc(spark, sf), 21, 50, 800).select("cell_id", "rna_low_genes", "rna_high_mt", "rna_low_counts", "rna_qc_fail")


@register("rel_10_extreme_counts", "SELECT cell_id, coalesce(protein_total_counts > 1.05 * (SELECT quantile_cont(CAST(protein_total_counts AS DOUBLE), 0.99) FROM protein_qc), false) AS protein_extreme_counts FROM protein_qc")
def rel_10(spark, sf):
    return Q.extreme_counts(protein_qc(spark, sf), fold=1.05).select("cell_id", "protein_extreme_counts")


@register("rel_11_protein_flags", """SELECT cell_id, coalesce(protein_pct_isotype > 36, false) AS protein_high_isotype,
    coalesce(protein_total_counts < 800, false) OR coalesce(protein_n_detected < 4, false) OR coalesce(protein_pct_isotype > 36, false) AS protein_qc_fail FROM protein_qc""")
def rel_11(spark, sf):
    return Q.protein_flags(protein_qc(spark, sf), 800, 4, 36).select("cell_id", "protein_high_isotype", "protein_qc_fail")


@register("rel_01_prefilter_cells", "SELECT cell_id, count(*) AS n_genes FROM expr WHERE count <> 0 GROUP BY 1 HAVING count(*) >= 22")
def rel_01(spark, sf):
    return X.prefilter_cells(S.expr(spark, sf), 22)


@register("rel_02_prefilter_genes", """SELECT feature, count(*) AS n_cells FROM expr WHERE cell_id IN (SELECT cell_id FROM expr WHERE count <> 0 GROUP BY 1 HAVING count(*) >= 22) GROUP BY 1 HAVING count(*) >= 3""")
def rel_02(spark, sf):
    e = S.expr(spark, sf)
    kept = e.join(X.prefilter_cells(e, 22).select("cell_id"), "cell_id", "left_semi")
    return X.prefilter_genes(kept, 3)


def _steps():
    return X.strict_steps(min_genes=21, min_counts=800, max_pct_mt=50, max_pct_hb=8, protein_min_total=850, max_pct_isotype=38, cells="assigned")


def _labelled(spark, sf):
    base = S.cells(spark, sf).select("cell_id", "n_guides")
    both = protein_qc(spark, sf, rna_qc(spark, sf, base))
    return X.label_removed(both, _steps())


SUBQUERIES["removed"] = """SELECT r.cell_id, CASE WHEN n_genes_by_counts < 21 THEN 'rna_min_genes' WHEN total_counts < 800 THEN 'rna_min_counts' WHEN pct_counts_mt >= 50 THEN 'rna_max_pct_mt' WHEN pct_counts_hb >= 8 THEN 'rna_max_pct_hb'
    WHEN coalesce(protein_total_counts < 850, false) THEN 'protein_min_total_counts' WHEN coalesce(protein_pct_isotype > 38, false) THEN 'protein_max_pct_isotype' WHEN c.n_guides < 1 THEN 'perturbation_assigned_only' END AS removed_by
    FROM rna_qc r JOIN protein_qc p ON r.cell_id = p.cell_id JOIN cells c ON c.cell_id = r.cell_id"""


@register("rel_03_strict_filter", "SELECT cell_id, removed_by FROM removed")
def rel_03(spark, sf):
    return _labelled(spark, sf).select("cell_id", "removed_by")


@register("rel_04_cell_mode", "SELECT cell_id FROM cells WHERE n_guides = 1")
def rel_04(spark, sf):
    return X.kept_cells(X.label_removed(S.cells(spark, sf), X.perturbation_mode("single_guide"))).select("cell_id")


@register("rel_05_gene_filter_after_cells", """SELECT (SELECT count(DISTINCT feature) FROM expr) AS genes_before, count(*) AS genes_after, (SELECT count(DISTINCT feature) FROM expr) - count(*) AS genes_removed
    FROM (SELECT feature FROM expr WHERE cell_id IN (SELECT cell_id FROM removed WHERE removed_by IS NULL) GROUP BY 1 HAVING count(*) >= 3)""")
def rel_05(spark, sf):
    return X.gene_step(S.expr(spark, sf), X.kept_cells(_labelled(spark, sf)), 3)


def _audit_sql():
    parts, failed = ["SELECT 0 AS step_order, 'input' AS step, 'input' AS category, '-' AS threshold, (SELECT count(*) FROM removed) AS cells_before, (SELECT count(*) FROM removed) AS cells_after"], []
    for i, s in enumerate(_steps_text()):
        before = f"(SELECT count(*) FROM removed WHERE coalesce(removed_by, '') NOT IN ({', '.join(repr(x) for x in failed) or repr('-')}))"
        failed.append(s[0])
        after = f"(SELECT count(*) FROM removed WHERE coalesce(removed_by, '') NOT IN ({', '.join(repr(x) for x in failed)}))"
        parts.append(f"SELECT {i + 1}, '{s[0]}', '{s[1]}', '{s[2]}', {before}, {after}")
    parts.append(f"SELECT {len(failed) + 1}, 'final', 'final', '-', (SELECT count(*) FROM removed WHERE removed_by IS NULL), (SELECT count(*) FROM removed WHERE removed_by IS NULL)")
    return "SELECT CAST(step_order AS BIGINT) AS step_order, step, category, threshold, cells_before, cells_after, cells_before - cells_after AS cells_removed FROM (" + " UNION ALL ".join(parts) + ")"


def _steps_text():
    return [("rna_min_genes", "rna", "genes detected >= 21"), ("rna_min_counts", "rna", "total counts >= 800"), ("rna_max_pct_mt", "rna", "% mitochondrial < 50"), ("rna_max_pct_hb", "rna", "% haemoglobin < 8"),
            ("protein_min_total_counts", "protein", "total ADT >= 850"), ("protein_max_pct_isotype", "protein", "% isotype <= 38"), ("perturbation_assigned_only", "perturbation", "n_guides >= 1")]


@register("rel_06_filter_audit", _audit_sql())
def rel_06(spark, sf):
    return X.audit_cells(_labelled(spark, sf), _steps()).withColumn("step_order", F.col("step_order").cast("bigint"))


@register("win_07_audit_chaining", "SELECT coalesce(removed_by, 'kept') AS step, count(*) AS cells_after, sum(count(*)) OVER () AS cells_total FROM removed GROUP BY 1".replace("sum(count(*)) OVER ()", "CAST(sum(count(*)) OVER () AS BIGINT)"))
def win_07(spark, sf):
    from pyspark.sql import Window as W

    steps = _labelled(spark, sf).groupBy(F.coalesce("removed_by", F.lit("kept")).alias("step")).agg(F.count(F.lit(1)).alias("cells_after"))
    return steps.withColumn("cells_total", F.sum("cells_after").over(W.partitionBy()))  # one row per step name


def _cond(prefix="c."):
    return ", ".join(f"count(*) FILTER ({prefix}condition = '{v}') AS \"condition={v}\"" for v in CONDITIONS)


_LEAST = "least(" + ", ".join(f"coalesce(\"condition={v}\", 0)" for v in CONDITIONS) + ")"
_COLS = ", ".join(f"coalesce(\"condition={v}\", 0) AS \"condition={v}\"" for v in CONDITIONS)


def _coverage_sql(key: str, parts: str, extra: str, extra_out: str):
    return f"""SELECT a.{key}, n_cells_any, coalesce(n, 0) AS n_cells_single_guide, {extra_out}, {_COLS}, CASE WHEN coalesce(cc, '') = '' THEN 'targeting' ELSE cc END AS class, {_LEAST} AS min_cells_per_condition, coalesce(n, 0) < 10 AS low_coverage
    FROM (SELECT {key}, count(*) AS n_cells_any FROM (SELECT unnest(string_split({parts}, ';')) AS {key} FROM multi_cells WHERE n_guides > 0) GROUP BY 1) a
    LEFT JOIN (SELECT {key}, min(control_class) AS cc, count(*) AS n, {extra}, {_cond('')} FROM multi_cells WHERE n_guides = 1 GROUP BY 1) s ON a.{key} = s.{key}"""


@register("agg_07_guide_coverage", _coverage_sql("guide", "guides", "min(target) AS target", "target"))
def agg_07(spark, sf):
    return C.entity_coverage(S.multi_cells(spark, sf), "guide", "guides", "condition", CONDITIONS, 10)


@register("agg_08_target_coverage", _coverage_sql("target", "targets", "count(DISTINCT guide) AS n_guides", "coalesce(n_guides, 0) AS n_guides"))
def agg_08(spark, sf):
    return C.entity_coverage(S.multi_cells(spark, sf), "target", "targets", "condition", CONDITIONS, 10)


@register("agg_09_label_counts", f"SELECT perturbation, min(perturbation_class) AS perturbation_class, count(*) AS n_cells, {_cond('')} FROM cells GROUP BY 1")
def agg_09(spark, sf):
    return C.label_counts(S.cells(spark, sf), "condition", CONDITIONS)


@register("agg_10_condition_coverage", """SELECT k.target, k.class, v.condition, count(c.cell_id) AS n_cells, count(c.cell_id) < 10 AS low_coverage
    FROM (SELECT target, CASE WHEN min(control_class) = '' THEN 'targeting' ELSE min(control_class) END AS class FROM multi_cells WHERE n_guides = 1 GROUP BY 1) k CROSS JOIN (SELECT DISTINCT c_mktsegment AS condition FROM customer) v
    LEFT JOIN (SELECT * FROM multi_cells WHERE n_guides = 1) c ON c.target = k.target AND c.condition = v.condition GROUP BY 1, 2, 3""")
def agg_10(spark, sf):
    return C.condition_coverage(S.multi_cells(spark, sf), "target", "condition", CONDITIONS, 10)


@register("agg_11_moi_with_margins", "SELECT coalesce(CAST(n_guides AS VARCHAR), 'All') AS n_guides, coalesce(condition, 'All') AS condition, count(*) AS n_cells FROM multi_cells GROUP BY CUBE(n_guides, condition)")
def agg_11(spark, sf):
    return C.moi_table(S.multi_cells(spark, sf), "condition")


_CLASSES = ["single_targeting", "single_control", "multi_targeting", "multi_control", "mixed_control_targeting", "ambiguous", "unassigned"]
_CLASS_SQL = ", ".join(f"count(*) FILTER (perturbation_class = '{c}') AS n_{c}" for c in _CLASSES)


@register("agg_12_screen_summary", f"""SELECT count(*) AS n_cells, {_CLASS_SQL}, round(count(*) FILTER (n_guides = 0) / count(*), 4) AS frac_unassigned, round(count(*) FILTER (n_guides = 1) / count(*), 4) AS frac_single_guide,
    round(count(*) FILTER (n_guides > 1) / count(*), 4) AS frac_multi_guide FROM multi_cells""")
def agg_12(spark, sf):
    return C.screen_summary(S.multi_cells(spark, sf))


@register("agg_12_coverage_bins", f"""SELECT quantile_cont(CAST(n_cells_single_guide AS DOUBLE), 0.5) AS median, count(*) AS n, min(n_cells_single_guide) AS min, max(n_cells_single_guide) AS max, count(*) FILTER (low_coverage) AS n_low_coverage,
    count(*) FILTER (n_cells_single_guide < 10) AS n_lt_10, count(*) FILTER (n_cells_single_guide < 20) AS n_lt_20, count(*) FILTER (n_cells_single_guide < 30) AS n_lt_30, count(*) FILTER (n_cells_single_guide < 50) AS n_lt_50
    FROM ({_coverage_sql("guide", "guides", "min(target) AS target", "target")}) WHERE class = 'targeting'""")
def agg_12b(spark, sf):
    return C.coverage_bins(C.entity_coverage(S.multi_cells(spark, sf), "guide", "guides", "condition", CONDITIONS, 10).where("class = 'targeting'"))


@register("agg_13_group_summary", f"""SELECT c.sample, count(*) AS n_cells, {_CLASS_SQL}, quantile_cont(CAST(total_counts AS DOUBLE), 0.5) AS median_total_counts, quantile_cont(CAST(n_genes_by_counts AS DOUBLE), 0.5) AS median_n_genes
    FROM cells c JOIN rna_qc r ON c.cell_id = r.cell_id GROUP BY 1""")
def agg_13(spark, sf):
    base = S.cells(spark, sf).select("cell_id", "sample", "perturbation_class")
    return C.group_summary(rna_qc(spark, sf, base), "sample", {"total_counts": "median_total_counts", "n_genes_by_counts": "median_n_genes"})


@register("agg_14_crosstab", f"SELECT sample, {_cond('')} FROM meta GROUP BY 1")
def agg_14(spark, sf):
    return C.crosstab(S.cell_metadata(spark, sf), "sample", "condition", CONDITIONS)


@register("agg_50_composition_per_stratum", "SELECT sample, target, count(*) AS n_eligible, count(*) FILTER (condition = 'BUILDING') AS n_selected FROM cells WHERE perturbation_class = 'single_targeting' GROUP BY 1, 2")
def agg_50(spark, sf):
    eligible = S.cells(spark, sf).where("perturbation_class = 'single_targeting'").select("cell_id", "sample", "target", "condition")
    return C.composition(eligible, ["sample", "target"], eligible.where("condition = 'BUILDING'"))
