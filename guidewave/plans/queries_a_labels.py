"""Queries: guide calls, perturbation labels, alignment and set questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import align as A
from ..operators import guides as G
from ..operators import labels as L
from . import screen_tables as S
from .registry import register

_CALL_COLUMNS = """cell_id, has_guide_counts, CAST(guide_total_counts AS BIGINT) AS guide_total_counts, CAST(n_guides_detected AS BIGINT) AS n_guides_detected,
    array_to_string(guides_detected, ';') AS guides_detected, guide_top, CAST(guide_top_count AS BIGINT) AS guide_top_count, CAST(guide_second_count AS BIGINT) AS guide_second_count,
    CASE WHEN is_dominant THEN guide_top WHEN is_ambiguous THEN 'ambiguous' ELSE 'unassigned' END AS guide_dominant_call"""


@register("rel_27_dominant_guide_call", f"SELECT {_CALL_COLUMNS} FROM calls")
def dominant_call(spark, sf):
    return S.calls(spark, sf).select(
        "cell_id", "has_guide_counts", "guide_total_counts", F.col("n_guides_detected").cast("bigint").alias("n_guides_detected"),
        F.array_join("guides_detected", ";").alias("guides_detected"), "guide_top", "guide_top_count", "guide_second_count", "guide_dominant_call")


@register("rel_28_threshold_guide_call", "SELECT cell_id, array_to_string(guides_detected, ';') AS guides, CAST(len(guides_detected) AS BIGINT) AS n_guides FROM calls")
def threshold_call(spark, sf):
    lists = G.assigned_lists(S.calls(spark, sf), "threshold")
    return lists.select("cell_id", F.array_join("guides", ";").alias("guides"), F.size("guides").cast("bigint").alias("n_guides"))


@register("rel_22_parse_target", "SELECT guide, target FROM guide_library")
def parse_target(spark, sf):
    return S.guide_library(spark, sf).select("guide", "target")


@register("rel_23_classify_target", "SELECT guide, target, CASE WHEN control_class = '' THEN 'targeting' ELSE control_class END AS class FROM guide_library")
def classify_target(spark, sf):
    lib = S.guide_library(spark, sf)
    return lib.select("guide", "target", F.coalesce(F.nullif("control_class", F.lit("")), F.lit("targeting")).alias("class"))


@register("rel_24_harmonized_labels", """SELECT cell_id, guides, CAST(n_guides AS BIGINT) AS n_guides, targets, CAST(n_targets AS BIGINT) AS n_targets, guide, target, control_class,
    CASE WHEN n_guides = 1 THEN target WHEN n_guides = 0 THEN 'unassigned' ELSE 'multi' END AS perturbation, perturbation_class,
    perturbation_class = 'single_control' AS is_control, perturbation_class = 'single_targeting' AS is_targeting, n_guides = 1 AS is_single_guide FROM multi_cells""")
def harmonized(spark, sf):
    df = S.multi_cells(spark, sf)
    return df.select("cell_id", "guides", F.col("n_guides").cast("bigint").alias("n_guides"), "targets", F.col("n_targets").cast("bigint").alias("n_targets"), "guide", "target",
                     "control_class", "perturbation", "perturbation_class", "is_control", "is_targeting", "is_single_guide")


@register("rel_29_ambiguous_override", "SELECT cell_id, guide, target, perturbation, perturbation_class FROM cells")
def ambiguous_override(spark, sf):
    return S.cells(spark, sf).select("cell_id", "guide", "target", "perturbation", "perturbation_class")


@register("rel_25_cell_table", "SELECT cell_id, perturbation_class, condition, sample, TRY_CAST(balance AS DOUBLE) AS balance, TRY_CAST(condition AS DOUBLE) AS condition_number FROM cells")
def cell_table(spark, sf):
    meta = S.cell_metadata(spark, sf)
    base = S.cells(spark, sf).select("cell_id", "perturbation_class")
    return L.build_cell_table(base, meta, {"condition": "condition", "sample": "sample"}, {"balance": "balance", "condition_number": "condition"})


@register("rel_26_preserve_filters", "SELECT cell_id, CAST(n_guides AS BIGINT) AS n_guides FROM multi_cells WHERE n_guides = 1")
def preserve(spark, sf):
    kept = L.keep_cells(S.multi_cells(spark, sf), drop_multi=True, drop_unassigned=True)
    return kept.select("cell_id", F.col("n_guides").cast("bigint").alias("n_guides"))


_TAGS = """SELECT 'U' || user_id AS cell_id, event_type AS guide, count(*) AS umi FROM events GROUP BY 1, 2"""


@register("rel_33_hashing_singlets", f"""SELECT cell_id, coalesce(max(umi) FILTER (rn = 1), 0) AS guide_top_count, coalesce(max(umi) FILTER (rn = 2), 0) AS guide_second_count,
    CASE WHEN max(umi) FILTER (rn = 1) >= 2 AND max(umi) FILTER (rn = 1) > 1.5 * coalesce(max(umi) FILTER (rn = 2), 0) THEN max(guide) FILTER (rn = 1) ELSE '' END AS tag
    FROM (SELECT cell_id, guide, umi, row_number() OVER (PARTITION BY cell_id ORDER BY umi DESC, guide) AS rn FROM ({_TAGS})) GROUP BY cell_id""")
def singlets(spark, sf):
    events = S.read(spark, sf, "events").select(F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("cell_id"), F.col("event_type").alias("guide"))
    counts = events.groupBy("cell_id", "guide").agg(F.count(F.lit(1)).alias("umi"))
    # five tag names: position by name
    tags = events.select("guide").distinct().withColumn("pos", F.col("guide"))
    return G.singlet_call(events.select("cell_id").distinct(), counts, tags, min_umi=2, dominance_ratio=1.5)


@register("agg_15_guide_table", f"""SELECT l.guide, l.target, l.control_class, coalesce(t.total_umis, 0) AS total_umis, coalesce(t.det, 0) AS n_cells_detected, coalesce(d.n, 0) AS n_cells_dominant
    FROM guide_library l LEFT JOIN (SELECT guide, CAST(sum(umi) AS BIGINT) AS total_umis, count(*) FILTER (umi >= {S.DETECTION}) AS det FROM guide_counts GROUP BY 1) t ON l.guide = t.guide
    LEFT JOIN (SELECT guide_top AS guide, count(*) AS n FROM calls WHERE is_dominant GROUP BY 1) d ON l.guide = d.guide""")
def guide_table(spark, sf):
    out = G.guide_table(S.guide_library(spark, sf), S.guide_counts(spark, sf), S.calls(spark, sf), S.DETECTION)
    return out.select("guide", "target", "control_class", "total_umis", "n_cells_detected", "n_cells_dominant")


@register("agg_16_calling_summary", """SELECT count(*) FILTER (has_guide_counts) AS cells_with_guide_counts, count(*) FILTER (NOT has_guide_counts) AS cells_without_guide_counts,
    count(*) FILTER (is_dominant) AS assigned, count(*) FILTER (is_ambiguous) AS ambiguous, count(*) FILTER (NOT is_dominant AND NOT is_ambiguous) AS unassigned,
    count(*) FILTER (n_guides_detected = 0) AS cells_with_0_guides, count(*) FILTER (n_guides_detected = 1) AS cells_with_1_guide, count(*) FILTER (n_guides_detected > 1) AS cells_with_2plus_guides,
    quantile_cont(CAST(guide_total_counts AS DOUBLE), 0.5) FILTER (has_guide_counts) AS median_guide_umis_per_cell FROM calls""")
def calling_summary(spark, sf):
    return G.calling_summary(S.calls(spark, sf))


@register("win_02_top_two_per_cell", """SELECT cell_id, max(guide) FILTER (rn = 1) AS top_guide, max(umi) FILTER (rn = 1) AS top, coalesce(max(umi) FILTER (rn = 2), 0) AS second FROM guide_ranked GROUP BY cell_id""")
def top_two(spark, sf):
    c = S.calls(spark, sf).where("has_guide_counts")
    return c.select("cell_id", F.col("guide_top").alias("top_guide"), F.col("guide_top_count").alias("top"), F.col("guide_second_count").alias("second"))


# a second, independent assignment: the guide bought by line count
_GIVEN = f"""SELECT cell_id, list(guide ORDER BY guide) AS guides FROM (SELECT 'C' || o_custkey AS cell_id, {S._GUIDE} AS guide, count(*) AS n {S._lines_sql(S._PART)} GROUP BY 1, 2) WHERE n >= 3 GROUP BY 1"""


def _given(spark, sf):
    lines = S._lines(spark, sf).join(S.read(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    guide = F.concat("p_brand", F.lit("_"), (F.col("p_size") % 2 + 1).cast("string"))
    counts = lines.groupBy(S._cell("o_custkey").alias("cell_id"), guide.alias("guide")).agg(F.count(F.lit(1)).alias("n")).where("n >= 3")
    return counts.groupBy("cell_id").agg(F.sort_array(F.collect_list("guide")).alias("guides"))  # at most one entry per library guide


@register("join_08_compare_assignments", f"""SELECT count(*) AS cells_compared, count(*) FILTER (same) AS set_agree, count(*) FILTER (NOT same) AS set_disagree,
    count(*) FILTER (len(given) = 1 AND is_dominant) AS single_compared, count(*) FILTER (len(given) = 1 AND is_dominant AND given[1] = guide_top) AS single_agree,
    count(*) FILTER (len(given) = 1 AND is_dominant AND given[1] <> guide_top) AS single_disagree, count(*) FILTER (len(given) > 0 AND is_ambiguous) AS provided_assigned_but_counts_ambiguous,
    count(*) FILTER (len(given) > 0 AND NOT is_dominant AND NOT is_ambiguous) AS provided_assigned_but_counts_unassigned, count(*) FILTER (len(given) = 0 AND is_dominant) AS provided_unassigned_but_counts_assigned,
    round(count(*) FILTER (same) / count(*), 6) AS fraction_agree
    FROM (SELECT c.*, coalesce(g.guides, []) AS given, list_sort(coalesce(g.guides, [])) = list_sort(guides_detected) AS same FROM calls c LEFT JOIN ({_GIVEN}) g ON c.cell_id = g.cell_id WHERE has_guide_counts)""")
def compare_assignments(spark, sf):
    return G.compare_assignments(_given(spark, sf), S.calls(spark, sf)).withColumn("fraction_agree", F.round("fraction_agree", 6))


@register("join_09_metadata_guide_check", f"""SELECT count(*) AS metadata_guide_compared, count(*) FILTER (g.guides[1] <> c.guide) AS metadata_guide_mismatches
    FROM cells c JOIN ({_GIVEN}) g ON c.cell_id = g.cell_id WHERE c.guide <> '' AND len(g.guides) = 1""")
def metadata_check(spark, sf):
    meta = _given(spark, sf).where(F.size("guides") == 1).select("cell_id", F.element_at("guides", 1).alias("meta_guide"))
    return G.metadata_guide_check(S.cells(spark, sf), meta, "meta_guide")


@register("set_06_guide_set_equality", f"""SELECT c.cell_id, list_sort(coalesce(g.guides, [])) = list_sort(c.guides_detected) AS same,
    CAST(len(list_filter(coalesce(g.guides, []), lambda x: NOT list_contains(c.guides_detected, x))) AS BIGINT) AS n_only_given FROM calls c LEFT JOIN ({_GIVEN}) g ON c.cell_id = g.cell_id""")
def set_equality(spark, sf):
    both = S.calls(spark, sf).join(_given(spark, sf), "cell_id", "left").withColumn("guides", F.coalesce("guides", F.array().cast("array<string>")))
    return both.select("cell_id", (F.array_sort("guides") == F.array_sort("guides_detected")).alias("same"),
                       F.size(F.array_except("guides", "guides_detected")).cast("bigint").alias("n_only_given"))


# ---- alignment: documents, labels and benchmark-like key sets as modalities

_SETS = {"rna": "SELECT doc_id AS cell_id FROM documents", "protein_counts": "SELECT doc_id AS cell_id FROM labels", "metadata": "SELECT doc_id AS cell_id FROM documents WHERE lang = 'en'"}


def _sets(spark, sf):
    docs = S.read(spark, sf, "documents")
    return {"rna": docs.select(F.col("doc_id").alias("cell_id"), F.col("doc_id").alias("pos")),
            "protein_counts": S.read(spark, sf, "labels").select(F.col("doc_id").alias("cell_id")),
            "metadata": docs.where("lang = 'en'").select(F.col("doc_id").alias("cell_id"), F.col("doc_id").alias("pos"))}


@register("join_01_align_intersection", f"SELECT cell_id, cell_id AS pos FROM ({_SETS['rna']}) WHERE cell_id IN ({_SETS['protein_counts']})")
def align_intersection(spark, sf):
    return A.align_cells(_sets(spark, sf), ["rna", "protein"])


@register("join_02_align_metadata_lacking", f"SELECT cell_id FROM ({_SETS['metadata']}) WHERE cell_id NOT IN ({_SETS['protein_counts']})")
def align_metadata(spark, sf):
    sets = _sets(spark, sf)
    return A.lacking_cells(sets["metadata"], sets["protein_counts"])


_MEMBER = "SELECT cell_id, max(m = 'rna') AS r, max(m = 'protein_counts') AS p, max(m = 'metadata') AS d FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS m, cell_id FROM ({v})" for k, v in _SETS.items()) + ") GROUP BY cell_id"


@register("join_04_alignment_report", f"""SELECT 'rna' AS modality, count(*) FILTER (r) AS cells_before, 0 AS duplicates, count(*) FILTER (r AND NOT p AND NOT d) AS only_here, count(*) FILTER (r AND p AND NOT r) AS kept_but_missing, count(*) FILTER (r AND p) AS cells_kept FROM ({_MEMBER})
    UNION ALL SELECT 'protein_counts', count(*) FILTER (p), 0, count(*) FILTER (p AND NOT r AND NOT d), 0, count(*) FILTER (r AND p) FROM ({_MEMBER})
    UNION ALL SELECT 'metadata', count(*) FILTER (d), 0, count(*) FILTER (d AND NOT r AND NOT p), count(*) FILTER (r AND p AND NOT d), count(*) FILTER (r AND p) FROM ({_MEMBER})""")
def alignment_report(spark, sf):
    return A.alignment_report(_sets(spark, sf), ["rna", "protein"])


def _pair_sql(a: str, b: str, na: str, nb: str) -> str:
    return f"SELECT '{na}' AS first, '{nb}' AS second, count(*) FILTER ({a} AND {b}) AS shared, count(*) FILTER ({a} AND NOT {b}) AS only_first, count(*) FILTER ({a}) AS n_first, round(100.0 * count(*) FILTER ({a} AND {b}) / count(*) FILTER ({a}), 6) AS pct_of_first FROM ({_MEMBER})"


_ALIASES = [("r", "rna"), ("p", "protein_counts"), ("d", "metadata")]


@register("join_05_id_overlap", " UNION ALL ".join(_pair_sql(a, b, na, nb) for a, na in _ALIASES for b, nb in _ALIASES if a != b))
def id_overlap(spark, sf):
    return A.id_overlap(_sets(spark, sf)).withColumn("pct_of_first", F.round("pct_of_first", 6))


@register("fn_04_id_patterns", """SELECT 'digits' AS pattern, count(*) FILTER (regexp_matches(url, '[0-9]+')) AS n_matching, round(count(*) FILTER (regexp_matches(url, '[0-9]+')) / count(*), 6) AS fraction FROM pages
    UNION ALL SELECT 'https', count(*) FILTER (regexp_matches(url, '^https://')), round(count(*) FILTER (regexp_matches(url, '^https://')) / count(*), 6) FROM pages""")
def id_patterns(spark, sf):
    ids = S.read(spark, sf, "pages").select(F.col("url").alias("cell_id"))
    return A.id_patterns(ids, {"digits": "[0-9]+", "https": "^https://"}).withColumn("fraction", F.round("fraction", 6))


@register("join_06_optional_modality", """SELECT d.doc_id AS cell_id, l.quality IS NOT NULL AS has_labels, CAST(l.quality AS BIGINT) AS quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def optional_modality(spark, sf):
    table = S.read(spark, sf, "labels").select(F.col("doc_id").alias("cell_id"), F.col("quality").cast("bigint").alias("quality"))
    return A.attach_modality(S.read(spark, sf, "documents").select(F.col("doc_id").alias("cell_id")), table, "has_labels")


@register("join_07_metadata_attach", "SELECT c.cell_id, c.perturbation_class, m.condition, m.sample FROM cells c LEFT JOIN meta m ON c.cell_id = m.cell_id")
def metadata_attach(spark, sf):
    base = S.cells(spark, sf).select("cell_id", "perturbation_class")
    return base.join(S.cell_metadata(spark, sf).select("cell_id", "condition", "sample"), "cell_id", "left")


@register("set_01_union_sources", "SELECT 'documents' AS modality, CAST(doc_id AS VARCHAR) AS cell_id FROM documents UNION ALL SELECT 'labels', CAST(doc_id AS VARCHAR) FROM labels")
def union_sources(spark, sf):
    sets = {n: S.read(spark, sf, n).select(F.col("doc_id").alias("cell_id")) for n in ("documents", "labels")}
    return A.modality_cells(sets)


@register("set_02_shared_cells", "SELECT doc_id AS cell_id FROM documents INTERSECT SELECT doc_id FROM labels")
def shared_cells(spark, sf):
    return S.read(spark, sf, "documents").select(F.col("doc_id").alias("cell_id")).intersect(S.read(spark, sf, "labels").select("doc_id"))


@register("set_03_only_in", "SELECT doc_id AS cell_id FROM documents EXCEPT ALL SELECT doc_id FROM labels")
def only_in(spark, sf):
    return S.read(spark, sf, "documents").select(F.col("doc_id").alias("cell_id")).exceptAll(S.read(spark, sf, "labels").select("doc_id"))


@register("set_04_target_key_union", "SELECT target FROM cells WHERE perturbation_class = 'single_targeting' UNION SELECT target FROM guide_library WHERE control_class = '' UNION SELECT feature FROM expr")
def target_union(spark, sf):
    a = S.cells(spark, sf).where(L.is_perturbed()).select("target")
    b = S.guide_library(spark, sf).where("control_class = ''").select("target")
    return a.union(b).union(S.expr(spark, sf).select("feature")).distinct()


@register("set_05_ordered_dedup", "SELECT target, CAST(min(pos) AS BIGINT) AS first_pos FROM guide_library GROUP BY 1")
def ordered_dedup(spark, sf):
    return S.guide_library(spark, sf).groupBy("target").agg(F.min("pos").cast("bigint").alias("first_pos"))


@register("agg_17_cell_groups", """SELECT target, n_cells, n_control, n_cells >= 10 AND n_control >= 1 AS eligible, CASE WHEN n_cells < 10 THEN 'fewer than 10 single-guide targeting cells' END AS reason
    FROM (SELECT target, count(*) AS n_cells FROM cells WHERE perturbation_class = 'single_targeting' GROUP BY 1),
    (SELECT count(*) AS n_control FROM cells WHERE perturbation_class = 'single_control' AND control_class = 'non_targeting')""")
def cell_groups(spark, sf):
    return L.cell_groups(S.cells(spark, sf), S.CONTROLS, 10)


@register("agg_42_guides_per_target", "SELECT target, count(DISTINCT guide) AS n_guides FROM guide_library GROUP BY 1")
def guides_per_target(spark, sf):
    return S.guide_library(spark, sf).groupBy("target").agg(F.countDistinct("guide").alias("n_guides"))
