"""Queries: readers and writers (round trips of the given tables), checks, audit and plot tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.session import shared_path
from ..operators import checks as DQ
from ..operators import profile as PF
from ..sources import bundles as BU
from ..sources import inventory as IV
from ..sources import sinks as SK
from ..sources import text as TX
from . import queries_e_vectors as V
from . import screen_tables as S
from .queries_a_labels import _GIVEN, _given
from .queries_b_quality import _round
from .queries_c_statistics import R6, lognorm, screened
from .registry import SUBQUERIES, register


def counts(spark, sf):
    return S.stored(spark, sf, "counts", lambda: S.expr(spark, sf).withColumn("value", F.col("count").cast("double")))


def gene_list(spark, sf):
    names = S.read(spark, sf, "part").select(F.col("p_brand").alias("feature_id")).distinct()
    return names.select("feature_id", F.col("feature_id").alias("feature_name"), F.lit("Gene Expression").alias("feature_type"), F.expr("cast(substring(feature_id, 7) AS int)").alias("pos"))


def _triplets(spark, sf, cells):
    root = shared_path(spark, "triplets")
    SK.write_triplets(counts(spark, sf), cells, gene_list(spark, sf), root)
    return root


def dense_lines(rows, cells):
    """(k, feature, value): the header and one line per feature over ``cells(cell_id, pos)`` in order of pos, absent counts as 0."""
    wide = cells.crossJoin(F.broadcast(rows.select("feature").distinct()))  # the genes of the fixture
    dense = wide.join(rows.select("cell_id", "feature", "value"), ["cell_id", "feature"], "left").groupBy("feature").agg(
        F.sort_array(F.collect_list(F.struct("pos", "cell_id", F.coalesce(F.col("value").cast("bigint"), F.lit(0)).alias("n")))).alias("_a"))
    body = dense.select(F.lit(1).alias("k"), "feature", F.concat_ws(",", F.col("feature"), F.transform("_a", lambda a: a["n"].cast("string"))).alias("value"))
    axis = cells.agg(F.sort_array(F.collect_list(F.struct("pos", "cell_id"))).alias("_a"))
    head = axis.select(F.lit(0).alias("k"), F.lit("").alias("feature"), F.concat_ws(",", F.lit("GENE"), F.transform("_a", lambda a: a["cell_id"])).alias("value"))
    return head.unionByName(body)


def _dense(spark, sf):
    """Every second half of the cells as one wide text file (genes x cells)."""
    root = shared_path(spark, "dense")
    cells = S.cell_metadata(spark, sf).select("cell_id", "pos", (F.col("pos") % 2).alias("half"))
    rows = counts(spark, sf).join(cells.select("cell_id", "half"), "cell_id")
    paths = []
    for half in (0, 1):
        lines = dense_lines(rows.where(F.col("half") == half), cells.where(F.col("half") == half).select("cell_id", "pos"))
        path = f"{root}/half{half}.csv"
        # a wide text file is one ordered file by definition; the fixture has one row per gene
        lines.coalesce(1).sortWithinPartitions("k", "feature").select("value").write.text(path)
        paths.append(path)
    return paths


@register("src_01_dense_matrix", "SELECT cell_id, feature, CAST(count AS DOUBLE) AS value FROM expr")
def src_01(spark, sf):
    even, odd = (TX.read_dense_matrix(spark, path, separator="comma") for path in _dense(spark, sf))
    return even.unionByName(odd)


@register("src_02_dense_cell_partitions", "SELECT cell_id, feature, CAST(count AS DOUBLE) AS value FROM expr")
def src_02(spark, sf):
    return TX.read_dense_files(spark, _dense(spark, sf), separator="comma")


@register("src_04_triplet_matrix", "SELECT cell_id, feature, CAST(count AS DOUBLE) AS value FROM expr")
def src_04(spark, sf):
    cells = S.cell_metadata(spark, sf).select("cell_id", "pos")
    return TX.read_triplet_directory(spark, _triplets(spark, sf, cells))[0]


@register("src_05_positional_features", "SELECT CAST(row_number() OVER (ORDER BY CAST(substr(p_brand, 7) AS INT)) - 1 AS BIGINT) AS pos, p_brand AS feature_id, p_brand AS feature_name, 'Gene Expression' AS feature_type FROM (SELECT DISTINCT p_brand FROM part)")
def src_05(spark, sf):
    root = _triplets(spark, sf, S.cell_metadata(spark, sf).select("cell_id", "pos"))
    return TX.read_features(spark, f"{root}/features.tsv")


@register("src_06_unique_names", "SELECT p_partkey, CASE WHEN k = 0 THEN p_name ELSE p_name || '-' || k END AS feature FROM (SELECT p_partkey, p_name, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) - 1 AS k FROM part)")
def src_06(spark, sf):
    parts = S.read(spark, sf, "part").select("p_partkey", F.col("p_partkey").alias("pos"), F.col("p_name").alias("feature_name"))
    return TX.unique_names(parts).select("p_partkey", "feature")


@register("win_08_duplicate_ordinal", "SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS ordinal FROM orders".replace("row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1", "CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS BIGINT)"))
def win_08(spark, sf):
    orders = S.read(spark, sf, "orders").select("o_orderkey", F.col("o_orderkey").alias("pos"), F.concat(F.lit("n"), F.col("o_custkey").cast("string")).alias("feature_name"))
    named = TX.unique_names(orders)
    return named.select("o_orderkey", F.coalesce(F.nullif(F.regexp_extract("feature", r"-(\d+)$", 1), F.lit("")), F.lit("0")).cast("bigint").alias("ordinal"))


@register("src_07_table_with_type_row", "SELECT cell_id AS \"NAME\", condition, sample FROM meta")
def src_07(spark, sf):
    path = shared_path(spark, "metadata") + ".csv"
    meta = S.cell_metadata(spark, sf).select(F.col("cell_id").alias("NAME"), "condition", "sample")
    SK.write_typed_table(meta, {"NAME": "TYPE", "condition": "group", "sample": "group"}, path)
    return TX.read_table(spark, path, "comma", "NAME")


@register("src_08_guide_assignments", f"SELECT cell_id, array_to_string(guides, ';') AS guides FROM ({_GIVEN})")
def src_08(spark, sf):
    path = shared_path(spark, "guides")
    _given(spark, sf).select(F.col("cell_id").alias("Cell"), F.array_join("guides", " , ").alias("sgRNAs")).write.option("header", True).option("sep", "\t").csv(path)
    return TX.read_guide_assignments(spark, path, separator="tab").select("cell_id", F.array_join("guides", ";").alias("guides"))


@register("src_09_embedding", "SELECT CAST(cell_id AS VARCHAR) AS cell_id, CAST(a - 1 AS INT) AS axis, round(vec[a], 4) + 0.0 AS value FROM vectors, range(1, 65) AS r(a)")
def src_09(spark, sf):
    path = shared_path(spark, "embedding")
    axes = [f"X{i}" for i in range(1, 65)]
    S.vectors(spark, sf).select(F.col("cell_id").alias("NAME"), *[F.element_at("vec", i + 1).alias(x) for i, x in enumerate(axes)]).write.option("header", True).option("sep", "\t").csv(path)
    emb = TX.read_embedding(spark, path, axes, separator="tab")
    return _round(emb.select("cell_id", F.posexplode("vec").alias("axis", "value")), "value", digits=4)


@register("src_10_slot_addressed_matrix", "SELECT cell_id, protein AS feature, CAST(count AS DOUBLE) AS value FROM protein_counts")
def src_10(spark, sf):
    root = shared_path(spark, "slots")
    BU.write_slot(counts(spark, sf), root, "X")
    BU.write_slot(S.protein_counts(spark, sf).withColumnRenamed("protein", "feature").withColumnRenamed("count", "value"), root, "obsm", "protein_counts")
    return BU.read_slot(spark, root, "obsm", "protein_counts")


@register("src_11_lane_concatenation", "SELECT cell_id || '__' || CASE WHEN CAST(substr(cell_id, 2) AS BIGINT) % 2 = 0 THEN 'L1' ELSE 'L2' END AS cell_id, feature, CAST(count AS DOUBLE) AS value FROM expr")
def src_11(spark, sf):
    merged, _ = BU.concat_lanes(_lane_parts(spark, sf))
    return merged.select("cell_id", "feature", "value")


def _lane_parts(spark, sf):
    even = F.expr("cast(substring(cell_id, 2) AS bigint) % 2 = 0")
    base = counts(spark, sf).select("cell_id", "feature", "value")
    return [("L1", base.where(even)), ("L2", base.where(~even))]


@register("src_12_lane_sheet", "SELECT 'C' || o AS barcode_original, 'C' || o || '__' || l AS cell_id, l AS lane_id, CASE WHEN l = 'L1' THEN 'ctrl' ELSE 'stim' END AS condition FROM (SELECT DISTINCT o_custkey AS o, CASE WHEN o_custkey % 2 = 0 THEN 'L1' ELSE 'L2' END AS l FROM orders JOIN lineitem ON l_orderkey = o_orderkey)")
def src_12(spark, sf):
    _, lanes = BU.concat_lanes(_lane_parts(spark, sf), check=False)
    sheet = lanes.select("lane_id").distinct().withColumn("condition", F.when(F.col("lane_id") == "L1", "ctrl").otherwise("stim"))
    return BU.attach_lane_sheet(lanes, sheet)


def _combined(spark, sf):
    rna = counts(spark, sf).select("cell_id", "feature", "value")
    adt = S.protein_counts(spark, sf).select("cell_id", F.col("protein").alias("feature"), F.col("count").cast("double").alias("value"))
    genes = gene_list(spark, sf).drop("pos")
    panel = S.protein_panel(spark, sf).select(F.col("protein").alias("feature_id"), F.col("protein").alias("feature_name"), F.lit("Antibody Capture").alias("feature_type"))
    return rna.unionByName(adt), genes.unionByName(panel)


WANTED = {"rna": ["Gene Expression"], "protein_counts": ["Antibody Capture"]}


@register("src_13_split_feature_types", "SELECT 'rna' AS modality, count(*) AS n, CAST(sum(count) AS DOUBLE) AS total FROM expr UNION ALL SELECT 'protein_counts', count(*), CAST(sum(count) AS DOUBLE) FROM protein_counts")
def src_13(spark, sf):
    expr, features = _combined(spark, sf)
    return BU.split_feature_types(expr, features, WANTED).groupBy("modality").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


@register("src_14_keep_feature_types", "SELECT cell_id, protein AS feature, CAST(count AS DOUBLE) AS value FROM protein_counts")
def src_14(spark, sf):
    expr, features = _combined(spark, sf)
    return BU.keep_types(expr, features, ["Antibody Capture"])


@register("src_16_canonical_inputs", "SELECT 'rna' AS modality, count(DISTINCT cell_id) AS n_cells, count(DISTINCT feature) AS n_features FROM expr UNION ALL SELECT 'protein_counts', count(DISTINCT cell_id), count(DISTINCT protein) FROM protein_counts UNION ALL SELECT 'guide_counts', count(DISTINCT cell_id), count(DISTINCT guide) FROM guide_counts")
def src_16(spark, sf):
    expr, features = _combined(spark, sf)
    guides = S.guide_counts(spark, sf).withColumnRenamed("guide", "feature").withColumnRenamed("umi", "value")
    bundle = BU.load_inputs({"guide_counts": guides}, (expr, features, WANTED), metadata=S.cell_metadata(spark, sf))
    parts = [m.agg(F.countDistinct("cell_id").alias("n_cells"), F.countDistinct("feature").alias("n_features")).withColumn("modality", F.lit(k)) for k, m in bundle.matrices.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("src_15_multiplexed_lanes", "SELECT 'rna' AS modality, count(DISTINCT cell_id) AS n_cells FROM expr UNION ALL SELECT 'protein_counts', count(DISTINCT cell_id) FROM protein_counts")
def src_15(spark, sf):
    expr, features = _combined(spark, sf)
    even = F.expr("cast(substring(cell_id, 2) AS bigint) % 2 = 0")
    merged, _ = BU.concat_lanes([("L1", expr.where(even)), ("L2", expr.where(~even))], check=False)
    return BU.split_feature_types(merged, features, WANTED).groupBy("modality").agg(F.countDistinct("cell_id").alias("n_cells"))


@register("src_17_first_cells", "SELECT cell_id, feature, CAST(count AS DOUBLE) AS value FROM expr WHERE CAST(substr(cell_id, 2) AS BIGINT) < 700")
def src_17(spark, sf):
    return BU.first_cells(counts(spark, sf).select("cell_id", "feature", "value"), S.cell_metadata(spark, sf), 700)


@register("src_18_file_inventory", " UNION ALL ".join(f"SELECT 'half{h}.csv' AS name, CAST(count(DISTINCT p_brand) + 1 AS BIGINT) AS n_lines, (SELECT CAST(count(*) + 1 AS INT) FROM meta WHERE pos % 2 = {h}) AS n_columns, 'GENE' AS first_column FROM part" for h in (0, 1)))
def src_18(spark, sf):
    out = IV.inspect_text(spark, _dense(spark, sf), "comma")
    return out.select(F.regexp_extract("file", "(half[01]\\.csv)", 1).alias("name"), "n_lines", "n_columns", "first_column")


@register("src_19_explicit_map", "SELECT guide, CASE WHEN target = 'Brand#1' THEN 'mapped' ELSE target END AS target FROM guide_library")
def src_19(spark, sf):
    from ..operators.labels import annotate_guides

    table = S.guide_library(spark, sf).where("target = 'Brand#1'").select("guide", F.lit("mapped").alias("target"))
    lib = annotate_guides(S.guide_library(spark, sf).select("guide", "pos"), S.GUIDE_PATTERN, S.CONTROL_CLASSES, BU.map_entries(table, "guide", "target"))
    return lib.select("guide", "target")


@register("src_20_result_tables", "SELECT cell_id, condition, sample FROM meta")
def src_20(spark, sf):
    root = shared_path(spark, "results")
    paths = SK.write_results({"cells": S.cell_metadata(spark, sf).select("cell_id", "condition", "sample")}, root, "csv", ("cells",))
    return spark.read.option("header", True).csv(paths["cells"])


@register("src_21_processed_table_set", "SELECT 'cells' AS name, count(*) AS n_rows, 'final' AS status FROM meta UNION ALL SELECT 'expr', count(*), 'final' FROM expr UNION ALL SELECT 'expr', count(*), 'prefilter' FROM expr")
def src_21(spark, sf):
    e = counts(spark, sf).select("cell_id", "feature", "value")
    return SK.write_processed({"cells": S.cell_metadata(spark, sf), "expr": e}, shared_path(spark, "processed"), prefilter={"expr": e}).select("name", "n_rows", "status")


@register("src_22_run_manifest", "SELECT 'cells.n' AS key, CAST((SELECT count(*) FROM meta) AS VARCHAR) AS value UNION ALL SELECT 'dataset', '\"shared tables\"'")
def src_22(spark, sf):
    n = S.cell_metadata(spark, sf).count()
    return SK.run_manifest(spark, {"dataset": "shared tables", "cells": {"n": n}}, shared_path(spark, "manifest"))


@register("src_23_subset_in_input_layout", "SELECT cell_id, feature, CAST(count AS DOUBLE) AS value FROM expr WHERE cell_id IN (SELECT cell_id FROM meta WHERE condition = 'BUILDING')")
def src_23(spark, sf):
    cells = S.cell_metadata(spark, sf).where("condition = 'BUILDING'").select("cell_id", "pos")
    return TX.read_triplet_directory(spark, _triplets(spark, sf, cells))[0]


@register("src_24_result_catalog", "SELECT 'cells' AS name, count(*) AS n_rows FROM meta UNION ALL SELECT 'counts', count(*) FROM expr")
def src_24(spark, sf):
    meta = S.cell_metadata(spark, sf)
    catalog = SK.result_catalog({"cells": meta, "counts": counts(spark, sf), "empty": meta.where("false"), "absent": None})
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("name", F.lit(k)) for k, df in catalog.items()]
    return parts[0].unionByName(parts[1])


# ---- checks

@register("dq_02_matrix_checks", "SELECT 'info' AS level, 'non-integer values' AS check, count(*) AS n FROM lognorm WHERE abs(v - round(v)) > 1e-6")
def dq_02(spark, sf):
    return DQ.matrix_checks(lognorm(spark, sf), "lognorm", counts=False)


@register("dq_03_metadata_checks", "SELECT 'error' AS level, 'column donor is missing' AS check, count(DISTINCT 1) AS n FROM meta")
def dq_03(spark, sf):
    meta = S.cell_metadata(spark, sf)
    return DQ.metadata_checks(meta.select("cell_id"), meta, ["condition", "donor"])


@register("dq_04_guide_checks", f"SELECT 'warning' AS level, 'library guide not in the map table' AS check, count(*) AS n FROM guide_library WHERE control_class = '' HAVING count(*) > 0 UNION ALL SELECT 'error', 'assigned guide not in the library', count(DISTINCT guide) FROM (SELECT unnest(guides) AS guide FROM ({_GIVEN})) WHERE guide LIKE '%_1'")
def dq_04(spark, sf):
    lib = S.guide_library(spark, sf)
    lists = _given(spark, sf)
    known = DQ.guide_checks(lists, lib, lib.where("control_class <> ''").select("guide", "target"), S.GUIDE_PATTERN)
    unknown = DQ.guide_checks(lists, lib.where("guide NOT LIKE '%_1'"))
    return known.unionByName(unknown)


@register("dq_05_antibody_checks", "SELECT 'error' AS level, 'feature_id repeated' AS check, count(*) AS n FROM (SELECT l_returnflag FROM (SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem) GROUP BY 1 HAVING count(*) > 1)")
def dq_05(spark, sf):
    return DQ.antibody_checks(S.read(spark, sf, "lineitem").select(F.col("l_returnflag").alias("feature_id"), "l_linestatus").distinct())


@register("dq_06_duplicate_ids", "SELECT CAST(o_custkey AS VARCHAR) AS key, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1")
def dq_06(spark, sf):
    return DQ.duplicate_keys(S.read(spark, sf, "orders"), "o_custkey")


@register("dq_07_run_warnings", "SELECT 'frac_multi_guide' AS metric, round(count(*) FILTER (n_guides > 1) / count(*), 4) AS value, 0.3 AS \"limit\", 'many cells carry several guides' AS warning FROM multi_cells".replace("0.3 AS", "CAST(0.3 AS DOUBLE) AS"))
def dq_07(spark, sf):
    from ..operators.coverage import screen_summary

    return DQ.run_warnings(screen_summary(S.multi_cells(spark, sf)), {"frac_multi_guide": (0.3, "many cells carry several guides"), "frac_unassigned": (0.7, "most cells carry no guide")})


@register("dq_08_contract_checks", " UNION ALL ".join(f"SELECT '{c}' AS check, CAST(count(*) AS BIGINT) AS n, CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM {q}" for c, q in {
    "unknown perturbation class": "cells WHERE perturbation_class NOT IN ('single_targeting', 'single_control', 'ambiguous', 'unassigned')", "targeting cell without a target": "cells WHERE perturbation_class = 'single_targeting' AND target = ''",
    "control cell without a class": "cells WHERE perturbation_class = 'single_control' AND control_class = ''", "targeting cell with a control class": "cells WHERE perturbation_class = 'single_targeting' AND control_class <> ''",
    "repeated cell id": "(SELECT cell_id FROM cells GROUP BY 1 HAVING count(*) > 1)", "value not finite": "lognorm WHERE NOT isfinite(v)", "negative normalised value": "lognorm WHERE v < 0",
    "library sum off target": "(SELECT cell_id FROM lognorm GROUP BY 1 HAVING abs(sum(exp(v) - 1) - 10000) > 1)", "entry without a cell row": "expr WHERE cell_id NOT IN (SELECT cell_id FROM cells)"}.items()))
def dq_08(spark, sf):
    return DQ.contract_checks(screened(spark, sf), lognorm(spark, sf), ["single_targeting", "single_control", "ambiguous", "unassigned"])


_DIFF = "SELECT '{c}' AS \"column\", count(*) FILTER ({d}) AS n_different, {m} AS max_abs_diff, CASE WHEN count(*) FILTER ({d}) > 0 THEN 'DIFF' ELSE 'SAME' END AS status FROM customer"
_CHANGED = "c_mktsegment = 'BUILDING'"


def _versions(spark, sf):
    old = S.read(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    changed = S.read(spark, sf, "customer").select("c_custkey", "c_name", F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")).alias("c_acctbal"))
    return old, changed


_COMPARE = " UNION ALL ".join([_DIFF.format(c="*", d="false", m="CAST(NULL AS DOUBLE)"), _DIFF.format(c="c_name", d="false", m="CAST(NULL AS DOUBLE)"), _DIFF.format(c="c_acctbal", d=_CHANGED, m="1.0::DOUBLE")])


@register("dq_09_table_comparison", _COMPARE)
def dq_09(spark, sf):
    return _round(DQ.compare_tables(*_versions(spark, sf), ["c_custkey"]), "max_abs_diff")


@register("dq_10_parity_report", f"SELECT \"column\", n_different, max_abs_diff, CASE WHEN status = 'SAME' THEN 'MATCH' ELSE status END AS status FROM ({_COMPARE})")
def dq_10(spark, sf):
    return _round(DQ.parity_report(DQ.compare_tables(*_versions(spark, sf), ["c_custkey"])), "max_abs_diff")


@register("dq_11_fingerprints", "SELECT count(*) AS n_rows, true AS same FROM customer")
def dq_11(spark, sf):
    c = S.read(spark, sf, "customer")
    a, b = DQ.table_fingerprint(c), DQ.table_fingerprint(c.repartition(5))
    return a.crossJoin(b.select(F.col("content").alias("_other"))).select("n_rows", (F.col("content") == F.col("_other")).alias("same"))


# ---- audit and plot tables

@register("agg_39_guide_statistics", f"""SELECT 'guides_per_cell' AS statistic, CAST(len(guides) AS VARCHAR) AS key, count(*) AS n_cells FROM ({_GIVEN}) GROUP BY 2 UNION ALL SELECT 'cells_per_guide', g, count(*) FROM (SELECT unnest(guides) AS g FROM ({_GIVEN})) GROUP BY 2
    UNION ALL SELECT 'cells_per_target', l.target, count(DISTINCT cell_id) FROM (SELECT cell_id, unnest(guides) AS g FROM ({_GIVEN})) x JOIN guide_library l ON l.guide = x.g GROUP BY 2""")
def agg_39(spark, sf):
    return PF.guide_statistics(_given(spark, sf), S.guide_library(spark, sf))


@register("agg_40_column_profile", """SELECT 'condition' AS "column", count(*) AS n_rows, count(DISTINCT condition) AS n_unique, count(*) FILTER (condition = '') AS n_empty, false AS is_numeric, CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS max FROM meta
    UNION ALL SELECT 'pos', count(*), count(DISTINCT pos), 0, true, CAST(min(pos) AS DOUBLE), round(avg(pos), 4), CAST(max(pos) AS DOUBLE) FROM meta""")
def agg_40(spark, sf):
    return _round(PF.column_profile(S.cell_metadata(spark, sf), ["condition", "pos"]), "mean", digits=4)


@register("agg_40_level_counts", "SELECT 'condition' AS \"column\", condition AS level, count(*) AS n FROM meta GROUP BY 2 UNION ALL SELECT 'sample', sample, count(*) FROM meta GROUP BY 2 UNION ALL SELECT 'pos', CAST(pos AS VARCHAR), count(*) FROM meta GROUP BY 2")
def agg_40b(spark, sf):
    return PF.level_counts(S.cell_metadata(spark, sf), ["condition", "sample", "pos"])


@register("agg_41_matrix_statistics", "SELECT (SELECT count(*) FROM expr) AS n_stored, (SELECT min(count) FROM expr) AS min, (SELECT max(count) FROM expr) AS max, round(quantile_cont(CAST(n AS DOUBLE), 0.05), 6) AS nnz_q05, quantile_cont(CAST(n AS DOUBLE), 0.5) AS nnz_median, round(quantile_cont(CAST(n AS DOUBLE), 0.95), 6) AS nnz_q95, (SELECT count(*) FROM meta) AS n_cells, 25 AS n_features, round(1 - (SELECT count(*) FROM expr) / ((SELECT count(*) FROM meta) * 25), 6) AS zero_fraction FROM (SELECT cell_id, count(*) AS n FROM expr GROUP BY 1)")
def agg_41(spark, sf):
    n = S.cell_metadata(spark, sf).agg(F.count(F.lit(1)).alias("n_cells"))
    g = gene_list(spark, sf).agg(F.count(F.lit(1)).alias("n_features"))
    return _round(PF.matrix_statistics(counts(spark, sf), n, g), "nnz_q05", "nnz_q95", "zero_fraction")


@register("agg_46_histogram", "SELECT event_type, CAST(least(60, floor((value - lo) / ((hi - lo) / 60)) + 1) AS INT) AS bin, count(*) AS n FROM events JOIN (SELECT event_type, min(value) AS lo, max(value) AS hi FROM events GROUP BY 1) USING (event_type) GROUP BY 1, 2")
def agg_46(spark, sf):
    return PF.histogram(S.read(spark, sf, "events"), "value", 60, ["event_type"])


@register("agg_46_cumulative_shares", "SELECT DISTINCT event_type, value, round(cume_dist() OVER (PARTITION BY event_type ORDER BY value), 6) AS share FROM events")
def agg_46b(spark, sf):
    return _round(PF.cumulative_shares(S.read(spark, sf, "events"), ["event_type"], "value"), "share")


@register("agg_46_column_zscores", f"SELECT \"group\", cluster, {R6('(pct - avg(pct) OVER (PARTITION BY cluster)) / stddev_pop(pct) OVER (PARTITION BY cluster)', 5)} AS z FROM comp")
def agg_46c(spark, sf):
    from ..operators.enrichment import composition

    out = PF.zscore_columns(composition(V.cells(spark, sf), V.CLASSES), "cluster", "pct")
    return _round(out.select("group", "cluster", "z"), "z", digits=5)


_BINS = "(SELECT " + ", ".join(f"quantile_cont(o_totalprice, {i / 8}) AS q{i}" for i in range(1, 8)) + " FROM orders)"


@register("agg_45_binned_medians", f"SELECT bin, count(*) AS n, round(quantile_cont(x, 0.5), 4) AS median_x, round(quantile_cont(y, 0.5), 4) AS median_y FROM (SELECT o_totalprice AS x, CAST(o_custkey AS DOUBLE) AS y, 1 + {' + '.join(f'CAST(o_totalprice > q{i} AS INT)' for i in range(1, 8))} AS bin FROM orders, {_BINS}) GROUP BY 1".replace("SELECT bin,", "SELECT CAST(bin AS INT) AS bin,"))
def agg_45(spark, sf):
    return _round(PF.binned_medians(S.read(spark, sf, "orders"), "o_totalprice", "o_custkey"), "median_x", "median_y", digits=4)


@register("agg_48_cluster_positions", "SELECT cluster, CAST(a - 1 AS INT) AS axis, round(quantile_cont(vec[a], 0.5), 6) AS median FROM vectors, range(1, 65) AS r(a) GROUP BY 1, 2")
def agg_48(spark, sf):
    return _round(PF.cluster_positions(S.vectors(spark, sf), "cluster", 64), "median")


@register("agg_21_cluster_summary", """SELECT c.cluster, n AS n_cells, round(n / (SELECT count(*) FROM vectors), 6) AS fraction, 0.0 AS frac_ambiguous_or_unassigned, lv AS top_sample, round(k / n, 6) AS top_sample_share, '' AS flags FROM (SELECT cluster, count(*) AS n FROM vectors GROUP BY 1) c
    JOIN (SELECT cluster, max(k) AS k, arg_max(sample, (k, sample)) AS lv FROM (SELECT cluster, sample, count(*) AS k FROM vectors GROUP BY 1, 2) GROUP BY 1) t ON t.cluster = c.cluster""".replace("0.0 AS frac", "CAST(0 AS DOUBLE) AS frac"))
def agg_21(spark, sf):
    return _round(PF.cluster_summary(V.cells(spark, sf), ["sample"]), "fraction", "top_sample_share")


@register("agg_22_cluster_by_level", "SELECT k.cluster, t.target, count(v.cell_id) AS n_cells FROM (SELECT DISTINCT cluster FROM vectors) k CROSS JOIN (SELECT DISTINCT target FROM vectors) t LEFT JOIN vectors v ON v.cluster = k.cluster AND v.target = t.target GROUP BY 1, 2")
def agg_22b(spark, sf):
    return PF.cluster_level_counts(V.cells(spark, sf), "target")
