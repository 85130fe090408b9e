"""The shared test tables read as a perturbation screen.

cell = customer with orders, gene = part brand, guide = brand and size parity,
protein = return flag and line status, condition = market segment, sample =
region; quantities are the molecule counts.  ``embeddings`` supply cell vectors
with clusters (label) and targets (id modulo 7, class 0 being the control).
The SQL side of every definition stands next to it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.session import cut_lineage
from ..operators import guides as G
from ..operators import labels as L
from .registry import SUBQUERIES

# fixed parameters of the mapping, shared by both sides
GUIDE_PATTERN = r"^(?P<target>.+)_\d+$"
CONTROL_CLASSES = {"non_targeting": [r"^Brand#2[0-5]$"], "safe_harbor": [r"^Brand#19$"]}
CONTROLS = ["non_targeting"]
MIN_UMI, DOMINANCE, DETECTION = 60, 1.05, 75
MITO_PREFIX, RIBO_PREFIXES, HB_PATTERN = "Brand#1", ("Brand#3", "Brand#4"), r"^BRAND#2$"
ISOTYPES = [r"^N"]
ISOTYPE_MAP = {"RO": "NO", "AO": "NO", "RF": "NF", "AF": "NF"}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_STORED: dict[tuple[str, str, str], DataFrame] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A stage table of the screen (labelled cells, normalised values, neighbour edges), written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        _STORED[key] = cut_lineage(build())
    return _STORED[key]


def forget() -> None:
    """Drop the stage tables of this session, so that the next query builds its own."""
    _STORED.clear()


def _cell(column: str):
    return F.concat(F.lit("C"), F.col(column).cast("string"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))


def expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """expr(cell_id, feature, count): non-zero counts only."""
    lines = _lines(spark, sf_dir).join(read(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return lines.groupBy(_cell("o_custkey").alias("cell_id"), F.col("p_brand").alias("feature")).agg(F.sum("l_quantity").cast("bigint").alias("count"))


def guide_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir).join(read(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    guide = F.concat("p_brand", F.lit("_"), (F.col("p_size") % 2 + 1).cast("string"))
    return lines.groupBy(_cell("o_custkey").alias("cell_id"), guide.alias("guide")).agg(F.sum("l_quantity").cast("bigint").alias("umi"))


def guide_library(spark: SparkSession, sf_dir: str) -> DataFrame:
    """guides(guide, pos, target, control_class, is_control); position = dense order of the name."""
    part = read(spark, sf_dir, "part")
    names = part.select(F.concat("p_brand", F.lit("_"), (F.col("p_size") % 2 + 1).cast("string")).alias("guide")).distinct()
    # natural order key instead of a global window: brand number, then guide number
    key = F.regexp_extract("guide", r"#(\d+)_", 1).cast("int") * 10 + F.regexp_extract("guide", r"_(\d+)$", 1).cast("int")
    return L.annotate_guides(names.withColumn("pos", key), GUIDE_PATTERN, CONTROL_CLASSES)


def cell_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cells(cell_id, pos, condition, sample, balance) for customers with orders."""
    buyers = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return (read(spark, sf_dir, "customer").join(buyers, "c_custkey", "left_semi")
            .join(read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(_cell("c_custkey").alias("cell_id"), F.col("c_custkey").alias("pos"), F.col("c_mktsegment").alias("condition"),
                    F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("sample"), F.col("c_acctbal").alias("balance")))


def protein_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """protein counts(cell_id, protein, count): non-zero only."""
    return (_lines(spark, sf_dir).groupBy(_cell("o_custkey").alias("cell_id"), F.concat("l_returnflag", "l_linestatus").alias("protein"))
            .agg(F.sum("l_quantity").cast("bigint").alias("count")))


def protein_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = read(spark, sf_dir, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("protein")).distinct()
    return names.withColumn("is_isotype", F.col("protein").rlike("(?i)^N"))


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.call_guides(cell_metadata(spark, sf_dir), guide_counts(spark, sf_dir), guide_library(spark, sf_dir), MIN_UMI, DOMINANCE, DETECTION)


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled cells: dominant calls, harmonised, ambiguous ones marked."""
    called = calls(spark, sf_dir)
    own = F.when(F.col("is_dominant"), F.array("guide_top")).otherwise(F.array().cast("array<string>"))
    labelled = L.label_cells(called.withColumn("guides", own), GUIDE_PATTERN, CONTROL_CLASSES)
    return L.mark_ambiguous(labelled)


def multi_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled cells under the threshold rule (multi-guide lists)."""
    called = calls(spark, sf_dir)
    return L.label_cells(called.withColumn("guides", F.col("guides_detected")), GUIDE_PATTERN, CONTROL_CLASSES)


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec(cell_id, vec, cluster, target, perturbation_class, control_class, sample, guide)."""
    key = F.col("vec_id") % 7
    control = key == 0
    return read(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("cell_id"), F.col("embedding").cast("array<double>").alias("vec"), F.col("label").cast("string").alias("cluster"),
        F.when(control, "NT").otherwise(F.concat(F.lit("T"), key.cast("string"))).alias("target"),
        F.when(control, L.CONTROL).otherwise(L.TARGETING).alias("perturbation_class"),
        F.when(control, "non_targeting").otherwise("").alias("control_class"),
        F.concat(F.lit("S"), (F.col("vec_id") % 3).cast("string")).alias("sample"),
        F.concat(F.lit("G"), key.cast("string"), F.lit("_"), (F.col("vec_id") % 2).cast("string")).alias("guide"))


def _lines_sql(extra: str = "") -> str:
    return f"FROM lineitem JOIN orders ON l_orderkey = o_orderkey {extra}"


_PART = "JOIN part ON l_partkey = p_partkey"
_GUIDE = "p_brand || '_' || CAST(p_size % 2 + 1 AS VARCHAR)"

SUBQUERIES.update({
    "expr": f"SELECT 'C' || o_custkey AS cell_id, p_brand AS feature, CAST(sum(l_quantity) AS BIGINT) AS count {_lines_sql(_PART)} GROUP BY 1, 2",
    "guide_counts": f"SELECT 'C' || o_custkey AS cell_id, {_GUIDE} AS guide, CAST(sum(l_quantity) AS BIGINT) AS umi {_lines_sql(_PART)} GROUP BY 1, 2",
    "guide_library": f"""SELECT guide, pos, target, CASE WHEN regexp_matches(target, '^Brand#2[0-5]$') THEN 'non_targeting' WHEN target = 'Brand#19' THEN 'safe_harbor' ELSE '' END AS control_class
        FROM (SELECT DISTINCT {_GUIDE} AS guide, CAST(substr(p_brand, 7) AS INT) * 10 + p_size % 2 + 1 AS pos, p_brand AS target FROM part)""",
    "meta": """SELECT 'C' || c_custkey AS cell_id, c_custkey AS pos, c_mktsegment AS condition, 'R' || n_regionkey AS sample, c_acctbal AS balance
        FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey IN (SELECT o_custkey FROM orders)""",
    "protein_counts": f"SELECT 'C' || o_custkey AS cell_id, l_returnflag || l_linestatus AS protein, CAST(sum(l_quantity) AS BIGINT) AS count {_lines_sql()} GROUP BY 1, 2",
    "guide_ranked": """SELECT cell_id, g.guide, umi, pos, row_number() OVER (PARTITION BY cell_id ORDER BY umi DESC, pos) AS rn
        FROM guide_counts g JOIN guide_library l ON g.guide = l.guide WHERE umi > 0""",
    "calls": f"""SELECT m.*, coalesce(t.n, 0) > 0 AS has_guide_counts, coalesce(t.total, 0) AS guide_total_counts, coalesce(t.n_det, 0) AS n_guides_detected,
            coalesce(t.det, []) AS guides_detected, coalesce(t.top_guide, '') AS guide_top, coalesce(t.top, 0) AS guide_top_count, coalesce(t.second, 0) AS guide_second_count,
            coalesce(t.top >= {MIN_UMI} AND t.top > {DOMINANCE} * coalesce(t.second, 0), false) AS is_dominant,
            coalesce(t.top >= {MIN_UMI} AND NOT (t.top > {DOMINANCE} * coalesce(t.second, 0)), false) AS is_ambiguous
        FROM meta m LEFT JOIN (SELECT cell_id, count(*) AS n, CAST(sum(umi) AS BIGINT) AS total, count(*) FILTER (umi >= {DETECTION}) AS n_det,
            list(guide ORDER BY pos) FILTER (umi >= {DETECTION}) AS det, max(guide) FILTER (rn = 1) AS top_guide, max(umi) FILTER (rn = 1) AS top, max(umi) FILTER (rn = 2) AS second
            FROM guide_ranked GROUP BY cell_id) t ON m.cell_id = t.cell_id""",
    "cells": """SELECT c.*, CASE WHEN is_dominant THEN guide_top ELSE '' END AS guide, CASE WHEN is_dominant THEN 1 ELSE 0 END AS n_guides,
            CASE WHEN is_dominant THEN l.target ELSE '' END AS target, CASE WHEN is_dominant THEN l.control_class ELSE '' END AS control_class,
            CASE WHEN is_ambiguous THEN 'ambiguous' WHEN NOT is_dominant THEN 'unassigned' WHEN l.control_class = '' THEN 'single_targeting' ELSE 'single_control' END AS perturbation_class,
            CASE WHEN is_ambiguous THEN 'ambiguous' WHEN is_dominant THEN l.target ELSE 'unassigned' END AS perturbation
        FROM calls c LEFT JOIN guide_library l ON c.guide_top = l.guide""",
    "multi_parts": """SELECT cell_id, unnest(guides_detected) AS guide FROM calls""",
    "multi_cells": """SELECT c.cell_id, c.condition, c.sample, array_to_string(c.guides_detected, ';') AS guides, c.n_guides_detected AS n_guides, coalesce(x.nt, 0) AS n_targets,
            CASE WHEN c.n_guides_detected = 1 THEN x.g1 ELSE '' END AS guide, CASE WHEN c.n_guides_detected = 1 THEN x.t1 ELSE '' END AS target, coalesce(x.targets, '') AS targets,
            CASE WHEN c.n_guides_detected = 1 THEN x.c1 ELSE '' END AS control_class,
            CASE WHEN c.n_guides_detected = 0 THEN 'unassigned' WHEN c.n_guides_detected = 1 THEN CASE WHEN nc > 0 THEN 'single_control' ELSE 'single_targeting' END
                 WHEN nc > 0 AND nc < nt THEN 'mixed_control_targeting' WHEN nc > 0 THEN 'multi_control' ELSE 'multi_targeting' END AS perturbation_class
        FROM calls c LEFT JOIN (SELECT p.cell_id, count(DISTINCT l.target) AS nt, count(DISTINCT l.target) FILTER (l.control_class <> '') AS nc, min(p.guide) AS g1, min(l.target) AS t1, min(l.control_class) AS c1,
                array_to_string(list_distinct_ordered.ts, ';') AS targets
            FROM multi_parts p JOIN guide_library l ON p.guide = l.guide
            JOIN (SELECT cell_id, list(target ORDER BY tp) AS ts FROM (SELECT p.cell_id, l.target, min(l.pos) AS tp FROM multi_parts p JOIN guide_library l ON p.guide = l.guide GROUP BY 1, 2) GROUP BY cell_id) list_distinct_ordered ON p.cell_id = list_distinct_ordered.cell_id
            GROUP BY p.cell_id, list_distinct_ordered.ts) x ON c.cell_id = x.cell_id""",
    "vectors": """SELECT vec_id AS cell_id, CAST(embedding AS DOUBLE[]) AS vec, CAST(label AS VARCHAR) AS cluster, CASE WHEN vec_id % 7 = 0 THEN 'NT' ELSE 'T' || (vec_id % 7) END AS target,
            CASE WHEN vec_id % 7 = 0 THEN 'single_control' ELSE 'single_targeting' END AS perturbation_class, 'S' || (vec_id % 3) AS sample, 'G' || (vec_id % 7) || '_' || (vec_id % 2) AS guide FROM embeddings""",
})
