"""Input checks, run warnings, contract validation and run comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import any_regex


def _findings(stats: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(level, check, n) rows of a one-row table of counts where the count is positive."""
    rows = F.array(*[F.struct(F.lit(level).alias("level"), F.lit(check).alias("check"), F.col(column).cast("bigint").alias("n")) for level, check, column in rules])
    return stats.select(F.explode(rows).alias("_r")).select("_r.*").where("n > 0")


def matrix_checks(expr: DataFrame, value: str = "count", counts: bool = True) -> DataFrame:
    """Repeated entries, negative or fractional values, empty matrix: one aggregate over distinct entries."""
    v = F.col(value).cast("double")
    per_entry = expr.groupBy("cell_id", "feature").agg(F.count(F.lit(1)).alias("_n"), F.count_if(v < 0).alias("_neg"), F.count_if(F.abs(v - F.rint(v)) > 1e-6).alias("_frac"))
    stats = per_entry.agg(F.count_if(F.col("_n") > 1).alias("dup"), F.coalesce(F.sum("_neg"), F.lit(0)).alias("neg"), F.coalesce(F.sum("_frac"), F.lit(0)).alias("frac"), (F.count(F.lit(1)) == 0).cast("int").alias("empty"))
    return _findings(stats, [("error", "repeated cell and feature", "dup"), ("error" if counts else "warning", "negative values", "neg"), ("warning" if counts else "info", "non-integer values", "frac"), ("error", "empty matrix", "empty")])


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(F.col(key).cast("string").alias("key")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def metadata_checks(cells: DataFrame, metadata: DataFrame, columns: Sequence[str]) -> DataFrame:
    """No shared cell is an error, as is a mapped column that is absent."""
    shared = cells.join(metadata.select("cell_id"), "cell_id", "left_semi").agg((F.count(F.lit(1)) == 0).cast("int").alias("none"))
    for c in columns:
        shared = shared.withColumn(f"col_{c}", F.lit(int(c not in metadata.columns)))
    return _findings(shared, [("error", "no cell of the matrix is in the metadata", "none"), *[("error", f"column {c} is missing", f"col_{c}") for c in columns]])


def guide_checks(assigned: DataFrame, library: DataFrame, table: DataFrame | None = None, pattern: str | None = None) -> DataFrame:
    """Assigned guides unknown to the library, guides the pattern cannot parse, broken map table rows."""
    used = assigned.select(F.explode("guides").alias("guide")).distinct()
    parts = [used.join(library.select("guide"), "guide", "left_anti").agg(F.count(F.lit(1)).alias("n")).select(F.lit("error").alias("level"), F.lit("assigned guide not in the library").alias("check"), "n")]
    if pattern:
        java = "^(?:" + pattern.replace("(?P<", "(?<") + ")"
        parts.append(library.agg(F.count_if(~F.col("guide").rlike(java)).alias("n")).select(F.lit("warning").alias("level"), F.lit("guide id does not match the target pattern").alias("check"), "n"))
    if table is not None:
        parts.append(duplicate_keys(table, "guide").agg(F.count(F.lit(1)).alias("n")).select(F.lit("error").alias("level"), F.lit("guide repeated in the map table").alias("check"), "n"))
        parts.append(library.join(table.select("guide"), "guide", "left_anti").agg(F.count(F.lit(1)).alias("n")).select(F.lit("warning").alias("level"), F.lit("library guide not in the map table").alias("check"), "n"))
    return reduce(DataFrame.unionByName, parts).where("n > 0")


def antibody_checks(table: DataFrame) -> DataFrame:
    """``feature_id`` must exist, be filled and be unique."""
    if "feature_id" not in table.columns:
        return table.sparkSession.createDataFrame([("error", "feature_id column is missing", 1)], "level string, check string, n bigint")
    dup = duplicate_keys(table, "feature_id").agg(F.count(F.lit(1)).alias("dup"))
    empty = table.agg(F.count_if(F.col("feature_id").isNull() | (F.trim("feature_id") == "")).alias("blank"))
    return _findings(dup.crossJoin(empty), [("error", "feature_id repeated", "dup"), ("error", "feature_id empty", "blank")])


def run_warnings(summary: DataFrame, limits: Mapping[str, tuple[float, str]]) -> DataFrame:
    """Rows for every summary column above its limit (the summary is one row)."""
    rows = F.array(*[F.when(F.col(c) > limit, F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"), F.lit(float(limit)).alias("limit"), F.lit(text).alias("warning"))) for c, (limit, text) in limits.items()])
    return summary.select(F.explode(F.array_compact(rows)).alias("_r")).select("_r.*")


def contract_checks(cells: DataFrame, expr: DataFrame, classes: Sequence[str]) -> DataFrame:
    """PASS / WARN / FAIL rules of the processed tables: classes, uniqueness, finite values, library sums, references."""
    c = cells.agg(
        F.count_if(~F.col("perturbation_class").isin(list(classes))).alias("unknown perturbation class"),
        F.count_if((F.col("perturbation_class") == "single_targeting") & (F.coalesce("target", F.lit("")) == "")).alias("targeting cell without a target"),
        F.count_if((F.col("perturbation_class") == "single_control") & (F.coalesce("control_class", F.lit("")) == "")).alias("control cell without a class"),
        F.count_if((F.col("perturbation_class") == "single_targeting") & (F.coalesce("control_class", F.lit("")) != "")).alias("targeting cell with a control class"))
    dup = duplicate_keys(cells, "cell_id").agg(F.count(F.lit(1)).alias("repeated cell id"))
    bad = F.col("lognorm").isNull() | F.isnan("lognorm") | (F.abs("lognorm") == float("inf"))
    e = expr.agg(F.count_if(bad).alias("value not finite"), F.count_if(F.col("lognorm") < 0).alias("negative normalised value"))
    sums = expr.groupBy("cell_id").agg(F.sum(F.expm1("lognorm")).alias("s"))
    off = sums.agg(F.count_if(F.abs(F.col("s") - 1e4) > 1.0).alias("library sum off target"))
    lost = expr.join(cells.select("cell_id"), "cell_id", "left_anti").agg(F.count(F.lit(1)).alias("entry without a cell row"))
    one = reduce(lambda a, b: a.crossJoin(b), [c, dup, e, off, lost])  # one row each
    warn = {"library sum off target"}
    rows = F.array(*[F.struct(F.lit(n).alias("check"), F.col(f"`{n}`").cast("bigint").alias("n"), F.when(F.col(f"`{n}`") == 0, "PASS").otherwise("WARN" if n in warn else "FAIL").alias("status")) for n in one.columns])
    return one.select(F.explode(rows).alias("_r")).select("_r.*")


def compare_tables(old: DataFrame, new: DataFrame, key: Sequence[str], tolerance: float = 1e-6) -> DataFrame:
    """SAME / NOTE / DIFF / ADD per column of two versions of a table, with row mismatches (column ``*``)."""
    key = list(key)
    shared = [c for c in old.columns if c in new.columns and c not in key]
    kinds = dict(old.dtypes)
    a = old.select(*key, *[F.col(c).alias(f"a_{c}") for c in shared], F.lit(True).alias("_ina"))
    b = new.select(*key, *[F.col(c).alias(f"b_{c}") for c in shared], F.lit(True).alias("_inb"))
    both = a.join(b, key, "full_outer")
    paired = F.col("_ina").isNotNull() & F.col("_inb").isNotNull()
    aggs = [F.count_if(F.col("_inb").isNull()).alias("_only_old"), F.count_if(F.col("_ina").isNull()).alias("_only_new")]
    for c in shared:
        x, y = F.col(f"a_{c}"), F.col(f"b_{c}")
        numeric = kinds[c] in ("double", "float", "int", "bigint")
        aggs.append((F.max(F.when(paired, F.abs(x - y))).cast("double") if numeric else F.lit(None).cast("double")).alias(f"d_{c}"))
        differs = ~x.eqNullSafe(y) & ((F.abs(x - y) > tolerance) | x.isNull() | y.isNull() if numeric else F.lit(True))
        aggs.append(F.count_if(paired & differs).alias(f"n_{c}"))
    stats = both.agg(*aggs)
    rows = [F.struct(F.lit("*").alias("column"), (F.col("_only_old") + F.col("_only_new")).alias("n_different"), F.lit(None).cast("double").alias("max_abs_diff"), F.when(F.col("_only_old") > 0, "DIFF").when(F.col("_only_new") > 0, "ADD").otherwise("SAME").alias("status"))]
    for c in shared:
        note = F.when(F.col(f"n_{c}") > 0, "DIFF").when(F.coalesce(F.col(f"d_{c}"), F.lit(0.0)) > 0, "NOTE").otherwise("SAME")
        rows.append(F.struct(F.lit(c).alias("column"), F.col(f"n_{c}").alias("n_different"), F.col(f"d_{c}").alias("max_abs_diff"), note.alias("status")))
    for c in new.columns:
        if c not in old.columns:
            rows.append(F.struct(F.lit(c).alias("column"), F.lit(0).cast("bigint").alias("n_different"), F.lit(None).cast("double").alias("max_abs_diff"), F.lit("ADD").alias("status")))
    for c in old.columns:
        if c not in new.columns:
            rows.append(F.struct(F.lit(c).alias("column"), F.lit(0).cast("bigint").alias("n_different"), F.lit(None).cast("double").alias("max_abs_diff"), F.lit("MISSING").alias("status")))
    return stats.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def parity_report(report: DataFrame) -> DataFrame:
    """MATCH / DIFF / MISSING view of a column comparison."""
    return report.withColumn("status", F.when(F.col("status").isin("SAME", "NOTE"), "MATCH").otherwise(F.col("status")))


def table_fingerprint(df: DataFrame) -> DataFrame:
    """Row count and order-free content sum of a table (one row)."""
    row = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.pmod(row, F.lit(1_000_003)).cast("bigint")).alias("content"))


def isotype_checks(panel: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """Antibodies whose flag disagrees with the isotype patterns."""
    return panel.where(F.col("is_isotype") != any_regex(F.col("protein"), patterns))
