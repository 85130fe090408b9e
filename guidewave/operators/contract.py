"""Contract of a processed screen: declared rules, compiled into one aggregate pass per table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PASS, WARN, FAIL, SKIPPED = "PASS", "WARN", "FAIL", "SKIPPED"


@dataclass(frozen=True)
class Rule:
    """``holds`` is an SQL condition.

    ``kind`` row: it must hold in every row (null counts as broken).  table: it is an
    aggregate condition of the whole table.  unique: ``key`` must not repeat.
    refers: ``key`` must be in the table ``other``.  sums: ``holds`` is a column that must
    equal the sum of ``other``'s column ``of`` for the same ``key`` (no rows: 0).
    Only rows under ``where`` are judged.  A broken ``warn`` rule is a warning.
    """

    name: str
    table: str
    holds: str = "true"
    kind: str = "row"
    key: str = "cell_id"
    warn: bool = False
    where: str = "true"
    other: str = ""
    of: str = ""
    needs: tuple[str, ...] = ()


def applies(rule: Rule, tables: Mapping[str, DataFrame]) -> bool:
    """Whether the tables and columns that the rule needs are there."""
    named = [rule.table, *([rule.other] if rule.other else [])]
    return all(t in tables for t in named) and set(rule.needs) <= set(tables[rule.table].columns)


def _broken(rule: Rule) -> Column:
    return F.expr(f"({rule.where})") & ~F.coalesce(F.expr(f"({rule.holds})"), F.lit(False))


def _row(rule: Rule, n: Column, example: Column) -> Column:
    status = F.when(n == 0, PASS).otherwise(WARN if rule.warn else FAIL)
    return F.struct(F.lit(rule.name).alias("check"), F.lit(rule.table).alias("table"), status.alias("status"), n.cast("bigint").alias("n"), example.cast("string").alias("example"))


def _exploded(one: DataFrame, rows: list[Column]) -> DataFrame:
    return one.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def _pass(table: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All row and table rules of one table in one aggregate; the example is the least offending key."""
    aggregates, rows = [], []
    for k, rule in enumerate(rules):
        if rule.kind == "row":
            aggregates += [F.count_if(_broken(rule)).alias(f"n{k}"), F.min(F.when(_broken(rule), F.col(rule.key).cast("string"))).alias(f"e{k}")]
        else:
            aggregates += [F.coalesce(F.expr(f"CASE WHEN {rule.holds} THEN 0 ELSE 1 END"), F.lit(1)).alias(f"n{k}"), F.lit(None).cast("string").alias(f"e{k}")]
        rows.append(_row(rule, F.col(f"n{k}"), F.col(f"e{k}")))
    return _exploded(table.agg(*aggregates), rows)


def _keyed(tables: Mapping[str, DataFrame], rule: Rule) -> DataFrame:
    """A rule about keys: offenders are found by one shuffle on the key."""
    own = tables[rule.table].where(rule.where)
    if rule.kind == "unique":
        bad = own.groupBy(F.col(rule.key).alias("key")).agg(F.count("*").alias("c")).where("c > 1")
    elif rule.kind == "refers":
        bad = own.select(F.col(rule.key).alias("key")).distinct().join(tables[rule.other].select(F.col(rule.key).alias("key")).distinct(), "key", "left_anti")
    elif rule.kind == "sums":
        sums = tables[rule.other].groupBy(F.col(rule.key).alias("key")).agg(F.sum(rule.of).alias("_sum"))
        both = own.select(F.col(rule.key).alias("key"), F.expr(rule.holds).cast("double").alias("_said")).join(sums, "key", "left")
        bad = both.where(F.col("_said").isNull() | (F.abs(F.col("_said") - F.coalesce("_sum", F.lit(0.0))) > 1e-3))
    else:
        raise ValueError(f"unknown kind of rule: {rule.kind}")
    return _exploded(bad.agg(F.count("*").alias("n"), F.min(F.col("key").cast("string")).alias("e")), [_row(rule, F.col("n"), F.col("e"))])


def validate(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """(check, table, status, n, example): every rule with the number of broken rows or keys and the least of them.

    Each table is read once for all its row and table rules, and once more for every rule
    about keys.  A rule whose table or columns are absent is SKIPPED.
    """
    spark = next(iter(tables.values())).sparkSession
    parts, skipped = [], []
    by_table: dict[str, list[Rule]] = {}
    for rule in rules:
        if not applies(rule, tables):
            skipped.append((rule.name, rule.table, SKIPPED, 0, None))
        elif rule.kind in ("row", "table"):
            by_table.setdefault(rule.table, []).append(rule)
        else:
            parts.append(_keyed(tables, rule))
    parts += [_pass(tables[name], own) for name, own in by_table.items()]
    if skipped:
        parts.append(spark.createDataFrame(skipped, "check string, table string, status string, n bigint, example string"))
    return reduce(DataFrame.unionByName, parts)


def verdict(report: DataFrame) -> DataFrame:
    """Rules by outcome and whether the contract holds: no rule FAILs (one row)."""
    count = lambda s: F.count_if(F.col("status") == s).alias(f"n_{s.lower()}")
    return report.agg(*map(count, (PASS, WARN, FAIL, SKIPPED))).withColumn("valid", F.col("n_fail") == 0)


def _finite(column: str) -> str:
    return f"{column} IS NOT NULL AND abs({column}) < 1e300"


#: fixed values: the perturbation classes of the processed cells
CLASSES = ("single_targeting", "single_control", "multi_targeting", "multi_control", "mixed_control_targeting", "ambiguous", "unassigned")


def screen_rules(cells: int | None = None, genes: int | None = None, proteins: int | None = None) -> list[Rule]:
    """Rules of the processed tables; given numbers are what the caller expects.

    cells(cell_id, guide, target, ...), expr(cell_id, feature, count, lognorm), genes(feature),
    panel(protein, is_isotype, used_in_embedding, used_in_qc), protein(cell_id, protein, value),
    protein_counts(cell_id, protein, count), guide_counts(cell_id, guide, umi), library(guide, target),
    rna_pca / protein_pca(cell_id, vec), variance / protein_variance(pc, ratio), loadings(pos, pc, value),
    steps(step, cells_before, cells_after, genes_before, genes_after).
    """
    single = "perturbation_class IN ('single_targeting', 'single_control')"
    listed = ", ".join(f"'{c}'" for c in CLASSES)
    r: list[Rule] = []

    def add(name: str, table: str, holds: str = "true", **more) -> None:
        r.append(Rule(name, table, holds, **more))

    for name, table, n in (("cells", "cells", cells), ("genes", "genes", genes)):
        if n is not None:
            add(f"number of {name}", table, f"count(*) = {n}", kind="table")
    if proteins is not None:
        add("number of proteins", "panel", f"count(*) = {proteins}", kind="table")
    # identity
    add("cells unique", "cells", kind="unique")
    add("genes unique", "genes", kind="unique", key="feature")
    add("proteins unique", "panel", kind="unique", key="protein")
    add("guides unique", "library", kind="unique", key="guide")
    add("cell table not empty", "cells", "count(*) > 0", kind="table")
    add("cell ids filled", "cells", "cell_id IS NOT NULL AND cell_id <> ''")
    # values
    add("values finite", "expr", _finite("lognorm"), needs=("lognorm",))
    add("values not negative", "expr", "lognorm >= 0", needs=("lognorm",))
    add("counts whole", "expr", "abs(count - round(count)) < 1e-6", needs=("count",))
    add("counts not negative", "expr", "count >= 0", needs=("count",))
    add("value and count are zero together", "expr", "(count = 0) = (lognorm = 0)", needs=("count", "lognorm"))
    add("entries belong to cells", "expr", kind="refers", other="cells")
    add("entries belong to genes", "expr", kind="refers", key="feature", other="genes")
    add("count sums are the totals", "cells", "total_counts", kind="sums", other="expr", of="count", needs=("total_counts",), warn=True)
    # labels
    add("classes known", "cells", f"perturbation_class IN ({listed})", needs=("perturbation_class",))
    add("single-guide cells have a guide", "cells", "guide <> ''", where="n_guides = 1", needs=("guide", "n_guides"))
    add("single-guide cells have a target", "cells", "target <> ''", where="n_guides = 1", needs=("target", "n_guides"))
    add("single classes have one guide", "cells", "n_guides = 1", where=single, needs=("n_guides",))
    add("unassigned cells have no guide", "cells", "guide = '' AND n_guides = 0", where="perturbation_class = 'unassigned'", needs=("guide", "n_guides"))
    add("controls have a class", "cells", "control_class <> ''", where="perturbation_class = 'single_control'", needs=("control_class",))
    add("targeting cells have no control class", "cells", "control_class = ''", where="perturbation_class = 'single_targeting'", needs=("control_class",))
    add("cells beyond one guide kept", "cells", "count_if(n_guides <> 1) > 0", kind="table", warn=True, needs=("n_guides",))
    add("control cells present", "cells", "count_if(perturbation_class = 'single_control') > 0", kind="table", warn=True)
    add("conditions present", "cells", "count_if(condition IS NULL OR condition = '') = 0", kind="table", needs=("condition",))
    add("guides of cells are in the library", "cells", kind="refers", key="guide", other="library", where="guide <> ''", needs=("guide",))
    # quality columns
    for column in ("total_counts", "n_genes_by_counts", "pct_counts_mt", "pct_counts_ribo"):
        add(f"{column} finite", "cells", _finite(column), needs=(column,))
    for column in ("pct_counts_mt", "pct_counts_ribo"):
        add(f"{column} is a percentage", "cells", f"{column} BETWEEN 0 AND 100", needs=(column,))
    # filtering audit
    add("audit has input and final", "steps", "count_if(step = 'input') = 1 AND count_if(step = 'final') = 1", kind="table")
    add("audit never gains cells", "steps", "cells_after <= cells_before AND genes_after <= genes_before", key="step")
    if cells is not None:
        add("audit ends at the cells", "steps", f"max(CASE WHEN step = 'final' THEN cells_after END) = {cells}", kind="table")
    # proteins
    add("isotype controls identified", "panel", "count_if(is_isotype) > 0", kind="table", warn=True)
    add("targeting antibodies present", "panel", "count_if(NOT is_isotype) > 0", kind="table")
    add("isotypes not in the embedding", "panel", "NOT used_in_embedding", where="is_isotype", key="protein", needs=("used_in_embedding",))
    add("isotypes in quality control", "panel", "used_in_qc", where="is_isotype", key="protein", needs=("used_in_qc",))
    add("protein values finite", "protein", _finite("value"), where="value IS NOT NULL")
    add("protein values belong to the panel", "protein", kind="refers", key="protein", other="panel")
    add("protein values belong to cells", "protein", kind="refers", other="cells")
    add("no isotypes among protein values", "protein", kind="refers", key="protein", other="targeting")
    add("protein counts whole", "protein_counts", "abs(count - round(count)) < 1e-6")
    add("protein counts not negative", "protein_counts", "count >= 0")
    add("protein counts belong to the panel", "protein_counts", kind="refers", key="protein", other="panel")
    add("isotypes kept among protein counts", "isotypes", kind="refers", key="protein", other="protein_counts")
    # spaces
    for name in ("rna_pca", "protein_pca"):
        add(f"{name} finite", name, "forall(vec, x -> abs(x) < 1e300)", where="vec IS NOT NULL")
        add(f"{name} present", name, "count(vec) > 0", kind="table")
        add(f"{name} unique", name, kind="unique")
        add(f"{name} belongs to cells", name, kind="refers", other="cells")
        add(f"{name} has one length", name, "min(size(vec)) = max(size(vec))", kind="table")
    add("first component has a sane share", "variance", "max(CASE WHEN pc = 1 THEN ratio END) BETWEEN 1e-9 AND 0.5", kind="table", warn=True)
    add("shares fall with the component", "variance", "sum(ratio) <= 1 + 1e-6 AND min(ratio) >= 0", kind="table")
    add("protein components explain most", "protein_variance", "sum(ratio) > 0.8", kind="table", warn=True)
    add("loadings bounded", "loadings", "abs(value) < 0.9", key="pos", warn=True)
    add("first component not library size", "depth", "abs(corr(pc1, log_total)) < 0.9", kind="table", warn=True)
    add("first component not mitochondrial", "depth", "abs(corr(pc1, pct_counts_mt)) < 0.7", kind="table", warn=True)
    # guides
    add("guide counts whole and not negative", "guide_counts", "umi >= 0 AND abs(umi - round(umi)) < 1e-6")
    add("guide counts belong to cells", "guide_counts", kind="refers", other="cells")
    add("guide counts belong to the library", "guide_counts", kind="refers", key="guide", other="library")
    add("guide totals are the sums", "cells", "guide_total_counts", kind="sums", other="guide_counts", of="umi", needs=("guide_total_counts",))
    add("top guide not below the second", "cells", "guide_top_count >= guide_second_count", needs=("guide_top_count", "guide_second_count"))
    add("top guide within the total", "cells", "guide_top_count + guide_second_count <= guide_total_counts", needs=("guide_top_count", "guide_second_count", "guide_total_counts"))
    add("dominant calls are the guides", "cells", "guide_top = guide", where=single, needs=("guide_top", "guide"))
    add("ambiguous cells labelled", "cells", "(perturbation_class = 'ambiguous') = is_ambiguous", needs=("is_ambiguous",))
    add("cells without guide counts flagged", "cells", "has_guide_counts = (guide_total_counts > 0)", needs=("has_guide_counts", "guide_total_counts"))
    return r


def with_views(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """``tables`` with what rules derive from them: the two halves of the panel, and depth beside the first component."""
    found = dict(tables)
    if "panel" in found:
        found |= {"isotypes": found["panel"].where("is_isotype"), "targeting": found["panel"].where("NOT is_isotype")}
    if "rna_pca" in found and "cells" in found and {"total_counts", "pct_counts_mt"} <= set(found["cells"].columns):
        depth = found["cells"].select("cell_id", F.log1p(F.col("total_counts").cast("double")).alias("log_total"), "pct_counts_mt")
        found["depth"] = found["rna_pca"].select("cell_id", F.element_at("vec", 1).alias("pc1")).join(depth, "cell_id")
    return found
