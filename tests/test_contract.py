"""The contract of the processed tables: clean tables pass, every planted fault is named."""

import pytest
from pyspark.sql import functions as F

from guidewave.operators import contract as CT

CELLS = "cell_id string, guide string, target string, n_guides int, control_class string, perturbation_class string, condition string, total_counts double, n_genes_by_counts long, pct_counts_mt double, pct_counts_ribo double, guide_total_counts double, guide_top string, guide_top_count double, guide_second_count double, is_ambiguous boolean, has_guide_counts boolean"


def clean(spark):
    make = spark.createDataFrame
    cells = [
        ("c1", "A_1", "A", 1, "", "single_targeting", "x", 5.0, 2, 10.0, 5.0, 9.0, "A_1", 8.0, 1.0, False, True),
        ("c2", "N_1", "NT", 1, "nt", "single_control", "x", 3.0, 1, 0.0, 0.0, 7.0, "N_1", 7.0, 0.0, False, True),
        ("c3", "", "", 0, "", "unassigned", "y", 4.0, 1, 1.0, 0.0, 0.0, "", 0.0, 0.0, False, False),
        ("c4", "", "", 0, "", "ambiguous", "y", 9.0, 2, 2.0, 0.0, 4.0, "A_1", 2.0, 2.0, True, True),
    ]
    counts = [("c1", "g1", 2.0, 0.5), ("c1", "g2", 3.0, 0.7), ("c2", "g1", 3.0, 1.0), ("c3", "g2", 4.0, 1.1), ("c4", "g1", 4.0, 0.4), ("c4", "g2", 5.0, 0.6)]
    space = [(f"c{k}", [float(k % 2), 1.0]) for k in range(1, 5)]
    return CT.with_views({
        "cells": make(cells, CELLS), "expr": make(counts, "cell_id string, feature string, count double, lognorm double"), "genes": make([("g1",), ("g2",)], "feature string"),
        "panel": make([("P", False, True, False), ("I", True, False, True)], "protein string, is_isotype boolean, used_in_embedding boolean, used_in_qc boolean"),
        "protein": make([("c1", "P", 0.5), ("c2", "P", None)], "cell_id string, protein string, value double"),
        "protein_counts": make([("c1", "P", 4.0), ("c1", "I", 1.0)], "cell_id string, protein string, count double"),
        "guide_counts": make([("c1", "A_1", 8.0), ("c1", "N_1", 1.0), ("c2", "N_1", 7.0), ("c4", "A_1", 2.0), ("c4", "N_1", 2.0)], "cell_id string, guide string, umi double"),
        "library": make([("A_1", "A"), ("N_1", "NT")], "guide string, target string"),
        "rna_pca": make(space, "cell_id string, vec array<double>"), "protein_pca": make(space[:2] + [("c3", None)], "cell_id string, vec array<double>"),
        "variance": make([(1, 0.4), (2, 0.2)], "pc int, ratio double"), "protein_variance": make([(1, 0.6), (2, 0.4)], "pc int, ratio double"),
        "loadings": make([(0, 1, 0.3)], "pos int, pc int, value double"),
        "steps": make([("input", 6, 4, 2, 2), ("final", 4, 4, 2, 2)], "step string, cells_before int, cells_after int, genes_before int, genes_after int"),
    })


RULES = CT.screen_rules(4, 2, 2)


def report(tables):
    return {r["check"]: r for r in CT.validate(tables, RULES).collect()}


def test_clean_tables_pass_every_rule(spark):
    found = report(clean(spark))
    assert len(found) == len(RULES) > 70
    assert {k: r["n"] for k, r in found.items() if r["status"] != CT.PASS} == {}
    assert CT.verdict(CT.validate(clean(spark), RULES)).first()["valid"]


def test_absent_tables_and_columns_are_skipped(spark):
    tables = {"cells": clean(spark)["cells"].drop("is_ambiguous")}
    found = report(tables)
    assert found["values finite"]["status"] == CT.SKIPPED and found["ambiguous cells labelled"]["status"] == CT.SKIPPED
    assert found["cells unique"]["status"] == CT.PASS


def put(column, value, where):
    return lambda df: df.withColumn(column, F.when(F.expr(where), F.lit(value).cast(df.schema[column].dataType)).otherwise(F.col(column)))


FAULTS = [
    ("cells", lambda df: df.unionByName(df.limit(1)), {"cells unique": "c1", "number of cells": None}),
    ("cells", put("perturbation_class", "odd", "cell_id = 'c4'"), {"classes known": "c4"}),
    ("cells", put("target", "", "cell_id = 'c2'"), {"single-guide cells have a target": "c2"}),
    ("cells", put("guide", "Z_9", "cell_id = 'c1'"), {"guides of cells are in the library": "Z_9", "dominant calls are the guides": "c1"}),
    ("cells", put("control_class", "nt", "cell_id = 'c1'"), {"targeting cells have no control class": "c1"}),
    ("cells", put("pct_counts_mt", 101.0, "cell_id = 'c3'"), {"pct_counts_mt is a percentage": "c3"}),
    ("cells", put("total_counts", None, "cell_id = 'c3'"), {"total_counts finite": "c3"}),
    ("cells", put("guide_total_counts", 30.0, "cell_id = 'c2'"), {"guide totals are the sums": "c2"}),
    ("cells", put("guide_second_count", 9.0, "cell_id = 'c1'"), {"top guide not below the second": "c1", "top guide within the total": "c1"}),
    ("cells", put("is_ambiguous", True, "cell_id = 'c1'"), {"ambiguous cells labelled": "c1"}),
    ("cells", put("has_guide_counts", True, "cell_id = 'c3'"), {"cells without guide counts flagged": "c3"}),
    ("cells", put("condition", "", "cell_id = 'c1'"), {"conditions present": None}),
    ("expr", put("lognorm", float("nan"), "cell_id = 'c1' AND feature = 'g1'"), {"values finite": "c1"}),
    ("expr", put("lognorm", -1.0, "cell_id = 'c2'"), {"values not negative": "c2"}),
    ("expr", put("count", 2.5, "cell_id = 'c1' AND feature = 'g1'"), {"counts whole": "c1"}),
    ("expr", put("cell_id", "zz", "cell_id = 'c3'"), {"entries belong to cells": "zz"}),
    ("expr", put("feature", "g9", "cell_id = 'c2'"), {"entries belong to genes": "g9"}),
    ("genes", lambda df: df.union(df.limit(1)), {"genes unique": None, "number of genes": None}),
    ("panel", put("used_in_embedding", True, "is_isotype"), {"isotypes not in the embedding": "I"}),
    ("panel", put("used_in_qc", False, "is_isotype"), {"isotypes in quality control": "I"}),
    ("protein", put("protein", "I", "cell_id = 'c1'"), {"no isotypes among protein values": "I"}),
    ("protein", put("value", float("inf"), "cell_id = 'c1'"), {"protein values finite": "c1"}),
    ("protein_counts", put("count", 1.5, "protein = 'I'"), {"protein counts whole": "c1"}),
    ("protein_counts", lambda df: df.where("protein <> 'I'"), {"isotypes kept among protein counts": "I"}),
    ("guide_counts", put("umi", -2.0, "cell_id = 'c2'"), {"guide counts whole and not negative": "c2"}),
    ("guide_counts", put("guide", "Q_1", "cell_id = 'c2'"), {"guide counts belong to the library": "Q_1"}),
    ("rna_pca", lambda df: df.withColumn("vec", F.when(F.col("cell_id") == "c2", F.array(F.lit(float("nan")), F.lit(1.0))).otherwise(F.col("vec"))), {"rna_pca finite": "c2"}),
    ("rna_pca", lambda df: df.withColumn("vec", F.when(F.col("cell_id") == "c2", F.array(F.lit(1.0))).otherwise(F.col("vec"))), {"rna_pca has one length": None}),
    ("variance", put("ratio", -0.1, "pc = 2"), {"shares fall with the component": None}),
    ("steps", put("cells_after", 9, "step = 'input'"), {"audit never gains cells": "input"}),
]


@pytest.mark.parametrize("table,fault,named", FAULTS, ids=[", ".join(n) for *_, n in FAULTS])
def test_planted_faults_are_named(spark, table, fault, named):
    tables = clean(spark)
    broken = CT.with_views({**{k: v for k, v in tables.items() if k not in ("isotypes", "targeting", "depth")}, table: fault(tables[table])})
    rules = [r for r in RULES if r.name in named]
    assert len(rules) == len(named)
    for r in CT.validate(broken, rules).collect():
        assert r["status"] == CT.FAIL and r["n"] > 0
        if named[r["check"]] is not None:
            assert r["example"] == named[r["check"]]


def test_broken_warnings_only_warn(spark):
    tables = clean(spark)
    tables["variance"] = tables["variance"].withColumn("ratio", F.lit(0.9))
    found = CT.validate(tables, [r for r in RULES if r.name == "first component has a sane share"])
    assert found.first()["status"] == CT.WARN and CT.verdict(found).first()["valid"]
