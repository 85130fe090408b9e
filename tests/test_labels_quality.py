"""Guide calls, labels, alignment and filters on small designed inputs."""

import pytest
from pyspark.sql import functions as F

from guidewave.operators import align as A
from guidewave.operators import coverage as C
from guidewave.operators import filtering as X
from guidewave.operators import guides as G
from guidewave.operators import labels as L

CLASSES = {"non_targeting": ["^NO_SITE"], "safe": ["^SAFE"]}
PATTERN = r"^(?P<target>.+)_\d+$"


@pytest.fixture(scope="module")
def truth(spark):
    counts = {"c1": (10, 1, 0), "c2": (10, 6, 0), "c3": (2, 1, 0), "c4": (0, 0, 0), "c5": (5, 5, 5)}
    names = ["A_1", "B_1", "NO_SITE_1"]
    rows = [(c, g, u) for c, umis in counts.items() for g, u in zip(names, umis)]
    cells = spark.createDataFrame([(f"c{i}",) for i in range(1, 7)], "cell_id string")
    guides = spark.createDataFrame(list(zip(names, range(3))), "guide string, pos int")
    return cells, spark.createDataFrame(rows, "cell_id string, guide string, umi int"), guides


def test_dominant_and_threshold_calls(truth):
    cells, counts, guides = truth
    called = {r["cell_id"]: r for r in G.call_guides(cells, counts, guides, 3, 2.0, 3).collect()}
    want = {"c1": ("A_1", 1), "c2": ("ambiguous", 2), "c3": ("unassigned", 0), "c4": ("unassigned", 0), "c5": ("ambiguous", 3), "c6": ("unassigned", 0)}
    assert {c: (r["guide_dominant_call"], r["n_guides_detected"]) for c, r in called.items()} == want
    assert not called["c6"]["has_guide_counts"]
    lists = {r["cell_id"]: r["guides"] for r in G.assigned_lists(G.call_guides(cells, counts, guides, 3, 2.0, 5), "threshold").collect()}
    assert lists["c1"] == ["A_1"] and lists["c2"] == ["A_1", "B_1"] and lists["c5"] == ["A_1", "B_1", "NO_SITE_1"] and lists["c6"] == []


def test_second_gate(truth):
    cells, counts, guides = truth
    called = {r["cell_id"]: r["guide_dominant_call"] for r in G.call_guides(cells, counts, guides, 3, 1.5, 3, max_second_umi=0).collect()}
    assert called["c1"] == "ambiguous" and called["c2"] == "ambiguous"


def test_label_columns(spark):
    lists = spark.createDataFrame([("a", ["G1_1"]), ("b", ["NO_SITE_1"]), ("c", ["G1_1", "G1_2"]), ("d", ["NO_SITE_1", "SAFE_2"]), ("e", ["G1_1", "NO_SITE_1"]), ("f", [])], "cell_id string, guides array<string>")
    rows = {r["cell_id"]: r for r in L.label_cells(lists, PATTERN, CLASSES).collect()}
    got = {c: (r["perturbation_class"], r["perturbation"], r["n_targets"], r["control_class"]) for c, r in rows.items()}
    assert got == {"a": ("single_targeting", "G1", 1, ""), "b": ("single_control", "NO_SITE", 1, "non_targeting"), "c": ("multi_targeting", "multi", 1, ""),
                   "d": ("multi_control", "multi", 2, ""), "e": ("mixed_control_targeting", "multi", 2, ""), "f": ("unassigned", "unassigned", 0, "")}


def test_alignment_errors(spark):
    rna = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2), ("c", 3)], "cell_id string, pos int")
    adt = spark.createDataFrame([("b",), ("c",), ("z",)], "cell_id string")
    sets = {"rna": rna, "protein_counts": adt}
    assert [r["cell_id"] for r in A.align_cells(sets, ["rna", "protein"]).orderBy("pos").collect()] == ["b", "c"]
    report = A.alignment_report(sets, ["rna", "protein"])
    with pytest.raises(A.AlignmentError, match="twice"):
        A.check_alignment(report, ["rna", "protein"])
    A.check_alignment(report, ["rna", "protein"], fail_on_duplicates=False)
    with pytest.raises(A.AlignmentError, match="2 of 3"):
        A.check_alignment(report, ["rna", "protein"], fail_on_duplicates=False, min_overlap=0.9)
    with pytest.raises(A.AlignmentError, match="without"):
        A.align_cells(sets, ["guides"])


def test_filter_audit_conserves_cells(spark):
    rows = [(f"c{i}", i % 7, 100.0 * i, float(i % 11), i % 3) for i in range(60)]
    cells = spark.createDataFrame(rows, "cell_id string, n_genes_by_counts int, total_counts double, pct_counts_mt double, n_guides int")
    steps = X.strict_steps(min_genes=2, min_counts=500, max_pct_mt=9, cells="single_guide")
    audit = X.audit_cells(X.label_removed(cells, steps), steps).orderBy("step_order").collect()
    alive = rows
    tests = [lambda r: r[1] < 2, lambda r: r[2] < 500, lambda r: r[3] >= 9, lambda r: r[4] != 1]
    for row, fails in zip(audit[1:-1], tests):
        kept = [r for r in alive if not fails(r)]
        assert (row["cells_before"], row["cells_after"], row["cells_removed"]) == (len(alive), len(kept), len(alive) - len(kept))
        alive = kept
    assert audit[-1]["cells_after"] == len(alive)


def test_group_rules(spark):
    rows = [("T1", "single_targeting", "")] * 5 + [("T2", "single_targeting", "")] * 2 + [("NT", "single_control", "non_targeting")] * 3 + [("", "ambiguous", "")] * 9
    cells = spark.createDataFrame(rows, "target string, perturbation_class string, control_class string")
    groups = {r["target"]: r for r in L.cell_groups(cells, ["non_targeting"], 3).collect()}
    assert groups["T1"]["eligible"] and not groups["T2"]["eligible"] and groups["T1"]["n_control"] == 3
    none = {r["target"]: r for r in L.cell_groups(cells, ["other"], 3, 1).collect()}
    assert not none["T1"]["eligible"] and none["*"]["n_cells"] == 0


def test_margins(spark):
    cells = spark.createDataFrame([(0, "x"), (1, "x"), (1, "y")], "n_guides int, condition string")
    table = {(r["n_guides"], r["condition"]): r["n_cells"] for r in C.moi_table(cells, "condition").collect()}
    assert table[("All", "All")] == 3 and table[("1", "All")] == 2 and table[("All", "x")] == 2
    assert ("0", "y") not in table


def test_named_lists_keep_order(spark):
    df = spark.createDataFrame([("a", "G2_1; G1_1 ;")], "cell_id string, g string")
    assert L.guide_lists(df, metadata_guide="g").select(F.array_join("guides", ",").alias("x")).first()["x"] == "G2_1,G1_1"
