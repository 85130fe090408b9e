"""Readers, bundles and writers on small files."""

import gzip

import pytest

from guidewave.operators import checks as DQ
from guidewave.sources import bundles as BU
from guidewave.sources import sinks as SK
from guidewave.sources import text as TX


def test_dense_matrix_both_orientations(spark, tmp_path):
    a, b = tmp_path / "a.csv", tmp_path / "b.csv.gz"
    a.write_text('GENE,"c1",c2\ng1,1,0\ng2,0,2.5\n')
    with gzip.open(b, "wt") as fh:
        fh.write("GENE,c3\ng1,0\ng2,7\n")
    rows = {tuple(r) for r in TX.read_dense_files(spark, [str(a), str(b)]).collect()}
    assert rows == {("c1", "g1", 1.0), ("c2", "g2", 2.5), ("c3", "g2", 7.0)}
    t = tmp_path / "t.tsv"
    t.write_text("cell\tg1\tg2\nc1\t1\t0\nc2\t0\t3\n")
    assert {tuple(r) for r in TX.read_dense_matrix(spark, str(t), "cells_x_features").collect()} == {("c1", "g1", 1.0), ("c2", "g2", 3.0)}
    bad = tmp_path / "bad.csv"
    bad.write_text("GENE,c9\ng2,1\ng1,1\n")
    with pytest.raises(TX.InputError):
        TX.read_dense_files(spark, [str(a), str(bad)])


def test_triplets_sum_duplicates_and_check_dimensions(spark, tmp_path):
    (tmp_path / "barcodes.tsv").write_text("b1\nb2\n")
    (tmp_path / "features.tsv").write_text("g1\tA\nCD3\tCD3\tAntibody Capture\n")
    (tmp_path / "matrix.mtx").write_text("%%MatrixMarket matrix coordinate integer general\n%c\n2 2 3\n1 1 2\n1 1 3\n2 2 4\n")
    expr, features = TX.read_triplet_directory(spark, str(tmp_path))
    assert {tuple(r) for r in expr.collect()} == {("b1", "g1", 5.0), ("b2", "CD3", 4.0)}
    assert [r["feature_type"] for r in features.orderBy("pos").collect()] == ["Gene Expression", "Antibody Capture"]
    (tmp_path / "barcodes.tsv").write_text("b1\n")
    with pytest.raises(TX.InputError):
        TX.read_triplet_directory(spark, str(tmp_path))


def test_subset_round_trip(spark, tmp_path):
    cells = spark.createDataFrame([("c1", 5), ("c2", 70000), ("c3", 200000)], "cell_id string, pos int")
    genes = spark.createDataFrame([("g1", "A", "Gene Expression", 3), ("g2", "B", "Gene Expression", 9)], "feature_id string, feature_name string, feature_type string, pos int")
    expr = spark.createDataFrame([("c1", "g1", 1.0), ("c2", "g2", 4.0), ("c3", "g1", 2.0), ("x", "g1", 9.0)], "cell_id string, feature string, value double")
    SK.write_triplets(expr, cells, genes, str(tmp_path / "s"))
    back, features = TX.read_triplet_directory(spark, str(tmp_path / "s"))
    assert {tuple(r) for r in back.collect()} == {("c1", "g1", 1.0), ("c2", "g2", 4.0), ("c3", "g1", 2.0)} and features.count() == 2


def test_unique_names_skip_taken_suffixes(spark):
    df = spark.createDataFrame(list(enumerate(["A", "A", "A-1", "B", "A"])), "pos int, feature_name string")
    names = [r["feature"] for r in TX.unique_names(df).orderBy("pos").collect()]
    assert names == ["A", "A-2", "A-1", "B", "A-3"] and len(set(names)) == 5


def test_tables_and_assignments(spark, tmp_path):
    meta = tmp_path / "m.csv"
    meta.write_text("NAME,condition,MOI\nTYPE,group,numeric\nc1,x,1\nc2,,2\n")
    rows = {r["NAME"]: r for r in TX.read_table(spark, str(meta), index="NAME").collect()}
    assert set(rows) == {"c1", "c2"} and rows["c2"]["condition"] == "" and rows["c1"]["MOI"] == "1"
    guides = tmp_path / "g.txt"
    guides.write_text('Cell\tsgRNAs\nc1\t"A_1, B_2 ,"\nc2\t\n')
    got = {r["cell_id"]: r["guides"] for r in TX.read_guide_assignments(spark, str(guides)).collect()}
    assert got == {"c1": ["A_1", "B_2"], "c2": []}
    with pytest.raises(TX.InputError):
        TX.read_embedding(spark, str(meta), ["X"])


def test_typed_table_has_a_file_per_partition(spark, tmp_path):
    rows = [(f"c{i}", "TYPE" if i == 7 else f"x,{i}", None if i == 3 else "s") for i in range(40)] + [("TYPE", "later", "row")]
    table = spark.createDataFrame(rows, "NAME string, condition string, sample string").repartition(4)
    SK.write_typed_table(table, {"NAME": "TYPE", "condition": "group", "sample": "group"}, str(tmp_path / "m.csv"))
    files = [f.read_text().splitlines() for f in sorted((tmp_path / "m.csv").glob("*.csv"))]
    assert len(files) == 4 and all(f[:2] == ["NAME,condition,sample", "TYPE,group,group"] and len(f) < 30 for f in files)
    back = TX.read_table(spark, str(tmp_path / "m.csv"), index="NAME")
    assert sorted(map(tuple, back.collect())) == sorted((n, c, s or "") for n, c, s in rows)


def test_lanes_and_types(spark):
    part = spark.createDataFrame([("b", "g", 1.0)], "cell_id string, feature string, value double")
    merged, lanes = BU.concat_lanes([("L1", part), ("L2", part)])
    assert {r["cell_id"] for r in merged.collect()} == {"b__L1", "b__L2"} and lanes.count() == 2
    with pytest.raises(BU.InputError):
        BU.concat_lanes([("L1", part), ("L1", part)])
    features = spark.createDataFrame([("g", "Gene Expression"), ("x", "Odd")], "feature_id string, feature_type string")
    with pytest.raises(BU.InputError):
        BU.split_feature_types(part, features, {"rna": ["Gene Expression"]})
    with pytest.raises(BU.InputError):
        BU.load_inputs({"rna": part}, (part, features.where("feature_id = 'g'"), {"rna": ["Gene Expression"]}))
    sheet = spark.createDataFrame([("L1", "x")], "lane_id string, condition string")
    with pytest.raises(BU.InputError):
        BU.attach_lane_sheet(lanes, sheet)


def test_processed_slots_and_comparison(spark, tmp_path):
    part = spark.createDataFrame([("b", "g", 1.0), ("c", "g", 2.0)], "cell_id string, feature string, value double")
    BU.write_slot(part, str(tmp_path / "slots"), "layers", "counts")
    assert BU.read_slot(spark, str(tmp_path / "slots"), "layers", "counts").count() == 2
    with pytest.raises(BU.InputError):
        BU.read_slot(spark, str(tmp_path / "slots"), "X")
    changed = spark.createDataFrame([("b", "g", 1.0), ("c", "g", 2.5)], part.schema)
    report = {r["column"]: (r["status"], r["n_different"]) for r in DQ.compare_tables(part, changed, ["cell_id", "feature"]).collect()}
    assert report == {"*": ("SAME", 0), "value": ("DIFF", 1)}


def test_dense_lines_fill_absent_counts_without_a_lookup_per_cell(spark):
    from guidewave.plans.queries_h_sources import dense_lines

    cells = spark.createDataFrame([(f"C{i}", i) for i in (11, 2, 30, 7)], "cell_id string, pos int")
    rows = spark.createDataFrame([("C2", "g2", 4.0), ("C30", "g1", 1.0), ("C7", "g2", 9.0)], "cell_id string, feature string, value double")
    lines = dense_lines(rows, cells)
    assert [r["value"] for r in lines.orderBy("k", "feature").collect()] == ["GENE,C2,C7,C11,C30", "g1,0,0,0,1", "g2,4,9,0,0"]
    assert "map_from_entries" not in lines._jdf.queryExecution().toString()
