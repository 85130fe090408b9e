"""Group distances over small blocks against whole distance matrices."""

from __future__ import annotations

import numpy as np
import pytest

from guidewave.operators import distances as D
from guidewave.operators import pairblocks as PB


@pytest.fixture
def small_blocks(monkeypatch):
    """Blocks and tiles far smaller than the groups, so that every group is cut."""
    monkeypatch.setattr(PB, "MIN_BLOCK", 16)
    monkeypatch.setattr(PB, "MAX_BLOCK", 16)
    monkeypatch.setattr(PB, "TILE", 7)
    monkeypatch.setattr(PB, "_NUMBERED_AT_ONCE", 40)
    monkeypatch.setattr(D, "SMALL_TARGET", 20)


def groups(spark):
    rng = np.random.default_rng(5)
    vec = {"A": rng.normal(0.3, 1, (70, 4)), "B": rng.normal(0, 1, (37, 4)), "C": np.repeat(rng.normal(0, 1, (4, 4)), 3, axis=0), "D": rng.normal(1, 2, (5, 4)), "NT": rng.normal(0, 1, (61, 4))}
    vec["NT"][:9] = vec["A"][:9]
    rows = [(f"{t}{i:03d}", t, "single_control" if t == "NT" else "single_targeting", "non_targeting" if t == "NT" else "", x.tolist()) for t, v in vec.items() for i, x in enumerate(v)]
    return spark.createDataFrame(rows, "cell_id string, target string, perturbation_class string, control_class string, vec array<double>").repartition(5), vec


def test_cut_groups_keep_energy_permutations_and_mmd(spark, small_blocks):
    cells, vec = groups(spark)
    found = {r["target"]: r for r in D.perturbation_distance(cells, ["non_targeting"], min_cells=5, n_permutations=30, seed=9).collect()}
    plain = {r["target"]: r for r in D.perturbation_distance(cells, ["non_targeting"], min_cells=5, n_permutations=0, seed=9).collect()}
    names = spark.createDataFrame([("A", "9_0_A"), ("B", "9_1_B"), ("C", "9_2_C"), ("D", "9_3_D")], "target string, text string")
    seeds = dict(names.select("target", D.seed_from_text("text")).collect())
    for t in "ABCD":
        stat, p = D.permutation_p(vec[t], vec["NT"], 30, seeds[t])
        for rows in (found, plain):
            assert rows[t]["energy_distance"] == pytest.approx(stat, abs=1e-10)
            assert rows[t]["mmd_distance"] == pytest.approx(D.mmd_statistic(vec[t], vec["NT"]), abs=1e-10)
            assert (rows[t]["n_cells"], rows[t]["n_control"]) == (len(vec[t]), 61)
        assert found[t]["p_value"] == pytest.approx(p) and plain[t]["p_value"] is None


@pytest.mark.parametrize("metric, statistic", [("edistance", D.energy_statistic), ("mmd", D.mmd_statistic)])
def test_cut_groups_keep_pair_distances(spark, small_blocks, metric, statistic):
    cells, vec = groups(spark)
    found = {(r["target_a"], r["target_b"]): r["distance"] for r in D.pair_distances(cells, min_cells=5, metric=metric).collect()}
    want = {(a, b): statistic(vec[a], vec[b]) for a in "ABCD" for b in "ABCD" if a < b}
    assert found.keys() == want.keys()
    assert all(found[k] == pytest.approx(want[k], abs=1e-10) for k in want)


def test_no_task_sees_more_than_two_blocks(spark, small_blocks, monkeypatch):
    cells, _ = groups(spark)
    inner = PB._group_sums

    def bounded(x, gx, y, gy):
        if max(len(x), len(y)) > 2 * 16:
            raise ValueError("a block is larger than planned")
        return inner(x, gx, y, gy)

    monkeypatch.setattr(PB, "_group_sums", bounded)
    assert len(D.pair_distances(cells, min_cells=5).collect()) == 6


def test_cells_are_compared_once(spark, small_blocks):
    cells, _ = groups(spark)
    tables = [D.pair_distances(cells, min_cells=5), D.perturbation_distance(cells, ["non_targeting"], min_cells=5, n_permutations=0, secondary=None)]
    assert all("CoGroupsInArrow" not in t._jdf.queryExecution().optimizedPlan().toString() for t in tables)
