"""Tails, ranks, quantiles and adjusted p-values against brute force."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from guidewave.functions import ordering as O
from guidewave.functions import scalars, tails


def ks_by_enumeration(n, m):
    """Tail of the two-sample KS distance over all orders of n + m distinct values."""
    seen = {}
    for chosen in itertools.combinations(range(n + m), n):
        inside, i, j, worst = set(chosen), 0, 0, 0
        for k in range(n + m):
            i, j = (i + 1, j) if k in inside else (i, j + 1)
            worst = max(worst, abs(i * m - j * n))
        seen[worst] = seen.get(worst, 0) + 1
    total = sum(seen.values())
    return {d: sum(c for k, c in seen.items() if k >= d) / total for d in seen}


@pytest.mark.parametrize("n,m", [(3, 5), (4, 4), (6, 7)])
def test_ks_exact(n, m):
    for d, p in ks_by_enumeration(n, m).items():
        assert tails.ks_exact(n, m, d / (n * m)) == pytest.approx(p, abs=1e-12)


def test_ks_limit_agrees_for_large_samples():
    assert tails.ks_exact(3000, 3000, 0.04) == pytest.approx(tails.ks_limit(3000, 3000, 0.04), rel=0.1)


@pytest.mark.parametrize("n,m", [(2, 5), (4, 4), (5, 7)])
def test_rank_sum_distribution(n, m):
    f = np.zeros(n * m + 1)
    for chosen in itertools.combinations(range(1, n + m + 1), n):
        f[sum(chosen) - n * (n + 1) // 2] += 1
    assert np.allclose(f / f.sum(), tails.rank_sum_distribution(n, m))


def test_continuous_tails(spark):
    row = spark.range(1).select(
        tails.student_two_sided(F.lit(2.0), F.lit(10.0)).alias("t"), tails.normal_upper(F.lit(1.96)).alias("z"),
        tails.chi2_upper(F.lit(3.841458820694124), F.lit(1)).alias("c"), tails.correlation_two_sided(F.lit(0.5), F.lit(20)).alias("r")).first()
    # tabulated values
    assert row["t"] == pytest.approx(0.07338803, abs=1e-7)
    assert row["z"] == pytest.approx(0.02499790, abs=1e-7)
    assert row["c"] == pytest.approx(0.05, abs=1e-9)
    assert row["r"] == pytest.approx(0.02477, abs=1e-4)


def test_tied_rank_sum_normal(spark):
    """All values tied: no evidence."""
    row = spark.range(1).select(tails.rank_sum_two_sided(F.lit(20), F.lit(30), F.lit(300.0), F.lit(50.0**3 - 50)).alias("p")).first()
    assert row["p"] == 1.0


def test_seed_and_lists(spark):
    row = spark.range(1).select(scalars.seed_from_text(F.lit("123_0_JAK2")).alias("s"), scalars.split_list(F.lit(" a , ,b,c "), ",").alias("l"), scalars.significant3(F.lit(0.0123456)).alias("g")).first()
    assert row["s"] == 367703133
    assert row["l"] == ["a", "b", "c"]
    assert row["g"] == "0.0123"


def skewed(seed=0):
    """Values of three groups, one holding most rows, with heavy ties and negative values."""
    rng = np.random.default_rng(seed)
    rows = [("hot", float(v)) for v in np.round(rng.normal(0, 2, 700), 2)] + [("hot", 0.0)] * 300
    rows += [("warm", float(v)) for v in rng.exponential(1e4, 120)] + [("cold", float(v)) for v in rng.normal(0, 1e-8, 7)]
    return rows


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_quantiles_and_ranks_do_not_depend_on_partitions(spark, partitions):
    rows = skewed()
    df = spark.createDataFrame(rows, "g string, v double").repartition(partitions)
    got = {r["g"]: r for r in O.exact_quantiles(df, ["g"], "v", {"q10": 0.1, "q50": 0.5, "q99": 0.99}).collect()}
    ranks = {(r["g"], r["v"]): r["rank"] for r in O.average_ranks(df, ["g"], "v").collect()}
    for g in ("hot", "warm", "cold"):
        values = np.array([v for k, v in rows if k == g])
        for name, q in (("q10", 0.1), ("q50", 0.5), ("q99", 0.99)):
            assert got[g][name] == pytest.approx(float(np.quantile(values, q)), abs=1e-12, rel=1e-9)
        order = np.sort(values)
        for v in set(values[:40]):
            where = np.flatnonzero(order == v) + 1
            assert ranks[(g, v)] == pytest.approx(where.mean())


def test_bh_adjust(spark):
    rng = np.random.default_rng(1)
    p = np.concatenate([rng.uniform(0, 1, 200), rng.uniform(0, 1e-6, 20), [0.0, 1.0, 1.0, 0.5, 0.5]])
    rows = [(i, f, float(x)) for f in ("a", "b") for i, x in enumerate(p if f == "a" else p[:50])] + [(999, "a", None)]
    got = {(r["f"], r["i"]): r["q"] for r in O.bh_adjust(spark.createDataFrame(rows, "i int, f string, p double"), "p", "q", ["f"]).collect()}
    assert got[("a", 999)] is None
    for f, values in (("a", p), ("b", p[:50])):
        for i, x in enumerate(values):
            want = min(min(y * len(values) / np.sum(values <= y) for y in values if y >= x), 1.0)
            assert got[(f, i)] == pytest.approx(want, abs=1e-12)


def test_hash_rank_is_a_permutation(spark):
    df = spark.range(500).select(F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("h"))
    rows = O.hash_rank(df, [], "h").orderBy("h").collect()
    assert [r["draw"] for r in rows] == list(range(1, 501)) and rows[0]["draw_of"] == 500
    assert math.isclose(sum(r["draw"] for r in rows), 500 * 501 / 2)
