"""Knockdown, enrichment, rank tests and protein effects against direct computation."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from guidewave.operators import effects as EF
from guidewave.operators import enrichment as E
from guidewave.operators import genetests as GT
from guidewave.operators import knockdown as K
from guidewave.operators import ranktests as R


#: cells and mean count of the target's own gene; None: the gene is not measured
TARGETS = {"strong": (64, 0.3), "mild": (48, 1.4), "flat": (52, 4.0), "risen": (45, 11.0), "offpanel": (24, None), "mute": (22, 0.0), "scant": (6, 0.3)}
N_CONTROL, N_DOUBLE, USUAL = 150, 20, 4.0


def screen(seed=11):
    """A screen of designed knockdowns: one table of genes x cells drawn at once, its rates set per target."""
    rng = np.random.default_rng(seed)
    labels = [("ctrl", "single_control", "non_targeting")] * N_CONTROL + [("", "ambiguous", "")] * N_DOUBLE
    labels += [(t, "single_targeting", "") for t, (n, _) in TARGETS.items() for _ in range(n)]
    genes = [t for t in TARGETS if t != "offpanel"] + [f"other{i}" for i in range(9)]
    rate = np.full((len(labels), len(genes)), USUAL)
    for j, g in enumerate(genes):
        if g in TARGETS:
            rate[[k for k, label in enumerate(labels) if label[0] == g], j] = TARGETS[g][1]
    rate[:, genes.index("mute")] = 0.0
    counts = rng.poisson(rate)
    cells = [(f"c{k:03d}", *label) for k, label in enumerate(labels)]
    expr = [(cells[k][0], genes[j], float(np.log1p(counts[k, j]))) for k, j in zip(*np.nonzero(counts))]
    return cells, expr, genes


@pytest.fixture(scope="module")
def tables(spark):
    cells, expr, genes = screen()
    return (spark.createDataFrame(cells, "cell_id string, target string, perturbation_class string, control_class string"),
            spark.createDataFrame(expr, "cell_id string, feature string, lognorm double"), spark.createDataFrame([(g,) for g in genes], "feature string"), cells, expr)


def test_perturbation_strength(tables):
    cells, expr, features, raw_cells, raw_expr = tables
    table = {r["target"]: r for r in K.perturbation_strength(cells, expr, features, ["non_targeting"]).collect()}
    assert set(table) == {"strong", "mild", "flat", "risen"}
    assert {t for t, r in table.items() if r["is_hit_ntc"]} == {"strong", "mild"}
    perturbed = sum(n for n, _ in TARGETS.values())
    assert table["strong"]["rank"] == 1 and table["strong"]["n_control_other"] == perturbed - TARGETS["strong"][0]
    value = {(c, g): v for c, g, v in raw_expr}
    own = np.array([value.get((c, "mild"), 0.0) for c, t, k, _ in raw_cells if t == "mild"])
    ctrl = np.array([value.get((c, "mild"), 0.0) for c, t, k, _ in raw_cells if k == "single_control"])
    assert table["mild"]["log2fc_ntc"] == pytest.approx(math.log2((np.expm1(own).mean() + 0.01) / (np.expm1(ctrl).mean() + 0.01)))
    grid = np.unique(np.concatenate([own, ctrl]))
    d = max(abs((own <= x).mean() - (ctrl <= x).mean()) for x in grid)
    assert table["mild"]["ks_stat_ntc"] == pytest.approx(d)


def test_skip_reasons(tables):
    cells, expr, features, _, _ = tables
    targets = K.target_genes(K.target_sizes(cells, ["non_targeting"]))
    counts = K.own_gene_counts(cells, expr, targets, ["non_targeting"])
    reasons = {r["target"]: r["reason"] for r in K.eligibility(targets, K.knockdown_effect(counts), features).collect()}
    assert reasons["offpanel"] == "target gene not present in the expression matrix"
    assert reasons["scant"] == "fewer than 10 perturbed cells"
    assert reasons["mute"].startswith("not detectably expressed") and reasons["strong"] is None


def test_excluded_cells_change_nothing(tables):
    cells, expr, _, _, _ = tables
    def effect(c):
        targets = K.target_genes(K.target_sizes(c, ["non_targeting"]))
        return {r["target"]: r["log2fc_other"] for r in K.knockdown_effect(K.own_gene_counts(c, expr, targets, ["non_targeting"])).collect()}
    assert effect(cells) == pytest.approx(effect(cells.where("perturbation_class <> 'ambiguous'")))


def test_cluster_markers(tables):
    cells, expr, features, raw_cells, raw_expr = tables
    clusters = cells.select("cell_id", F.when(F.col("target") == "risen", "1").otherwise("0").alias("cluster"))
    for method in ("wilcoxon", "t-test", "t-test_overestim_var"):
        markers = GT.cluster_markers(clusters, expr, features, method)
        best = markers.where("cluster = '1'").orderBy(F.col("score").desc()).first()
        assert best["feature"] == "risen" and best["logfoldchange"] > 0
    score = markers = GT.cluster_markers(clusters, expr, features).where("cluster = '1' AND feature = 'other0'").first()["score"]
    value = {(c, g): v for c, g, v in raw_expr}
    x = np.array([value.get((c[0], "other0"), 0.0) for c in raw_cells])
    mask = np.array([c[1] == "risen" for c in raw_cells])
    ranks = np.array([(np.sum(x < v) + (np.sum(x == v) + 1) / 2) for v in x])
    n, m = mask.sum(), (~mask).sum()
    want = (ranks[mask].sum() - n * (n + m + 1) / 2) / math.sqrt(n * m * (n + m + 1) / 12)
    assert score == pytest.approx(want)
    panel = GT.marker_panel(GT.cluster_markers(clusters, expr, features), 3)
    assert "risen" in {r["feature"] for r in panel.collect()}


def enrichment_cells(spark):
    rng = np.random.default_rng(5)
    rows = [(f"n{i}", "NT", "single_control", "non_targeting", "NT_1", str(i % 3), f"s{i % 2}") for i in range(300)]
    for t, probs in (("EN", (0.9, 0.05, 0.05)), ("DE", (0.5, 0.0, 0.5)), ("NU", (1 / 3, 1 / 3, 1 / 3))):
        for i in range(90):
            guide = f"{t}_{i % 3 + 1}"
            p = (1 / 3, 1 / 3, 1 / 3) if guide == "EN_3" else probs
            rows.append((f"{t}{i}", t, "single_targeting", "", guide, str(rng.choice(3, p=p)), f"s{i % 2}"))
    rows += [(f"a{i}", "", "ambiguous", "", "", "1", "s0") for i in range(60)]
    return spark.createDataFrame(rows, "cell_id string, target string, perturbation_class string, control_class string, guide string, cluster string, sample string")


def hypergeometric_two_sided(a, b, c, d):
    row, col, n = a + b, a + c, a + b + c + d
    pmf = {x: math.comb(col, x) * math.comb(n - col, row - x) for x in range(max(0, col - (n - row)), min(row, col) + 1)}
    return sum(v for v in pmf.values() if v <= pmf[a] * (1 + 1e-7)) / math.comb(n, row)


def test_cluster_enrichment(spark):
    cells = enrichment_cells(spark)
    table = E.cluster_enrichment(cells, ["non_targeting"], "other").collect()
    assert len(table) == 3 * 3 * 2
    for r in table:
        assert r["pval_fisher"] == pytest.approx(hypergeometric_two_sided(r["a"], r["b"], r["c"], r["d"]), rel=1e-7)
    hits = {(r["target"], r["cluster"]): r for r in table if r["significant"]}
    assert hits[("EN", "0")]["direction"] == "enriched" and hits[("DE", "1")]["direction"] == "depleted"
    assert all(r["control"] == "other" for r in hits.values()) and hits[("EN", "0")]["guides_tested"] == 3
    clean = {(r["target"], r["cluster"], r["control"]): r["pval"] for r in E.cluster_enrichment(cells.where("perturbation_class <> 'ambiguous'"), ["non_targeting"], "other").collect()}
    assert clean == pytest.approx({(r["target"], r["cluster"], r["control"]): r["pval"] for r in table})


def test_stratified_and_omnibus(spark):
    cells = enrichment_cells(spark)
    table = {(r["target"], r["cluster"]): r for r in E.cluster_enrichment(cells, ["non_targeting"], "ntc", stratify_by="sample").where("control = 'ntc'").collect()}
    assert table[("EN", "0")]["cmh_n_strata"] == 2 and table[("EN", "0")]["pval"] < 1e-3 and table[("EN", "0")]["cmh_odds_ratio"] > 2
    row = E.omnibus_permutation(cells, 40).first()
    assert row["p_permutation"] == pytest.approx(1 / 41)
    chi = E.omnibus_chi2(cells).first()
    assert chi["dof"] == 4 and chi["p_chi2"] < 1e-6


def test_omnibus_draws_inside_the_tasks(spark, monkeypatch):
    """Every draw is the hash of (seed, permutation, cell), also when a batch is cut; no draw is a row of the plan."""
    from collections import Counter
    from hashlib import sha256

    monkeypatch.setattr(E, "DRAWS_AT_ONCE", 70)
    cells = enrichment_cells(spark)
    found = E.omnibus_permutation(cells, 30, seed=4)
    assert "Generate" not in found._jdf.queryExecution().toString()
    rows = cells.where("perturbation_class = 'single_targeting'").select("cell_id", "target", "cluster").collect()
    of_target, of_cluster = Counter(r["target"] for r in rows), Counter(r["cluster"] for r in rows)

    def spread(pairs):
        pairs = list(pairs)
        cols = Counter(c for _, c in pairs)
        return sum(o * o / (of_target[t] * cols[c]) for (t, c), o in Counter(pairs).items())

    names = sorted(of_cluster)
    upper = np.cumsum([of_cluster[c] for c in names]) / len(rows)
    cluster = lambda perm, cell: names[int(np.argmax(upper > int(sha256(f"4|{perm}|{cell}".encode()).hexdigest()[:12], 16) / 16.0**12))]
    observed = spread((r["target"], r["cluster"]) for r in rows)
    hits = sum(spread((r["target"], cluster(k, r["cell_id"])) for r in rows) >= observed for k in range(1, 31))
    assert found.first().asDict() == {"n_ge": hits, "n_permutations": 30, "p_permutation": (hits + 1) / 31}


def test_spearman_and_kruskal(spark):
    rng = np.random.default_rng(2)
    x, g = rng.integers(0, 6, 80), rng.integers(0, 3, 80)
    y = x + rng.normal(0, 2, 80).round(1)
    df = spark.createDataFrame([(int(a), float(b), str(c)) for a, b, c in zip(x, y, g)] + [(None, 1.0, "0")], "x int, y double, g string")
    rank = lambda v: np.array([(np.sum(v < q) + (np.sum(v == q) + 1) / 2) for q in v])
    got = R.spearman(df, [], "x", "y").first()
    assert got["rho"] == pytest.approx(np.corrcoef(rank(x), rank(y))[0, 1]) and got["n_pairs"] == 80
    r = rank(y)
    ties = sum(c**3 - c for c in np.unique(y, return_counts=True)[1])
    h = (12 / (80 * 81) * sum(r[g == k].sum() ** 2 / (g == k).sum() for k in range(3)) - 3 * 81) / (1 - ties / (80**3 - 80))
    assert R.kruskal_wallis(df.where("x IS NOT NULL"), [], "g", "y").first()["statistic"] == pytest.approx(h)
    assert R.spearman(df.limit(2), [], "x", "y").first()["rho"] is None


def test_protein_rank_sums_share_controls(spark):
    rng = np.random.default_rng(4)
    control, own = rng.normal(0, 1, 60).round(1), rng.normal(0.6, 1, 25).round(1)
    cells = [(f"n{i}", "NT", "single_control", "non_targeting") for i in range(60)] + [(f"t{i}", "T", "single_targeting", "") for i in range(25)]
    values = [(f"n{i}", "P", float(v)) for i, v in enumerate(control)] + [(f"t{i}", "P", float(v)) for i, v in enumerate(own)]
    out = EF.protein_effects(spark.createDataFrame(cells, "cell_id string, target string, perturbation_class string, control_class string"), spark.createDataFrame(values, "cell_id string, protein string, value double"), ["non_targeting"]).first()
    u = sum(np.sum(control < v) + np.sum(control == v) / 2 for v in own)
    n, m = 25, 60
    ties = sum(c**3 - c for c in np.unique(np.concatenate([control, own]), return_counts=True)[1])
    sd = math.sqrt(n * m / 12 * (n + m + 1 - ties / ((n + m) * (n + m - 1))))
    p = math.erfc((max(u, n * m - u) - n * m / 2 - 0.5) / sd / math.sqrt(2))
    assert out["u"] == pytest.approx(u) and out["p_value"] == pytest.approx(p)
    assert out["effect"] == pytest.approx(own.mean() - control.mean()) and out["status"].startswith("low_support")
