"""Supervised projection, graph weights, communities, variable genes from counts, and regression markers against brute force."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from guidewave.operators import communities as C
from guidewave.operators import connectivities as CN
from guidewave.operators import discriminant as D
from guidewave.operators import grouping as GR
from guidewave.operators import markers as MK
from guidewave.operators import taskgraph as TG
from guidewave.operators import variable as VG

# supervised projection


def brute_covariance(x):
    """Shrunk covariance by its definition, row by row."""
    n, p = x.shape
    scale = x.std(0)
    scale[scale == 0] = 1.0
    z = (x - x.mean(0)) / scale
    emp = z.T @ z / n
    mu = np.trace(emp) / p
    delta = ((emp - mu * np.eye(p)) ** 2).sum() / p
    beta = min(sum(((np.outer(r, r) - emp) ** 2).sum() for r in z) / n**2 / p, delta)
    w = beta / delta if beta > 0 else 0.0
    return ((1 - w) * emp + w * mu * np.eye(p)) * np.outer(scale, scale), w


def planted(seed=0, p=6):
    rng = np.random.default_rng(seed)
    centres = {"NT": np.zeros(p), "A": np.r_[4.0, np.zeros(p - 1)], "B": np.r_[0.0, 3.0, np.zeros(p - 2)], "C": np.r_[0.2, np.zeros(p - 1)]}
    mix = rng.normal(size=(p, p))
    x, y = [], []
    for (name, centre), n in zip(centres.items(), (80, 50, 40, 7)):
        x.append((rng.normal(size=(n, p)) + centre) @ mix + 30)
        y += [name] * n
    return np.concatenate(x), np.array(y)


def frame(spark, x, y):
    return spark.createDataFrame([(f"c{k:04d}", v.tolist(), str(label)) for k, (v, label) in enumerate(zip(x, y))], "cell_id string, vec array<double>, label string").repartition(5)


@pytest.mark.parametrize("block_rows", [D.BLOCK_ROWS, 9])
def test_discriminants_equal_their_definition(spark, monkeypatch, block_rows):
    monkeypatch.setattr(D, "BLOCK_ROWS", block_rows)
    x, y = planted()
    found = D.discriminants(frame(spark, x, y))
    parts = {c: brute_covariance(x[y == c]) for c in np.unique(y)}
    inside = sum((y == c).mean() * cov for c, (cov, _) in parts.items())
    whole, weight = brute_covariance(x)
    values, vectors = np.linalg.eig(np.linalg.solve(inside, whole - inside))
    order = np.argsort(-values.real)[:3]
    assert np.allclose(found.values, values.real[order], rtol=1e-7)
    for k, j in enumerate(order):
        v = vectors[:, j].real
        v = v / math.sqrt(v @ inside @ v)
        v = v * np.sign(v[np.abs(v).argmax()])
        assert np.allclose(found.axes[:, k], v, rtol=1e-5, atol=1e-8)
    shrinkage = {r["label"]: r["shrinkage"] for r in found.classes.collect()}
    assert np.allclose([shrinkage[c] for c in parts], [w for _, w in parts.values()]) and np.isclose(shrinkage[None], weight)


def test_planted_classes_come_apart_and_others_get_no_place(spark):
    x, y = planted(1)
    cells = spark.createDataFrame(pd.DataFrame({"cell_id": [f"c{k:04d}" for k in range(len(y))], "target": y, "is_control": y == "NT", "is_target": y != "NT"}))
    cells = cells.withColumn("is_target", F.col("is_target") & (F.col("cell_id") != "c0100"))
    labels = D.training_labels(cells, spark.createDataFrame([("A",), ("B",), ("C",)], "target string"), min_cells=8)
    placed, found = D.supervised_projection(frame(spark, x, y).select("cell_id", "vec"), labels)
    rows = placed.toPandas()
    assert set(rows["label"]) == {"NT", "A", "B", D.OTHER} and found.axes.shape[1] == 2
    outside = rows["label"] == D.OTHER
    assert rows.loc[outside, "vec"].isna().all() and rows.loc[~outside, "vec"].notna().all() and outside.sum() == 8
    points = {c: np.stack(rows.loc[rows["label"] == c, "vec"]) for c in ("NT", "A", "B")}
    for a, b in itertools.combinations(points, 2):
        gap = np.linalg.norm(points[a].mean(0) - points[b].mean(0))
        assert gap > 2.0 * max(points[a].std(0).max(), points[b].std(0).max())


def test_constant_axes_single_classes_and_empty_input(spark):
    x, y = planted(2, 3)
    flat = np.c_[x, np.full(len(x), 5.0)]
    with pytest.raises(ValueError, match="singular"):
        D.discriminants(frame(spark, np.c_[np.zeros((len(x), 1)), x * 0], y))
    assert np.isfinite(D.discriminants(frame(spark, flat[:, :3], y)).values).all()
    with pytest.raises(ValueError, match="two classes"):
        D.discriminants(frame(spark, x, ["A"] * len(x)))
    with pytest.raises(ValueError, match="no labelled"):
        D.discriminants(frame(spark, x, y).where("false"))


def test_unlabelled_vectors_count_in_the_total_only(spark):
    x, y = planted(3)
    named = np.arange(len(y)) % 5 != 0
    rows = frame(spark, x, y).withColumn("label", F.when(F.substring("cell_id", 2, 4).cast("int") % 5 != 0, F.col("label")))
    found = D.discriminants(rows)
    inside = sum((y[named] == c).mean() * brute_covariance(x[named & (y == c)])[0] for c in np.unique(y))
    values = np.linalg.eigvals(np.linalg.solve(inside, brute_covariance(x)[0] - inside)).real
    assert np.allclose(found.values, np.sort(values)[::-1][:3], rtol=1e-7)
    assert {r["label"]: r["n"] for r in found.classes.collect()}[None] == len(y)


@pytest.mark.parametrize("name", ["ml_13_discriminant_axes", "ml_13_projected_classes"])
def test_axes_equal_their_sql_with_unlabelled_rows_and_repeated_ids(spark, tmp_path, name):
    import duckdb

    from guidewave.plans import all_oracles, all_queries

    rng = np.random.default_rng(4)
    rows = [(None if k == 7 else k // 2, rng.normal(size=64).tolist(), None if k % 6 == 0 else k % 3) for k in range(90)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = con.execute(all_oracles()[name]).fetchdf()
    got = all_queries()[name](spark, str(tmp_path)).toPandas()[list(want.columns)]
    key = want.columns[0]
    pd.testing.assert_frame_equal(got.sort_values(key).reset_index(drop=True), want.sort_values(key).reset_index(drop=True), check_dtype=False)


# graph weights

def brute_weights(distances, k, overall):
    """One point at a time, by a plain search."""
    positive = [d for d in distances if d > 0]
    rho = min(positive) if positive else 0.0
    total = lambda s: sum(math.exp(-max(0.0, d - rho) / s) for d in distances)
    low, high = 1e-12, 1.0
    while total(high) <= math.log2(k) and high < 1e12:
        high *= 2
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (low, middle) if total(middle) > math.log2(k) else (middle, high)
    width = max(high, 1e-3 * (sum(distances) / (len(distances) + 1) if rho > 0 else overall))
    return [math.exp(-max(0.0, d - rho) / width) for d in distances]


def test_weights_equal_a_search_per_point(spark):
    rng = np.random.default_rng(0)
    points = np.r_[rng.normal(size=(40, 3)), np.repeat(rng.normal(size=(1, 3)), 6, 0), rng.normal(size=(14, 3)) * 20]
    k = 8
    d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    near = np.argsort(d, axis=1, kind="stable")[:, : k - 1]
    overall = np.take_along_axis(d, near, 1).sum() / (len(points) * k)
    directed = {}
    for i in range(len(points)):
        for j, w in zip(near[i], brute_weights([d[i, j] for j in near[i]], k, overall)):
            directed[i, int(j)] = w
    expected = {}
    for (i, j), a in directed.items():
        b = directed.get((j, i), 0.0)
        expected[min(i, j), max(i, j)] = a + b - a * b
    cells = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(points)], "cell_id int, vec array<double>")
    found = {(r["src"], r["dst"]): r["weight"] for r in CN.neighbor_graph(cells, k)[1].collect()}
    assert found.keys() == expected.keys()
    assert max(abs(found[e] - expected[e]) for e in found) < 1e-6


def test_modality_graphs_leave_incomplete_cells_out(spark):
    rng = np.random.default_rng(1)
    rna = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(30)], "cell_id int, vec array<double>")
    protein = rna.select("cell_id", F.when(F.col("cell_id") < 20, F.slice("vec", 1, 2)).alias("vec"))
    graphs = CN.modality_graphs(rna, protein, 5)
    ends = {name: {x for r in g.collect() for x in (r["src"], r["dst"])} for name, g in graphs.items()}
    assert ends == {"rna": set(range(30)), "protein": set(range(20)), "joint": set(range(20))}
    assert set(CN.modality_graphs(rna, None, 5)) == {"rna"}
    assert all(0 < r["weight"] <= 1 + 1e-12 for g in graphs.values() for r in g.collect())


# communities

def edges_of(spark, pairs):
    return spark.createDataFrame([(int(a), int(b), float(w)) for a, b, w in pairs], "src int, dst int, weight double")


def cliques(n, size, bridge=1.0):
    found = []
    for c in range(n):
        found += [(c * size + i, c * size + j, 1.0) for i, j in itertools.combinations(range(size), 2)]
        found.append((c * size, ((c + 1) % n) * size + 1, bridge))
    return found


def brute_modularity(pairs, label, resolution=1.0):
    m = sum(w for *_, w in pairs)
    k = {}
    for a, b, w in pairs:
        k[a], k[b] = k.get(a, 0) + w, k.get(b, 0) + w
    mass = {}
    for node, d in k.items():
        mass[label[node]] = mass.get(label[node], 0) + d
    return sum(w for a, b, w in pairs if label[a] == label[b]) / m - resolution * sum(v * v for v in mass.values()) / (4 * m * m)


def labels_of(found):
    return {r["cell_id"]: r["cluster"] for r in found.collect()}


def test_ring_of_cliques_is_found_exactly(spark):
    found = labels_of(C.communities(edges_of(spark, cliques(8, 5))))
    groups = {frozenset(n for n in found if found[n] == c) for c in set(found.values())}
    assert groups == {frozenset(range(c * 5, c * 5 + 5)) for c in range(8)}


def test_modularity_rises_with_every_round(spark, monkeypatch):
    rng = np.random.default_rng(3)
    side = rng.integers(0, 4, 90)
    pairs = [(a, b, float(rng.integers(1, 4))) for a, b in itertools.combinations(range(90), 2) if rng.random() < (0.3 if side[a] == side[b] else 0.03)]
    states, keep = [], C.cut_lineage

    def spied(df):
        out = keep(df)
        if out.columns == ["node", "k", "com", "salt", "moved"]:
            states.append({r["node"]: r["com"] for r in out.collect()})
        return out

    monkeypatch.setattr(C, "cut_lineage", spied)
    found = labels_of(C.communities(edges_of(spark, pairs), tolerance=0.0))
    course = [brute_modularity(pairs, s) for s in states]
    assert len(course) > 1 and all(b >= a for a, b in itertools.pairwise(course))
    final = brute_modularity(pairs, found)
    assert final >= course[-1] - 1e-12 and final >= brute_modularity(pairs, dict(enumerate(side.tolist()))) - 0.01


def test_resolution_changes_granularity_and_numbers_follow_size(spark):
    pairs = cliques(6, 4, 0.5) + [(0, 100, 1.0), (1, 100, 1.0), (2, 100, 1.0), (3, 100, 1.0)]
    low, high = labels_of(C.communities(edges_of(spark, pairs), 0.1)), labels_of(C.communities(edges_of(spark, pairs), 3.0))
    assert len(set(low.values())) < len(set(high.values()))
    middle = labels_of(C.communities(edges_of(spark, pairs)))
    sizes = [sum(v == str(c) for v in middle.values()) for c in range(len(set(middle.values())))]
    assert sizes == sorted(sizes, reverse=True) and sizes[0] == 5


def test_same_result_at_any_partitioning(spark):
    edges = edges_of(spark, cliques(5, 4, 2.0))
    assert labels_of(C.communities(edges.repartition(7))) == labels_of(C.communities(edges.coalesce(1)))


def test_rounds_grow_slowly_with_the_graph(spark):
    rounds = {n: sum(C.find_communities(edges_of(spark, cliques(n, 5))).rounds) for n in (6, 24)}
    assert rounds[24] <= rounds[6] + 8 * math.log2(24 / 6)


def test_apart_communities_are_split_and_stay_connected(spark):
    graph = C.undirected(edges_of(spark, [(1, 2, 1.0), (2, 3, 1.0), (3, 4, 1.0), (10, 11, 1.0), (20, 21, 1.0), (4, 10, 1.0)]))
    given = spark.createDataFrame([(n, "x") for n in (1, 2, 3, 10, 11)] + [(4, "y"), (20, "z"), (21, "z")], "cell_id int, node string")
    parts = {r["cell_id"]: r["node"] for r in C.connected_parts(graph, given).collect()}
    assert parts == {1: 1, 2: 1, 3: 1, 4: 4, 10: 10, 11: 10, 20: 20, 21: 20}
    chain = [(k, k + 1, 1.0) for k in range(60)]
    whole = spark.createDataFrame([(k, "c") for k in range(61)], "cell_id int, node string")
    assert {r["node"] for r in C.connected_parts(C.undirected(edges_of(spark, chain)), whole).collect()} == {0}


def test_graph_without_edges_or_with_loops_only(spark):
    assert C.communities(edges_of(spark, [(1, 1, 1.0)])).count() == 0
    assert C.communities(edges_of(spark, []).where("false")).count() == 0


def test_a_small_graph_takes_few_jobs(spark, monkeypatch):
    writes, keep = [], C.cut_lineage
    monkeypatch.setattr(C, "cut_lineage", lambda df: writes.append(1) or keep(df))
    found = labels_of(C.communities(edges_of(spark, cliques(24, 5))))
    assert len(found) == 120 and len(writes) <= 8


def test_joins_beyond_the_bound_of_a_task(spark, monkeypatch):
    monkeypatch.setattr(C, "TASK_EDGES", 0)
    monkeypatch.setattr(C, "_one_task", None)
    found = labels_of(C.communities(edges_of(spark, cliques(8, 5))))
    groups = {frozenset(n for n in found if found[n] == c) for c in set(found.values())}
    assert groups == {frozenset(range(c * 5, c * 5 + 5)) for c in range(8)}


def test_node_tables_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(C, "TASK_EDGES", 0)
    plans, keep = [], C.cut_lineage

    def spied(df):
        plans.append((df.columns, df._jdf.queryExecution().executedPlan().toString()))
        return keep(df)

    graph = keep(C.undirected(edges_of(spark, cliques(4, 4))))
    label = keep(graph.select(F.col("a").alias("cell_id")).distinct().withColumn("node", F.lit("x")))
    monkeypatch.setattr(C, "cut_lineage", spied)
    assert C.connected_parts(graph, label).select("node").distinct().count() == 1
    inside = [plan for columns, plan in plans if columns == ["a", "b"]]
    assert len(inside) == 1 and "SortMergeJoin" in inside[0] and "Broadcast" not in inside[0]


def test_names_of_any_type_give_connected_communities(spark):
    named = edges_of(spark, cliques(6, 5)).select(F.concat(F.lit("é"), "src").alias("src"), F.concat(F.lit("é"), "dst").alias("dst"), "weight")
    found = C.communities(named)
    parts = C.connected_parts(C.undirected(named), found.select("cell_id", F.col("cluster").alias("node")))
    groups = lambda df, c: {frozenset(r["cell_id"] for r in df.collect() if r[c] == x) for x in {r[c] for r in df.collect()}}
    assert found.count() == 30 and groups(found, "cluster") == groups(parts, "node")


def task_graph(pairs, n):
    rows = sorted([(a, b, w) for a, b, w in pairs] + [(b, a, w) for a, b, w in pairs])
    sizes = np.bincount([a for a, *_ in rows], minlength=n)
    return TG.Graph(np.concatenate([[0], np.cumsum(sizes)]), np.array([b for _, b, _ in rows], np.int32), np.array([w for *_, w in rows]), np.bincount([a for a, *_ in rows], weights=[w for *_, w in rows], minlength=n))


@pytest.mark.parametrize("entries", [1, 7, 1 << 18])
def test_rounds_in_a_task_against_brute_force(monkeypatch, entries):
    """Whatever the parts: contracted links, degrees, rising modularity and the connected parts."""
    monkeypatch.setattr(TG, "_ENTRIES", entries)
    rng = np.random.default_rng(5)
    pairs = [(a, b, float(rng.integers(1, 9))) for a, b in itertools.combinations(range(70), 2) if rng.random() < (0.5 if a % 5 == b % 5 else 0.04)]
    graph, label = task_graph(pairs, 70), rng.integers(0, 12, 70).astype(np.int32)
    level, want = TG.contracted(graph, label, 12), {}
    for a, b, w in pairs:
        for x, y in ((label[a], label[b]), (label[b], label[a])):
            if x != y:
                want[x, y] = want.get((x, y), 0) + w
    assert {(x, int(level.other[i])): level.w[i] for x in range(12) for i in range(level.start[x], level.start[x + 1])} == want
    assert len(level.other) == len(want) and level.k.tolist() == np.bincount(label, weights=graph.k, minlength=12).tolist()
    rate, alone = 1 / graph.k.sum(), np.arange(70)
    course = [brute_modularity(pairs, dict(enumerate(alone.tolist())))]
    merged, rounds = TG.merged(graph, alone, rate, 3, 0)
    course.append(brute_modularity(pairs, dict(enumerate(merged.tolist()))))
    moved, _ = TG.moved(graph, merged, rate, 4, 0.0)
    course.append(brute_modularity(pairs, dict(enumerate(moved.tolist()))))
    assert rounds and course == sorted(course) and course[-1] >= brute_modularity(pairs, {n: n % 5 for n in range(70)}) - 1e-12
    # no single move is left that gains
    assert all(brute_modularity(pairs, dict(enumerate(moved.tolist())) | {n: c}) <= course[-1] + 1e-9 for n in range(70) for c in set(moved.tolist()))
    name = alone.copy()
    for _ in range(70):
        for a, b, _ in pairs:
            if label[a] == label[b]:
                name[a] = name[b] = min(name[a], name[b])
    assert TG.connected(graph, label).tolist() == name.tolist()


# variable genes

def brute_trend(counts, batches, n_top, span=0.3):
    """counts: cells x genes."""
    norms, ranks = [], []
    for b in sorted(set(batches)):
        x = counts[batches == b].astype(float)
        n, mean, var = len(x), x.mean(0), x.var(0, ddof=1)
        sd = np.ones(x.shape[1])
        ok = var > 0
        lx, ly = np.log10(mean[ok]), np.log10(var[ok])
        q = math.floor(span * ok.sum() + 1e-5)
        fit = []
        for c in lx:
            near = np.argsort(np.abs(lx - c), kind="stable")[:q]
            w = (1 - (np.abs(lx[near] - c) / np.abs(lx[near] - c).max()) ** 3) ** 3
            fit.append(np.polyval(np.polyfit(lx[near] - c, ly[near], 2, w=np.sqrt(w)), 0.0))
        sd[ok] = np.sqrt(10.0 ** np.array(fit))
        clipped = np.minimum(x, mean + sd * math.sqrt(n))
        norm = ((clipped - mean) ** 2).sum(0) / ((n - 1) * sd**2)
        order = np.lexsort((np.arange(x.shape[1]), -norm))
        rank = np.empty(x.shape[1])
        rank[order] = np.arange(x.shape[1])
        norms.append(norm)
        ranks.append(np.where(rank < n_top, rank, np.nan))
    ranks = np.array(ranks)
    held = (~np.isnan(ranks)).sum(0)
    median = np.array([np.nanmedian(r) if h else np.inf for r, h in zip(ranks.T, held)])
    chosen = np.lexsort((np.arange(len(held)), -held, median))[:n_top]
    return np.mean(norms, 0), median, held, set(chosen.tolist())


@pytest.mark.parametrize("names", [["x"], ["x", "y", "z"]])
def test_trend_genes_equal_the_definition(spark, names):
    rng = np.random.default_rng(5)
    genes = 60
    mean = 10 ** rng.uniform(-0.5, 1.5, genes)
    counts = rng.poisson(rng.gamma(2.0, mean / 2.0, size=(90, genes)))
    counts[:, 7] = 0
    counts[:, 11] = 4
    counts[::9, 20] += 60
    batch = np.array([names[i % len(names)] for i in range(90)])
    stored = spark.createDataFrame([(i, f"g{j:02d}", int(counts[i, j])) for i in range(90) for j in range(genes) if counts[i, j]], "cell_id int, feature string, count long")
    cells = spark.createDataFrame([(i, str(batch[i])) for i in range(90)], "cell_id int, batch string")
    features = spark.createDataFrame([(f"g{j:02d}",) for j in range(genes)], "feature string")
    found = VG.variable_genes_by_trend(stored, cells, features, 12).orderBy("feature").toPandas()
    norm, median, held, chosen = brute_trend(counts, batch, 12)
    assert np.allclose(found["variance_norm"], norm, rtol=1e-6)
    assert np.array_equal(found["n_batches"], held) and np.array_equal(found["median_rank"].fillna(np.inf), median)
    assert set(np.flatnonzero(found["highly_variable"])) == chosen and 20 in chosen


def test_local_fit_is_exact_on_a_parabola_and_bears_equal_points():
    x = np.linspace(-2, 2, 41)
    assert np.allclose(VG.local_quadratic(x, 1 + 2 * x - 3 * x * x, x), 1 + 2 * x - 3 * x * x)
    assert np.allclose(VG.local_quadratic(np.full(10, 3.0), np.arange(10.0), np.array([3.0]), 1.0), 4.5)


def test_batches_vote_for_variable_genes(spark):
    from guidewave.operators import embedding as B

    rng = np.random.default_rng(6)
    values = np.log1p(rng.gamma(2.0, 1.0, size=(80, 25)) * rng.uniform(0.5, 4, 25))
    values[:40, 3] *= rng.integers(0, 2, 40) * 3
    values[:40, 9] = 0
    stored = spark.createDataFrame([(i, f"g{j:02d}", float(values[i, j])) for i in range(80) for j in range(25) if values[i, j]], "cell_id int, feature string, lognorm double")
    cells = spark.createDataFrame([(i, "a" if i < 40 else "b") for i in range(80)], "cell_id int, batch string")
    features = spark.createDataFrame([(f"g{j:02d}",) for j in range(26)], "feature string")
    found = VG.variable_genes_over_batches(stored, cells, features, 6, n_bins=4).toPandas().set_index("feature")
    size = spark.createDataFrame([(40,)], "n_cells long")
    parts = [B.variable_genes(stored.where(c), size, 6, "seurat", 4).toPandas().set_index("feature") for c in ("cell_id < 40", "cell_id >= 40")]
    for g, row in found.iterrows():
        own = [p.loc[g] for p in parts if g in p.index]
        assert row["n_batches"] == sum(o["highly_variable"] for o in own)
        assert np.isclose(row["dispersion_norm"], sum(np.nan_to_num(o["dispersion_norm"]) for o in own) / 2)
    order = found.reset_index().sort_values(["n_batches", "dispersion_norm", "feature"], ascending=[False, False, True])
    assert set(order["feature"][:6]) == set(found.index[found["highly_variable"]]) and found["n_batches"].max() == 2


# regression markers

def test_regression_reaches_the_optimum_and_ranks_planted_markers(spark):
    rng = np.random.default_rng(7)
    n, genes, k = 150, 8, 3
    y = rng.integers(0, k, n)
    x = rng.poisson(1.0, size=(n, genes)).astype(float)
    for c in range(k):
        x[y == c, c] += rng.poisson(2.0, (y == c).sum())
    x[:, 7] = 0
    x[5] = 0
    stored = spark.createDataFrame([(i, f"g{j}", float(x[i, j])) for i in range(n) for j in range(genes) if x[i, j]], "cell_id int, feature string, lognorm double")
    cells = spark.createDataFrame([(i, f"k{y[i]}") for i in range(n)], "cell_id int, cluster string")
    features = spark.createDataFrame([(f"g{j}",) for j in range(genes)], "feature string")
    found, gradient = MK.regression_markers(cells, stored, features)
    table = found.toPandas().pivot(index="cluster", columns="feature", values="coefficient")
    # accelerated descent on the plain objective, to convergence
    w, b, truth = np.zeros((k, genes)), np.zeros(k), np.eye(k)[y]
    step = 1.0 / (0.5 * np.linalg.eigvalsh(np.c_[x, np.ones(n)].T @ np.c_[x, np.ones(n)])[-1] + 1)
    vw, vb, prev = w.copy(), b.copy(), (w.copy(), b.copy())
    for t in range(20000):
        s = x @ vw.T + vb
        p = np.exp(s - s.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        nw, nb = vw - step * ((p - truth).T @ x + vw), vb - step * (p - truth).sum(0)
        if np.abs(nw - prev[0]).max() < 1e-13:
            break
        m = t % 400 / (t % 400 + 3)
        vw, vb, prev = nw + m * (nw - prev[0]), nb + m * (nb - prev[1]), (nw, nb)
    assert np.allclose(table.to_numpy(), prev[0], atol=1e-4)
    assert gradient.agg(F.max(F.abs("gradient"))).first()[0] < 1e-6
    assert gradient.count() == k * (genes + 1)
    top = {r["cluster"]: r["feature"] for r in found.where("rank = 1").collect()}
    assert top == {"k0": "g0", "k1": "g1", "k2": "g2"}
