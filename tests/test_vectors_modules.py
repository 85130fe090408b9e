"""Neighbours, distances, geometry, communities and hierarchical modules."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from guidewave.operators import communities as C
from guidewave.operators import concordance as CO
from guidewave.operators import distances as D
from guidewave.operators import embedding as B
from guidewave.operators import grouping as GR
from guidewave.operators import modules as MO
from guidewave.operators import neighborhood as H
from guidewave.operators import neighbors as KN
from guidewave.operators.sampling import bounded_sample


def points(spark, x):
    return spark.createDataFrame([(f"p{i:04d}", [float(v) for v in row]) for i, row in enumerate(x)], "cell_id string, vec array<double>")


def brute_knn(x, k):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    return {i: [int(j) for j in np.lexsort((np.arange(len(x)), d[i]))[:k]] for i in range(len(x))}


@pytest.mark.parametrize("cell_size,q,c", [(4096, 2048, 8192), (40, 25, 60), (15, 7, 20)])
def test_knn_is_exact_with_small_blocks_and_a_hot_cell(spark, cell_size, q, c):
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(0, 0.01, (120, 5)), rng.normal(0, 1, (100, 5)), rng.normal(8, 1, (60, 5))])
    got = KN.knn(points(spark, x), 6, cell_size, q, c).collect()
    want = brute_knn(x, 6)
    table = {}
    for r in got:
        table.setdefault(int(r["src"][1:]), {})[r["rank"]] = int(r["dst"][1:])
    assert len(got) == 280 * 6
    assert all([table[i][k] for k in range(1, 7)] == want[i] for i in range(280))


@pytest.mark.parametrize("cell_size,q,c", [(4096, 2048, 4096), (40, 25, 60), (400, 64, 32)])
def test_knn_orders_ties_by_id(spark, cell_size, q, c):
    rng = np.random.default_rng(1)
    x = np.vstack([np.repeat(rng.normal(0, 1, (1, 8)), 210, axis=0), rng.normal(0, 1, (190, 8))])[rng.permutation(400)]
    table = {}
    for r in KN.knn(points(spark, x), 3, cell_size, q, c).collect():
        table.setdefault(int(r["src"][1:]), {})[r["rank"]] = int(r["dst"][1:])
    assert {i: [t[k] for k in (1, 2, 3)] for i, t in table.items()} == brute_knn(x, 3)


def test_knn_routes_few_copies_between_clusters(spark):
    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal(20 * i, 1, (60, 3)) for i in range(8)])
    placed, pivots = KN.place(points(spark, x), len(x), 30)
    own = placed.select("cell", "cell_id", "vec")
    inside = KN._top(KN._cell_join(own, own, 4, 64, 64), 4)
    copies = KN.route(placed, inside, pivots, 4).count()
    assert len(pivots) == 16 and copies < 4 * len(x)


def test_knn_sends_a_point_to_blocks_of_cells_and_stays_exact(spark):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(0, 1, (500, 24)), np.zeros((20, 24)), np.full((20, 24), -0.0)])[rng.permutation(540)]
    placed, pivots = KN.place(points(spark, x), len(x), 10)
    own = placed.select("cell", "cell_id", "vec")
    inside = KN._top(KN._cell_join(own, own, 5, 64, 64), 5)
    space = KN._space(placed, pivots)
    packs = KN._packs(space[3], 150)
    # nothing is far apart in 24 dimensions: nearly every cell is reached, yet a point travels once per block
    assert KN.route(placed, inside, pivots, 5).count() > 10 * len(x)
    assert KN.route(placed, inside, pivots, 5, space, packs).count() <= (packs.max() + 1) * len(x) <= 8 * len(x)
    table = {}
    for r in KN.knn(points(spark, x), 5, 10, 150, 150).collect():
        table.setdefault(int(r["src"][1:]), {})[r["rank"]] = int(r["dst"][1:])
    assert {i: [t[k] for k in range(1, 6)] for i, t in table.items()} == brute_knn(x, 5)


def test_knn_blocks_grow_with_the_table_up_to_a_bound():
    assert KN.block_rows(12_000, 64) == 4096 and KN.block_rows(720_000, 64) == 45_000
    assert KN.block_rows(10**8, 64) == 65_536 and KN.block_rows(10**8, 3) == 131_072


def test_knn_overlap_reads_each_graph_once(spark):
    rng = np.random.default_rng(4)
    x, y = rng.normal(0, 1, (60, 4)), rng.normal(0, 1, (60, 4))
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    first = KN.knn(points(spark, x), 5).select("src", "dst")
    row = KN.knn_overlap(first.mapInArrow(counted, first.schema), KN.knn(points(spark, y), 5), 5, 60).first()
    want, other = brute_knn(x, 5), brute_knn(y, 5)
    assert row["n_cells"] == 60 and row["overlap_mean"] == pytest.approx(np.mean([len(set(want[i]) & set(other[i])) for i in range(60)]) / 5)
    assert seen.value == 300


def grouped(spark, shift=4.0, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for t, n, centre in (("NT", 40, 0.0), ("A", 35, shift), ("B", 32, shift), ("C", 33, 0.0), ("R", 4, 0.0)):
        for i in range(n):
            v = rng.normal(0, 1, 3)
            v[0] += centre
            rows.append((f"{t}{i:03d}", t, "single_control" if t == "NT" else "single_targeting", "non_targeting" if t == "NT" else "", str(int(v[0] > 2)), f"s{i % 2}", [float(z) for z in v]))
    return spark.createDataFrame(rows, "cell_id string, target string, perturbation_class string, control_class string, cluster string, sample string, vec array<double>"), rows


def energy(x, y):
    cd = lambda a, b: np.sqrt(((a[:, None] - b[None]) ** 2).sum(-1)).mean()
    return 2 * cd(x, y) - cd(x, x) - cd(y, y)


def test_energy_distance_and_permutation(spark):
    cells, rows = grouped(spark)
    out = {r["target"]: r for r in D.perturbation_distance(cells, ["non_targeting"], n_permutations=60).collect()}
    vec = lambda t: np.array([r[6] for r in sorted(rows) if r[1] == t])
    for t in ("A", "B", "C"):
        assert out[t]["energy_distance"] == pytest.approx(energy(vec(t), vec("NT")), abs=1e-9)
    assert out["A"]["p_value"] == pytest.approx(1 / 61) and out["A"]["significant"] and out["C"]["p_value"] > 0.05
    assert out["R"]["reason"] == "fewer than 30 cells (4)" and out["R"]["energy_distance"] is None
    again = {r["target"]: r["p_value"] for r in D.perturbation_distance(cells.repartition(3), ["non_targeting"], n_permutations=60).collect()}
    assert again == {t: r["p_value"] for t, r in out.items()}
    none = D.perturbation_distance(cells, ["non_targeting"], n_permutations=0, secondary=None).where("target = 'A'").first()
    assert none["p_value"] is None and none["mmd_distance"] is None


def test_pair_space_neighbours_and_coordinates(spark):
    cells, rows = grouped(spark)
    pairs = D.pair_distances(cells, block=2)
    table = {(r["target_a"], r["target_b"]): r["distance"] for r in pairs.collect()}
    vec = lambda t: np.array([r[6] for r in rows if r[1] == t])
    assert set(table) == {("A", "B"), ("A", "C"), ("B", "C")}
    assert all(v == pytest.approx(energy(vec(a), vec(b)), abs=1e-9) for (a, b), v in table.items())
    nearest = {r["target"]: r["neighbor"] for r in D.nearest_targets(pairs, 1).collect()}
    assert nearest["A"] == "B" and nearest["B"] == "A"


def test_principal_coordinates_recover_distances(spark):
    x = np.array([[0, 0], [3, 0], [0, 4], [1, 1], [5, 2]], float)
    rows = [(f"t{i}", f"t{j}", float(np.linalg.norm(x[i] - x[j]))) for i in range(5) for j in range(i + 1, 5)]
    coords, eigen = D.principal_coordinates(spark.createDataFrame(rows, "target_a string, target_b string, distance double"))
    got = np.zeros((5, 2))
    for r in coords.collect():
        got[int(r["target"][1:]), r["axis"] - 1] = r["value"]
    assert eigen.count() == 2
    assert all(np.linalg.norm(got[int(a[1:])] - got[int(b[1:])]) == pytest.approx(d, abs=1e-6) for a, b, d in rows)


def test_indefinite_distances_keep_positive_axes_only(spark):
    rng = np.random.default_rng(0)
    m = rng.uniform(0.5, 2, (6, 6))
    m = (m + m.T) / 2
    np.fill_diagonal(m, 0)
    rows = [(f"t{i}", f"t{j}", float(m[i, j])) for i in range(6) for j in range(i + 1, 6)]
    _, eigen = D.principal_coordinates(spark.createDataFrame(rows, "target_a string, target_b string, distance double"))
    h = np.eye(6) - 1 / 6
    want = np.linalg.eigvalsh(-0.5 * h @ (m**2) @ h)[::-1]
    got = [r["value"] for r in eigen.orderBy("axis").collect()]
    assert got == pytest.approx([w for w in want if w > 1e-10], abs=1e-8)


def test_local_enrichment_permutation_null(spark):
    cells, _ = grouped(spark, 9.0)
    edges = KN.knn(cells.select("cell_id", "vec"), 10)
    rows = {r["target"]: r for r in H.permutation_null(cells, edges, 10, ["non_targeting"], 30).collect()}
    assert rows["A"]["p_empirical"] == pytest.approx(1 / 31) and abs(rows["A"]["null_mean"]) < 0.2
    assert "R" not in rows
    s = {r["target"]: r for r in H.summary(cells, edges, 10, ["non_targeting"]).collect()}
    assert s["A"]["mean_in_own_cells"] == pytest.approx(rows["A"]["observed"]) and s["A"]["mean_in_control_cells"] < 0


def test_stored_neighbours():
    assert H.stored_neighbors(300, 100_000) == 299 and H.stored_neighbors(300, 50) == 48 and H.stored_neighbors(300, 1000, 0.1) == 99


def test_bounded_sample(spark):
    df = spark.range(400).select(F.col("id").alias("cell_id"), (F.col("id") % 4 == 0).cast("int").alias("g"), (F.col("id") % 10 == 0).cast("string").alias("s"))
    for stratum in (None, "s"):
        out = bounded_sample(df, ["g"], 120, 7, stratum=stratum)
        sizes = {r["g"]: r["count"] for r in out.groupBy("g").count().collect()}
        assert sizes == {0: 120, 1: 100}
        same = bounded_sample(df.repartition(9), ["g"], 120, 7, stratum=stratum)
        assert out.exceptAll(same.select(out.columns)).isEmpty()


def lance_williams(d, linkage):
    """Straight greedy merging: sorted merge heights."""
    n = len(d)
    power = 2 if linkage == "ward" else 1
    dist = {(i, j): d[i, j] ** power for i in range(n) for j in range(n) if i != j}
    size, alive, heights = dict.fromkeys(range(n), 1), set(range(n)), []
    while len(alive) > 1:
        a, b = min(((i, j) for i in alive for j in alive if i < j), key=lambda p: dist[p])
        h = dist[(a, b)]
        heights.append(h ** (1 / power))
        for k in alive - {a, b}:
            x, y, na, nb, nk = dist[(a, k)], dist[(b, k)], size[a], size[b], size[k]
            v = {"average": (na * x + nb * y) / (na + nb), "complete": max(x, y), "single": min(x, y), "weighted": (x + y) / 2,
                 "ward": ((na + nk) * x + (nb + nk) * y - nk * h) / (na + nb + nk)}[linkage]
            dist[(a, k)] = dist[(k, a)] = v
        size[a] += size[b]
        alive.remove(b)
    return sorted(heights)


@pytest.mark.parametrize("linkage", ["average", "ward", "complete"])
def test_agglomeration_matches_greedy_merging(spark, linkage):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(c, 0.4, (4, 3)) for c in (0, 4, 9)])
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    rows = [(f"i{i:02d}", f"i{j:02d}", float(d[i, j])) for i in range(12) for j in range(i + 1, 12)]
    merges = GR.agglomerate(spark.createDataFrame(rows, "a string, b string, distance double"), linkage)
    assert sorted(r["height"] for r in merges.collect()) == pytest.approx(lance_williams(d, linkage))
    items = spark.createDataFrame([(f"i{i:02d}",) for i in range(12)], "item string")
    labels = {r["item"]: r["module"] for r in GR.cut_tree(items, merges, 3).collect()}
    assert [labels[f"i{i:02d}"] for i in range(12)] == ["M1"] * 4 + ["M2"] * 4 + ["M3"] * 4


def test_distance_space_joins_similar_targets(spark):
    cells, _ = grouped(spark)
    space = D.distance_space(cells, n_modules=2)
    modules = {r["target"]: r["phenotype_module"] for r in space["modules"].collect()}
    assert set(modules) == {"A", "B", "C"} and modules["A"] == modules["B"] != modules["C"]
    nearest = {r["target"]: r["neighbor"] for r in space["neighbors"].where("rank = 1").collect()}
    assert nearest["A"] == "B" and nearest["B"] == "A"
    assert [tuple(r) for r in space["skipped"].collect()] == [("R", 4, "fewer than 30 cells (4)")]
    alone = D.distance_space(cells.where("target in ('NT', 'A')"))
    assert all(alone[t].isEmpty() for t in ("pairs", "coordinates", "modules", "neighbors"))


def test_identical_vectors_are_at_distance_zero():
    x = np.repeat(np.random.default_rng(0).normal(3, 1, (1, 40)), 100, axis=0)
    assert not D._refined(x, x.copy()).any() and D.mmd_statistic(x, x.copy()) == 0.0


def test_agglomeration_goes_on_to_one_cluster(spark):
    at = np.cumsum(1.02 ** np.arange(30))
    rows = [(f"i{i:02d}", f"i{j:02d}", float(at[j] - at[i])) for i in range(30) for j in range(i + 1, 30)]
    merges = GR.agglomerate(spark.createDataFrame(rows, "a string, b string, distance double"), "single").collect()
    assert len(merges) == 29 and max(r["round"] for r in merges) == 29


def test_module_driver_falls_back_to_variable_genes(spark):
    rng = np.random.default_rng(6)
    centre = {"A": rng.normal(0, 1, 12), "B": rng.normal(0, 1, 12)}
    rows = [(f"{k}{i}", f"g{j:02d}", float(centre[k][j] + rng.normal(0, 0.05)), bool(abs(centre[k][j]) > 1)) for k in "AB" for i in range(4) for j in range(12)]
    effects = spark.createDataFrame(rows, "target string, feature string, log2fc double, de boolean")
    genes = lambda n: spark.createDataFrame([(f"g{j:02d}",) for j in range(n)], "feature string")
    out = MO.module_tables(effects, {"cluster_markers": genes(4), "variable": genes(12)}, genes(12), n_modules=2, n_programs=3)
    assert {r["panel"] for r in out["panel"].collect()} == {"variable"} and out["panel"].count() == 12
    labels = {r["item"]: r["module"] for r in out["modules"].collect()}
    assert len({labels[f"A{i}"] for i in range(4)}) == 1 and labels["A0"] != labels["B0"]
    with pytest.raises(ValueError):
        MO.choose_panel("response", {"response": genes(3)}, genes(12))


def test_communities_find_planted_partition(spark):
    rng = np.random.default_rng(0)
    rows = [(i, j, 1.0) for i in range(45) for j in range(i + 1, 45) if rng.random() < (0.6 if i // 15 == j // 15 else 0.03)]
    edges = spark.createDataFrame(rows, "src int, dst int, weight double")
    found = C.communities(edges)
    both = found.withColumn("truth", F.floor(F.col("cell_id") / 15))
    assert MO.partition_agreement(both, "cluster", "truth").first()["ari"] > 0.9
    assert GR.modularity(edges, found).first()["modularity"] > 0.4


def test_mantel(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (9, 2))
    rows = [(f"t{i}", f"t{j}", float(np.linalg.norm(x[i] - x[j]))) for i in range(9) for j in range(i + 1, 9)]
    pairs = spark.createDataFrame(rows, "target_a string, target_b string, distance double")
    same = CO.mantel(pairs, pairs.withColumn("distance", F.col("distance") * 2), 40).first()
    assert same["mantel_rho"] == pytest.approx(1.0) and same["p_permutation"] == pytest.approx(1 / 41) and same["n_pairs"] == 36
    other = [(a, b, float(v)) for (a, b, _), v in zip(rows, rng.uniform(0, 1, 36))]
    assert CO.mantel(pairs, spark.createDataFrame(other, pairs.schema), 40).first()["p_permutation"] > 0.05
    assert CO.mantel(pairs, pairs, 0).first()["p_permutation"] is None


def test_principal_components(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (80, 4)) @ np.diag([5, 2, 1, 0.5]) + 3
    scores, loadings, variance = B.principal_components(points(spark, x), 3)
    got = np.array([r["vec"] for r in scores.orderBy("cell_id").collect()])
    centred = x - x.mean(0)
    u, s, _ = np.linalg.svd(centred, full_matrices=False)
    assert np.abs(got) == pytest.approx(np.abs(u[:, :3] * s[:3]), abs=1e-6)
    assert [r["ratio"] for r in variance.orderBy("pc").collect()] == pytest.approx(list(s[:3] ** 2 / (s**2).sum()))
    assert loadings.groupBy("pc").agg(F.max_by("value", F.abs("value")).alias("v")).where("v < 0").isEmpty()


@pytest.mark.parametrize("method", ["pearson", "spearman"])
@pytest.mark.parametrize("block", [256, 7])
def test_blocked_correlations_equal_pairwise_ones(spark, method, block):
    rng = np.random.default_rng(8)
    x = rng.normal(100, 1, (23, 11)).round(1)
    x[4] = 5.0
    there = rng.random(x.shape) < 0.7
    there[6] = [True] + [False] * 10
    there[7] = [False] + [True] * 10
    rows = [(f"r{i:02d}", f"c{j:02d}", float(x[i, j]) if there[i, j] else None) for i in range(23) for j in range(11)]
    table = spark.createDataFrame(rows, "item string, column string, v double")
    found = {(r["a"], r["b"]): r["r"] for r in MO.correlation_matrix(table, "item", "column", "v", method, block).collect()}
    frame = pd.DataFrame(np.where(there, x, np.nan))
    if method == "spearman":
        frame = frame.rank(axis=1)
    for i in range(23):
        for j in range(i + 1, 23):
            both = frame.loc[[i, j]].dropna(axis=1).to_numpy()
            key = f"r{i:02d}", f"r{j:02d}"
            if not both.shape[1]:
                assert key not in found
            elif both.shape[1] < 2 or both.std(1).min() < 1e-12:
                assert found[key] is None
            else:
                assert abs(found[key] - np.corrcoef(both)[0, 1]) < 1e-9
    assert all(a < b for a, b in found)


def test_correlations_of_a_wide_panel(spark):
    # 5,000 genes against 12 targets: 20 blocks, 12.5 million pairs, summed where they are made
    genes = spark.range(5000).select(F.format_string("g%05d", "id").alias("gene"), F.explode(F.sequence(F.lit(0), F.lit(11))).alias("target"))
    table = genes.withColumn("v", F.sin(F.xxhash64("gene", "target") % 1000).cast("double"))
    out = MO.correlation_matrix(table, "gene", "target", "v").agg(F.count("*").alias("n"), F.max(F.abs("r")).alias("m"), F.avg("r").alias("mean")).first()
    assert out["n"] == 5000 * 4999 // 2 and out["m"] <= 1 and abs(out["mean"]) < 0.01


def test_draws_are_exact_and_four_wise_values_are_uniform(spark):
    from guidewave.operators import draws

    cells = spark.range(700).select((F.col("id") % 690).cast("string").alias("cell_id"))  # ten ids twice: ties
    keys = cells.select(draws.cell_key(F.col("cell_id"))).cache()
    own = np.array([r["key"] for r in keys.collect()], np.int64)
    rows = draws.coefficients(40, 3)
    sizes = np.array([1, 7, 350, 699, 700, 5000], np.int64)
    found = draws.thresholds(keys, rows, sizes)
    for p in range(40):
        a, b, c, d = (int(x) for x in rows[p])
        values = sorted((((a * int(x) + b) * int(x) + c) * int(x) + d) % draws.PRIME for x in own)
        assert found[p].tolist() == [values[min(n, 700) - 1] for n in sizes]
    many = draws.values(own, draws.coefficients(2000, 4)) / draws.PRIME
    assert np.abs(many.mean(0) - 0.5).max() < 0.04 and abs(many.std() - 12**-0.5) < 0.002
    edges = cells.select(F.col("cell_id").alias("src"), F.reverse("cell_id").alias("dst"))
    counted = {(r["perm"], r["level"]): r["n"] for r in draws.edge_counts(edges, rows, found).collect()}
    ids = [r["cell_id"] for r in cells.collect()]
    import hashlib
    key = lambda s: int(hashlib.sha256(s.encode()).hexdigest()[:13], 16) % draws.PRIME
    src, dst = np.array([key(i) for i in ids]), np.array([key(i[::-1]) for i in ids])
    later = np.maximum(draws.values(src, rows), draws.values(dst, rows))
    for p in range(40):
        upto = [sum(counted.get((p + 1, k), 0) for k in range(level + 1)) for level in range(len(sizes))]
        assert upto == [(later[p] <= limit).sum() for limit in found[p]]


def test_genes_at_a_bin_edge_keep_their_bin_when_sums_vary_in_the_last_bits(spark):
    """Means differ a little at each evaluation, as float sums do on a cluster; 21 genes put every edge on a gene."""
    @F.pandas_udf("double")
    def varied(x: pd.Series) -> pd.Series:
        return x * (1 + np.random.default_rng().uniform(-1e-13, 1e-13, len(x)))

    rows = [(f"c{c}", f"g{g:02d}", 0.1 * (g + 1) + 0.01 * c) for g in range(21) for c in range(4)]
    expr = spark.createDataFrame(rows, "cell_id string, feature string, x double").withColumn("lognorm", varied.asNondeterministic()("x")).drop("x")
    n_cells = spark.createDataFrame([(4,)], "n_cells bigint")
    found = {r["feature"]: r["bin"] for r in B.variable_genes(expr, n_cells, 5, "cell_ranger").collect()}
    # edges at the genes 2, 3, ..., 20 of 0..20, right-closed
    assert found == {f"g{g:02d}": max(0, g - 2) for g in range(21)}
