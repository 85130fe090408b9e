"""Verified near-copies and the pipeline's near-duplicate stage against brute force."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from guidewave.llm import idfilter, nearcopies


def grams(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def brute_classes(rows, radius=64):
    """Smallest id reachable over links of similarity 0.8 whose fingerprints lie within the radius."""
    sets, prints = [grams(t) for _, t in rows], [nearcopies.simhash((t or "").encode(), 5) for _, t in rows]
    label = {d: d for d, _ in rows}
    links = [(rows[i][0], rows[j][0]) for i, j in itertools.combinations(range(len(rows)), 2)
             if jaccard(sets[i], sets[j]) >= 0.8 and (prints[i] ^ prints[j]).bit_count() <= radius]
    moved = True
    while moved:
        moved = False
        for a, b in links:
            low = min(label[a], label[b])
            moved |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def edited(rng, words, times):
    words = list(words)
    for at in rng.sample(range(len(words)), times):
        words[at] = f"changed{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def copies():
    rng = random.Random(5)
    plain = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    texts = [None, "", "  ", "one", "One", "one two three four five", "ONE two three four five"]
    for n in (30, 60, 120, 300):
        for _ in range(6):
            first = plain(n)
            texts += [" ".join(first), " ".join(first), edited(rng, first, 1), edited(rng, first, max(1, n // 60)), edited(rng, first, n // 8), " ".join(first[: n // 2] + plain(n // 2))]
    whole = plain(200)
    texts += [edited(rng, whole, 2) for _ in range(60)]
    order = list(range(len(texts)))
    rng.shuffle(order)
    return [(k * 3, texts[i]) for k, i in enumerate(order)]


@pytest.mark.parametrize("tile", [1024, 16])
def test_classes_are_those_of_verified_links(spark, copies, tile, monkeypatch):
    monkeypatch.setattr(nearcopies, "TILE_ROWS", tile)
    frame = spark.createDataFrame(copies, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("node", "label", "cell", "words", "size", "class_id", "a", "b")})
    got = {r["doc_id"]: r["class_id"] for r in nearcopies.classes(frame).collect()}
    assert got == brute_classes(copies, nearcopies.RADIUS)
    if tile == 1024:
        every = brute_classes(copies)
        caught = sum(got[d] != d for d in got) / sum(every[d] != d for d in every)
        assert caught >= 0.95 and nearcopies.classes(frame.where("false")).count() == 0


def test_refuted_links_of_a_dense_block_are_struck_out(spark):
    # with any two fingerprints near, nearly all candidates of the forest are refuted and must not hide the true links
    rng = random.Random(7)
    texts = []
    for _ in range(12):
        first = [f"w{rng.randrange(3000)}" for _ in range(100)]
        texts += [" ".join(first), edited(rng, first, 1)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    got = {r["doc_id"]: r["class_id"] for r in nearcopies.classes(spark.createDataFrame(rows, "doc_id long, text string"), radius=32).collect()}
    assert got == brute_classes(rows, 32) and len(set(got.values())) < len(rows)


def test_stage_keeps_one_row_of_every_class(spark, copies):
    frame = spark.createDataFrame([(*r, "en", "s", len(r[1] or "")) for r in copies] + [(None, "one", "en", "s", 3), (0, copies[0][1], "en", "s", 3)],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.deduplicated(spark, frame, "").collect()
    assert sorted(r["doc_id"] for r in kept) == sorted({c for c in brute_classes(copies, nearcopies.RADIUS).values()}) and kept[0].__fields__ == frame.columns


def test_every_fingerprint_goes_to_few_tiles(spark, monkeypatch):
    # 200 texts of one band of sizes are one tile, whatever bits their fingerprints have
    rng = random.Random(9)
    seen = []
    inner = nearcopies.tile_pairs

    def counted(nodes, *more):
        placed, met = inner(nodes, *more)
        seen.append(met.count())
        return placed, met

    texts = [(k, " ".join(f"w{rng.randrange(3000)}" for _ in range(100))) for k in range(200)]
    monkeypatch.setattr(nearcopies, "tile_pairs", counted)
    nearcopies.classes(spark.createDataFrame(texts, "doc_id long, text string"))
    assert seen[0] <= 3


def test_block_of_refuted_candidates_takes_one_round(spark, monkeypatch):
    # all of one template and near by fingerprint, few of them similar: links came as forests, refuted round after round
    rng = random.Random(11)
    first = [f"w{rng.randrange(3000)}" for _ in range(150)]
    texts = [edited(rng, first, 7) for _ in range(90)]
    texts += [edited(rng, t.split(), 1) for t in texts[:10]]
    rows = list(enumerate(texts))
    rounds = []
    inner = nearcopies.components
    monkeypatch.setattr(nearcopies, "components", lambda edges: rounds.append(1) or inner(edges))
    got = {r["doc_id"]: r["class_id"] for r in nearcopies.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_classes(rows, nearcopies.RADIUS) and 10 < len(set(got.values())) < 95 and len(rounds) == 1


def test_classes_do_not_depend_on_pieces(spark, copies, monkeypatch):
    monkeypatch.setattr(nearcopies, "PIECE_SHINGLES", 500)
    got = {r["doc_id"]: r["class_id"] for r in nearcopies.classes(spark.createDataFrame(copies, "doc_id long, text string")).collect()}
    assert got == brute_classes(copies, nearcopies.RADIUS)


@pytest.mark.parametrize("listed", [0, 4, 10**9])
def test_shared_elements_of_sets_are_counted(monkeypatch, listed):
    monkeypatch.setattr(nearcopies, "_LISTED", listed)
    monkeypatch.setattr(nearcopies, "_LISTED_AT_ONCE", 50)
    monkeypatch.setattr(nearcopies, "_COLUMNS", 8)
    rng = np.random.default_rng(1)
    first, second = ([np.unique(rng.integers(0, 60, rng.integers(0, 40))).astype(np.uint64) for _ in range(n)] for n in (17, 23))
    want = [[len(set(x.tolist()) & set(y.tolist())) for y in second] for x in first]
    assert nearcopies._common(first, second).tolist() == want and nearcopies._common([], second).shape == (0, 23)
    assert nearcopies._common([np.zeros(0, np.uint64)], second[:1]).tolist() == [[0.0]]


@pytest.mark.parametrize("bits", [64, 1 << 25])
def test_only_ids_surely_absent_are_told_so(spark, monkeypatch, bits):
    monkeypatch.setattr(idfilter, "BITS", bits)
    rows = spark.range(2000).select((F.col("id") - 5).alias("doc_id"), F.col("id").cast("string").alias("_x"))
    ids = rows.where("doc_id % 40 = 0").select("doc_id")
    told = idfilter.maybe_among(rows, "doc_id", ids.union(ids))
    found = {r["doc_id"]: r["maybe"] for r in told.collect()}
    assert len(found) == 2000 == told.count() and all(found[d] for d in found if d % 40 == 0)
    assert sum(found.values()) == 50 if bits > 64 else sum(found.values()) > 50
    assert idfilter.maybe_among(rows, "doc_id", ids.where("false")).where("maybe").count() == 0


def test_stage_moves_no_row_that_surely_stays(spark, copies):
    # the whole rows went through the exchange of a join by id
    frame = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in copies], "doc_id long, text string, lang string, source string, n_chars long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = corpus_pipeline.deduplicated(spark, frame, "")._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Union" in plan and plan.count("BroadcastHashJoin") >= 2
