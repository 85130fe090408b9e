"""Near-copies by SimHash tiles, each link verified by the exact similarity of word shingles.

Fingerprints are dealt to tiles by the number of distinct shingles, in geometric
bands.  Two texts of Jaccard similarity s have shingle counts of a ratio of s or
more, so they lie in the same or in neighbouring bands, whose tiles are compared
whole with exclusive-or and bit counts (at a radius of 14 population counts
would rule out hardly any pair).  What is near is then compared shingle by
shingle, the texts of a pair of tiles together, and only verified links join.
"""

from __future__ import annotations

import contextlib
import functools
import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.session import cut_lineage
from .idfilter import maybe_among
from .simhash import _spanning, components, simhash
from .textruns import texts_of

#: fingerprints in a tile on average; each is sent once per tile that its own one meets
TILE_ROWS = 1024
SHINGLE = 5
SIMILARITY = 0.8
#: bits by which candidates may differ; a similarity of 0.8 differs in 9.7 bits of 64 on average
RADIUS = 14
#: shingles of a piece of a tile; only a longer text has more
PIECE_SHINGLES = 1 << 19
#: rows of an Arrow batch: a pair of tiles has some 64 KB, a text has no bound
_TILE_PAIRS, _TEXTS = 32, 256
#: pairs of texts up to which those that share a shingle are listed, pairs listed and columns multiplied at a time
_LISTED, _LISTED_AT_ONCE, _COLUMNS = 256, 1 << 20, 1024
#: fingerprints of a tile that are held against another tile at a time
_COMPARED_AT_ONCE = 128
_digest = functools.partial(xxhash.xxh64_intdigest, seed=42)
_PAIR = ["cell_a", "part_a", "cell_b", "part_b"]
_GROUP = [*_PAIR, "i", "j"]


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int):
    """Arrow batches of at most ``rows`` rows for the tables written inside; the setting is put back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, was)


def shingles(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles; fewer words are one shingle, no words none."""
    words = text.lower().split()
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else iter([b" ".join(words)] if words else [])
    return np.unique(np.fromiter(map(_digest, grams), np.uint64))


def _described(batches, shingle: int):
    for batch in batches:
        texts = batch.column(1).cast(pa.large_binary())
        rows = []
        for k in range(batch.num_rows):
            text = texts[k].as_py()
            rows.append((hashlib.sha256(b" ".join(text.lower().split())).digest(), simhash(text, shingle), len(shingles(text, shingle))))
        prints = np.array([r[1] for r in rows], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array([r[0] for r in rows], pa.binary()), pa.array(prints), pa.array([r[2] for r in rows], pa.int64())],
                                         ["doc_id", "words", "fingerprint", "size"])


def _candidates(x: dict[str, np.ndarray], y: dict[str, np.ndarray], radius: int, similarity: float) -> np.ndarray:
    """Which rows of two sides are near, of like size and not the same node."""
    near = np.zeros((len(x["node"]), len(y["node"])), bool)
    for at in range(0, len(near), _COMPARED_AT_ONCE):
        part = {k: v[at : at + _COMPARED_AT_ONCE, None] for k, v in x.items()}
        rows = np.bitwise_count((part["fingerprint"] ^ y["fingerprint"]).view(np.uint64)) <= radius
        if rows.any():
            rows &= np.minimum(part["size"], y["size"]) >= similarity * np.maximum(part["size"], y["size"]) * (1 - 1e-12)
            near[at : at + _COMPARED_AT_ONCE] = rows & (part["node"] != y["node"])
    return near


def _pieces(size: np.ndarray) -> list[np.ndarray]:
    """Places cut into runs of some PIECE_SHINGLES shingles, a larger text alone."""
    number = (np.cumsum(size) - size) // PIECE_SHINGLES
    return np.split(np.arange(len(size)), np.flatnonzero(np.diff(number)) + 1)


def _near(batches, radius: int, similarity: float):
    """The nodes of every tile pair that have a candidate on the other side, by pairs (i, j) of pieces of the two tiles."""
    column = lambda x, name: x.values.field(name).to_numpy(zero_copy_only=False)
    for batch in batches:
        keys = [batch.column(k).to_pylist() for k in range(4)]
        met, nodes, prints, second = [], [], [], []
        for k in range(batch.num_rows):
            x, y = ({c: column(side, c) for c in ("fingerprint", "node", "size")} for side in (batch.column(4)[k], batch.column(5)[k]))
            near = _candidates(x, y, radius, similarity)
            if not near.any():
                continue
            same = keys[0][k] == keys[2][k] and keys[1][k] == keys[3][k]
            for i, left in enumerate(_pieces(x["size"])):
                for j, right in enumerate(_pieces(y["size"])):
                    part = near[np.ix_(left, right)] if not same or i <= j else np.zeros((0, 0), bool)
                    for side, at, beside in ((x, left[part.any(axis=1)], False), (y, right[part.any(axis=0)], True)) if part.any() else ():
                        met += [(*(key[k] for key in keys), i, j)] * len(at)
                        nodes.append(side["node"][at])
                        prints.append(side["fingerprint"][at])
                        second += [beside] * len(at)
        told = [pa.array([m[c] for m in met], pa.int64()) for c in range(len(_GROUP))]
        joined = [pa.array(np.concatenate(side).astype(np.int64) if side else np.zeros(0, np.int64)) for side in (nodes, prints)]
        yield pa.RecordBatch.from_arrays([*told, *joined, pa.array(second, pa.bool_())], [*_GROUP, "node", "fingerprint", "second"])


def _common(first: list[np.ndarray], second: list[np.ndarray]) -> np.ndarray:
    """How many elements each two of the sorted distinct arrays share.

    Elements that many arrays hold are multiplied as 0/1 columns; the pairs of
    arrays that share any other element are listed, some at a time.
    """
    out = np.zeros((len(first), len(second)))
    vocabulary = np.intersect1d(np.concatenate([*first, np.zeros(0, np.uint64)]), np.concatenate([*second, np.zeros(0, np.uint64)]))
    sides = []
    for side in (first, second):
        row, value = np.repeat(np.arange(len(side)), [len(v) for v in side]), np.concatenate([*side, np.zeros(0, np.uint64)])
        code = np.searchsorted(vocabulary, value)
        held = code < len(vocabulary)
        held[held] = vocabulary[code[held]] == value[held]
        order = np.argsort(code[held], kind="stable")
        code = code[held][order]
        sides.append((row[held][order], code, np.bincount(code, minlength=len(vocabulary))))
    (row_x, code_x, n_x), (row_y, code_y, n_y) = sides
    often = n_x * n_y > _LISTED
    # a place among the frequent elements
    place = np.cumsum(often) - 1
    for at in range(0, int(often.sum()), _COLUMNS):
        held = np.zeros((len(first), _COLUMNS), np.float32), np.zeros((len(second), _COLUMNS), np.float32)
        for matrix, row, code in ((held[0], row_x, code_x), (held[1], row_y, code_y)):
            chosen = often[code] & (place[code] >= at) & (place[code] < at + _COLUMNS)
            matrix[row[chosen], place[code[chosen]] - at] = 1.0
        out += held[0] @ held[1].T
    chosen = ~often[code_x]
    row_x, code_x, starts = row_x[chosen], code_x[chosen], np.cumsum(n_y) - n_y
    times = n_y[code_x]
    number = (np.cumsum(times) - times) // _LISTED_AT_ONCE
    for part in np.split(np.arange(len(row_x)), np.flatnonzero(np.diff(number)) + 1):
        of = np.repeat(part, times[part])
        nth = np.arange(len(of)) - np.repeat(np.cumsum(times[part]) - times[part], times[part])
        out += np.bincount(row_x[of] * len(second) + row_y[starts[code_x[of]] + nth], minlength=out.size).reshape(out.shape)
    return out


def _linked(table: pa.Table, shingle: int, radius: int, similarity: float) -> pa.Table:
    """Verified links (a, b) of two pieces; of more than their rows a spanning forest."""
    texts, second = table.column("text").cast(pa.large_binary()), table.column("second").to_numpy(zero_copy_only=False)
    known: dict[int, np.ndarray] = {}
    sides = []
    for chosen in (~second, second):
        at = np.flatnonzero(chosen)
        side = {c: table.column(c).to_numpy()[at] for c in ("node", "fingerprint")}
        for node, k in zip(side["node"].tolist(), at.tolist()):
            if node not in known:
                known[node] = shingles(texts[k].as_py(), shingle)
        side["sets"] = [known[node] for node in side["node"].tolist()]
        side["size"] = np.array([len(v) for v in side["sets"]], np.int64)
        sides.append(side)
    x, y = sides
    near = _candidates(*({c: side[c] for c in ("node", "fingerprint", "size")} for side in sides), radius, similarity)
    if np.count_nonzero(near) < near.shape[0] + near.shape[1]:
        rows, cols = np.nonzero(near)
        both = np.array([len(np.intersect1d(x["sets"][r], y["sets"][c], assume_unique=True)) for r, c in zip(rows, cols)], float)
        share = both / np.maximum(x["size"][rows] + y["size"][cols] - both, 1)
        rows, cols = rows[share >= similarity], cols[share >= similarity]
    else:
        both = _common(x["sets"], y["sets"])
        near &= both / np.maximum(x["size"][:, None] + y["size"][None, :] - both, 1) >= similarity
        rows, cols = _spanning(near) if np.count_nonzero(near) >= near.shape[0] + near.shape[1] else np.nonzero(near)
    return pa.table({"a": x["node"][rows].astype(np.int64), "b": y["node"][cols].astype(np.int64)})


def tile_pairs(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes with their (cell, part), and the pairs of tiles that can hold links: those of one band and of two neighbouring ones.

    The table of cells has one row per band of sizes, some 100 rows at any size of the corpus.
    """
    sizes = nodes.groupBy("cell").agg(F.ceil(F.count("*") / TILE_ROWS).alias("n_tiles"))
    placed = nodes.join(F.broadcast(sizes), "cell").withColumn("part", F.pmod(F.xxhash64("node"), F.col("n_tiles")))
    reach = sizes.select(F.col("cell").alias("cell_a"), F.col("n_tiles").alias("n_a"), F.explode(F.array(F.col("cell"), F.col("cell") + 1)).alias("cell"))
    met = reach.join(F.broadcast(sizes.withColumnRenamed("n_tiles", "n_b")), "cell").withColumnRenamed("cell", "cell_b")
    parts = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    met = met.select("cell_a", "cell_b", "n_b", parts("n_a").alias("part_a")).select("cell_a", "cell_b", "part_a", parts("n_b").alias("part_b"))
    return placed, met.where((F.col("cell_a") != F.col("cell_b")) | (F.col("part_a") <= F.col("part_b"))).select(*[F.col(c).cast("long").alias(c) for c in _PAIR])


def classes(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """(doc_id, class_id): every row of ``docs`` with the smallest doc_id of its class; doc_id must be unique.

    Texts of equal words (A-Z lower-cased) are one node; nodes are linked if
    their sets of ``shingle``-word shingles have a Jaccard similarity of
    ``similarity`` or more and their fingerprints differ in at most ``radius``
    bits.  Null texts and texts without words are one class.  Very long texts
    are read whole.  Other columns are ignored; an empty table gives none.

    The texts of a tile pair's candidates meet in one task, in pieces of bounded
    size, so a text is sent once per tile pair and refuted candidates leave no row;
    a dense block of verified links is thinned to a spanning forest.
    """
    spark = docs.sparkSession
    texts = texts_of(docs)
    with batches_of(spark, _TEXTS):
        rows = cut_lineage(texts.mapInArrow(lambda batches: _described(batches, shingle), "doc_id long, words binary, fingerprint long, size long"))
    band = F.floor(F.log(F.greatest(F.col("size"), F.lit(1))) / math.log(1 / similarity))
    nodes = rows.groupBy("words").agg(F.min("doc_id").alias("node"), F.first("fingerprint").alias("fingerprint"), F.first("size").alias("size"))
    nodes = cut_lineage(nodes.withColumn("cell", band))
    placed, met = tile_pairs(nodes)
    tiles = cut_lineage(placed.groupBy("cell", "part").agg(F.collect_list(F.struct("fingerprint", "node", "size")).alias("members")))
    side = lambda s: tiles.select(F.col("cell").alias(f"cell_{s}"), F.col("part").alias(f"part_{s}"), F.col("members").alias(f"members_{s}"))
    # pairs stay where their second tile is: moved again, they would be two tiles each
    met = met.join(side("a"), ["cell_a", "part_a"]).join(side("b"), ["cell_b", "part_b"]).select(*_PAIR, "members_a", "members_b")
    with batches_of(spark, _TILE_PAIRS):
        found = cut_lineage(met.mapInArrow(lambda batches: _near(batches, radius, similarity), ", ".join(f"{c} long" for c in (*_GROUP, "node", "fingerprint")) + ", second boolean"))
    wanted = maybe_among(texts.withColumnRenamed("doc_id", "node"), "node", found).where("maybe").select("node", "text")
    held = found.join(wanted, "node")
    links = cut_lineage(held.groupBy(*_GROUP).applyInArrow(lambda table: _linked(table, shingle, radius, similarity), "a long, b long"))
    labels = components(links)
    owned = nodes.join(labels, "node", "left").select("words", F.coalesce("label", "node").alias("node"))
    return rows.join(owned, "words").select("doc_id", F.col("node").alias("class_id"))
