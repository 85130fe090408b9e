"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are sorted into tiles by the population counts of their four
16-bit quarters.  The counts of two fingerprints that differ in r bits differ by
at most r in sum, so only tiles within that distance meet; they are compared
whole with numpy exclusive-or and bit counts.  The result is exact.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.session import cut_lineage
from .textruns import texts_of

#: fingerprints in a tile on average, where a cell of population counts has more
TILE_ROWS = 1024
_QUARTERS, _LEVELS = 4, 17
_HASHED_AT_ONCE = 1 << 15
_digest = functools.partial(xxhash.xxh64_intdigest, seed=42)


def simhash(text: bytes, shingle: int = 3) -> int:
    """The 64-bit SimHash of a text's word shingles, each repeat counted; no words: zero."""
    words = text.lower().split()
    grams = list(map(b" ".join, zip(*(words[i:] for i in range(shingle))))) if len(words) >= shingle else [b" ".join(words)] if words else []
    if not grams:
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(grams), _HASHED_AT_ONCE):
        part = grams[at : at + _HASHED_AT_ONCE]
        hashes = np.fromiter(map(_digest, part), np.uint64, len(part))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(ones * 2 > len(grams), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fingerprint): the signed 64-bit pattern of every document; null texts count as empty."""
    def per_batch(batches):
        for batch in batches:
            prints = [simhash(t, shingle) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(np.array(prints, np.uint64).view(np.int64))], ["doc_id", "fingerprint"])

    return texts_of(docs).mapInArrow(per_batch, "doc_id long, fingerprint long")


def _steps(radius: int) -> list[list[int]]:
    """Differences of quarter counts of at most ``radius`` in sum, one of each pair of opposite ones."""
    every = itertools.product(range(-radius, radius + 1), repeat=_QUARTERS)
    return [list(d) for d in every if sum(map(abs, d)) <= radius and d >= (0,) * _QUARTERS]


def _spanning(near: np.ndarray) -> tuple[list[int], list[int]]:
    """Rows and columns of fewer true cells than the sides' sum, which join the same rows and columns as all do."""
    rows, cols = [], []
    fresh_row, fresh_col = near.any(axis=1), near.any(axis=0)
    for start in np.flatnonzero(fresh_row).tolist():
        if not fresh_row[start]:
            continue
        fresh_row[start] = False
        waiting = [(start, True)]
        while waiting:
            at, is_row = waiting.pop()
            fresh = fresh_col if is_row else fresh_row
            new = np.flatnonzero((near[at] if is_row else near[:, at]) & fresh)
            fresh[new] = False
            for other in new.tolist():
                rows.append(at if is_row else other)
                cols.append(other if is_row else at)
                waiting.append((other, not is_row))
    return rows, cols


def _compare(batches, radius: int):
    for batch in batches:
        found = []
        same = batch.column(0).to_pylist()
        for k in range(batch.num_rows):
            a = batch.column(1)[k].values.to_numpy(zero_copy_only=False).view(np.uint64)
            b = batch.column(2)[k].values.to_numpy(zero_copy_only=False).view(np.uint64)
            near = np.bitwise_count(a[:, None] ^ b[None, :]) <= radius
            if same[k]:
                near &= np.tri(len(a), len(b), -1, dtype=bool)
            if near.any():
                rows, cols = _spanning(near) if np.count_nonzero(near) >= len(a) + len(b) else np.nonzero(near)
                found.append((a[rows], b[cols]))
        left = np.concatenate([x for x, _ in found]) if found else np.zeros(0, np.uint64)
        right = np.concatenate([y for _, y in found]) if found else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(left.view(np.int64)), pa.array(right.view(np.int64))], ["a", "b"])


def links(distinct: DataFrame, radius: int = 3) -> DataFrame:
    """(a, b): links between the given distinct fingerprints that join whatever lies within ``radius`` bits.

    Within a pair of tiles a dense block of links is thinned to a spanning
    forest, so the classes stay whole while their number stays linear.
    """
    quarter = lambda i: F.bit_count(F.shiftrightunsigned("fingerprint", 16 * i).bitwiseAND(F.lit(0xFFFF)))
    cell = F.array(*[quarter(i).cast("int") for i in range(_QUARTERS)])
    number = lambda c: functools.reduce(lambda x, y: x * _LEVELS + y, [c[i] for i in range(_QUARTERS)])
    placed = distinct.select("fingerprint", cell.alias("counts")).select("fingerprint", "counts", number(F.col("counts")).alias("cell"))
    # at most 17^4 cells, so this table may be broadcast at any size of the corpus
    sizes = placed.groupBy("cell").agg(F.ceil(F.count("*") / TILE_ROWS).alias("n_tiles"))
    tiles = (placed.join(F.broadcast(sizes), "cell")
             .groupBy("cell", F.pmod(F.xxhash64("fingerprint"), "n_tiles").alias("part"))
             .agg(F.first("counts").alias("counts"), F.collect_list("fingerprint").alias("members")))
    tiles = cut_lineage(tiles)
    step = F.explode(F.array(*[F.array(*map(F.lit, d)) for d in _steps(radius)]))
    left = tiles.select("cell", F.col("part").alias("part_a"), "counts", F.col("members").alias("xs"), step.alias("step"))
    other = F.transform(F.arrays_zip("counts", "step"), lambda z: z["counts"] + z["step"])
    left = (left.select(F.col("cell").alias("cell_a"), "part_a", "xs", other.alias("other"))
            .where(F.forall("other", lambda c: c.between(0, 16)))
            .select("cell_a", "part_a", "xs", number(F.col("other")).alias("cell")))
    right = tiles.select("cell", F.col("part").alias("part_b"), F.col("members").alias("ys"))
    met = left.join(right, "cell").where((F.col("cell_a") != F.col("cell")) | (F.col("part_a") <= F.col("part_b")))
    met = met.select(((F.col("cell_a") == F.col("cell")) & (F.col("part_a") == F.col("part_b"))).alias("same"), "xs", "ys")
    return met.mapInArrow(lambda batches: _compare(batches, radius), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable over ``edges``(a, b), for every node that has one.

    Rounds of smallest-neighbour labels and label jumping until nothing moves;
    each round is written to the shared folder.
    """
    both = cut_lineage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").select(F.col("a").alias("node"), "label")
        lower = cut_lineage(labels.unionByName(near).groupBy("node").agg(F.min("label").alias("label")))
        jump = lower.select(F.col("node").alias("label"), F.col("label").alias("next"))
        jumped = cut_lineage(lower.join(jump, "label").select("node", F.col("next").alias("label")))
        moved = jumped.join(labels.select("node", F.col("label").alias("was")), "node").where("label <> was").limit(1).count()
        labels = jumped
        if not moved:
            return labels


def near_duplicates(docs: DataFrame, radius: int = 3, shingle: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id): every row of ``docs`` with its class.

    Null and empty texts have the fingerprint zero and link like any other;
    repeated rows stay; other columns are ignored; an empty table gives none.
    """
    prints = cut_lineage(fingerprints(docs, shingle))
    distinct = cut_lineage(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")))
    labels = components(links(distinct, radius))
    rooted = cut_lineage(distinct.join(labels.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
                         .select("fingerprint", "first_id", F.coalesce("label", "fingerprint").alias("root")))
    smallest = cut_lineage(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")))
    classes = cut_lineage(rooted.join(smallest, "root").select("fingerprint", "component_id"))
    return prints.join(classes, "fingerprint", "left").select("doc_id", "fingerprint", "component_id")
