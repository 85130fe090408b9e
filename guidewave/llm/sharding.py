"""Histogram sort: shards of near-equal bytes over a sort key, one exchange."""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.session import cut_lineage
from .textruns import widened

SHARDS = 24
#: bytes by which a splitter may miss its target, as a share of a shard
TOLERANCE = 0.002
#: candidate boundaries put into each open interval per round
PROBES = 256
#: rows of one sorted slice of a shard
SLICE_ROWS = 100_000

_LOW, _HIGH = -(1 << 127), 1 << 127
_HALF = 1 << 64


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, k1, k2): bytes plus 8, and the two halves of the sort key.

    k1 is a hash of the text, so equal texts are neighbours; k2 is a hash of the
    id, so that a text which many rows share can still be cut.
    """
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    return docs.select(docs["doc_id"].alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
                       F.xxhash64(text).alias("k1"), F.xxhash64("doc_id").alias("k2"))


def _key(k1: int, k2: int) -> int:
    """Both halves as one integer that sorts as the pair does."""
    return k1 * _HALF + k2 + _HALF // 2


def _halves(key: int) -> tuple[int, int]:
    k1, rest = divmod(key, _HALF)
    return k1, rest - _HALF // 2


def _place(k1: np.ndarray, k2: np.ndarray, bounds: list[tuple[int, int]]) -> np.ndarray:
    """Number of bounds at or below each key: equal first halves are settled by the second."""
    b1, b2 = np.array([b[0] for b in bounds], np.int64), np.array([b[1] for b in bounds], np.int64)
    low, high = np.searchsorted(b1, k1, "left"), np.searchsorted(b1, k1, "right")
    tied = np.flatnonzero(low < high)
    for value in np.unique(k1[tied]):
        own = tied[k1[tied] == value]
        a, b = low[own[0]], high[own[0]]
        low[own] += np.searchsorted(b2[a:b], k2[own], "right")
    return low


def _below(keys: DataFrame, probes: list[int]) -> list[tuple[int, int]]:
    """Exact bytes and rows below each probe."""
    bounds = [_halves(p) for p in probes]

    def count(batches):
        total, rows = np.zeros(len(bounds) + 1, np.int64), np.zeros(len(bounds) + 1, np.int64)
        for batch in batches:
            at = _place(batch.column(0).to_numpy(), batch.column(1).to_numpy(), bounds)
            np.add.at(total, at, batch.column(2).to_numpy())
            rows += np.bincount(at, minlength=len(rows))
        full = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(total[full]), pa.array(rows[full])], ["bucket", "bytes", "n"])

    counts = np.zeros((len(bounds) + 1, 2), np.int64)
    for r in keys.select("k1", "k2", "size").mapInArrow(count, "bucket long, bytes long, n long").groupBy("bucket").agg(F.sum("bytes"), F.sum("n")).collect():
        counts[r[0]] = r[1:]
    return [(b, n) for b, n in np.cumsum(counts[:-1], axis=0).tolist()]


def splitters(keys: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, probes: int = PROBES) -> list[tuple[int, int]]:
    """The keys at which shards 1, 2, ... begin.

    Each round counts the exact bytes below evenly spaced probes in the
    intervals that still hold a target, and narrows them, until every splitter
    lies within ``tolerance`` of a shard's bytes of its target or no other key
    lies nearer (a text may be longer than the tolerance).
    """
    total, n = keys.agg(F.sum("size"), F.count("*")).first()
    total = total or 0
    targets = [total * s / shards for s in range(1, shards)]
    counted = {_LOW: (0, 0), _HIGH: (total, n)}
    while True:
        known = sorted(counted)
        bytes_of = [counted[k][0] for k in known]
        asked: set[int] = set()
        around = []
        for t in targets:
            at = bisect.bisect_left(bytes_of, t)
            low, high = known[max(at - 1, 0)], known[at]
            above, below = counted[high][0] - t, t - counted[low][0]
            around.append(high if above <= below else low)
            if min(above, below) > tolerance * total / shards and high - low > 1 and counted[high][1] - counted[low][1] > 1:
                step = max((high - low) // (probes + 1), 1)
                asked.update(range(low + step, min(high, low + step * probes + 1), step))
        if not asked:
            return [_halves(min(k, _HIGH - 1)) for k in around]
        order = sorted(asked)
        counted.update(zip(order, _below(keys, order)))


def assign(keys: DataFrame, bounds: list[tuple[int, int]]) -> DataFrame:
    """``keys`` with shard: the number of splitters at or below the key."""
    def per_batch(batches):
        for batch in batches:
            at = _place(batch.column("k1").to_numpy(), batch.column("k2").to_numpy(), bounds)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at.astype(np.int32))], names=[*batch.schema.names, "shard"])

    return keys.mapInArrow(per_batch, widened(keys.schema, "shard int"))


def slots(placed: DataFrame) -> DataFrame:
    """``placed`` with slot: gapless from 0 in every shard.

    A shard is cut into slices by the id's hash, so that no task sorts a whole
    shard; the slices' sizes become their first slots.
    """
    n = placed.groupBy("shard").count()
    slices = placed.join(F.broadcast(n.select("shard", F.ceil(F.col("count") / SLICE_ROWS).alias("_n"))), "shard").withColumn("_slice", F.pmod(F.xxhash64("k2"), "_n"))
    starts = slices.groupBy("shard", "_slice").agg(F.count("*").alias("_rows"))
    starts = starts.withColumn("_start", F.sum("_rows").over(Window.partitionBy("shard").orderBy("_slice")) - F.col("_rows")).drop("_rows")
    inside = Window.partitionBy("shard", "_slice").orderBy("k1", "k2", "doc_id", "size")
    return (slices.withColumn("_at", F.row_number().over(inside) - 1).join(starts, ["shard", "_slice"])
            .withColumn("slot", (F.col("_start") + F.col("_at")).cast("long")).drop("_n", "_slice", "_start", "_at"))


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard): every row in a shard of near-equal bytes.

    The texts are read once for sizes and keys, which are written to the shared
    folder; the rounds count over those, and they are exchanged once.  Null
    texts have 8 bytes and the checksum of no bytes; repeated rows get slots of
    their own; an empty table gives none.  Other columns are ignored.
    """
    keys = cut_lineage(sized(docs))
    placed = assign(keys, splitters(keys, shards))
    return slots(placed).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
