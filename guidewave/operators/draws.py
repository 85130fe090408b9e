"""Random label draws that tasks make for themselves: which cells a permutation puts among the first n, without moving ranks.

A permutation orders the cells by a random polynomial of degree 3 over a prime field, taken at a hash of the cell id.
Such values are four-wise independent, so counts over pairs of cells have the mean and the variance of uniform draws.
A draw of n cells is those with values up to the n-th smallest, which is found exactly by counting below probes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: the field: values are below this prime, products of two fit 64 bits
PRIME = (1 << 31) - 1
#: probes put into every open interval of a round
PROBES = 32
#: permutations evaluated at a time for a batch of cells or edges
_PERMS_AT_ONCE = 16


def coefficients(n_permutations: int, seed: int) -> np.ndarray:
    """Four field elements per permutation, from digests of ``seed|permutation|place``."""
    digest = lambda p, c: int(hashlib.sha256(f"{seed}|{p}|{c}".encode()).hexdigest()[:13], 16) % PRIME
    return np.array([[digest(p, c) for c in range(4)] for p in range(1, n_permutations + 1)], np.int64)


def cell_key(cell_id: Column) -> Column:
    """A field element per cell, from the digest of its id."""
    return (F.conv(F.substring(F.sha2(cell_id.cast("string").cast("binary"), 256), 1, 13), 16, 10).cast("long") % PRIME).alias("key")


def values(keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The value of every key (column) under every permutation (row of coefficients)."""
    out = np.broadcast_to(rows[:, :1], (len(rows), len(keys))).copy()
    for c in range(1, 4):
        out = (out * keys[None, :] + rows[:, c : c + 1]) % PRIME
    return out


def _counts_below(keys: DataFrame, rows: np.ndarray, probes: np.ndarray) -> np.ndarray:
    """Cells whose value is at or below each probe: permutations x probes (ascending in a row)."""
    n, width = probes.shape

    def count(batches):
        total = np.zeros((n, width + 1), np.int64)
        for batch in batches:
            own = batch.column(0).to_numpy()
            for k in range(n):
                v = values(own, rows[k : k + 1])[0]
                total[k] += np.bincount(np.searchsorted(probes[k], v, "left"), minlength=width + 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.reshape(-1)[at])], ["at", "n"])

    flat = np.zeros(n * (width + 1), np.int64)
    for r in keys.mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():  # one row per probe at most
        flat[r["at"]] = r["n"]
    return np.cumsum(flat.reshape(n, width + 1)[:, :-1], axis=1)


def thresholds(keys: DataFrame, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Permutations x sizes: the value up to which a draw of each size reaches, ties with the last cell included.

    ``keys(key)`` is one written row per cell.  Intervals begin around the expected place
    and are halved by probes until they hold one value; one that misses starts anew from
    the whole field.
    """
    n = keys.count()
    share = np.minimum(sizes / n, 1.0)
    spread = 8 * np.sqrt(share * (1 - share) / n) * PRIME + 64
    low = np.tile(np.maximum(share * PRIME - spread, -1).astype(np.int64), (len(rows), 1))
    high = np.tile(np.minimum(share * PRIME + spread, PRIME - 1).astype(np.int64), (len(rows), 1))
    wanted = np.minimum(sizes, n)
    sure_low, sure_high = low < 0, high == PRIME - 1
    while ((high - low > 1) | ~sure_low | ~sure_high).any():
        step = np.linspace(0, 1, PROBES + 2)
        inside = (low[..., None] + ((high - low)[..., None] * step)).astype(np.int64)  # ends included
        flat = inside.reshape(len(rows), -1)
        order = np.argsort(flat, axis=1, kind="stable")
        counts = np.empty_like(flat)
        np.put_along_axis(counts, order, _counts_below(keys, rows, np.take_along_axis(flat, order, 1)), 1)
        counts = counts.reshape(inside.shape)
        enough = counts >= wanted[None, :, None]
        missed_low, missed_high = enough[..., 0] & (low >= 0), ~enough[..., -1]
        first = np.argmax(enough, axis=2)
        new_high = np.take_along_axis(inside, first[..., None], 2)[..., 0]
        new_low = np.take_along_axis(inside, np.maximum(first - 1, 0)[..., None], 2)[..., 0]
        high = np.where(missed_high, PRIME - 1, np.where(missed_low, low, new_high))
        low = np.where(missed_low, -1, np.where(missed_high, inside[..., -1], new_low))
        sure_low, sure_high = np.ones_like(sure_low), np.ones_like(sure_high)
    return high


def edge_counts(edges: DataFrame, rows: np.ndarray, limits: np.ndarray) -> DataFrame:
    """(perm, level, n): edges (src, dst) whose later end falls into the level, level l being the draws from size l on.

    Only ids move to the tasks; each evaluates all permutations for its edges and sends
    permutations x levels counts.
    """
    n_levels = limits.shape[1]

    def count(batches):
        total = np.zeros((len(rows), n_levels + 1), np.int64)
        for batch in batches:
            src, dst = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for start in range(0, len(rows), _PERMS_AT_ONCE):
                part = rows[start : start + _PERMS_AT_ONCE]
                later = np.maximum(values(src, part), values(dst, part))
                for k, v in enumerate(later):
                    total[start + k] += np.bincount(np.searchsorted(limits[start + k], v, "left"), minlength=n_levels + 1)
        perm, level = np.nonzero(total[:, :-1])
        yield pa.RecordBatch.from_arrays([pa.array(perm.astype(np.int32) + 1), pa.array(level.astype(np.int32)), pa.array(total[perm, level])], ["perm", "level", "n"])

    keyed = edges.select(cell_key(F.col("src")).alias("src"), cell_key(F.col("dst")).alias("dst"))
    return keyed.mapInArrow(count, "perm int, level int, n long").groupBy("perm", "level").agg(F.sum("n").alias("n"))
