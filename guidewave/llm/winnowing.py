"""Document fingerprints by winnowing: rolling k-gram hashes, the minimum of every window, positions kept."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: code points of a gram and grams of a window: a passage of GRAM + WINDOW - 1 code points always shares a fingerprint
GRAM, WINDOW = 24, 41
_AT_ONCE = 1 << 20
_RADIX = np.uint64(0x9E3779B97F4A7C15 | 1)
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_LOW = np.uint64(0xFFFFFFFF)


def _rolling(points: np.ndarray) -> np.ndarray:
    """A 32-bit hash of every ``GRAM`` code points, or of all of them in a shorter text, by doubling the hashed length."""
    size = min(GRAM, len(points))
    n = len(points) - size + 1
    block, width, out, done = points.astype(np.uint64), 1, None, 0
    while True:
        if size & width:
            out = block if out is None else block[: len(out) - width] * _RADIX**np.uint64(done) + out[width:]
            done += width
        if done == size:
            break
        block = block[:-width] * _RADIX**np.uint64(width) + block[width:]
        width *= 2
    out = out[:n]
    out = (out ^ (out >> np.uint64(33))) * _MIX
    return out >> np.uint64(32)


def _window_minima(keys: np.ndarray) -> np.ndarray:
    """The minimum of every ``WINDOW`` consecutive keys: running minima within blocks, forwards and backwards."""
    n = len(keys) - WINDOW + 1
    pad = -len(keys) % WINDOW
    blocks = np.concatenate([keys, np.full(pad, ~np.uint64(0))]).reshape(-1, WINDOW)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n], ahead[WINDOW - 1 : WINDOW - 1 + n])


def winnow(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions (code points) of the fingerprint; equal hashes in a window: the rightmost.

    A text shorter than a window has one window, an empty text none.  Long
    texts are hashed in parts that overlap by a window.
    """
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    found = []
    for at in range(0, max(len(points) - GRAM - WINDOW + 2, 1), _AT_ONCE):
        part = points[at : at + _AT_ONCE + GRAM + WINDOW - 2]
        if not len(part):
            break
        hashes = _rolling(part)
        # smallest hash first, then the largest position
        keys = (hashes << np.uint64(32)) | (_LOW - (np.arange(len(hashes), dtype=np.uint64) + np.uint64(at)))
        least = _window_minima(keys) if len(keys) >= WINDOW else keys.min(keepdims=True)
        found.append(least[np.concatenate([[True], least[1:] != least[:-1]])])
    keys = np.concatenate(found) if found else np.zeros(0, np.uint64)
    if len(found) > 1:
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    return keys >> np.uint64(32), _LOW - (keys & _LOW)


def encoded(fingerprint: tuple[np.ndarray, np.ndarray]) -> str:
    """position:hash in order of position, comma-joined."""
    return ",".join([f"{p}:{h:08x}" for h, p in zip(fingerprint[0].tolist(), fingerprint[1].tolist())])


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Jaccard index of the two sets of hashes; 1 if both are empty."""
    x, y = np.unique(a[0]), np.unique(b[0])
    if not len(x) and not len(y):
        return 1.0
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return shared / (len(x) + len(y) - shared)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, hashes, positions) for every row of ``docs``; null texts are empty and have none."""
    def per_batch(batches):
        for batch in batches:
            found = [winnow(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([h.tolist() for h, _ in found], pa.list_(pa.int64())), pa.array([p.tolist() for _, p in found], pa.list_(pa.int64()))], ["doc_id", "hashes", "positions"])

    kept = docs.select("doc_id", docs["text"].cast("string").alias("text"))
    return kept.mapInArrow(per_batch, "doc_id {}, hashes array<long>, positions array<long>".format(kept.schema["doc_id"].dataType.simpleString()))


def _ranges(docs: DataFrame) -> DataFrame:
    """(part, last, at, doc_id, text): ``docs`` cut into ranges of ids, each followed (last = 1) by the first rows of the next one.

    Range bounds are quantiles of the ids, four ranges for every shuffle
    partition; each row moves once, and only the first rows of ranges twice.
    The last range is followed by the first row of all.  Null ids come first.
    """
    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    own = own.withColumn("at", F.coalesce("doc_id", F.lit(-(1 << 63))))
    wanted = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lowest, inner = own.agg(F.min("at"), F.percentile_approx("at", [k / wanted for k in range(1, wanted)], 10 * wanted)).first()
    bounds = np.array(sorted({lowest or 0, *(inner or [])}), np.int64)
    n = len(bounds)

    @F.pandas_udf("long")
    def placed(at: pd.Series) -> pd.Series:
        part = np.searchsorted(bounds, at.to_numpy(), "right") - 1
        return pd.Series(2 * part + (bounds[part] == at.to_numpy()))

    own = own.withColumn("placed", placed("at")).withColumn("part", F.expr("cast(placed div 2 as int)"))
    here = F.struct(F.col("part"), F.lit(0).alias("last"))
    before = F.struct(F.pmod(F.col("part") - 1, F.lit(n)).alias("part"), F.lit(1).alias("last"))
    goes = F.explode(F.when(F.col("placed") % 2 == 1, F.array(here, before)).otherwise(F.array(here)))
    moved = own.withColumn("goes", goes).select("goes.part", "goes.last", "at", "doc_id", "text")
    return moved.repartition("part").sortWithinPartitions("part", "last", "at", F.xxhash64("text"))


_PAIRED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by as many code points from the beginning of ``following``, or all."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _pairs(batches):
    names = [f.strip().split()[0] for f in _PAIRED.split(",")]
    waiting = None
    for batch in batches:
        out: list[list] = [[] for _ in names]
        for part, last, doc_id, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4))):
            if last and (waiting is None or waiting[0] != part):
                continue
            own = winnow(text)
            if waiting is not None:
                _, was_id, was_text, was = waiting
                new_text = edited(was_text, text)
                new = winnow(new_text)
                row = (was_id, len(was_text), hashlib.sha256(new_text.encode()).hexdigest(), encoded(was), encoded(new), likeness(was, new), likeness(was, own))
                for column, value in zip(out, row):
                    column.append(value)
            waiting = None if last else (part, doc_id, text, own)
        kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)


def compared(docs: DataFrame) -> DataFrame:
    """Every row's fingerprint beside that of its edited text and of the next row by doc_id (after the last: the first).

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next).  Null texts are empty; an empty text has an empty
    fingerprint, and two empty ones are alike (1).  Rows of one id follow each
    other in the order of a hash of their texts; a single row follows itself.
    Other columns are left out.
    """
    return _ranges(docs).mapInArrow(_pairs, _PAIRED)
