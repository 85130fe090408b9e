"""Arrow and numpy helpers for tasks that read whole texts in bounded slices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: bytes hashed at a time; longer texts are cut between words
SLICE_BYTES = 1 << 21

_RADIX = np.uint64(0x9E3779B97F4A7C15 | 1)
_RADIX_INVERSE = np.uint64(pow(int(_RADIX), -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)


def texts_of(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of ``docs`` with null texts as empty ones; all other columns are left out."""
    return docs.select(docs["doc_id"].alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))


def widened(schema: StructType, ddl: str) -> StructType:
    """``schema`` followed by the columns of ``ddl``."""
    return StructType([*schema.fields, *StructType.fromDDL(ddl).fields])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its row offsets; null rows are empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return body[bounds[0] : bounds[-1]], bounds - bounds[0]


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def word_classes() -> np.ndarray:
    """1 for bytes of words: digits, letters (after lower-casing) and everything beyond ASCII."""
    table = np.zeros(256, np.uint8)
    table[48:58] = table[97:123] = table[128:] = 1
    return table


def run_classes() -> np.ndarray:
    """As :func:`word_classes`, with 2 for visible marks; blanks and controls are 0."""
    table = word_classes()
    marks = np.arange(33, 127)
    table[marks[table[marks] == 0]] = 2
    return table


def runs(body: np.ndarray, bounds: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of one non-zero class; none crosses a row's bound."""
    kind = classes[body]
    if not len(kind):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.empty(len(kind) + 1, bool)
    cut[0] = cut[-1] = True
    np.not_equal(kind[1:], kind[:-1], out=cut[1:-1])
    cut[bounds] = True
    edges = np.flatnonzero(cut)
    own = kind[edges[:-1]] > 0
    return edges[:-1][own], edges[1:][own]


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, SLICE_BYTES)
        up, down = np.full(size, _RADIX), np.full(size, _RADIX_INVERSE)
        up[0] = down[0] = 1
        _POWERS[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    return _POWERS[0], _POWERS[1]


def run_hashes(body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run's bytes, from prefix sums over slices of at most about ``SLICE_BYTES``."""
    out, at, n = np.empty(len(starts), np.uint64), 0, len(starts)
    while at < n:
        base = starts[at]
        upto = max(int(np.searchsorted(ends, base + SLICE_BYTES, "right")), at + 1)
        piece = body[base : ends[upto - 1]]
        up, down = _powers(len(piece))
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * up[: len(piece)], out=sums[1:])
        s, e = starts[at:upto] - base, ends[at:upto] - base
        h = (sums[e] - sums[s]) * down[s]
        h ^= h >> np.uint64(29)
        h *= _MIX
        out[at:upto] = h ^ (h >> np.uint64(32))
        at = upto
    return out


def row_of(bounds: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The row in which each run lies."""
    return np.searchsorted(bounds, starts, "right") - 1


def row_slices(bounds: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes, or of one longer row."""
    at, n = 0, len(bounds) - 1
    while at < n:
        upto = max(int(np.searchsorted(bounds, bounds[at] + limit, "right")) - 1, at + 1)
        yield at, min(upto, n)
        at = upto
