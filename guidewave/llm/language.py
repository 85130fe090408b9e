"""Language identification by rank-order n-gram profiles and the out-of-place distance."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .textruns import widened

#: ranks kept in a profile, of a language and of a document
PROFILE_RANKS = 400
ORDERS = 3
UNDETERMINED = "und"

_LETTERS = re.compile(r"[^\W\d_]+")
_SHIFT = np.uint64(21)
_COUNTED_AT_ONCE = 1 << 21


def _padded(text: str) -> np.ndarray:
    """Code points of the lower-cased words, each between single blanks; empty without letters."""
    words = _LETTERS.findall(text.lower())
    if not words:
        return np.zeros(0, np.uint64)
    return np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le"), np.uint32).astype(np.uint64)


def _grams(points: np.ndarray) -> np.ndarray:
    """Codes of the n-grams of 1 to 3 code points; the single blank is none."""
    one = points
    two = (points[:-1] << _SHIFT) | points[1:]
    three = (two[:-1] << _SHIFT) | points[2:]
    return np.concatenate([one[one != 32], two, three])


def _counts(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    grams = np.sort(grams)
    at = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    return grams[at], np.diff(np.append(at, len(grams)))


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, inverse = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    return codes, np.bincount(inverse, np.concatenate([n for _, n in parts]).astype(np.float64)).astype(np.int64)


def _gram_counts(batches) -> Iterator[pa.RecordBatch]:
    """Sums of a whole task; a language's texts wait until they hold ``_COUNTED_AT_ONCE`` code points."""
    waiting: dict[str, list[np.ndarray]] = {}
    lengths: dict[str, int] = {}
    counted: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def fold(lang: str) -> None:
        new = _counts(np.concatenate([_grams(p) for p in waiting[lang]]))
        counted[lang] = _merge([counted[lang], new]) if lang in counted else new
        waiting[lang], lengths[lang] = [], 0

    for batch in batches:
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            points = _padded(text)
            if len(points):
                waiting.setdefault(lang, []).append(points)
                lengths[lang] = lengths.get(lang, 0) + len(points)
                if lengths[lang] >= _COUNTED_AT_ONCE:
                    fold(lang)
    for lang in [x for x in waiting if waiting[x]]:
        fold(lang)
    for lang, (codes, n) in counted.items():
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes.view(np.int64)), pa.array(n)], ["lang", "gram", "n"])


def profiles(docs: DataFrame, ranks: int = PROFILE_RANKS) -> DataFrame:
    """(lang, gram, rank): the most frequent n-grams of each language, ranked from 0 (ties by code), over all rows with a language."""
    learned = docs.where("lang is not null").select(F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"), docs["lang"].cast("string").alias("lang"))
    counts = learned.mapInArrow(_gram_counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return counts.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < ranks).select("lang", "gram", "rank")


class _Ranks:
    """All profiles as one sorted array of codes and a rank matrix (codes x languages)."""

    def __init__(self, rows: list[tuple[str, int, int]], ranks: int):
        self.langs = sorted({r[0] for r in rows})
        self.codes = np.unique(np.array([r[1] for r in rows], np.int64).view(np.uint64))
        self.table = np.full((len(self.codes) + 1, len(self.langs)), ranks, np.int32)
        self.known = np.zeros((len(self.codes) + 1, len(self.langs)), bool)
        column = {x: k for k, x in enumerate(self.langs)}
        for lang, gram, rank in rows:
            at = np.searchsorted(self.codes, np.int64(gram).view(np.uint64))
            self.table[at, column[lang]], self.known[at, column[lang]] = rank, True
        self.ranks = ranks

    def predict(self, text: str) -> tuple[str, float]:
        points = _padded(text)
        if not len(points) or not self.langs:
            return UNDETERMINED, 0.0
        codes, n = _counts(_grams(points))
        codes = codes[np.lexsort((codes, -n))[: self.ranks]]
        at = np.searchsorted(self.codes, codes)
        at[(at == len(self.codes)) | (self.codes[np.minimum(at, len(self.codes) - 1)] != codes)] = len(self.codes)
        away = np.where(self.known[at], np.abs(self.table[at] - np.arange(len(codes))[:, None]), self.ranks).sum(axis=0)
        best = int(np.argmin(away))
        return self.langs[best], float(1 - away[best] / (self.ranks * len(codes)))


def identify(docs: DataFrame, learn_from: DataFrame, ranks: int = PROFILE_RANKS) -> DataFrame:
    """``docs`` with lang_pred and score, from profiles learned on ``learn_from``.

    The language of least out-of-place distance wins (ties: the first name);
    score is one minus the distance as a share of the largest possible one.
    Null texts, texts without letters and every text when nothing was learned
    are ``und`` with score 0.  Only the text is read for a prediction; repeated
    rows and further columns stay.  The profiles sent to the tasks hold
    ``ranks`` rows a language.
    """
    learned = [(r["lang"], r["gram"], r["rank"]) for r in profiles(learn_from, ranks).collect()]
    model = docs.sparkSession.sparkContext.broadcast(_Ranks(learned, ranks))
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    at = kept.index("text")

    def per_batch(batches):
        for batch in batches:
            found = [model.value.predict(t or "") for t in batch.column(at).cast(pa.string()).to_pylist()]
            extra = [pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*kept, "lang_pred", "score"])

    schema = widened(docs.select(*kept).schema, "lang_pred string, score double")
    return docs.select(*kept).mapInArrow(per_batch, schema)
