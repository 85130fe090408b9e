"""Benchmark decontamination: a hash set of normalised test n-grams scanned over training texts, hits verified."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.session import cut_lineage
from .textruns import lower_table, row_of, row_slices, run_hashes, runs, text_bytes, texts_of, word_classes

WINDOW = 10
#: test texts are broadcast up to this many bytes, and scanned in parts of this size beyond
PART_BYTES = 64 << 20
_SLICE = 4 << 20
_FILTER_BITS = 20
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[bytes]:
    body = lower_table()[np.frombuffer(text.encode(), np.uint8)]
    starts, ends = runs(body, np.array([0, len(body)]), word_classes())
    raw = body.tobytes()
    return [raw[s:e] for s, e in zip(starts.tolist(), ends.tolist())]


def _rolled(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive word hashes."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for k in range(1, size):
        out *= _STEP
        out += hashes[k : k + n]
    out ^= out >> np.uint64(31)
    return out


class _Windows:
    """The windows of test items of one word count: sorted hashes, a bit filter, and the items with their words by hash."""

    def __init__(self, size: int, windows: dict[tuple[bytes, ...], set[str]]):
        self.size = size
        grams = list(windows)
        flat = [w for g in grams for w in g]
        body = np.frombuffer(b"".join(flat), np.uint8)
        ends = np.cumsum([len(w) for w in flat])
        starts = ends - np.array([len(w) for w in flat])
        words = run_hashes(body, starts, ends).reshape(len(grams), size)
        own = words[:, 0].copy()
        for k in range(1, size):
            own *= _STEP
            own += words[:, k]
        own ^= own >> np.uint64(31)
        self.items: dict[int, list[tuple[tuple[bytes, ...], set[str]]]] = {}
        for h, g in zip(own.tolist(), grams):
            self.items.setdefault(h, []).append((g, windows[g]))
        self.sorted = np.unique(own)
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[(self.sorted >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def candidates(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rolled = _rolled(hashes, self.size)
        at = np.flatnonzero(self.filter[(rolled >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        at = at[np.isin(rolled[at], self.sorted)]
        return at, rolled[at]


def _item_windows(items: list[tuple[str, str]], window: int) -> list[_Windows]:
    by_size: dict[int, dict[tuple[bytes, ...], set[str]]] = {}
    for item, text in items:
        words = words_of(text)
        size = min(len(words), window)
        for i in range(len(words) - size + 1 if size else 0):
            by_size.setdefault(size, {}).setdefault(tuple(words[i : i + size]), set()).add(item)
    return [_Windows(size, by_size[size]) for size in sorted(by_size)]


def _scan(batches, sets: list[_Windows]):
    lower, classes = lower_table(), word_classes()
    for batch in batches:
        n_rows = batch.num_rows
        body, bounds = text_bytes(batch.column(1))
        n_words, spans, found = np.zeros(n_rows, np.int64), [[] for _ in range(n_rows)], [set() for _ in range(n_rows)]
        for lo, hi in row_slices(bounds, _SLICE):
            part, cuts = lower[body[bounds[lo] : bounds[hi]]], bounds[lo : hi + 1] - bounds[lo]
            starts, ends = runs(part, cuts, classes)
            if not len(starts):
                continue
            row = row_of(cuts, starts)
            n_words[lo:hi] = np.bincount(row, minlength=hi - lo)[: hi - lo]
            first = np.searchsorted(row, row, "left")
            hashes = run_hashes(part, starts, ends)
            for s in sets:
                at, keys = s.candidates(hashes)
                for i, key in zip(at.tolist(), keys.tolist()):
                    if row[i] != row[i + s.size - 1]:
                        continue
                    gram = tuple(part[starts[j] : ends[j]].tobytes() for j in range(i, i + s.size))
                    for words, items in s.items[key]:
                        if words == gram:
                            r, w = lo + int(row[i]), int(i - first[i])
                            spans[r].append((w, w + s.size))
                            found[r].update(items)
        merged = []
        for own in spans:
            out: list[list[int]] = []
            for a, b in sorted(own):
                if out and a <= out[-1][1]:
                    out[-1][1] = max(out[-1][1], b)
                else:
                    out.append([a, b])
            merged.append([{"first": a, "past": b} for a, b in out])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_words), pa.array(merged, pa.list_(pa.struct([("first", pa.int32()), ("past", pa.int32())]))), pa.array([sorted(x) for x in found], pa.list_(pa.string()))],
            ["doc_id", "n_words", "spans", "items"])


def _once(docs: DataFrame, items: DataFrame, window: int) -> DataFrame:
    sets = docs.sparkSession.sparkContext.broadcast(_item_windows([(r[0], r[1]) for r in items.collect()], window))
    own = texts_of(docs)
    ids = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(lambda batches: _scan(batches, sets.value), f"doc_id {ids}, n_words long, spans array<struct<first:int,past:int>>, items array<string>")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, spans, items): word spans covered by windows of test items, and those items, for every row.

    Texts are lower-cased in A-Z and cut into words; an item of fewer words than
    ``window`` is one window, one without words none.  Null texts have no words;
    repeated rows stay.  The test texts' size is read first: up to
    ``PART_BYTES`` they are broadcast at once, beyond in as many parts, and the
    parts' findings are summed per document.
    """
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.coalesce(benchmark["text"].cast("string"), F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    if total <= PART_BYTES:
        return _once(docs, items, window)
    n_parts = -(-total // PART_BYTES)
    keyed = cut_lineage(docs.select(F.col("doc_id").alias("own_id"), F.monotonically_increasing_id().alias("doc_id"), "text"))
    found = None
    for k in range(n_parts):
        part = _once(keyed, items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n_parts)) == k), window)
        found = part if found is None else found.unionByName(part)
    flat = (found.groupBy("doc_id").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")))
    # one document's spans, sorted: a span that begins before the last end extends it
    joined = F.aggregate(F.array_sort("spans"), F.array().cast("array<struct<first:int,past:int>>"),
                         lambda acc, s: F.when(F.size(acc) == 0, F.array(s)).when(s["first"] <= F.element_at(acc, -1)["past"],
                         F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["first"].alias("first"), F.greatest(F.element_at(acc, -1)["past"], s["past"]).alias("past"))))).otherwise(F.concat(acc, F.array(s))))
    return keyed.select("own_id", "doc_id").join(flat, "doc_id").select(F.col("own_id").alias("doc_id"), "n_words", joined.alias("spans"), "items")


def n_hit(spans: str = "spans"):
    """Number of words inside the spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, s: total + s["past"] - s["first"])


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, spans: bool = False) -> DataFrame:
    """``docs`` without contamination: hit documents leave, or with ``spans=True`` only their hit words do.

    Works row by row on the scanned columns, so all columns of ``docs`` stay.
    Cutting spans removes the text from a span's first word to its last and
    sets ``n_chars`` anew; it asks for test texts of at most ``PART_BYTES``.
    """
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")), F.coalesce(benchmark["text"].cast("string"), F.lit("")))
    if (benchmark.agg(F.sum(F.octet_length(benchmark["text"].cast("string")) + 16)).first()[0] or 0) > PART_BYTES:
        if spans:
            raise ValueError("test texts beyond PART_BYTES: cut spans part by part")
        keyed = cut_lineage(docs.select(F.monotonically_increasing_id().alias("doc_id"), "text", F.struct(*docs.columns).alias("own")))
        hit = contamination(keyed, benchmark, window).where(F.size("spans") > 0).select("doc_id")
        return keyed.join(hit, "doc_id", "left_anti").select("own.*")
    sets = docs.sparkSession.sparkContext.broadcast(_item_windows([(r[0], r[1]) for r in items.collect()], window))
    at = docs.columns.index("text")

    def keep(batches):
        for batch in batches:
            text = batch.column(at).cast(pa.string())
            pair = pa.RecordBatch.from_arrays([pa.array(np.zeros(batch.num_rows, np.int64)), text.fill_null("")], ["doc_id", "text"])
            hits = next(_scan([pair], sets.value)).column(2).to_pylist() if batch.num_rows else []
            if not spans:
                yield batch.filter(pa.array([not h for h in hits], pa.bool_()))
                continue
            texts = [t if not h else _without(t, h) for t, h in zip(text.to_pylist(), hits)]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.column(at).type)
            if "n_chars" in batch.schema.names:
                k = batch.schema.names.index("n_chars")
                columns[k] = pa.array([len(t) if h else n for t, h, n in zip(texts, hits, columns[k].to_pylist())], batch.column(k).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(keep, docs.schema)


def _without(text: str, spans: list[dict]) -> str:
    raw = text.encode()
    body = lower_table()[np.frombuffer(raw, np.uint8)]
    starts, ends = runs(body, np.array([0, len(body)]), word_classes())
    out, at = [], 0
    for s in spans:
        out.append(raw[at : starts[s["first"]]])
        at = ends[s["past"] - 1]
    return b"".join([*out, raw[at:]]).decode()
