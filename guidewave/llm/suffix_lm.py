"""Language-model scoring by a probabilistic suffix tree, with a unigram base.

The tree's symbols are the bytes of a word and a closing mark; a context is at
most ``DEPTH`` symbols, counted from the last mark on.  A context stays in the
tree if it is frequent enough and its next-symbol distribution diverges from
that of its longest proper suffix, or if a longer kept one needs it.  Every
symbol is scored in the longest suffix that is a state of the tree.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.session import cut_lineage
DEPTH = 6
#: least number of symbols that a context precedes, at every size of the corpus
LEAST = 2
#: a context stays if N(s) KL(P(.|s) || P(.|suffix)) is above this many nats per log of all symbols
DIVERGENCE = 2.0
#: weight of the suffix's distribution in a state's own, in counts
SMOOTHING = 4.0
#: text bytes of a block of documents that share a word list
BLOCK_BYTES = 24 << 20
_WORDS_IN_ROW = 20_000
_REMEMBERED = 300_000
_SALTS = 16
#: the closing mark and, after it, the end of the text
MARK, END = 256, 257
BEGINNING = b"\xff"
#: bytes that UTF-8 never uses, for the closing mark and the end of the text in packed pairs
MARK_BYTE, END_BYTE = 0xFE, 0xFF
_ALPHABET = 258


class _WordList(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


_PARTS = "block string, doc_id long, learned boolean, n_tokens long, ids array<int>, times array<int>, first int, words array<binary>, counts array<long>"
_ARROW = pa.schema([("block", pa.string()), ("doc_id", pa.int64()), ("learned", pa.bool_()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())), ("times", pa.list_(pa.int32())),
                    ("first", pa.int32()), ("words", pa.list_(pa.binary())), ("counts", pa.list_(pa.int64()))])


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(parts) if parts else np.zeros(0), kind))


def _blocks(batches):
    """Documents as counted numbers of their block's word list, and the word lists with the learned documents' counts."""
    part, number = TaskContext.get().partitionId(), 0
    words, counts, size = _WordList(), np.zeros(1 << 12, np.int64), 0

    def word_rows(block: str):
        names = list(words)
        for at in range(0, len(names), _WORDS_IN_ROW):
            own = names[at : at + _WORDS_IN_ROW]
            row = {"block": [block], "first": [at], "words": [own], "counts": [counts[at : at + len(own)].tolist()]}
            yield pa.RecordBatch.from_arrays([pa.array(row.get(f.name, [None]), f.type) for f in _ARROW], schema=_ARROW)

    for batch in batches:
        block = f"{part}-{number}"
        texts = batch.column(1).cast(pa.large_binary())
        learned = batch.column(2).to_pylist()
        ids, times, totals, blocks = [], [], [], []
        for k in range(batch.num_rows):
            text = texts[k].as_py()
            if size and size + len(text) > BLOCK_BYTES:
                yield from word_rows(block)
                number, size = number + 1, 0
                block, words, counts = f"{part}-{number}", _WordList(), np.zeros(1 << 12, np.int64)
            size += len(text) + 64
            own = list(map(words.__getitem__, text.lower().split()))
            distinct, n = np.unique(np.array(own, np.int32), return_counts=True)
            if len(words) > len(counts):
                counts = np.append(counts, np.zeros(max(len(words) - len(counts), len(counts)), np.int64))
            if learned[k]:
                counts[distinct] += n
            ids.append(distinct)
            times.append(n)
            totals.append(len(own) + 1)
            blocks.append(block)
        none = lambda f: pa.nulls(batch.num_rows, f.type)
        told = [pa.array(blocks, pa.string()), batch.column(0).cast(pa.int64()), batch.column(2), pa.array(totals, pa.int64()), _lists(ids, pa.int32()), _lists(times, pa.int32())]
        yield pa.RecordBatch.from_arrays([*told, *[none(f) for f in list(_ARROW)[6:]]], schema=_ARROW)
    if words:
        yield from word_rows(f"{part}-{number}")


def _history(word: bytes, i: int) -> bytes:
    """The last ``DEPTH`` symbols before position i; the byte that UTF-8 never uses stands for the word's beginning."""
    return BEGINNING + word[:i] if i < DEPTH else word[i - DEPTH : i]


def _packed(batches):
    """(number, n, length, key) for every symbol of every word of (number, word, n): the history's bytes above the symbol's byte, and the history's length."""
    for batch in batches:
        words = batch.column(1).cast(pa.large_binary())
        sizes = np.diff(np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1])
        if not len(sizes):
            continue
        # every word between a beginning and a closing mark
        starts = np.cumsum(sizes + 2) - sizes - 2
        row = np.repeat(np.arange(len(sizes)), sizes + 2)
        place = np.arange(len(row)) - starts[row]
        body = np.empty(len(row), np.int64)
        offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
        inner = (place > 0) & (place <= sizes[row])
        body[inner] = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if words.buffers()[2] else 0
        body[starts], body[starts + sizes + 1] = BEGINNING[0], MARK_BYTE
        key = body.copy()
        for back in range(1, DEPTH + 1):
            key[back:] |= np.where(place[back:] >= back, body[:-back] << 8 * back, 0)
        told = place > 0
        number, n = batch.column(0).to_numpy(), batch.column(2).to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(number[row[told]]), pa.array(n[row[told]]), pa.array(np.minimum(place[told], DEPTH).astype(np.int32)), pa.array(key[told])], ["number", "n", "length", "key"])


def _positions(words: DataFrame) -> DataFrame:
    return words.select("number", "word", "n").mapInArrow(_packed, "number long, n long, length int, key long")


def _cut(key: Column, depth: int) -> Column:
    """The pair of a context's last ``depth`` symbols and the same next symbol."""
    return key.bitwiseAND(F.lit((1 << 8 * (depth + 1)) - 1))


def _context(key: Column) -> Column:
    return F.shiftright(key, 8)


def states(pairs: DataFrame, total: int) -> tuple[list[DataFrame], list[DataFrame], list[DataFrame]]:
    """Per context length the counts (key, n) of all pairs, their probabilities (key, p) and the states (context) of the tree, from ``pairs``(length, key, n).

    Pairs of count 0 get their probability too.  Every context met ``LEAST``
    times or more is tested, whatever its share; the contexts of one length are
    one table, joined to that of their suffixes.  None comes to the driver.
    """
    # a context has 258 symbols at most
    counts = [pairs.where(F.col("length") == d).select("key", "n") for d in range(DEPTH + 1)]
    counts[DEPTH] = cut_lineage(counts[DEPTH])
    for d in range(DEPTH - 1, -1, -1):
        longer = counts[d + 1].select(_cut(F.col("key"), d).alias("key"), "n")
        counts[d] = cut_lineage(counts[d].unionByName(longer).groupBy("key").agg(F.sum("n").alias("n")))
    tried: list[DataFrame] = []
    for d in range(DEPTH + 1):
        own = counts[d].withColumn("context", _context(F.col("key")))
        own = own.withColumn("size", F.sum("n").over(Window.partitionBy("context")))
        if d:
            lower = tried[-1].select(F.col("key").alias("shorter"), F.col("p").alias("base"))
            own = own.where(F.col("size") >= LEAST).withColumn("shorter", _cut(F.col("key"), d - 1)).join(lower, "shorter")
        else:
            own = own.withColumn("base", F.lit(1.0 / _ALPHABET))
        gain = F.when(F.col("n") > 0, F.col("n") * F.log(F.col("n") / F.col("size") / F.col("base"))).otherwise(0.0)
        tried.append(cut_lineage(own.select("key", "context", ((F.col("n") + SMOOTHING * F.col("base")) / (F.col("size") + SMOOTHING)).alias("p"), gain.alias("gain"))))
    kept: list[DataFrame] = []
    for d in range(DEPTH, -1, -1):
        own = tried[d].groupBy("context").agg(F.sum("gain").alias("apart")).where(F.col("apart") > DIVERGENCE * math.log(max(total, 2))).select("context")
        if kept:
            own = own.unionByName(kept[0].select(F.col("context").bitwiseAND(F.lit((1 << 8 * d) - 1)).alias("context")))
        kept.insert(0, cut_lineage(own.distinct()))
    return counts, [t.select("key", "p") for t in tried], kept


def tree_scores(words: DataFrame, n_texts: int) -> tuple[DataFrame, float]:
    """(number, tree): log10 probability of every one of the distinct ``words``(number, word, n), and that of the end of a text.

    The tree is learned from the counts n and the number of texts; every
    distinct (history, symbol) pair is scored once, in the longest suffix that
    is a state, and the words gather the scores of their pairs.
    """
    spark = words.sparkSession
    found = _positions(words).groupBy("length", "key").agg(F.sum("n").alias("n"))
    # where a word may begin, the text may end
    end_key = BEGINNING[0] << 8 | END_BYTE
    pairs = cut_lineage(found.unionByName(spark.createDataFrame([(1, end_key, n_texts)], "length int, key long, n long")))
    counts, probability, kept = states(pairs, pairs.where(F.col("key") != end_key).agg(F.sum("n")).first()[0] or 0)
    scores = probability[0].select("key", "p")
    every = None
    for d in range(1, DEPTH + 1):
        longer = probability[d].select("key", "p", _context(F.col("key")).alias("context")).join(kept[d], "context", "left_semi").select("key", "p")
        lower = scores.select(F.col("key").alias("shorter"), F.col("p").alias("lower"))
        scores = (counts[d].select("key").withColumn("shorter", _cut(F.col("key"), d - 1)).join(lower, "shorter").join(longer, "key", "left")
                  .select("key", F.coalesce("p", "lower").alias("p")))
        scores = cut_lineage(scores)
        # a history shorter than DEPTH is told by the byte of its beginning
        whole = scores if d == DEPTH else scores.where(F.shiftright("key", 8 * d) == BEGINNING[0])
        every = whole if every is None else every.unionByName(whole)
    every = every.select("key", F.log10("p").alias("tree"))
    # beginnings of words are few and met by very many words: these pairs are dealt over several keys
    common = F.col("key") < 1 << 24
    salted = every.withColumn("salt", F.explode(F.when(common, F.sequence(F.lit(0), F.lit(_SALTS - 1))).otherwise(F.array(F.lit(0)))))
    own = _positions(words).select("number", "key", F.when(common, F.pmod(F.xxhash64("number"), F.lit(_SALTS)).cast("int")).otherwise(0).alias("salt"))
    valued = own.join(salted, ["key", "salt"]).groupBy("number").agg(F.sum("tree").alias("tree"))
    return valued, every.where(F.col("key") == end_key).first()["tree"]


def _states(nodes: dict[bytes, dict[int, int]], total: int) -> dict[bytes, tuple[float, dict[int, float]]]:
    """The tree of ``states`` in memory, for small tables: tests hold the Spark tables against it."""
    threshold = DIVERGENCE * math.log(max(total, 2))
    probability: dict[bytes, dict[int, float]] = {}
    sizes = {c: sum(own.values()) for c, own in nodes.items()}

    def p(context: bytes, symbol: int) -> float:
        if symbol in probability.get(context, ()):
            return probability[context][symbol]
        lower = p(context[1:], symbol) if context else 1.0 / _ALPHABET
        return lower * SMOOTHING / (sizes.get(context, 0) + SMOOTHING)

    kept = {b""}
    for context in sorted(nodes, key=len):
        n, apart, own = sizes[context], 0.0, {}
        for symbol, count in nodes[context].items():
            base = p(context[1:], symbol) if context else 1.0 / _ALPHABET
            own[symbol] = (count + SMOOTHING * base) / (n + SMOOTHING)
            apart += count * math.log(count / n / base)
        probability[context] = own
        if apart > threshold:
            while context not in kept:
                kept.add(context)
                context = context[1:]
    return {c: (math.log10(SMOOTHING / (sizes.get(c, 0) + SMOOTHING)), {s: math.log10(x) for s, x in probability.get(c, {}).items()}) for c in kept}


class Scorer:
    """log10 probabilities in a tree; the longest suffix state of each history is remembered."""

    def __init__(self, states: dict[bytes, tuple[float, dict[int, float]]]):
        self.states = states
        self.longest: dict[bytes, bytes] = {}

    def symbol(self, history: bytes, symbol: int) -> float:
        suffix = self.longest.get(history)
        if suffix is None:
            suffix = history
            while suffix not in self.states:
                suffix = suffix[1:]
            if len(self.longest) < _REMEMBERED:
                self.longest[history] = suffix
        weight, own = self.states[suffix]
        if symbol in own:
            return own[symbol]
        score = weight
        while suffix:
            suffix = suffix[1:]
            weight, own = self.states[suffix]
            if symbol in own:
                return score + own[symbol]
            score += weight
        return score - math.log10(_ALPHABET)

    def word(self, word: bytes) -> float:
        """A word with its closing mark."""
        return sum(self.symbol(_history(word, i), word[i] if i < len(word) else MARK) for i in range(len(word) + 1))

    def end(self) -> float:
        return self.symbol(BEGINNING, END)


def scored(docs: DataFrame, learned: Column) -> DataFrame:
    """(doc_id, learned, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``.

    ``learned`` is a condition on the columns of ``docs``: the rows the counts
    and the tree are learned from.  Null texts are empty: one token, the end.
    Repeated rows are scored, and learned, each; without any learned row all
    counts are zero and the tree is flat.

    One pass turns texts into blocks of numbered words (written to the shared
    folder); the word lists are summed over blocks, each distinct word is
    scored once, and the scores go back to their blocks.
    """
    flagged = docs.select(docs["doc_id"].alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"), F.coalesce(learned, F.lit(False)).alias("learned"))
    parts = cut_lineage(flagged.mapInArrow(_blocks, _PARTS))
    listed = parts.where("words is not null").select("block", F.col("first"), F.posexplode(F.arrays_zip("words", "counts")).alias("at", "own")).select("block", (F.col("first") + F.col("at")).alias("id"), F.col("own.words").alias("word"), F.col("own.counts").alias("n"))
    words = cut_lineage(listed.groupBy("word").agg(F.sum("n").alias("n")).withColumn("number", F.monotonically_increasing_id()))
    n_words, n_distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    n_texts = parts.where("words is null and learned").count()
    n_train, n_kinds = n_words + n_texts, n_distinct + (n_texts > 0)
    trees, end = tree_scores(words, n_texts)
    below = n_train + 0.5 * (n_kinds + 1)
    base_of = lambda c: np.log10((c + 0.5) / below)

    valued = cut_lineage(words.join(trees, "number").select("word", "n", F.col("tree").alias("score")))
    back = listed.select("block", "id", "word").join(valued, "word").select("block", "id", "n", "score")
    own = parts.where("words is null").select(F.col("block").alias("own_block"), "doc_id", "learned", "n_tokens", "ids", "times")

    def join_back(left: pa.Table, right: pa.Table) -> pa.Table:
        size = right.num_rows
        order = right["id"].to_numpy()
        n, tree = np.zeros(size, np.int64), np.zeros(size)
        n[order], tree[order] = right["n"].to_numpy(), right["score"].to_numpy()
        base = base_of(n)
        ids, times = left["ids"].combine_chunks(), left["times"].combine_chunks()
        lengths = np.asarray(ids.value_lengths())
        row = np.repeat(np.arange(left.num_rows), lengths)
        at, count = ids.flatten().to_numpy(), times.flatten().to_numpy()
        total = lambda v: np.bincount(row, count * v[at], minlength=left.num_rows)
        columns = [left["doc_id"], left["learned"], left["n_tokens"], pa.array((total((n > 0).astype(float)) + (n_texts > 0)).astype(np.int64)), pa.array(np.full(left.num_rows, n_train)),
                   pa.array(total(base) + base_of(n_texts)), pa.array(total(tree) + end)]
        return pa.Table.from_arrays(columns, names=["doc_id", "learned", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return (own.groupBy("own_block").cogroup(back.groupBy("block"))
            .applyInArrow(join_back, "doc_id long, learned boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"))
