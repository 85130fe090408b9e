"""Conversation repair: the cheapest edits that give every conversation a well-formed order of roles.

A row becomes one symbol of its role and fault.  Sequences are cut into pieces of bounded length; Re-Pair rules are drawn
from the pair counts of all distinct pieces, and each rule has one min-plus transfer matrix between the states of the
role order, whose entries hold a cost and the audit as a rope.  Matrices are evaluated bottom up once per worker and
shared by all conversations; a conversation is the product of the matrices of its compressed pieces, in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.session import cut_lineage
from .numbering import numbered

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5
ROLES = "suax"
FAULTS = ("none", "blank", "duplicate", "truncated")
SPACES = " \t\n\x0b\x0c\r"
#: states: nothing yet, after the system row, after a user row, after an assistant row
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
ACCEPTED = (START, ASSISTANT)

#: rows of a piece
PIECE_ROWS = 512
#: pairs considered per round of the grammar
ROUND_PAIRS = 64
#: a rule must replace pairs worth this share of all symbols, so there are at most 2 / LEAST_SHARE rules
LEAST_SHARE = 0.002
#: code points of the terminals and, behind them, of the rules
FIRST = 0x4E00
#: results of whole pieces kept per worker
CACHED = 65_536

Rope = tuple  # (length, left, right) or (length, text)
Entry = tuple[int, Rope]
Matrix = list[list[Entry | None]]

EMPTY: Rope = (0, "")


# audits as ropes

def joined(a: Rope, b: Rope) -> Rope:
    return b if not a[0] else a if not b[0] else (a[0] + b[0], a, b)


def flat(rope: Rope) -> str:
    parts, stack = [], [rope]
    while stack:
        node = stack.pop()
        if len(node) == 2:
            parts.append(node[1])
        else:
            stack += (node[2], node[1])
    return "".join(parts)


def precedes(a: Rope, b: Rope) -> bool:
    """Whether text ``a`` comes before text ``b``; subtrees that both share are passed over whole."""
    left, right = [a], [b]
    while left and right:
        x, y = left.pop(), right.pop()
        if x is y:
            continue
        if len(x) == 3 and (len(y) == 2 or x[0] >= y[0]):
            left += (x[2], x[1])
            right.append(y)
        elif len(y) == 3:
            right += (y[2], y[1])
            left.append(x)
        else:
            n = min(x[0], y[0])
            if x[1][:n] != y[1][:n]:
                return x[1] < y[1]
            if x[0] > n:
                left.append((x[0] - n, x[1][n:]))
            if y[0] > n:
                right.append((y[0] - n, y[1][n:]))
    return bool(right) and any(node[0] for node in right)


# transfer matrices

def _better(found: Entry | None, cost: int, a: Rope, b: Rope) -> Entry:
    if found is None or cost < found[0]:
        return cost, joined(a, b)
    if cost == found[0]:
        rope = joined(a, b)
        if precedes(rope, found[1]):
            return cost, rope
    return found


def after(row: list[Entry | None], matrix: Matrix) -> list[Entry | None]:
    """One row of a min-plus product.  Equal costs over the same rows are never prefixes of each other (they hold equally
    many inserts), so the least audit of a whole is made of least audits of its parts."""
    found: list[Entry | None] = [None] * 4
    for k, entry in enumerate(row):
        if entry is not None:
            for j, step in enumerate(matrix[k]):
                if step is not None:
                    found[j] = _better(found[j], entry[0] + step[0], entry[1], step[1])
    return found


def product(a: Matrix, b: Matrix) -> Matrix:
    return [after(row, b) for row in a]


def _matrix(steps: list[tuple[int, int, int, str]]) -> Matrix:
    found: Matrix = [[None] * 4 for _ in STATES]
    for i, j, cost, letters in steps:
        found[i][j] = _better(found[i][j], cost, (len(letters), letters), EMPTY)
    return found


def _next(state: int) -> int:
    return ASSISTANT if state == USER else USER


def inserts() -> Matrix:
    """Any inserts, an empty one included; more than two never pay."""
    steps = []
    for i in STATES:
        one, two = _next(i), _next(_next(i))
        steps += [(i, i, 0, ""), (i, one, INSERT_COST, INSERT), (i, two, 2 * INSERT_COST, 2 * INSERT)]
    return _matrix(steps)


def terminal(role: str, fault: str) -> Matrix:
    """Inserts before a row, then one edit of the row."""
    steps = [(q, q, DELETE_COST, DELETE) for q in STATES]
    if fault not in ("blank", "duplicate"):
        extra = TRUNCATED_COST if fault == "truncated" else 0
        if role == "s":
            steps.append((START, SYSTEM, extra, KEEP))
        for q in STATES:
            if role == "ua"[_next(q) == ASSISTANT]:
                steps.append((q, _next(q), extra, KEEP))
            steps.append((q, _next(q), REROLE_COST + extra, REROLE))
    return product(inserts(), _matrix(steps))


# counts of faults and of adjacent roles that no order allows

def _illegal(a: str, b: str) -> int:
    return int(a + b not in ("su", "ua", "au"))


def added(a: tuple, b: tuple) -> tuple:
    """(blank, duplicate, truncated, illegal, first role, last role) of two neighbouring runs."""
    return (a[0] + b[0], a[1] + b[1], a[2] + b[2], a[3] + b[3] + _illegal(a[5], b[4]), a[4], b[5])


# the grammar

def symbol(role: str, fault: str) -> str:
    return chr(FIRST + len(FAULTS) * ROLES.index(role) + FAULTS.index(fault))


@lru_cache(maxsize=4)
def evaluated(rules: tuple[str, ...]) -> tuple[dict[str, Matrix], dict[str, tuple]]:
    """Matrix and counts of every symbol; rule k replaces the pair ``rules[k]`` and stands behind the terminals."""
    matrices, counts = {}, {}
    for role in ROLES:
        for fault in FAULTS:
            s = symbol(role, fault)
            matrices[s] = terminal(role, fault)
            counts[s] = (*(int(fault == f) for f in FAULTS[1:]), 0, role, role)
    for k, (a, b) in enumerate(rules):
        s = _rule(k)
        matrices[s], counts[s] = product(matrices[a], matrices[b]), added(counts[a], counts[b])
    return matrices, counts


def _rule(k: int) -> str:
    return chr(FIRST + len(ROLES) * len(FAULTS) + k)


def compressed(piece: str, rules: tuple[str, ...]) -> str:
    for k, pair in enumerate(rules):
        piece = piece.replace(pair, _rule(k))
    return piece


def repair(pieces: Iterator[str], rules: tuple[str, ...]) -> tuple[tuple, int, str]:
    """Counts, cost and audit of one conversation, piece by piece."""
    matrices, counts = evaluated(rules)
    row: list[Entry | None] = [(0, EMPTY), None, None, None]
    total = None
    for piece in pieces:
        for s in compressed(piece, rules):
            row = after(row, matrices[s])
            total = counts[s] if total is None else added(total, counts[s])
    row = after(row, inserts())
    cost, audit = min(((row[q][0], flat(row[q][1])) for q in ACCEPTED if row[q] is not None))
    return total or (0, 0, 0, 0, "", ""), cost, audit


def independent(pairs: list[str]) -> list[str]:
    """Pairs, most frequent first, of which no two can overlap: no symbol ends one and begins another."""
    heads, tails, chosen = set(), set(), []
    for a, b in pairs:
        if a not in tails and b not in heads and (a != b or a not in heads):
            heads.add(a)
            tails.add(b)
            chosen.append(a + b)
    return chosen


def grammar(pieces: DataFrame) -> tuple[str, ...]:
    """Re-Pair rules over ``pieces`` (symbols): in every round the most frequent pairs that cannot overlap become rules.

    Pairs are counted and replaced in Spark over the distinct pieces; the driver holds the rules, whose number
    LEAST_SHARE bounds at every size of the table.
    """
    seen = cut_lineage(pieces.groupBy("symbols").agg(F.count("*").alias("weight")))
    least = max(2, LEAST_SHARE * (seen.agg(F.sum(F.length("symbols") * F.col("weight"))).first()[0] or 0))
    rules: list[str] = []
    while True:
        pair = F.explode(F.transform(F.sequence(F.lit(1), F.length("symbols") - 1), lambda i: F.substring("symbols", i, F.lit(2))))
        counted = seen.where(F.length("symbols") > 1).select(pair.alias("pair"), "weight").groupBy("pair").agg(F.sum("weight").alias("weight"))
        top = counted.where(F.col("weight") >= least).orderBy(F.desc("weight"), "pair").limit(ROUND_PAIRS).collect()
        if not top:
            return tuple(rules)
        shorter = F.col("symbols")
        for found in independent([r["pair"] for r in top]):
            shorter = F.replace(shorter, F.lit(found), F.lit(_rule(len(rules))))
            rules.append(found)
        seen = cut_lineage(seen.select(shorter.alias("symbols"), "weight"))


# tables

def conversation_key(conv_id: Column) -> Column:
    return F.when(conv_id.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), conv_id.cast("string")))


def _rows(conversations: DataFrame) -> DataFrame:
    """(key, conv_id, turn, role, text, text_key): null roles and texts are one space."""
    c = conversations
    text = F.coalesce(c["text"].cast("string"), F.lit(" "))
    return c.select(conversation_key(c["conv_id"]).alias("key"), c["conv_id"].alias("conv_id"), c["turn"].alias("turn"), F.coalesce(c["role"].cast("string"), F.lit(" ")).alias("role"), text.alias("text"), F.sha2(text.cast("binary"), 256).alias("text_key"))


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text_key")]


def placed(conversations: DataFrame) -> DataFrame:
    """(key, conv_id, turn, symbol, number): every row with its place in its conversation; texts stay behind.

    A row is a duplicate if it is not the first of its conversation, role and text; both places come from exact
    numbering, so a conversation or a text of any number of rows is spread over tasks.
    """
    rows = _rows(conversations)
    last = F.substring(F.rtrim(F.col("text"), F.lit(SPACES)), -1, 1)
    same = F.sha2(F.concat_ws(":", F.length("key").cast("string"), "key", F.length("role").cast("string"), "role", "text_key").cast("binary"), 256)
    keys = cut_lineage(rows.select("key", "conv_id", "turn", "role", "text_key", same.alias("same"), (last == "").alias("blank"), (~last.isin(*".!?")).alias("cut")))
    keys = cut_lineage(numbered(keys, "same", [F.col("turn").asc_nulls_first()]).withColumn("again", F.col("number") > 0).drop("number", "same"))
    found = numbered(keys, "key", [*_order(), F.col("again")])
    initial = F.substring("role", 1, 1)
    role = F.coalesce(*[F.when(initial == r, F.lit(k)) for k, r in enumerate(ROLES[:3])], F.lit(3))
    fault = F.when(F.col("blank"), 1).when(F.col("again"), 2).when(F.col("cut"), 3).otherwise(0)
    return found.select("key", "conv_id", "turn", (role * len(FAULTS) + fault).alias("symbol"), "number")


def _sequences(rows: DataFrame) -> DataFrame:
    """(key, conv_id, piece, symbols): at most PIECE_ROWS rows of a conversation as one text."""
    symbols = F.transform(F.array_sort(F.collect_list(F.struct("number", "symbol"))), lambda x: F.element_at(F.array(*[F.lit(chr(FIRST + k)) for k in range(len(ROLES) * len(FAULTS))]), x["symbol"] + 1))
    pieces = rows.withColumn("piece", F.floor(F.col("number") / PIECE_ROWS)).groupBy("key", "piece").agg(F.first("conv_id").alias("conv_id"), symbols.alias("symbols"))
    return pieces.select("key", "conv_id", "piece", F.array_join("symbols", "").alias("symbols"))


def repairs(conversations: DataFrame) -> DataFrame:
    """One row per conversation (conv_id, turn, role, text): its ``gaps``, fault counts (``blank``, ``duplicate``,
    ``truncated``), ``illegal`` neighbours, and the ``cost`` and ``audit`` of its cheapest repair.

    Rows stand by turn (nulls first), ties by role and a digest of the text.  Null roles and texts read as one space; a
    role that begins with none of s, u, a (an empty one too) can only be deleted or given another role.  Null conv_ids
    form one conversation.  Texts are read whole; other columns are left out; an empty table has no conversations.
    Pieces of a conversation are folded in order by one task, which holds its audit (one letter a row) and no rows.
    """
    rows = cut_lineage(placed(conversations))
    pieces = cut_lineage(_sequences(rows))
    rules = grammar(pieces)

    def fold(batches):
        whole = lru_cache(maxsize=CACHED)(lambda piece: repair(iter([piece]), rules))

        def conversations():
            key, name, held = None, None, []
            for batch in batches:
                for k, conv, piece in zip(*[batch.column(c).to_pylist() for c in ("key", "conv_id", "symbols")], strict=True):
                    if k != key and held:
                        yield key, name, held
                        held = []
                    key, name = k, conv
                    held.append(piece)
            if held:
                yield key, name, held

        done = []
        for key, name, held in conversations():
            counts, cost, audit = whole(held[0]) if len(held) == 1 else repair(iter(held), rules)
            done.append((key, name, *counts[:4], cost, audit))
            if len(done) == 1000:
                yield _columns(done, names, kinds)
                done = []
        yield _columns(done, names, kinds)

    names = ["key", "conv_id", *FAULTS[1:], "illegal", "cost", "audit"]
    conv_kind = conversations.schema["conv_id"].dataType
    kinds = [pa.string(), _arrow(conv_kind), *[pa.int64()] * 5, pa.string()]
    folded = pieces.repartition("key").sortWithinPartitions("key", "piece").select("key", "conv_id", "symbols").mapInArrow(
        fold, f"key string, conv_id {conv_kind.simpleString()}, blank long, duplicate long, truncated long, illegal long, cost long, audit string")
    span = (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).cast("long")
    turns = rows.groupBy("key").agg(F.coalesce(span, F.lit(0)).alias("gaps"))
    return folded.join(turns, "key")


def _arrow(kind):
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def _columns(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)


def _edited(conversations: DataFrame, found: DataFrame) -> DataFrame:
    """Audit and rows of every conversation in one sorted stream: the audit (``turn`` and ``text`` null) comes first."""
    rows = _rows(conversations).select("key", F.lit(1).alias("kind"), "turn", "role", "text", "text_key")
    audits = found.select("key", F.lit(0).alias("kind"), F.col("audit").alias("text"))
    both = rows.unionByName(audits, allowMissingColumns=True)
    return both.repartition("key").sortWithinPartitions("key", "kind", *_order()).select("key", "kind", "role", "text")


class _Walk:
    """The kept and inserted rows of one conversation, in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _put(self, letter: str, role: str, text: str) -> tuple[str, str, str]:
        state = SYSTEM if letter == KEEP and self.state == START and role[:1] == "s" else _next(self.state)
        if letter != KEEP:
            role = "assistant" if state == ASSISTANT else "user"
        self.state = state
        return letter, role, "" if letter == INSERT else text

    def row(self, role: str | None, text: str | None) -> Iterator[tuple[str, str, str]]:
        """What an original row gives; at the end (role None) the inserts that are left."""
        while self.at < len(self.audit):
            letter = self.audit[self.at]
            if letter != INSERT and role is None:
                raise ValueError("an audit is longer than its conversation")
            self.at += 1
            if letter != DELETE:
                yield self._put(letter, role or "", text or "")
            if letter != INSERT:
                return


def _walked(batches) -> Iterator[tuple[str, tuple[str, str, str] | None]]:
    """(key, edit) for every row of the repaired conversations; (key, None) at the end of each."""
    key, walk = None, None
    for batch in batches:
        for k, kind, role, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if not kind:
                if walk is not None:
                    yield from ((key, edit) for edit in walk.row(None, None))
                    yield key, None
                key, walk = k, _Walk(text)
            else:
                yield from ((key, edit) for edit in walk.row(role, text))
    if walk is not None:
        yield from ((key, edit) for edit in walk.row(None, None))
        yield key, None


def repaired_rows(conversations: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired conversations: (key, place, edit, role, text); ``found`` are their :func:`repairs` as a written table."""
    def rows(batches):
        done, place = [], 0
        for key, edit in _walked(batches):
            if edit is None:
                place = 0
                continue
            done.append((key, place, *edit))
            place += 1
            if len(done) == 1000:
                yield _columns(done, names, kinds)
                done = []
        yield _columns(done, names, kinds)

    names, kinds = ["key", "place", "edit", "role", "text"], [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
    return _edited(conversations, found).mapInArrow(rows, "key string, place long, edit string, role string, text string")


def repaired_digests(conversations: DataFrame, found: DataFrame) -> DataFrame:
    """(key, repaired_sha256) over the ``role:text`` lines of every repaired conversation, as they stream by."""
    def digests(batches):
        done, sha, fresh = [], hashlib.sha256(), True
        for key, edit in _walked(batches):
            if edit is not None:
                sha.update(("" if fresh else "\n").encode() + f"{edit[1]}:{edit[2]}".encode())
                fresh = False
                continue
            done.append((key, sha.hexdigest()))
            sha, fresh = hashlib.sha256(), True
            if len(done) == 1000:
                yield _columns(done, names, kinds)
                done = []
        yield _columns(done, names, kinds)

    names, kinds = ["key", "repaired_sha256"], [pa.string(), pa.string()]
    return _edited(conversations, found).mapInArrow(digests, "key string, repaired_sha256 string")
