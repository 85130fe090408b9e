"""Secret scans with a trigram inverted index, in DataFrame operations only.

From every rule's regular expression a Boolean query over trigrams is derived
that each match must satisfy.  Documents post the trigrams that the queries
name, an intersection of the postings gives every rule its candidates, and only
those are searched.  A rule without mandatory trigrams searches every document.
"""

from __future__ import annotations

import itertools
import re._constants as _op
import re._parser as _parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textruns import texts_of


@dataclass(frozen=True)
class Rule:
    """``pattern`` in the syntax that Java and Python share; with ``group``, that group must have ``least`` characters, else the whole match."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# fixed values: the three base rules first, then those of well-known token formats
BASE_RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("repository_token", r"gh[pousr]_[A-Za-z0-9]{36,255}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,250}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("bearer", r"[Bb]earer [A-Za-z0-9._~+/-]{20,}"),
)
RULES = BASE_RULES + MORE_RULES

#: a piece of a pattern is spelled out up to this many strings; beyond, it binds nothing
MAX_STRINGS = 64
_CHUNK = 256


def _spelled(items) -> tuple[set[str] | None, list[frozenset[str]]]:
    """All strings that a sequence of pattern nodes matches, if they are few, and its mandatory trigram sets (a disjunction)."""
    run: set[str] = {""}
    needs: list[frozenset[str]] = [frozenset()]
    whole = True

    def close() -> None:
        nonlocal run, needs
        if all(len(s) >= 3 for s in run):
            here = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in run}
            needs = [a | b for a in needs for b in here]
        run = {""}

    for kind, value in items:
        strings, inner = _node(kind, value)
        if strings is not None and len(run) * len(strings) <= MAX_STRINGS:
            run = {a + b for a in run for b in strings}
            continue
        close()
        whole = False
        if inner:
            needs = [a | b for a in needs for b in inner]
    if whole:
        strings = run
        close()
        return strings, needs
    close()
    return None, needs


def _node(kind, value) -> tuple[set[str] | None, list[frozenset[str]]]:
    free: list[frozenset[str]] = [frozenset()]
    if kind == _op.LITERAL:
        return {chr(value).lower()}, free
    if kind == _op.IN and all(k == _op.LITERAL for k, _ in value):
        return {chr(c).lower() for _, c in value}, free
    if kind == _op.SUBPATTERN:
        return _spelled(value[3])
    if kind == _op.BRANCH:
        parts = [_spelled(p) for p in value[1]]
        strings = set().union(*(s for s, _ in parts)) if all(s is not None for s, _ in parts) else None
        return strings, [n for _, needs in parts for n in needs]
    if kind == _op.MAX_REPEAT:
        low, high, body = value
        strings, needs = _spelled(body)
        if strings is not None and high <= 3 and len(strings) ** high <= MAX_STRINGS:
            return {"".join(c) for n in range(low, high + 1) for c in itertools.product(strings, repeat=n)}, free
        return None, needs if low else free
    return None, free


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Clauses of lower-cased trigrams; a matching text has all trigrams of one clause.  An empty clause: any text may match."""
    _, clauses = _spelled(_parser.parse(pattern))
    kept: list[frozenset[str]] = []
    for c in sorted(set(clauses), key=lambda c: (len(c), sorted(c))):
        if not any(k <= c for k in kept):
            kept.append(c)
    return kept


def _one_of(trigrams: list[str]) -> str:
    """A pattern that finds the given trigrams at every place, overlapping ones too."""
    quote = lambda c: f"\\x{ord(c):02x}" if ord(c) < 128 and not c.isalnum() else c
    by_first = itertools.groupby(sorted(trigrams), key=lambda t: t[0])
    return "(?=(" + "|".join(quote(c) + "(?:" + "|".join(quote(t[1]) + quote(t[2]) for t in ts) + ")" for c, ts in by_first) + "))"


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The index: (trigram, doc_id), one row for each of the given trigrams that a lower-cased text holds."""
    held = F.regexp_extract_all(F.lower("text"), F.lit(_one_of(trigrams)), 1)
    return docs.select("doc_id", F.explode(F.array_distinct(held)).alias("trigram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(doc_id, found): the kinds of the rules whose trigram query the document's postings satisfy."""
    spark = docs.sparkSession
    clauses = [(r.kind, k, len(c), t) for r in rules for k, c in enumerate(trigram_query(r.pattern)) for t in sorted(c)]
    asked = spark.createDataFrame(clauses, "kind string, clause int, size int, trigram string")
    # the query table is as long as the rules are, not the corpus
    met = postings(docs, sorted({c[3] for c in clauses})).join(F.broadcast(asked), "trigram")
    whole = met.groupBy("doc_id", "kind", "clause").agg(F.size(F.collect_set("trigram")).alias("n"), F.first("size").alias("size")).where("n = size")
    return whole.groupBy("doc_id").agg(F.array_sort(F.collect_set("kind")).alias("found"))


def _spans(text: Column, rule: Rule) -> Column:
    """The rule's matches as (kind, start, end) in code points; too short ones dropped."""
    whole = F.regexp_extract_all(text, F.lit(f"({rule.pattern})"), 1)
    gaps = F.split(text, rule.pattern)
    held = F.regexp_extract_all(text, F.lit(rule.pattern), rule.group) if rule.group else whole
    pieces = F.transform(F.arrays_zip(gaps.alias("gap"), whole.alias("match"), held.alias("held")),
                         lambda z: F.struct(F.length(z["gap"]).alias("gap"), F.coalesce(F.length(z["match"]), F.lit(0)).alias("length"), F.coalesce(F.length(z["held"]), F.lit(0)).alias("held")))
    kept = F.filter(_placed(pieces), lambda s: (s["end"] > s["start"]) & (s["held"] >= rule.least))
    return F.transform(kept, lambda s: F.struct(s["start"].alias("start"), F.lit(rule.kind).alias("kind"), s["end"].alias("end")))


def _placed(pieces: Column) -> Column:
    """(start, end, held) of each (gap, length, held): running sums, first inside chunks, then over them, as an array grows by copying."""
    none = F.array().cast("array<struct<start:int,end:int,held:int>>")

    def chunk(c: Column) -> Column:
        return F.aggregate(F.slice(pieces, c * _CHUNK + 1, F.lit(_CHUNK)), F.struct(F.lit(0).alias("at"), none.alias("spans")), lambda acc, z: F.struct(
            (acc["at"] + z["gap"] + z["length"]).alias("at"),
            F.concat(acc["spans"], F.array(F.struct((acc["at"] + z["gap"]).alias("start"), (acc["at"] + z["gap"] + z["length"]).alias("end"), z["held"].alias("held")))).alias("spans")))

    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / _CHUNK).cast("int")), chunk)
    starts = F.aggregate(chunks, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")), lambda acc, c: F.struct(
        (acc["at"] + c["at"]).alias("at"), F.concat(acc["starts"], F.array(acc["at"])).alias("starts")))["starts"]
    return F.flatten(F.zip_with(chunks, starts, lambda c, at: F.transform(c["spans"], lambda s: F.struct(
        (s["start"] + at).alias("start"), (s["end"] + at).alias("end"), s["held"].alias("held")))))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, spans): for every row of ``docs`` the secrets found, ordered by rule and place.

    spans is an array of (start, kind, end) in code points, the end exclusive.
    Null texts are empty; repeated rows are searched each (they share their
    postings, which are the same); other columns are left out.
    """
    own = texts_of(docs)
    indexed = tuple(r for r in rules if all(trigram_query(r.pattern)))
    found = candidates(own, indexed).withColumnRenamed("doc_id", "found_id")
    joined = own.join(found, F.col("doc_id").eqNullSafe(F.col("found_id")), "left").select("doc_id", "text", "found")
    empty = F.array().cast("array<struct<start:int,kind:string,end:int>>")
    asked = lambda r: F.array_contains("found", r.kind) if r in indexed else F.col("text").rlike(r.pattern)
    parts = [F.when(asked(r), _spans(F.col("text"), r)).otherwise(empty) for r in rules]
    return joined.select("doc_id", F.concat(*parts).alias("spans"))


def joined_spans(spans: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of the given kinds, by start, then in the order of ``kinds``; comma-joined."""
    place = F.create_map(*[x for k, kind in enumerate(kinds) for x in (F.lit(kind), F.lit(k))])
    rows = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    ordered = F.array_sort(F.transform(rows, lambda s: F.struct(s["start"].alias("start"), place[s["kind"]].alias("place"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.concat_ws(",", F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
