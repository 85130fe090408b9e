"""Personal data by a skip-chain conditional random field over the tokens of each document.

Tokens are the blank-separated pieces that hold a digit or an at-sign.  Each has
a potential for every label from its shape, and strong evidence where a base
pattern matched.  Neighbouring tokens share chain potentials.  Repeated tokens,
and tokens that end in the same seven digits, share skip potentials however far
apart they are.  Loopy message passing settles the labels of a document.  The
potentials are fitted piece by piece: each factor from the counts of its own
labels in the whole corpus, with the base patterns as the labelling.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textruns import texts_of

# fixed values: kinds in the order of the output, and the base patterns
KINDS = ("email", "ip", "card", "phone")
OTHER = len(KINDS)
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

_MARK = re.compile(r"[0-9@]")
_BLANK = re.compile(r"\s")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

#: tokens of one label closer than this many characters form one span
JOIN_CHARS = 2
#: final digits that make two tokens similar
TAIL_DIGITS = 7
#: log odds of a label where its base pattern matched
EVIDENCE = 8.0
ROUNDS, DAMPING = 30, 0.3
#: a label must be this likely to add a span
CONFIDENCE = 0.7
_PRIOR_COUNT = 2.0
_SHAPE_LENGTH, _DIGITS_BOUND = 4, 20


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _emails(text: str):
    """Each at-sign with the characters before it that no earlier match took, and a dotted name behind."""
    at, past = text.find("@"), 0
    while at >= 0:
        start = at
        while start > past and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            past = m.end()
        at = text.find("@", max(at + 1, past))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns' matches, by kind, then start."""
    found = [(0, s, e) for s, e in _emails(text)]
    found += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append((2, m.start(), m.end()))
    found += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= sum("0" <= c <= "9" for c in m.group()) <= 15]
    return found


def tokens(text: str) -> list[tuple[int, int]]:
    """Places of the pieces between blanks that hold a digit or an at-sign, without the marks at their ends."""
    found, past = [], 0
    m = _MARK.search(text)
    while m:
        start = m.start()
        while start > past and not text[start - 1].isspace():
            start -= 1
        blank = _BLANK.search(text, m.end())
        past = blank.start() if blank else len(text)
        piece = text[start:past]
        lead = len(piece) - len(piece.lstrip("\"'.,;:!?*#$%&|=[]{}<>"))
        found.append((start + lead, start + len(piece.rstrip("\"'.,;:!?*#$%&|=[]{}<>"))))
        m = _MARK.search(text, past)
    return found


def _shape(piece: str) -> str:
    """Kinds of the first few runs (digit, letter, at, dot, other) and the number of digits, both bounded."""
    kinds, digits, last = [], 0, ""
    for c in piece:
        if "0" <= c <= "9":
            kind = "9"
            digits += 1
        else:
            kind = "a" if c.isalpha() else c if c in "@." else "-"
        if kind != last:
            last = kind
            if len(kinds) < _SHAPE_LENGTH:
                kinds.append(kind)
    return f"{''.join(kinds)}{min(digits, _DIGITS_BOUND)}"


def _labels(places: list[tuple[int, int]], base: list[tuple[int, int, int]]) -> list[int]:
    """The base kind that overlaps each token (the first in order of kind), or ``OTHER``."""
    out = [OTHER] * len(places)
    ends = [e for _, e in places]
    for kind, s, e in reversed(base):
        at = bisect_left(ends, s + 1)
        while at < len(places) and places[at][0] < e:
            out[at] = kind
            at += 1
    return out


def _chain(places: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Neighbouring tokens with nothing but a few characters between them."""
    return [(i, i + 1) for i in range(len(places) - 1) if places[i + 1][0] - places[i][1] <= JOIN_CHARS]


def _skips(pieces: list[str]) -> list[tuple[int, int]]:
    """Each token with the last one before it that reads the same, and with the last one of the same final digits."""
    edges, seen = set(), {}
    for i, piece in enumerate(pieces):
        digits = "".join(c for c in piece if "0" <= c <= "9")
        for key in [("same", piece.lower()), *([("tail", digits[-TAIL_DIGITS:])] if len(digits) >= TAIL_DIGITS else [])]:
            if key in seen:
                edges.add((seen[key], i))
            seen[key] = i
    return sorted(edges)


def _counts(batches):
    """Sums over a task of (factor, key, label, other label)."""
    total: dict[tuple[str, str, int, int], int] = {}

    def add(*key) -> None:
        total[key] = total.get(key, 0) + 1

    for batch in batches:
        for text in batch.column(0).to_pylist():
            places = tokens(text)
            if not places:
                continue
            labels = _labels(places, base_spans(text))
            pieces = [text[s:e] for s, e in places]
            for piece, label in zip(pieces, labels):
                add("shape", _shape(piece), label, 0)
            for factor, edges in (("chain", _chain(places)), ("skip", _skips(pieces))):
                for i, j in edges:
                    add(factor, "", labels[i], labels[j])
    keys = list(total)
    yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([k[2] for k in keys], pa.int32()), pa.array([k[3] for k in keys], pa.int32()),
                                      pa.array([total[k] for k in keys], pa.int64())], ["factor", "key", "label", "other", "n"])


class Potentials:
    """Log potentials of the factors; the shapes are at most 5^4 x 21, whatever the corpus."""

    def __init__(self, rows: list[tuple[str, str, int, int, int]]):
        width = OTHER + 1
        shapes: dict[str, np.ndarray] = {}
        pairs = {"chain": np.zeros((width, width)), "skip": np.zeros((width, width))}
        for factor, key, label, other, n in rows:
            if factor == "shape":
                shapes.setdefault(key, np.zeros(width))[label] += n
            else:
                pairs[factor][label, other] += n
                pairs[factor][other, label] += n
        whole = sum(shapes.values()) if shapes else np.zeros(width)
        prior = (whole + np.eye(width)[OTHER] + 0.1) / (whole + np.eye(width)[OTHER] + 0.1).sum()
        self.prior = np.log(prior)
        self.shapes = {s: np.log((n + _PRIOR_COUNT * prior) / (n.sum() + _PRIOR_COUNT)) for s, n in shapes.items()}
        self.chain = self._association(pairs["chain"])
        # agreement is what skip edges are for: a repeated token keeps its label even where few repeats were seen
        self.skip = self._association(pairs["skip"] + 20 * np.eye(width))

    @staticmethod
    def _association(n: np.ndarray) -> np.ndarray:
        """How much likelier a pair of labels is than its labels on their own."""
        p = (n + 0.5) / (n + 0.5).sum()
        own = p.sum(axis=1)
        return np.log(p / np.outer(own, own))


def marginals(node: np.ndarray, edges: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Label probabilities by loopy sum-product: node (n x L), edges (m x 2), factors (m x L x L), all log potentials."""
    n, width = node.shape
    if not len(edges):
        p = np.exp(node - node.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)
    source, target = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
    both = np.exp(np.concatenate([factors, factors.transpose(0, 2, 1)]))
    back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
    message = np.zeros((len(source), width))
    for _ in range(ROUNDS):
        belief = node.copy()
        np.add.at(belief, target, message)
        out = belief[source] - message[back]
        out -= out.max(axis=1, keepdims=True)
        new = np.log(np.einsum("ml,mlk->mk", np.exp(out), both) + 1e-300)
        new -= new.max(axis=1, keepdims=True)
        new = (1 - DAMPING) * new + DAMPING * message
        moved = np.abs(new - message).max()
        message = new
        if moved < 1e-4:
            break
    belief = node.copy()
    np.add.at(belief, target, message)
    p = np.exp(belief - belief.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def label_spans(text: str, potentials: Potentials) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and the spans that the field adds; both by kind, then start."""
    places = tokens(text)
    if not places:
        return [], []
    base = base_spans(text)
    evidence = _labels(places, base)
    pieces = [text[s:e] for s, e in places]
    node = np.stack([potentials.shapes.get(_shape(p), potentials.prior) for p in pieces])
    for i, kind in enumerate(evidence):
        if kind != OTHER:
            node[i, kind] += EVIDENCE
    chain, skip = _chain(places), _skips(pieces)
    factors = np.concatenate([np.repeat(potentials.chain[None], len(chain), axis=0), np.repeat(potentials.skip[None], len(skip), axis=0)])
    p = marginals(node, np.array(chain + skip, np.int64).reshape(-1, 2), factors)
    label = p.argmax(axis=1)
    added: list[tuple[int, int, int]] = []
    for i, (s, e) in enumerate(places):
        kind = int(label[i])
        if evidence[i] != OTHER or kind == OTHER or p[i, kind] < CONFIDENCE or s >= e:
            continue
        if added and added[-1][0] == kind and s - added[-1][2] <= JOIN_CHARS and i and evidence[i - 1] == OTHER:
            added[-1] = (kind, added[-1][1], e)
        else:
            added.append((kind, s, e))
    return base, sorted(added)


def train(docs: DataFrame) -> Potentials:
    """Potentials from the counts of every factor over all rows of ``docs``."""
    counts = texts_of(docs).select("text").mapInArrow(_counts, "factor string, key string, label int, other int, n long")
    return Potentials([tuple(r) for r in counts.groupBy("factor", "key", "label", "other").agg(F.sum("n").alias("n")).collect()])


_SPANS = "array<struct<kind:string,start:int,end:int>>"


def find(docs: DataFrame, learn_from: DataFrame | None = None) -> DataFrame:
    """(doc_id, base, added): for every row of ``docs`` the spans of personal data, in code points, ends exclusive.

    base are the matches of the base patterns, added those that only the field
    gives; none overlaps a base span's token.  Null texts are empty; repeated
    rows are labelled each; other columns are left out.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(learn_from if learn_from is not None else docs))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    named = lambda spans: [{"kind": KINDS[k], "start": s, "end": e} for k, s, e in spans]

    def per_batch(batches):
        for batch in batches:
            found = [label_spans(t, model.value) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([named(b) for b, _ in found], kind), pa.array([named(a) for _, a in found], kind)], ["doc_id", "base", "added"])

    own = texts_of(docs)
    return own.mapInArrow(per_batch, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, base {_SPANS}, added {_SPANS}")
