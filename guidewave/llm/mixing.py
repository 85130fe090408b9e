"""Soft-membership mixing: domain posteriors from a labelled table, then nonnegative document rates by least squares.

A classifier learns the domains of the labelled documents and gives every
document its posterior p.  A document of t tokens taken at rate r adds r t p to
the domains' expected token totals.  The rates minimise the squared distance of
those totals from the targets, by projected gradient steps from rate 1; a step
moves a document by its posterior times the residual, and rates are kept
between 0 and MAX_RATE, or between 1 and MAX_RATE for clean documents.  Only the residual (one number per domain) goes to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.session import cut_lineage
from .textruns import lower_table, row_of, row_slices, run_classes, run_hashes, runs, text_bytes, widened

DOMAINS = ("plain", "good", "toxic")
#: shares of the tokens to come from each domain where the caller names none: more plain text than the tables hold
TARGETS = {"plain": 0.25, "good": 0.75, "toxic": 0.0}
#: a document is taken this often at most
MAX_RATE = 4.0
FEATURE_BITS = 18
#: standard errors by which a feature's rate in a domain must differ to count
EVIDENCE = 5.0
#: labelled rows that the classifier is fitted to, at most
SAMPLE_ROWS = 20_000
FIT_STEPS, RIDGE = 200, 1.0
TOLERANCE = 1e-3
#: pull of every rate towards 1, against the pull of the targets
HOLD = 0.01
_SLICE = 4 << 20


def labelled_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain): toxic before good (quality 1) before plain; ids without any label or with none left out; one row an id."""
    own = labels.where("doc_id is not null and (quality is not null or toxic is not null)")
    return (own.groupBy("doc_id").agg(F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"), F.max(F.coalesce("quality", F.lit(0))).alias("quality"))
            .select("doc_id", F.when(F.col("toxic") > 0, 2).when(F.col("quality") > 0, 1).otherwise(0).alias("domain")))


def _features(column: pa.Array):
    """Per slice: first row, past row, row and bucket of each distinct (row, bucket), words per row."""
    body, bounds = text_bytes(column)
    lower, classes = lower_table(), run_classes()
    for lo, hi in row_slices(bounds, _SLICE):
        part, cuts = lower[body[bounds[lo] : bounds[hi]]], bounds[lo : hi + 1] - bounds[lo]
        starts, ends = runs(part, cuts, classes)
        row = row_of(cuts, starts)
        tokens = np.bincount(row, minlength=hi - lo)
        bucket = (run_hashes(part, starts, ends) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)
        pairs = np.sort((row << FEATURE_BITS) | bucket)
        pairs = pairs[np.concatenate([[True], pairs[1:] != pairs[:-1]])] if len(pairs) else pairs
        yield lo, hi, pairs >> FEATURE_BITS, pairs & ((1 << FEATURE_BITS) - 1), tokens


def _extracted(batches):
    """Tokens and the distinct features of every text, beside its id."""
    for batch in batches:
        tokens, parts = np.zeros(batch.num_rows, np.int64), []
        for lo, hi, row, bucket, n in _features(batch.column(1)):
            tokens[lo:hi] = n
            parts.append((np.bincount(row, minlength=hi - lo), bucket))
        ends = np.concatenate([[0], np.cumsum(np.concatenate([c for c, _ in parts]))]) if parts else np.zeros(1)
        flat = np.concatenate([f for _, f in parts]) if parts else np.zeros(0)
        lists = pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(flat.astype(np.int32)))
        yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc_id", "features"])


def _presence(batches):
    """Documents of each domain that hold each feature, summed over a task."""
    size = 1 << FEATURE_BITS
    held = np.zeros(len(DOMAINS) * size, np.int64)
    for batch in batches:
        domain, features = batch.column(0).to_numpy(), batch.column(1)
        held += np.bincount(np.repeat(domain, features.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64) * size + features.flatten().to_numpy(), minlength=len(held))
    at = np.flatnonzero(held)
    yield pa.RecordBatch.from_arrays([pa.array(at // size), pa.array(at % size), pa.array(held[at])], ["domain", "bucket", "n"])


def _telling(own: DataFrame) -> np.ndarray:
    """Features of ``own``(domain, features) whose share of documents in some domain differs from the others' by ``EVIDENCE`` standard errors."""
    sizes = dict(own.groupBy("domain").count().collect())
    total = sum(sizes.values())
    counts = own.select("domain", "features").mapInArrow(_presence, "domain long, bucket long, n long").groupBy("bucket").agg(
        F.sum("n").alias("held"), *[F.sum(F.when(F.col("domain") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(len(DOMAINS))])
    pooled = (F.col("held") + 1) / (total + 2)
    apart = F.lit(False)
    for k in range(len(DOMAINS)):
        size, rest = sizes.get(k, 0) + 1, total - sizes.get(k, 0) + 1
        gap = F.abs((F.col(f"n{k}") + 0.5) / size - (F.col("held") - F.col(f"n{k}") + 0.5) / rest)
        apart = apart | (gap > EVIDENCE * F.sqrt(pooled * (1 - pooled) * (1 / size + 1 / rest)))
    return np.array(sorted(r[0] for r in counts.where(apart).select("bucket").collect()), np.int64)


def _logistic(row: np.ndarray, feature: np.ndarray, domain: np.ndarray, n_features: int) -> tuple[np.ndarray, np.ndarray]:
    """Intercepts and weights (domain x feature) of a multinomial logistic regression, by accelerated gradient steps."""
    n, k = len(domain), len(DOMAINS)
    truth = np.eye(k)[domain]
    width = np.bincount(row, minlength=n)
    step = 1.0 / (0.5 * (1 + (width.max() if len(row) else 0)) + RIDGE)  # the curvature of one row is at most half its squared length
    seen = np.bincount(feature, minlength=n_features)
    speed = n / np.maximum(np.append(seen, n), 1.0) ** 0.5 / n**0.5  # rare features move faster
    w = np.zeros((k, n_features + 1))
    ahead, momentum = w.copy(), 1.0
    for _ in range(FIT_STEPS):
        score = np.stack([np.bincount(row, ahead[c][feature], minlength=n) + ahead[c, -1] for c in range(k)], axis=1)
        p = np.exp(score - score.max(axis=1, keepdims=True))
        wrong = p / p.sum(axis=1, keepdims=True) - truth
        slope = np.stack([np.append(np.bincount(feature, wrong[row, c], minlength=n_features), wrong[:, c].sum()) for c in range(k)])
        slope[:, :-1] += RIDGE * ahead[:, :-1]
        new = ahead - step * speed * slope / n
        faster = (1 + (1 + 4 * momentum**2) ** 0.5) / 2
        if ((new - w) * slope).sum() > 0:  # uphill: begin the momentum anew
            faster = 1.0
        ahead, w, momentum = new + (momentum - 1) / faster * (new - w), new, faster
    return w[:, -1], w[:, :-1]


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Intercepts and weights (domain x hashed feature) of the domain classifier.

    A feature is a hashed word or run of marks, present or absent.  The texts
    become lists of features before they meet the labels, so that only these
    move; the labelled ones are written once.  Which features tell domains apart
    is counted over all labelled rows of ``docs``, by Spark; a logistic regression on these is fitted to ``sample_rows``
    labelled rows at most, those of the smallest hashes of their ids, then of
    their features.
    """
    kept = docs.select("doc_id", docs["text"].cast("string").alias("text")).where("doc_id is not null")
    features = kept.mapInArrow(_extracted, f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, features array<int>")
    # both sides grow with the corpus, so neither is broadcast at any size
    own = cut_lineage(features.hint("merge").join(labelled_domains(labels), "doc_id").select(F.xxhash64("doc_id").alias("key"), "domain", "features"))
    telling = _telling(own)
    weight = np.zeros((len(DOMAINS), 1 << FEATURE_BITS))
    last = own.select("key").orderBy("key").limit(sample_rows).agg(F.max("key")).first()[0]
    if last is None:
        return np.zeros(len(DOMAINS)), weight
    place = np.full(1 << FEATURE_BITS, -1, np.int32)
    place[telling] = np.arange(len(telling))

    def told(batches):
        for batch in batches:
            at = place[batch.column(1).flatten().to_numpy()]
            row = np.repeat(np.arange(batch.num_rows), batch.column(1).value_lengths().to_numpy(zero_copy_only=False))[at >= 0]
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=batch.num_rows))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, pa.array(at[at >= 0]))], ["domain", "features"])

    # rows of one id may be many: among equal keys a hash of the features decides
    first = own.where(F.col("key") <= last).withColumn("tie", F.xxhash64("features")).orderBy("key", "domain", "tie").limit(sample_rows)
    chosen = first.select("domain", "features").mapInArrow(told, "domain int, features array<int>").toArrow()
    lists, domain = chosen["features"].combine_chunks(), chosen["domain"].to_numpy()
    del chosen
    row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    feature = lists.flatten().to_numpy().astype(np.int64)
    del lists
    bias, fitted = _logistic(row, feature, domain, len(telling))
    weight[:, telling] = fitted
    return bias, weight


def posteriors(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The columns of ``docs`` without its text and those this operator makes, and tokens and p (one posterior per domain, summing to 1), for every row.

    A text without words, or null, has 0 tokens and the posteriors of no
    feature.  Without any labelled row all domains are equally likely.
    """
    prior, weight = train(docs, labels)
    model = docs.sparkSession.sparkContext.broadcast((prior, weight.astype(np.float32)))
    kept = [c for c in docs.columns if c not in ("text", "tokens", "p", "rate", "copies")]

    def per_batch(batches):
        prior, weight = model.value
        for batch in batches:
            score, tokens = np.tile(prior, (batch.num_rows, 1)), np.zeros(batch.num_rows, np.int64)
            for lo, hi, row, bucket, n in _features(batch.column(len(kept))):
                tokens[lo:hi] = n
                for k in range(len(prior)):
                    score[lo:hi, k] += np.bincount(row, weight[k][bucket], minlength=hi - lo)
            score = np.exp(score - score.max(axis=1, keepdims=True)) if batch.num_rows else score
            p = score / score.sum(axis=1, keepdims=True)
            flat = pa.ListArray.from_arrays(np.arange(batch.num_rows + 1, dtype=np.int32) * len(prior), pa.array(p.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(tokens), flat], names=[*kept, "tokens", "p"])

    schema = widened(docs.select(*kept).schema, "tokens long, p array<double>")
    return docs.select(*kept, docs["text"].cast("string").alias("text")).mapInArrow(per_batch, schema)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _rates(p: np.ndarray, steps: Sequence[np.ndarray], clean: np.ndarray | None = None, most: float = MAX_RATE) -> tuple[np.ndarray, np.ndarray]:
    """Rates after the given gradient steps, and the point ahead of them at which the next step is taken.

    A step takes p times its vector off, and its last number's part of the
    distance from 1, and stops at 0 and ``most``, or at 1 for documents most
    likely of a domain that ``clean`` marks; the point ahead carries a growing part
    of the last move on (Nesterov's rule).
    """
    rate = ahead = np.ones(len(p))
    least = 0.0 if clean is None or not len(p) else clean[p.argmax(axis=1)].astype(float)
    for k, step in enumerate(steps):
        new = np.clip(ahead - p @ step[:-1] - step[-1] * (ahead - 1.0), least, most)
        ahead = new + k / (k + 3) * (new - rate)
        rate = new
    return rate, ahead


def _totals(members: DataFrame, steps: list[np.ndarray], width: int, clean: np.ndarray | None = None, most: float = MAX_RATE) -> tuple[np.ndarray, np.ndarray]:
    """Expected domain tokens at the point ahead of the rates after ``steps``, and sum of t p p'."""
    def per_batch(batches):
        total, square = np.zeros(width), np.zeros((width, width))
        for batch in batches:
            p, t = _matrix(batch.column(1), width), batch.column(0).to_numpy().astype(float)
            total += (t * _rates(p, steps, clean, most)[1]) @ p
            square += (p * t[:, None]).T @ p
        yield pa.RecordBatch.from_arrays([pa.array([[*total, *square.reshape(-1)]])], ["v"])

    rows = members.select("tokens", "p").mapInArrow(per_batch, "v array<double>").select(F.posexplode("v")).groupBy("pos").agg(F.sum("col")).collect()
    flat = np.zeros(width * (width + 1))
    for k, v in rows:
        flat[k] = v
    return flat[:width], flat[width:].reshape(width, width)


def fit(members: DataFrame, shares: Sequence[float], tolerance: float = TOLERANCE, times: float = 1.0, clean: np.ndarray | None = None) -> list[np.ndarray]:
    """Gradient steps whose rates bring ``members``(tokens, p) to the token shares.

    The budget is ``times`` the tokens outside domains with share 0, so with 1
    the rest keeps about its size; documents of the domains that ``clean``
    marks keep a rate of 1 or more.  All domains count in one scale, so that stray
    posteriors of a domain without a share do not decide which documents repeat;
    the step is one over the largest curvature, with momentum.  ``HOLD`` ties
    every rate to 1, so that a target which cannot be met (a share of 0 with
    uncertain posteriors) takes the documents most likely of that domain, not
    all a little.  Steps end when no total moves by ``tolerance`` of the budget.
    """
    width = len(shares)
    wanted = np.array(shares, float) / (sum(shares) or 1)
    total, square = _totals(members, [], width)
    budget = total[wanted > 0].sum()
    if budget <= 0:
        return []
    budget *= times
    target = wanted * budget
    curvature = np.linalg.eigvalsh(square)[-1]
    steps: list[np.ndarray] = []
    while True:
        steps.append(np.append((total - target) / curvature, HOLD) / (1 + HOLD))
        last = total
        total, _ = _totals(members, steps, width, clean)
        if np.abs(total - last).max() <= tolerance * budget:
            return steps


def mixing_rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """The columns of ``docs`` without its text, tokens, p, rate and copies for every row.

    ``targets`` are the callers' token shares of the domains, ``TARGETS`` without.
    The budget is so large that no wanted domain (share above 0) must shrink:
    shares are met by repeats, not by loss, and a document most likely of a
    wanted domain is taken once at least.
    ``copies`` is the whole part of the rate, and one more where a hash of the
    row falls below the rest, so that expected totals are those of the rates.
    Repeated rows are documents of their own; an empty table gives none.
    """
    shares = [(targets or TARGETS)[d] for d in DOMAINS]
    draw = "draw"
    while draw in docs.columns:
        draw += "_"
    drawn = docs.withColumn(draw, F.xxhash64(F.lit(draw), "doc_id", docs["text"].cast("string")))
    members = cut_lineage(posteriors(drawn, labels))
    clean = np.array(shares) > 0
    total = _totals(members, [], len(shares))[0]
    wanted = np.array(shares, float)[clean] / (sum(shares) or 1)
    times = float(max(1.0, (total[clean] / wanted).max() / total[clean].sum())) if total[clean].sum() > 0 else 1.0
    steps = fit(members, shares, times=times, clean=clean)
    columns = [c for c in members.columns if c != draw]

    def per_batch(batches):
        for batch in batches:
            rate, _ = _rates(_matrix(batch.column("p"), len(DOMAINS)), steps, clean)
            chance = (batch.column(draw).to_numpy().view(np.uint64) >> np.uint64(11)) * 2.0**-53
            copies = np.floor(rate) + (chance < rate - np.floor(rate))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], pa.array(rate), pa.array(copies.astype(np.int64))], names=[*columns, "rate", "copies"])

    return members.mapInArrow(per_batch, widened(members.drop(draw).schema, "rate double, copies long"))
