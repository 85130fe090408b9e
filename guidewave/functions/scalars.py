"""Scalar expressions: names, lists, odds, seeds, formatting."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

LANE_SEPARATOR = "__"


def lane_cell_id(barcode: Column, lane: Column) -> Column:
    """Global cell id of a barcode inside one lane."""
    return F.concat_ws(LANE_SEPARATOR, barcode, lane)


def split_list(text: Column, separator: str = ",") -> Column:
    """Trimmed, non-empty members of a delimited list; NULL gives an empty list."""
    parts = F.split(F.coalesce(text, F.lit("")), re.escape(separator))
    return F.filter(F.transform(parts, lambda item: F.trim(item)), lambda item: item != "")


def any_regex(text: Column, patterns: Sequence[str]) -> Column:
    """True when any pattern is found in ``text``, ignoring case."""
    hit = F.lit(False)
    for pattern in patterns:
        hit = hit | text.rlike(f"(?i){pattern}")
    return hit


def target_from_guide(guide: Column, pattern: str | None) -> Column:
    """First capture group of ``pattern`` matched at the start of the guide id, else the id."""
    if not pattern:
        return guide
    java = "^(?:" + re.sub(r"\(\?P<", "(?<", pattern) + ")"
    found = F.regexp_extract(guide, java, 1)
    return F.coalesce(F.nullif(found, F.lit("")), guide)


def control_class_of(target: Column, classes: Mapping[str, Sequence[str]]) -> Column:
    """First class, in the given order, with a matching pattern; ``targeting`` otherwise."""
    out = None
    for name, patterns in classes.items():
        cond = any_regex(target, patterns)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return F.lit("targeting") if out is None else out.otherwise(F.lit("targeting"))


def feature_base_name(name: Column, suffix: str | None, rename: Mapping[str, str] | None = None) -> Column:
    """Antibody name without its file suffix, passed through a rename map."""
    base = name
    if suffix:
        base = F.regexp_replace(name, re.escape(suffix) + "$", "")
    base = F.trim(base)
    if rename:
        pairs = F.create_map(*[F.lit(x) for kv in rename.items() for x in kv])
        base = F.coalesce(F.element_at(pairs, base), base)
    return base


def ratio(num: Column, den: Column) -> Column:
    """Division that gives NULL for a zero or missing denominator."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def log2_ratio(num: Column, den: Column, pseudocount: float) -> Column:
    eps = F.lit(float(pseudocount))
    return F.log2((num + eps) / (den + eps))


def corrected_odds(a: Column, b: Column, c: Column, d: Column, pseudocount: float = 0.5) -> Column:
    """Odds ratio of a 2x2 table with a constant added to every cell."""
    h = F.lit(float(pseudocount))
    return ((a + h) * (d + h)) / ((b + h) * (c + h))


def raw_odds(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Sample odds ratio: infinite without off-diagonal counts, NULL for 0/0."""
    num, den = (a * d).cast("double"), (b * c).cast("double")
    return F.when(den > 0, num / den).when(num > 0, F.lit(float("inf")))


def seed_from_text(text: Column) -> Column:
    """Seed of a text key: leading 32 bits of its SHA-256, modulo 2^31 - 1."""
    head = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("bigint")
    return head % F.lit(2**31 - 1)


def significant3(value: Column) -> Column:
    """Three significant digits as text, empty for a missing value."""
    return F.coalesce(F.format_string("%.3g", value), F.lit(""))


def squared_distance(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two array columns."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, v: acc + v)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)
