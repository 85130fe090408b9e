"""Ranks, running counts and quantiles that never gather one group in one task.

A plain ``Window.partitionBy(group).orderBy(value)`` sends a whole group to one
task, which fails when one group holds a third of all rows.  Here every group is
cut into value-ordered buckets: totals per bucket are aggregated (map-side
combine), turned into offsets over the short bucket table, and the running sums
are finished inside each (group, bucket).  Rows are first collapsed to one row
per distinct value, so a heavy tie is a single row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .session import cut_lineage

#: buckets per doubling of |value|, and the magnitude below which values share a bucket
_BUCKETS_PER_OCTAVE = 32
_SMALLEST = 1e-6


def value_bucket(value: Column) -> Column:
    """Bucket number that never decreases as ``value`` grows (at most a few thousand buckets)."""
    octave = F.log2(F.lit(1.0) + F.abs(value) / F.lit(_SMALLEST)) * F.lit(float(_BUCKETS_PER_OCTAVE))
    return (F.signum(value) * F.floor(octave)).cast("int")


def hash_bucket(digest: Column) -> Column:
    """Bucket of a hexadecimal digest: its first three digits (4,096 even buckets)."""
    return F.substring(digest, 1, 3)


def running_sums(df: DataFrame, keys: Sequence[str], order: str, sums: Sequence[str], bucket: Column | None = None) -> DataFrame:
    """Add ``<s>_below`` (strictly earlier rows of the group) and ``<s>_total`` for each summed column.

    ``df`` holds one row per (keys, order value); ``bucket`` must be monotone in ``order``.
    """
    keys = list(keys)
    rows = df.withColumn("_bucket", value_bucket(F.col(order)) if bucket is None else bucket)
    totals = rows.groupBy(*keys, "_bucket").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    earlier = W.partitionBy(*keys).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    group = W.partitionBy(*keys)
    offsets = totals.select(
        *keys, "_bucket",
        *[F.coalesce(F.sum(f"_t_{s}").over(earlier), F.lit(0)).alias(f"_o_{s}") for s in sums],
        *[F.sum(f"_t_{s}").over(group).alias(f"{s}_total") for s in sums],
    )
    inside = W.partitionBy(*keys, "_bucket").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    out = rows.join(offsets, [*keys, "_bucket"])
    for s in sums:
        out = out.withColumn(f"{s}_below", F.col(f"_o_{s}") + F.coalesce(F.sum(s).over(inside), F.lit(0)))
    return out.drop("_bucket", *[f"_o_{s}" for s in sums])


def value_counts(df: DataFrame, keys: Sequence[str], value: str, **counts: Column) -> DataFrame:
    """One row per (keys, value) with the requested counts; ``n`` counts all rows by default."""
    aggs = [expr.alias(name) for name, expr in (counts or {"n": F.count(F.lit(1))}).items()]
    return df.groupBy(*keys, value).agg(*aggs)


def average_ranks(df: DataFrame, keys: Sequence[str], value: str, out: str = "rank") -> DataFrame:
    """Distinct values of each group with their tie-averaged rank, tie size ``n`` and group size ``n_total``."""
    ranked = running_sums(value_counts(df.where(F.col(value).isNotNull()), keys, value), keys, value, ["n"])
    return ranked.withColumn(out, F.col("n_below") + (F.col("n") + 1) / 2.0).drop("n_below")


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, quantiles: dict[str, float], weight: str | None = None) -> DataFrame:
    """Linearly interpolated quantiles per group, one output column per entry of ``quantiles``.

    ``weight`` names an integer multiplicity column (for example a block of zeros).
    """
    kept = df.where(F.col(value).isNotNull())
    size = F.sum(F.col(weight)) if weight else F.count(F.lit(1))
    runs = running_sums(value_counts(kept, keys, value, n=size).where("n > 0"), keys, value, ["n"])
    aggs = []
    for name, q in quantiles.items():
        position = (F.col("n_total") - 1) * F.lit(float(q))
        lo, hi = F.floor(position), F.ceil(position)
        upto = F.col("n_below") + F.col("n")

        def at(index: Column) -> Column:
            return F.max(F.when((F.col("n_below") <= index) & (index < upto), F.col(value)))

        share = F.max(position - lo)
        aggs.append((at(lo) + share * (at(hi) - at(lo))).alias(name))
    if keys:
        return runs.groupBy(*keys).agg(*aggs)
    return runs.agg(*aggs)


def hash_rank(df: DataFrame, keys: Sequence[str], digest: str, out: str = "draw") -> DataFrame:
    """1-based position of each row in digest order inside its group (a reproducible shuffle)."""
    ones = df.withColumn("_one", F.lit(1))
    ranked = running_sums(ones, keys, digest, ["_one"], hash_bucket(F.col(digest)))
    return ranked.withColumn(out, (F.col("_one_below") + 1).cast("bigint")).drop("_one", "_one_below").withColumnRenamed("_one_total", f"{out}_of")


def bh_adjust(df: DataFrame, p: str, out: str, family: Sequence[str] = (), materialise: bool = True) -> DataFrame:
    """Benjamini-Hochberg adjusted values inside each family; NULL stays NULL and is not counted.

    Equal p-values always share one adjusted value, so the step-up is computed on
    distinct p-values and joined back.  The tests are materialised first so that
    both sides of that join see identical numbers.
    """
    family = list(family)
    tests = cut_lineage(df) if materialise else df
    counted = value_counts(tests.where(F.col(p).isNotNull()), family, p)
    bucket = F.when(F.col(p) <= 0, F.lit(-10000)).otherwise(F.floor(F.log2(F.col(p)) * 16)).cast("int")
    runs = running_sums(counted, family, p, ["n"], bucket).withColumn("_bucket", bucket)
    raw = runs.withColumn("_raw", F.col(p) * F.col("n_total") / (F.col("n_below") + F.col("n")))
    later = W.partitionBy(*family).orderBy("_bucket").rowsBetween(1, W.unboundedFollowing)
    heads = raw.groupBy(*family, "_bucket").agg(F.min("_raw").alias("_head"))
    heads = heads.withColumn("_later", F.min("_head").over(later)).drop("_head")
    onward = W.partitionBy(*family, "_bucket").orderBy(p).rowsBetween(0, W.unboundedFollowing)
    adjusted = raw.join(heads, [*family, "_bucket"]).select(
        *family, p, F.least(F.lit(1.0), F.min("_raw").over(onward), F.col("_later")).alias(out))
    return tests.join(adjusted, [*family, p], "left")


def bh_adjust_columns(df: DataFrame, key: Sequence[str], columns: dict[str, str]) -> DataFrame:
    """Adjust several p-value columns, each its own family, in one ordered pass; ``key`` identifies a row."""
    key = list(key)
    tests = cut_lineage(df)
    stacked = F.explode(F.array(*[F.struct(F.lit(p).alias("_family"), F.col(p).alias("_p")) for p in columns]))
    long = tests.select(*key, stacked.alias("_s")).select(*key, "_s._family", "_s._p")
    adjusted = bh_adjust(long, "_p", "_q", ["_family"], materialise=False)
    wide = adjusted.groupBy(*key).agg(*[F.max(F.when(F.col("_family") == p, F.col("_q"))).alias(out) for p, out in columns.items()])
    return tests.join(wide, key, "left")
