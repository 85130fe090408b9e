"""Group moments with implicit zeros, Welch t and standardised differences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import ratio
from ..functions.tails import student_two_sided


def moment_sums(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Sums over stored values: ``s1``, ``s2``, ``se`` (of expm1) and ``nnz``; partial sums are combined map-side."""
    x = F.col(value)
    return df.groupBy(*keys).agg(F.sum(x).alias("s1"), F.sum(x * x).alias("s2"), F.sum(F.expm1(x)).alias("se"), F.count_if(x != 0).alias("nnz"))


def mean_of(s1: Column, n: Column) -> Column:
    return ratio(s1, n)


def variance_of(s1: Column, s2: Column, n: Column) -> Column:
    """Unbiased variance from sums, never negative; one cell gives zero."""
    mean = s1 / n
    return F.greatest(F.lit(0.0), (s2 / n - mean * mean) * (n / F.greatest(n - 1, F.lit(1))))


def welch(df: DataFrame, a: str, b: str, t: str = "t", p: str | None = "p_value") -> DataFrame:
    """Welch t (and p) from columns ``mean_<g>``, ``var_<g>``, ``n_<g>``; no spread gives t = 0, p = 1."""
    def col(stat: str, group: str) -> Column:
        return F.col(f"{stat}_{group}").cast("double")

    va, vb = col("var", a) / col("n", a), col("var", b) / col("n", b)
    se2 = va + vb
    dof = (se2 * se2) / (va * va / F.greatest(col("n", a) - 1, F.lit(1.0)) + vb * vb / F.greatest(col("n", b) - 1, F.lit(1.0)))
    out = df.withColumn(t, F.when(se2 > 0, (col("mean", a) - col("mean", b)) / F.sqrt(se2)).otherwise(0.0))
    if p is None:
        return out
    return out.withColumn("_dof", F.when(se2 > 0, F.greatest(dof, F.lit(1.0)))).withColumn(
        p, F.when(F.col("_dof").isNotNull(), student_two_sided(F.col(t), F.col("_dof"))).otherwise(1.0)).drop("_dof")


def cohen_d(mean_a: Column, var_a: Column, n_a: Column, mean_b: Column, var_b: Column, n_b: Column) -> Column:
    """Difference over the pooled standard deviation; NULL below two cells or without spread."""
    pooled = ((n_a - 1) * var_a + (n_b - 1) * var_b) / F.greatest(n_a + n_b - 2, F.lit(1))
    return F.when((n_a >= 2) & (n_b >= 2) & (pooled > 0), (mean_a - mean_b) / F.sqrt(pooled))


def group_moments(sums: DataFrame, sizes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``mean`` and ``var`` with zeros included; ``sizes`` carries ``n_cells`` on (a subset of) the keys."""
    on = [k for k in keys if k in sizes.columns]
    joined = sums.join(sizes, on) if on else sums.crossJoin(F.broadcast(sizes))
    n = F.col("n_cells").cast("double")
    return joined.withColumn("mean", mean_of(F.col("s1"), n)).withColumn("var", variance_of(F.col("s1"), F.col("s2"), n)).withColumn("mean_linear", ratio(F.col("se"), n))


def leave_one_out(own: DataFrame, total: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Sums over everybody else: pool totals minus a group's own sums."""
    joined = own.join(total.select(*keys, *[F.col(c).alias(f"_tot_{c}") for c in columns]), list(keys), "left")
    for c in columns:
        joined = joined.withColumn(f"other_{c}", F.coalesce(f"_tot_{c}", F.lit(0)) - F.coalesce(c, F.lit(0)))
    return joined.drop(*[f"_tot_{c}" for c in columns])
