"""Distribution and rank tests over value counts, safe for very large groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordering import average_ranks, running_sums
from ..functions.tails import chi2_upper, correlation_two_sided, ks_two_sided, rank_sum_less, rank_sum_two_sided


def two_sample_counts(df: DataFrame, keys: Sequence[str], value: str, first: Column, second: Column) -> DataFrame:
    """One row per distinct value with the number of cells of each group."""
    return df.groupBy(*keys, value).agg(F.count_if(first).alias("n_a"), F.count_if(second).alias("n_b"))


def with_zero_block(counts: DataFrame, sizes: DataFrame, keys: Sequence[str], value: str, groups: Sequence[str]) -> DataFrame:
    """Add the implicit zeros: group size minus stored cells, as counts at value 0.

    ``sizes`` carries the group sizes under the same column names on the keys.
    """
    keys = list(keys)
    stored = counts.groupBy(*keys).agg(*[F.sum(g).alias(f"_s_{g}") for g in groups])
    base = sizes.join(stored, keys, "left")
    zero = base.select(*keys, F.lit(0.0).alias(value), *[(F.col(g) - F.coalesce(f"_s_{g}", F.lit(0))).alias(g) for g in groups])
    return counts.select(*keys, value, *groups).unionByName(zero).groupBy(*keys, value).agg(*[F.sum(g).alias(g) for g in groups])


def compare_distributions(counts: DataFrame, keys: Sequence[str], value: str, a: str = "n_a", b: str = "n_b") -> DataFrame:
    """Per key: group sizes, KS distance, rank-sum U of the first group, tie term and AUC, from one ordered pass."""
    runs = running_sums(counts.where(F.col(a) + F.col(b) > 0).withColumn("_pool", F.col(a) + F.col(b)), keys, value, [a, b, "_pool"])
    return _summarise(runs, keys, a, b)


def _summarise(runs: DataFrame, keys: Sequence[str], a: str, b: str, suffix: str = "") -> DataFrame:
    return runs.groupBy(*keys).agg(*_pair_aggregates(a, b, suffix))\
        .transform(lambda d: _finish_pair(d, suffix))


def _pair_aggregates(a: str, b: str, suffix: str = "", pool: str | None = None) -> list[Column]:
    """Aggregates of one ordered pass for the pair of count columns (a, b)."""
    na, nb = F.col(f"{a}_total"), F.col(f"{b}_total")
    upto_a, upto_b = F.col(f"{a}_below") + F.col(a), F.col(f"{b}_below") + F.col(b)
    gap = F.abs(F.try_divide(upto_a.cast("double"), na) - F.try_divide(upto_b.cast("double"), nb))
    tie = (F.col(a) + F.col(b)).cast("double")
    rank = (F.col(f"{a}_below") + F.col(f"{b}_below")).cast("double") + (tie + 1) / 2
    return [F.max(na).alias(f"n_first{suffix}"), F.max(nb).alias(f"n_second{suffix}"), F.max(gap).alias(f"ks_stat{suffix}"),
            F.sum(F.col(a) * rank).alias(f"_r{suffix}"), F.sum(tie * tie * tie - tie).alias(f"ties{suffix}")]


def _finish_pair(df: DataFrame, suffix: str = "") -> DataFrame:
    n, m = F.col(f"n_first{suffix}"), F.col(f"n_second{suffix}")
    out = df.withColumn(f"u{suffix}", F.col(f"_r{suffix}") - n * (n + 1) / 2).drop(f"_r{suffix}")
    return out.withColumn(f"auc{suffix}", F.try_divide(F.col(f"u{suffix}"), (n * m).cast("double")))


def with_ks_p(df: DataFrame, out: str = "ks_pval", suffix: str = "", method: str = "auto") -> DataFrame:
    n, m = F.col(f"n_first{suffix}"), F.col(f"n_second{suffix}")
    return df.withColumn(out, ks_two_sided(n.cast("double"), m.cast("double"), F.col(f"ks_stat{suffix}"), method))


def with_rank_sum_p(df: DataFrame, out: str = "p_value", alternative: str = "two-sided", suffix: str = "") -> DataFrame:
    test = rank_sum_less if alternative == "less" else rank_sum_two_sided
    n, m = F.col(f"n_first{suffix}"), F.col(f"n_second{suffix}")
    return df.withColumn(out, test(n, m, F.col(f"u{suffix}"), F.col(f"ties{suffix}")))


def spearman(df: DataFrame, keys: Sequence[str], x: str, y: str, p: str | None = "p_value", out: str = "rho", n: str = "n_pairs") -> DataFrame:
    """Rank correlation per key over rows with both values.

    Pairs are first collapsed to distinct (x, y) with a multiplicity; each axis is
    ranked with bucketed running counts, and the correlation comes from weighted
    sums, so no task ever holds a whole group.  NULL below three pairs or without spread.
    """
    keys = list(keys)
    pairs = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*keys, F.col(x).alias("_x"), F.col(y).alias("_y")).agg(F.count(F.lit(1)).alias("_w"))

    def ranks(axis: str) -> DataFrame:
        counts = pairs.groupBy(*keys, axis).agg(F.sum("_w").alias("n"))
        r = running_sums(counts, keys, axis, ["n"])
        return r.select(*keys, axis, (F.col("n_below") + (F.col("n") + 1) / 2.0).alias(f"_r{axis}"))

    ranked = pairs.join(ranks("_x"), [*keys, "_x"]).join(ranks("_y"), [*keys, "_y"])
    w = F.col("_w")
    sums = ranked.groupBy(*keys).agg(
        F.sum(w).alias(n), *[F.sum(w * e).alias(k) for k, e in {
            "_sx": F.col("_r_x"), "_sy": F.col("_r_y"), "_sxx": F.col("_r_x") * F.col("_r_x"), "_syy": F.col("_r_y") * F.col("_r_y"), "_sxy": F.col("_r_x") * F.col("_r_y")}.items()])
    c = F.col(n).cast("double")
    vx, vy = F.col("_sxx") - F.col("_sx") * F.col("_sx") / c, F.col("_syy") - F.col("_sy") * F.col("_sy") / c
    rho = F.when((c >= 3) & (vx > 0) & (vy > 0), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (F.col("_sxy") - F.col("_sx") * F.col("_sy") / c) / F.sqrt(vx * vy))))
    res = sums.withColumn(out, rho).drop("_sx", "_sy", "_sxx", "_syy", "_sxy")
    return res.withColumn(p, correlation_two_sided(F.col(out), F.col(n))) if p else res


def kruskal_wallis(df: DataFrame, keys: Sequence[str], group: str, value: str) -> DataFrame:
    """Tie-corrected H and its chi-square tail per key; NULL below two groups or when all values tie."""
    keys = list(keys)
    kept = df.where(F.col(value).isNotNull())
    ranks = average_ranks(kept, keys, value, "_rank")
    counts = kept.groupBy(*keys, group, value).agg(F.count(F.lit(1)).alias("_c"))
    rank_rows = counts.join(ranks.select(*keys, value, "_rank"), [*keys, value])
    per_group = rank_rows.groupBy(*keys, group).agg(F.sum("_c").alias("_n"), F.sum(F.col("_c") * F.col("_rank")).alias("_r"))
    summed = per_group.groupBy(*keys).agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("n_groups"), F.sum(F.col("_r") * F.col("_r") / F.col("_n")).alias("_q"))
    ties = ranks.groupBy(*keys).agg(F.sum(F.col("n").cast("double") * F.col("n") * F.col("n") - F.col("n")).alias("_ties"))
    joined = summed.join(ties, keys) if keys else summed.crossJoin(ties)
    n = F.col("n").cast("double")
    correction = 1 - F.col("_ties") / (n * n * n - n)
    h = (12 / (n * (n + 1)) * F.col("_q") - 3 * (n + 1)) / correction
    out = joined.withColumn("statistic", F.when((F.col("n_groups") >= 2) & (correction > 0), h))
    return out.withColumn("p_value", chi2_upper(F.col("statistic"), F.col("n_groups") - 1)).drop("_q", "_ties")
