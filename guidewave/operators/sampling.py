"""Reproducible bounded sampling by hash order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ordering import hash_rank


def bounded_sample(df: DataFrame, group: Sequence[str], limit: int | None, seed: int, id_column: str = "cell_id", stratum: str | None = None) -> DataFrame:
    """At most ``limit`` rows per group: all of a small group, a hash-ordered draw of a larger one.

    With a stratum every level first gets its rounded share (at least one row);
    the draw is then trimmed or topped up to the limit in hash order.  Without a
    limit all rows stay.
    """
    if limit is None:
        return df
    group = list(group)
    digest = F.sha2(F.concat_ws("|", F.lit(str(seed)), F.col(id_column).cast("string")), 256)
    rows = df.withColumn("_h", digest)
    if stratum is None:
        return hash_rank(rows, group, "_h", "_r").where(F.col("_r") <= limit).drop("_h", "_r", "_r_of")
    inside = hash_rank(rows, [*group, stratum], "_h", "_rs")
    totals = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")) if group else df.agg(F.count(F.lit(1)).alias("_n"))
    inside = inside.join(totals, group) if group else inside.crossJoin(F.broadcast(totals))
    quota = F.greatest(F.lit(1), F.rint(F.lit(float(limit)) * F.col("_rs_of") / F.col("_n")))
    first = F.when((F.col("_n") <= limit) | (F.col("_rs") <= quota), "0").otherwise("1")
    ranked = _rank_with_priority(inside.withColumn("_first", first), group)
    return ranked.where(F.col("_r") <= limit).drop("_h", "_rs", "_rs_of", "_n", "_first", "_r", "_r_of")


def _rank_with_priority(df: DataFrame, group: list[str]) -> DataFrame:
    """Hash rank with the chosen rows first: their count is the offset of the others."""
    ranked = hash_rank(df, [*group, "_first"], "_h", "_r")
    chosen = df.groupBy(*group).agg(F.count_if(F.col("_first") == "0").alias("_c")) if group else df.agg(F.count_if(F.col("_first") == "0").alias("_c"))
    joined = ranked.join(chosen, group) if group else ranked.crossJoin(F.broadcast(chosen))
    return joined.withColumn("_r", F.when(F.col("_first") == "0", F.col("_r")).otherwise(F.col("_r") + F.col("_c"))).drop("_c")
