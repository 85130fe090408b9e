"""A test of bounded size for ids that may be in a table, so that the rows of all others need not travel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: bits of a filter, 64 in a row: at most 524,288 rows are broadcast, whatever the number of ids
BITS = 1 << 25


def _bit(key: str) -> tuple[Column, Column]:
    """The row and the bit of an id."""
    at = F.pmod(F.xxhash64(key), F.lit(BITS))
    return F.floor(at / 64), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(64)).cast("int"))


def maybe_among(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """``rows`` with ``maybe``: false only if ``key`` is not in the column ``key`` of ``ids``.

    Beyond some millions of ids most rows are told true; an exact join must follow for these.
    """
    word, bit = _bit(key)
    words = ids.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    told = rows.withColumns({"_at": word, "_bit": bit}).join(F.broadcast(words.withColumnRenamed("_word", "_at")), "_at", "left")
    return told.withColumn("maybe", F.coalesce(F.col("_bits").bitwiseAND(F.col("_bit")) != 0, F.lit(False))).select(*rows.columns, "maybe")
