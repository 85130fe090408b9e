"""A training corpus from raw documents: languages, near-duplicates, test passages, mixture, shards.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; what it returns is written as Parquet and read again for the next one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from guidewave.functions.session import cut_lineage
from guidewave.llm import decontaminate, language, mixing, nearcopies, sharding
from guidewave.llm.idfilter import maybe_among


def _whole(docs: DataFrame) -> Column:
    """All columns of a row in one, out of the way of the operators' own names."""
    return F.struct(*docs.columns).alias("own")


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without any letter (or a null text) go."""
    found = language.identify(docs.select("text", _whole(docs)), docs.select("text", "lang"))
    return found.where(F.col("lang_pred") != language.UNDETERMINED).select("own.*")


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate class: that of the smallest doc_id (null last), of rows with one id the first.

    Near-duplicates share 0.8 or more of their five-word shingles.  Rows are
    numbered and written once, as doc_ids may be missing or repeated.
    """
    rows = cut_lineage(docs.select(F.monotonically_increasing_id().alias("doc_id"), _whole(docs)))
    classes = nearcopies.classes(rows.select("doc_id", "own.text"))
    order = F.struct(F.col("own.doc_id").isNull().alias("missing"), F.col("own.doc_id").alias("id"), F.col("doc_id").alias("row"))
    first = rows.select("doc_id", order.alias("order")).join(classes, "doc_id").groupBy("class_id").agg(F.min("order").alias("order"))
    gone = cut_lineage(rows.select("doc_id").join(first.select(F.col("order.row").alias("doc_id")), "doc_id", "left_anti"))
    # most rows surely stay, and stay where they are
    told = maybe_among(rows, "doc_id", gone)
    return told.where("NOT maybe").select("own.*").unionByName(told.where("maybe").join(gone, "doc_id", "left_anti").select("own.*"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark text."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str, targets: dict[str, float] | None = None) -> DataFrame:
    """Every document as often as its rate says, a fractional part by a hash of the row; clean documents stay once at least."""
    rates = mixing.mixing_rates(docs.select("doc_id", "text", _whole(docs)), spark.read.parquet(f"{sf_dir}/labels.parquet"), targets)
    copy = F.explode(F.sequence(F.lit(1).cast("long"), "copies"))
    return rates.where("copies > 0").select("own", copy.alias("copy")).select("own.*")


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard of near-equal bytes and its place there."""
    return sharding.shard(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", identified), ("SimHash near-dedup", deduplicated), ("benchmark decontamination", decontaminated),
    ("mixing sources to target weights", mixed), ("sharding", sharded),
]

#: none: XXH64 fingerprints, profile distances and least-squares rates are not SQL; tests hold the stages against brute force
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
