"""Exact places of rows in a global order, without a group in one task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.session import cut_lineage
from .textruns import widened


def _group_starts(column: pa.Array, before: str | None, first: bool) -> np.ndarray:
    """Rows at which another group begins; ``before`` is the group of the row before this batch."""
    fresh = np.ones(len(column), bool)
    fresh[0] = first or column[0].as_py() != before
    fresh[1:] = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
    return fresh


def numbered(rows: DataFrame, group: str, by: list[Column], weight: str | None = None) -> DataFrame:
    """``rows`` with ``number``, a row's place (from 0) in its ``group`` under the order ``by``, and, where ``weight``
    names a column, ``before``: the weight of all rows ahead of it in the order (group, by).

    ``group`` is a string column without nulls and ``rows`` a written table (it is read twice).  A range exchange cuts
    groups of any size; each partition counts its own runs, and only the run that opens a partition needs what earlier
    partitions hold of its group: one summary row per partition on the driver.  Rows that tie in ``by`` are numbered
    in the order of the written table.  The result is a written table too; an empty table gives an empty one.
    """
    spark, extra = rows.sparkSession, "part int, head boolean, run long, upto long"
    tie = F.monotonically_increasing_id()
    dealt = rows.withColumn("_tie", tie).repartitionByRange(F.col(group), *by, F.col("_tie")).sortWithinPartitions(F.col(group), *by, F.col("_tie"))
    dealt = dealt.withColumn("part", F.spark_partition_id())
    schema = widened(rows.schema, extra)
    kept, names = rows.columns, [*rows.columns, "part", "head", "run", "upto"]

    def count(batches):
        last, run, upto, head, seen = None, 0, 0, True, False
        for batch in batches:
            if not len(batch):
                continue
            keys = batch.column(group)
            fresh = _group_starts(keys, last, not seen)
            at = np.arange(len(batch))
            start = np.maximum.accumulate(np.where(fresh, at, -1))
            own = np.where(start >= 0, at - start, at + run)
            heads = np.full(len(batch), head) & ((np.cumsum(fresh) == 1) if not seen else (np.cumsum(fresh) == 0))
            total = np.cumsum(batch.column(weight).to_numpy()) + upto if weight else np.zeros(len(batch), np.int64)
            ahead = total - batch.column(weight).to_numpy() if weight else total
            yield pa.RecordBatch.from_arrays([*map(batch.column, kept), batch.column("part"), pa.array(heads), pa.array(own.astype(np.int64)), pa.array(ahead.astype(np.int64))], names)
            last, run, seen, head = keys[-1].as_py(), int(own[-1]) + 1, True, bool(heads[-1])
            upto = int(total[-1]) if weight else 0

    runs = cut_lineage(dealt.mapInArrow(count, schema))
    size = F.col(weight) if weight else F.lit(0)
    ends = runs.groupBy("part").agg(
        F.count_if("head").alias("head"), F.min(group).alias("first"), F.max(group).alias("last"),
        F.max(F.struct(F.col(group), F.col("run"))).alias("tail"), F.sum(size).alias("weight")).orderBy("part").collect()
    offsets, carried, group_before, weight_before = [], 0, None, 0
    for r in ends:
        offset = carried if r["first"] == group_before else 0
        offsets.append((r["part"], offset, weight_before))
        carried = r["tail"]["run"] + 1 + (offset if r["first"] == r["last"] else 0)
        group_before, weight_before = r["last"], weight_before + r["weight"]
    table = spark.createDataFrame(offsets, "part int, offset long, ahead long")
    found = runs.join(F.broadcast(table), "part").withColumn("number", F.col("run") + F.when(F.col("head"), F.col("offset")).otherwise(0))
    return found.withColumn("before", F.col("upto") + F.col("ahead")).drop("part", "head", "run", "upto", "offset", "ahead", *([] if weight else ["before"]))
