"""The order of a result as a column, so that it outlives the way it is stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tripfare.operators.durable import durable

# A generated row id holds the partition above this bit and the row below it.
_ROW_BITS = 33


def positioned(ordered: DataFrame, name: str = "position") -> DataFrame:
    """Number the rows of a sorted frame from 1 on.

    A global sort lays rows out in ranges over the partitions. Each row is
    marked by its place in its range; only the sizes of the ranges are added
    up in one task, so a result of any length is numbered in parallel.
    """
    marked = durable(ordered.withColumn("row_id", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("row_id", _ROW_BITS)
    sizes = marked.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("size"))
    before = F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row per range; there are as many as the sort made.
    starts = sizes.select("part", before.alias("before"))
    inner = F.col("row_id").bitwiseAND((1 << _ROW_BITS) - 1)
    numbered = marked.withColumn("part", part).join(F.broadcast(starts), "part")
    return numbered.withColumn(name, F.col("before") + inner + 1).drop("part", "before", "row_id")
