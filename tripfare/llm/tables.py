"""Shared helpers over DataFrames: id filters of checked size, groups of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tripfare.operators.durable import durable

# A list of ids is sent to every executor up to this many; beyond it, both sides are shuffled.
BROADCAST_IDS = 1_000_000


# Sizes of the batches that reach a task's Python, unless the session names its own:
# with Spark's defaults a batch of long texts takes hundreds of megabytes.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


def bound_batches(spark: SparkSession) -> None:
    for key, value in BATCHES.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def only_ids(frame: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``frame`` whose key is among ``ids``, a stored table with one long column ``key``."""
    return frame.join(small(ids), key, "left_semi")


def small(rows: DataFrame) -> DataFrame:
    """A stored table of a few numbers a row, marked for broadcast if it has few rows."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_IDS else rows


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links of one task: every node with its least companion."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while (up := parent.get(x, x)) != top:
            parent[x] = top
            x = up
        return top

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(u), root(v)
            low, high = min(a, b), max(a, b)
            parent[high] = low
            parent.setdefault(low, low)
    pairs = [(n, r) for n in parent if (r := root(n)) != n]
    for at in range(0, len(pairs), 50_000):
        part = np.array(pairs[at : at + 50_000], dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(part[:, 0]), pa.array(part[:, 1])], ["u", "v"])


def components(links: DataFrame) -> DataFrame:
    """Least reachable node of every linked node: ``links`` (u, v) → (node, component).

    Union-find first shrinks the links inside each task. The forests of the
    tasks are then merged by alternating stars: nodes hang their larger, then
    their smaller neighbours on their least one, until all trees are flat. A
    round is a few joins over stored tables; nothing is gathered on the driver.
    """
    edges = durable(links.select("u", "v").filter("u <> v").mapInArrow(_forest, "u long, v long"), "forest")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = durable(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "stars")
        # Flat when no node has two parents and no parent has a parent.
        twice = edges.groupBy("u").count().filter("count > 1").select("u")
        deep = edges.select(F.col("v").alias("u")).join(edges, "u", "left_semi")
        if twice.unionByName(deep).isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
