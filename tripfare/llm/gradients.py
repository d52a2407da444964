"""Distributed gradient rounds: tasks step on their own rows, their changes are averaged."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Weights travel in pieces of this many floats, each summed by another task.
PIECE = 4096


def _pieces(learn: Callable[[Iterator[pa.RecordBatch]], tuple[np.ndarray, float]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        change, weight = learn(batches)
        if not weight:
            return
        flat = (change.reshape(-1) * weight).astype(np.float64)
        for i, low in enumerate(range(0, len(flat), PIECE)):
            row = [[i], [weight], [flat[low : low + PIECE].tobytes()]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in row], ["piece", "weight", "change"])

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, list] = {}
    for batch in batches:
        for i, weight, change in zip(*(c.to_pylist() for c in batch.columns)):
            values = np.frombuffer(change)
            if i in held:
                held[i][0] += weight
                held[i][1] = held[i][1] + values
            else:
                held[i] = [weight, values]
    for i, (weight, values) in held.items():
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in ([i], [weight], [values.tobytes()])], ["piece", "weight", "change"])


def averaged(rows: DataFrame, learn: Callable[[Iterator[pa.RecordBatch]], tuple[np.ndarray, float]], shape: tuple[int, ...]) -> np.ndarray:
    """Mean change of the weights over all tasks, each by the weight it reports.

    Each task sends its change once; sums are taken by piece, on the executors.
    Only the mean, of the size of the model, comes to the driver.
    """
    schema = "piece long, weight double, change binary"
    sums = rows.mapInArrow(_pieces(learn), schema).repartition("piece").mapInArrow(_summed, schema)
    total = np.zeros(int(np.prod(shape)))
    for row in sums.toLocalIterator():
        values = np.frombuffer(row["change"])
        total[row["piece"] * PIECE : row["piece"] * PIECE + len(values)] = values / row["weight"]
    return total.reshape(shape).astype(np.float32)
