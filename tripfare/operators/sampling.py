"""Seeded samples without replacement."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, functions as F, types as T


def _checked(fraction: float) -> float:
    if not 0 < fraction <= 1:
        raise ValueError(f"sample fraction {fraction} is outside (0, 1]")
    return fraction


def bernoulli_sample(trips: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Keep each row with probability ``fraction``.

    Which rows are kept depends on how they are laid out in partitions. Store
    the result (``durable``) before using it more than once.
    """
    return trips.sample(False, _checked(fraction), seed)


def hash_sample(trips: DataFrame, keys: Sequence[str], fraction: float, seed: int = 42) -> DataFrame:
    """Keep rows by a hash of whole-number keys: the same rows on any layout.

    Rows with equal keys are kept or dropped together.
    """
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    for key in keys:
        if not isinstance(trips.schema[key].dataType, whole):
            raise TypeError(f"sample key {key} must be a whole number")
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    bucket = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")
    return trips.filter(bucket < int(_checked(fraction) * 2**32))
