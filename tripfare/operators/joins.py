"""Lookup joins that stay whole and balanced whatever the key distribution."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_
from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

# A lookup is broadcast only when rows x fixed row width stays below this.
BROADCAST_BYTES = 64 * 1024 * 1024
# A key is hot when it holds at least this share of the (sampled) rows, so
# there are never more than 1 / HOT_SHARE hot keys.
HOT_SHARE = 0.01
HOT_SAMPLE = 0.01

# A fixed-width field takes a word; a hashed row also holds its key, a pointer
# and a header, and the pages it lies in are grown by doubling.
_FIXED = (T.BooleanType, T.IntegerType, T.DateType, T.LongType, T.DoubleType, T.TimestampType, T.TimestampNTZType)
_WORD = 8
_ROW_OVERHEAD = 6 * _WORD
_DOUBLING = 2


def row_bytes(schema: T.StructType) -> int | None:
    """Most bytes of a broadcast row of fixed-width columns; None when a column can grow."""
    if not all(isinstance(f.dataType, _FIXED) for f in schema.fields):
        return None
    return _DOUBLING * (_WORD * len(schema.fields) + _ROW_OVERHEAD)


def fits_broadcast(lookup: DataFrame, rows: int | None = None, limit: int = BROADCAST_BYTES) -> bool:
    """Prove that ``lookup`` is small enough to send to every executor.

    ``rows`` is a known upper bound; without it the rows are counted, which for
    a Parquet table reads footers only.
    """
    width = row_bytes(lookup.schema)
    if width is None or limit < width:
        return False
    return (lookup.count() if rows is None else rows) * width <= limit


def hot_keys(
    facts: DataFrame,
    keys: Sequence[str],
    share: float = HOT_SHARE,
    sample: float = HOT_SAMPLE,
    seed: int = 42,
) -> list[tuple]:
    """Keys that hold at least ``share`` of the sampled rows: at most 1 / share tuples.

    The join below is exact for any list, so a sample is good enough here.
    """
    rows = facts.select(*keys).na.drop("any")
    if sample < 1:
        rows = rows.sample(sample, seed)
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_of_key"))
    total = rows.agg(F.count(F.lit(1))).scalar()
    hot = counts.filter(F.col("rows_of_key") >= total * share).select(*keys)
    return [tuple(r) for r in hot.collect()]


def _is_hot(keys: Sequence[str], hot: Sequence[tuple]) -> Column:
    any_null = reduce(or_, [F.isnull(k) for k in keys])
    if not hot:
        return any_null
    if len(keys) == 1:
        member = F.col(keys[0]).isin([k[0] for k in hot])
    else:
        member = reduce(or_, [reduce(and_, [F.col(k) == v for k, v in zip(keys, key)]) for key in hot])
    return any_null | F.coalesce(member, F.lit(False))


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    *,
    lookup_rows: int | None = None,
    broadcast_limit: int = BROADCAST_BYTES,
    hot: Sequence[tuple] | None = None,
) -> DataFrame:
    """Join facts with a lookup that is unique on ``keys``.

    * A lookup proven small is broadcast and the facts are not shuffled.
    * Otherwise the rows of hot keys, and rows with a NULL key, take a broadcast
      of just those few lookup rows and are not shuffled either. Only the
      remaining, balanced rows are shuffled. No row is dropped or replicated.

    The second way reads both sides more than once; that suits stored tables.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"lookup joins are left or inner, not {how!r}")
    keys = list(keys)
    if fits_broadcast(lookup, lookup_rows, broadcast_limit):
        return facts.join(F.broadcast(lookup), keys, how)
    found = hot_keys(facts, keys) if hot is None else list(hot)
    hot_flag = _is_hot(keys, found)
    # At most len(found) rows, since the lookup is unique on its keys.
    few = lookup.filter(hot_flag & reduce(and_, [F.col(k).isNotNull() for k in keys]))
    in_place = facts.filter(hot_flag).join(F.broadcast(few), keys, how)
    shuffled = facts.filter(~hot_flag).join(lookup.hint("shuffle_merge"), keys, how)
    return in_place.unionByName(shuffled)
