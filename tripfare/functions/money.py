"""Sums and means of money that do not depend on the order of addition.

A double is rounded once, to whole millionths, and those are added as integers:
whole units and the millionths left over, apart, so that neither sum overflows
before nine quintillion units or nine trillion rows.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MILLIONTHS = 1_000_000


def whole_and_rest(amount: Column) -> tuple[Column, Column]:
    """Whole units of an amount and its millionths; NULL stays NULL, NaN is an error."""
    millionths = F.rint(amount * MILLIONTHS).cast("bigint")
    return F.call_function("div", millionths, F.lit(MILLIONTHS)), millionths % MILLIONTHS


def exact_sums(amount: Column, name: str) -> list[Column]:
    """Aggregates ``{name}_whole`` and ``{name}_rest``, which add up further by ``summed``."""
    whole, rest = whole_and_rest(amount)
    return [F.sum(whole).alias(f"{name}_whole"), F.sum(rest).alias(f"{name}_rest")]


def summed(name: str) -> list[Column]:
    return [F.sum(f"{name}_{part}").alias(f"{name}_{part}") for part in ("whole", "rest")]


def _millionths(name: str) -> Column:
    whole, rest = (F.col(f"{name}_{part}").cast("decimal(20,0)") for part in ("whole", "rest"))
    return whole * F.lit(MILLIONTHS).cast("decimal(7,0)") + rest


def total(name: str) -> Column:
    """The sum as a double."""
    return _millionths(name).cast("double") / MILLIONTHS


def mean(name: str, count: str) -> Column:
    """The mean as a double: equal sums over equal counts give equal means."""
    return _millionths(name).cast("double") / (F.col(count).cast("double") * MILLIONTHS)


def exact_mean(name: str, count: str) -> Column:
    """The mean in millionths as a decimal, to rank by: equal true means are equal."""
    return _millionths(name) / F.col(count).cast("decimal(20,0)")
