"""Exact grouped medians that no single group can overload."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tripfare.operators.durable import durable
from tripfare.operators.joins import fits_broadcast

_GROUP = ("grp", "measure")

# Where the sketch is asked for the ends of the bracket; its error is 1 in SKETCH_ACCURACY.
BRACKET = (0.498, 0.502)
SKETCH_ACCURACY = 1000
# Values inside a bracket that one task may count through.
INSIDE_VALUES = 1_000_000


def value_counts(frame: DataFrame, keys: Sequence[str], measures: Mapping[str, str]) -> DataFrame:
    """Rows per (group, measure, value); NULL is a value too, so no group is lost.

    Counts are combined before the shuffle and spread by value, so a hot group
    is split and copies collapse. Stored, as every step below reads them.
    """
    # A struct equals itself when a key inside it is NULL, in joins as well.
    group = F.struct(F.lit(True).alias("any"), *[F.col(k) for k in keys]).alias("grp")
    pairs = [
        F.struct(F.lit(name).alias("measure"), F.col(column).cast("double").alias("value"))
        for name, column in measures.items()
    ]
    values = frame.select(group, F.inline(F.array(*pairs)))
    return durable(values.groupBy(*_GROUP, "value").agg(F.count(F.lit(1)).alias("n")), "value-counts")


def rolled_up(counts: DataFrame) -> DataFrame:
    """The counts of all groups taken together, as one group without keys."""
    whole = F.struct(F.lit(True).alias("any")).alias("grp")
    return counts.groupBy("measure", "value").agg(F.sum("n").alias("n")).select(whole, "measure", "value", "n")


def medians_of(counts: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Lower median of each measure per key, from ``value_counts``.

    Values are put in order over the cluster: parts are ranges of (group,
    measure, value). Sums per part tell which part holds the middle row of each
    group, and only that part of the group is counted through. So a group of any
    size, in any range of values, is spread over many tasks.
    """
    ordered = counts.repartitionByRange(*_GROUP, "value").withColumn("part", F.spark_partition_id())
    ordered = durable(ordered, "ordered-values")
    real = F.col("value").isNotNull()

    group = Window.partitionBy(*_GROUP)
    upto = group.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = F.expr("(total + 1) div 2")
    chosen = (
        ordered.filter(real)
        .groupBy(*_GROUP, "part")
        .agg(F.sum("n").alias("size"))
        .withColumns({"upto": F.sum("size").over(upto), "total": F.sum("size").over(group)})
        .filter((F.col("upto") - F.col("size") < middle) & (middle <= F.col("upto")))
        .select(*_GROUP, "part", (middle - F.col("upto") + F.col("size")).alias("rank"))
    )
    running = group.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (
        ordered.filter(real)
        .join(chosen, [*_GROUP, "part"])
        .withColumn("upto", F.sum("n").over(running))
        .filter((F.col("upto") - F.col("n") < F.col("rank")) & (F.col("rank") <= F.col("upto")))
        .select(*_GROUP, "value")
    )
    # A group of NULLs only is kept by its NULLs.
    every = found.unionByName(ordered.filter(~real).select(*_GROUP, "value"))
    per_measure = [F.max(F.when(F.col("measure") == name, F.col("value"))).alias(name) for name in measures]
    return every.groupBy("grp").agg(*per_measure).select(*[F.col(f"grp.{k}").alias(k) for k in keys], *measures)


def _bracketed(frame: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Per group and measure: rows with a value, how many of them are numbers, and a bracket of the median.

    A sketch of each group, combined before the shuffle, gives the bracket. It
    is a guess: what it leaves out is counted, and checked against the rank.
    """
    sketched = []
    for name in names:
        number = F.when(~F.isnan(name), F.col(name))
        sketched += [
            F.count(name).alias(f"{name}_n"),
            F.count(number).alias(f"{name}_numbers"),
            F.percentile_approx(number, list(BRACKET), SKETCH_ACCURACY).alias(f"{name}_bracket"),
        ]
    rows = frame.groupBy(*keys).agg(*sketched)
    ends = [F.col(f"{n}_bracket")[i].alias(f"{n}_{end}") for n in names for i, end in enumerate(("low", "high"))]
    return rows.select(*keys, *[f"{n}_{c}" for n in names for c in ("n", "numbers")], *ends)


def _beside(frame: DataFrame, lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each row with the one row of its group; a NULL key is a key like others."""
    if not keys:
        row = lookup.first()
        return frame.withColumns({f.name: F.lit(row[f.name] if row else None).cast(f.dataType) for f in lookup.schema.fields})
    renamed = lookup.withColumnsRenamed({k: f"group_{k}" for k in keys})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"group_{k}")) for k in keys])
    few = F.broadcast(renamed) if fits_broadcast(lookup) else renamed
    return frame.join(few, same).drop(*[f"group_{k}" for k in keys])


def _inside(frame: DataFrame, brackets: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Rows per value inside the bracket of its group; all values below it are one, NULL."""
    slots = [
        F.struct(
            F.lit(name).alias("measure"),
            F.when(F.col(name) >= F.col(f"{name}_low"), F.col(name)).alias("value"),
            (F.col(name) <= F.col(f"{name}_high")).alias("upto_high"),
            F.col(f"{name}_n").alias("n"),
            F.col(f"{name}_numbers").alias("numbers"),
        )
        for name in names
    ]
    values = _beside(frame, brackets, keys).select(*keys, F.inline(F.array(*slots))).filter("upto_high")
    return values.groupBy(*keys, "measure", "value", "n", "numbers").agg(F.count(F.lit(1)).alias("size"))


def grouped_medians(frame: DataFrame, keys: Sequence[str], measures: Mapping[str, str]) -> DataFrame:
    """Lower median of each measure per key: ``measures`` maps output name → column.

    This is the value ``percentile_disc(0.5)`` returns, NULLs ignored and NaN
    the largest; a group without values has a NULL median.

    Two passes over the stored columns: a sketch brackets the median of each
    group, then what lies below is counted and only values inside are kept, some
    thousandths of a large group. The median is the value that brings the count
    to the middle rank. A group whose bracket misses it, or holds more than
    ``INSIDE_VALUES`` values, is counted through in full.
    """
    names = list(measures)
    columns = [F.col(column).cast("double").alias(name) for name, column in measures.items()]
    stored = durable(frame.select(*keys, *columns), "values")
    brackets = durable(_bracketed(stored, keys, names), "brackets")
    group = Window.partitionBy(*keys, "measure")
    upto = group.orderBy(F.asc_nulls_first("value")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = F.expr("(n + 1) div 2")
    counted = _inside(stored, brackets, keys, names).withColumns({"upto": F.sum("size").over(upto), "distinct": F.count("value").over(group)})
    hit = (F.col("upto") >= middle) & (F.col("upto") - F.col("size") < middle) & F.col("value").isNotNull()
    found = counted.filter(hit & (F.col("distinct") <= INSIDE_VALUES)).select(*keys, "measure", "value")
    # Every group is kept, and told what to expect: NaN beyond its numbers, or a value.
    expected = [
        F.struct(
            F.lit(name).alias("measure"),
            F.when((F.col(f"{name}_n") + 1) / 2 >= F.col(f"{name}_numbers") + 1, F.lit(float("nan"))).alias("value"),
            (F.col(f"{name}_n") > 0).alias("some"),
        )
        for name in names
    ]
    every = brackets.select(*keys, F.inline(F.array(*expected))).unionByName(found.withColumn("some", F.lit(False)))
    per_measure = [F.max(F.when(F.col("measure") == name, F.col("value"))).alias(name) for name in names]
    missed = [
        F.bool_or((F.col("measure") == name) & F.col("some")) & (F.count(F.when(F.col("measure") == name, F.col("value"))) == 0) for name in names
    ]
    medians = durable(every.groupBy(*keys).agg(*per_measure, reduce(or_, missed).alias("missed")), "medians")
    rest = medians.filter("missed").select(*keys, F.lit(True).alias("missed"))
    if rest.isEmpty():
        return medians.drop("missed")
    again = value_counts(_beside(stored, rest, keys), keys, {name: name for name in names})
    return medians.filter(~F.col("missed")).drop("missed").unionByName(medians_of(again, keys, names))
