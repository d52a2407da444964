"""Benchmark passages in documents, found by winnowing. DataFrame functions only."""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tripfare.operators.durable import durable

# Fixed value: what stands between words once A-Z are lower case.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM_WORDS = 4
# A side of a join is sent to every executor up to this many rows and bytes (as
# JSON); beyond it both sides are shuffled.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20


def words_of(text: Column) -> Column:
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lower, BETWEEN_WORDS), "")


def _places(count: Column) -> Column:
    """1 .. count, or nothing."""
    return F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.expr("cast(array() as array<int>)"))


def _grams(words: str, k: int) -> Column:
    """Hash of the ``k`` words from each place on."""
    return F.transform(_places(F.size(words) - (k - 1)), lambda i: F.xxhash64(F.lit(k), *[F.element_at(words, i + j) for j in range(k)]))


def _least(grams: str, width: int) -> Column:
    """Winnowing: the least hash in each window of ``width`` k-grams."""
    if width == 1:
        return F.col(grams)
    return F.transform(_places(F.size(grams) - (width - 1)), lambda i: F.array_min(F.slice(grams, i, width)))


def _small(frame: DataFrame) -> DataFrame:
    """A stored table, marked for broadcast if its rows, which may hold lists and words of any length, are few and short."""
    if frame.count() > BROADCAST_ROWS:
        return frame
    if all(isinstance(f.dataType, (T.LongType, T.BooleanType)) for f in frame.schema.fields):
        return F.broadcast(frame)
    size = frame.agg(F.sum(F.octet_length(F.to_json(F.struct(*frame.columns))))).first()[0] or 0
    return F.broadcast(frame) if size <= BROADCAST_BYTES else frame


def _windows(items: DataFrame, length: int, k: int, whole: bool) -> DataFrame:
    """(hash, gram_at, item_id, window): each window, its fingerprint, and where in it that gram stands."""
    size = F.size("item_words")
    chosen = items.filter(size == length if whole else size >= length).withColumn("grams", _grams("item_words", k))
    at = chosen.select("item_id", "item_words", "grams", F.explode(_places(size - (length - 1))).alias("s"))
    inner = at.select("item_id", F.slice("item_words", F.col("s"), length).alias("window"), F.slice("grams", F.col("s"), length - k + 1).alias("g"))
    found = inner.select("item_id", "window", F.array_min("g").alias("hash"), F.posexplode("g").alias("gram_at", "gram"))
    return found.filter("gram = hash").select("hash", "gram_at", "item_id", "window").distinct()


def decontamination(docs: DataFrame, benchmark: DataFrame, length: int = 10) -> DataFrame:
    """Words of documents that lie in ``length`` consecutive words of a benchmark item.

    Returns (doc_id, n_words, n_hit, n_items, items, items_sha256, contaminated,
    text_hash), ``items`` being the item_ids whose windows occur, as sorted strings.

    Winnowing: the least 4-gram hash of every ``length``-word window is its
    fingerprint, so equal windows have equal fingerprints and no shared span of
    ``length`` words is missed. Fingerprints of documents and items are joined;
    each hit is then extended to the windows around it and compared word by
    word. An item with fewer words is one window and its own fingerprint.

    NULL texts have no words. Items without id or words take no part. Rows that
    repeat both id and text are returned once; rows without id are judged like
    others. Other columns are ignored; an empty table gives no rows.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("item_words"))
    items = durable(items.filter("item_id is not null and size(item_words) > 0"), "items")
    # At most length - 1 numbers.
    short = [r[0] for r in items.filter(F.size("item_words") < length).select(F.size("item_words")).distinct().collect()]
    kinds = {n: n for n in sorted(short)} | {length: min(GRAM_WORDS, length)}
    windows = {n: durable(_windows(items, n, k, n < length), "item-windows") for n, k in kinds.items()}

    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("key"), F.col("text").cast("string").alias("text")
    )
    worded = texts.select("doc_id", "key", words_of(F.col("text")).alias("words"))
    grams = worded.select("*", *[_grams("words", k).alias(f"grams_{n}") for n, k in kinds.items()])
    prints = [_least(f"grams_{n}", n - k + 1) for n, k in kinds.items()]
    # The NULL stands for the document itself, so that one without hits is kept.
    marks = F.concat(F.expr("array(cast(null as bigint))"), F.array_distinct(F.concat(*prints)))
    spread = grams.select("doc_id", "key", F.size("words").cast("long").alias("n_words"), F.explode(marks).alias("hash"))
    known = durable(reduce(DataFrame.unionByName, [w.select("hash") for w in windows.values()]).distinct(), "item-prints")
    hits = spread.join(_small(known.withColumn("known", F.lit(True))), "hash", "left").filter("hash is null or known")
    met = durable(hits.groupBy("doc_id", "key", "n_words").agg(F.collect_set("hash").alias("met")), "met")

    suspects = durable(met.filter("size(met) > 0").select(F.col("doc_id").alias("id"), F.col("key").alias("k"), "met"), "suspects")
    again = texts.join(_small(suspects), F.col("key").eqNullSafe(F.col("k")) & F.col("doc_id").eqNullSafe(F.col("id")))
    again = again.select("doc_id", "key", "met", words_of(F.col("text")).alias("words"))
    found = []
    for n, k in kinds.items():
        placed = again.withColumn("grams", _grams("words", k)).select(
            "doc_id", "key", "words", "met", F.transform("grams", lambda g, i: F.struct(i.alias("p"), g.alias("hash"))).alias("grams")
        )
        extended = placed.select(
            "doc_id", "key", "words", F.inline(F.filter("grams", lambda x: F.array_contains("met", x["hash"])))
        ).join(_small(windows[n]), "hash")
        first = F.col("p") - F.col("gram_at") + 1
        inside = (first >= 1) & (first + (n - 1) <= F.size("words"))
        same = extended.filter(inside).filter(F.slice("words", first, n) == F.col("window"))
        found.append(same.select("doc_id", "key", "item_id", F.sequence(first, first + (n - 1)).alias("places")))
    covered = (
        reduce(DataFrame.unionByName, found)
        .groupBy(F.col("doc_id").alias("id"), F.col("key").alias("k"))
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_set("places")))).cast("long").alias("n_hit"),
            F.array_sort(F.collect_set("item_id")).alias("items"),
        )
    )
    joined = met.join(covered, F.col("key").eqNullSafe(F.col("k")) & F.col("doc_id").eqNullSafe(F.col("id")), "left")
    names = F.coalesce("items", F.expr("cast(array() as array<string>)"))
    hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size(names).cast("long").alias("n_items"),
        names.alias("items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
        F.col("key").alias("text_hash"),
    )
