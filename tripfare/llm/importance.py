"""Documents drawn by how much more likely their phrases are in a target set."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tripfare.llm import arrays
from tripfare.llm.checksums import crc32_spans, joined
from tripfare.llm.tables import bound_batches
from tripfare.operators.durable import durable

_U = np.uint64

# Words in the head are told apart by their bytes in two 64-bit numbers.
HEAD_BYTES = 16
# Words that are worked on at a time, whatever the length of a text.
CHUNK_WORDS = 1 << 18

# Bytes that are no word once A-Z are lower case.
SEPARATORS = np.ones(256, dtype=bool)
SEPARATORS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

_SPACE = crc32_spans(np.array([32], np.uint8), np.array([0]), np.array([1]))
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=_U)


@dataclass(frozen=True)
class Resampling:
    """Features are runs of up to three words, dealt into ``buckets`` by their CRC-32.

    The head holds at most ``head_words`` words of up to 16 bytes and
    ``head_pairs`` pairs of them, chosen by their counts in batches where they
    occur ``head_at_least`` times. It decides how a CRC is found, never its value.
    """

    buckets: int = 10_000
    percent: int = 5
    min_words: int = 20
    seed: int = 42
    head_words: int = 1 << 16
    head_pairs: int = 1 << 16
    head_at_least: int = 8


class Head(NamedTuple):
    """Frequent words by their bytes, and frequent pairs by their places among the words."""

    low: np.ndarray
    high: np.ndarray
    word_crc: np.ndarray
    pair: np.ndarray
    pair_crc: np.ndarray
    pair_bucket: np.ndarray


class Words(NamedTuple):
    """Words of some texts in lower case; ``first`` is the first word of each text."""

    data: np.ndarray
    starts: np.ndarray
    stops: np.ndarray
    first: np.ndarray


def _words(data: np.ndarray, offsets: np.ndarray) -> Words:
    return Words(arrays.LOWER[data], *arrays.words(data, offsets, SEPARATORS))


def _numbers(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of each word of up to 16 bytes as two numbers; no word holds byte 0."""
    padded = np.r_[data, np.zeros(HEAD_BYTES, np.uint8)]
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)
    low = eight[starts].view("<u8").reshape(-1) & _MASK[np.minimum(sizes, 8)]
    high = eight[starts + 8].view("<u8").reshape(-1) & _MASK[np.clip(sizes - 8, 0, 8)]
    return low, high


def _mixed(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return arrays.mix(low ^ arrays.mix(high + _U(0x9E3779B97F4A7C15)))


def _frequent(at_least: int):
    names = ["low", "high", "next_low", "next_high", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            for _, _, data, offsets in arrays.slices(batch.column(1)):
                words = _words(data, offsets)
                sizes = words.stops - words.starts
                low, high = _numbers(words.data, words.starts, sizes)
                short = sizes <= HEAD_BYTES
                pair = short[:-1] & short[1:]
                pair[words.first[1:-1][(words.first[1:-1] > 0) & (words.first[1:-1] < len(sizes))] - 1] = False
                none = np.zeros(int(short.sum()), _U)
                found.append((low[short], high[short], none, none))
                found.append((low[:-1][pair], high[:-1][pair], low[1:][pair], high[1:][pair]))
            keys = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, _U)] * 4
            _, where, n = np.unique(_mixed(_mixed(keys[0], keys[1]), _mixed(keys[2], keys[3])), return_index=True, return_counts=True)
            often = n >= at_least
            columns = [arrays.signed(k[where[often]]) for k in keys] + [n[often].astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return run


def learn_head(texts: DataFrame, settings: Resampling) -> Head:
    """The most frequent words and pairs of ``texts`` (id, text); their number is bounded."""
    schema = "low long, high long, next_low long, next_high long, n long"
    counted = texts.mapInArrow(_frequent(settings.head_at_least), schema)
    keys = ["low", "high", "next_low", "next_high"]
    counted = durable(counted.groupBy(*keys).agg(F.sum("n").alias("n")), "frequent")

    def most(rows: DataFrame, limit: int) -> list[np.ndarray]:
        table = rows.orderBy(F.desc("n"), *keys).limit(limit).select(*keys).toArrow()
        return [table.column(k).to_numpy().view(_U) for k in keys]

    low, high, _, _ = most(counted.filter("next_low = 0"), settings.head_words)
    raw = np.stack([low, high], axis=1).astype("<u8").view(np.uint8)
    sizes = (raw != 0).sum(axis=1).astype(np.int64)
    starts = np.arange(len(low)) * HEAD_BYTES
    word_crc = crc32_spans(raw.reshape(-1), starts, starts + sizes)

    pairs = most(counted.filter("next_low <> 0"), settings.head_pairs)
    index = arrays.HashIndex(_mixed(low, high))
    a, b = (_place(index, low, high, *k) for k in (pairs[:2], pairs[2:]))
    a, b = a[(a >= 0) & (b >= 0)], b[(a >= 0) & (b >= 0)]
    spaced = joined(np.broadcast_to(_SPACE, len(b)), word_crc[b], sizes[b])
    pair_crc = joined(word_crc[a], spaced, sizes[b] + 1)
    return Head(low, high, word_crc, a.astype(_U) << _U(32) | b.astype(_U), pair_crc, (pair_crc % settings.buckets).astype(np.int64))


def _place(index: arrays.HashIndex, heads_low, heads_high, low, high) -> np.ndarray:
    """Place of each word in the head, or -1; compared by all its bytes."""
    found = index.find(_mixed(low, high))
    if not len(heads_low):
        return found
    same = (found >= 0) & (heads_low[found] == low) & (heads_high[found] == high)
    return np.where(same, found, -1)


class Features:
    """Buckets of the features of words, with the head at hand."""

    def __init__(self, head: Head, buckets: int):
        self.head, self.buckets = head, buckets
        self.words = arrays.HashIndex(_mixed(head.low, head.high))
        self.pairs = arrays.HashIndex(arrays.mix(head.pair))

    def of(self, words: Words) -> Iterator[tuple[int, int, list[np.ndarray], list[np.ndarray]]]:
        """Ranges of words: for runs of 1, 2 and 3 from each of them on, the bucket, and whether its text goes on so far."""
        n = len(words.starts)
        last = np.repeat(words.first[1:], np.diff(words.first))
        for low in range(0, n, CHUNK_WORDS):
            high, reach = min(n, low + CHUNK_WORDS), min(n, low + CHUNK_WORDS + 2)
            found = self._buckets(words.data, words.starts[low:reach], words.stops[low:reach])
            at = np.arange(low, high)
            inside = [at + k < last[low:high] for k in range(3)]
            yield low, high, [np.r_[b, np.zeros(2, np.int64)][: high - low] for b in found], inside

    def _buckets(self, data, starts, stops) -> list[np.ndarray]:
        head, sizes = self.head, stops - starts
        place = _place(self.words, head.low, head.high, *_numbers(data, starts, sizes))
        place[sizes > HEAD_BYTES] = -1
        tail = np.flatnonzero(place < 0)
        crc = head.word_crc[place] if len(head.word_crc) else np.zeros(len(place), np.uint32)
        crc[tail] = crc32_spans(data, starts[tail], stops[tail])
        spaced = joined(np.broadcast_to(_SPACE, len(crc)), crc, sizes)

        key = np.where((place[:-1] >= 0) & (place[1:] >= 0), place[:-1].astype(_U) << _U(32) | place[1:].astype(_U), ~_U(0))
        known = self.pairs.find(arrays.mix(key))
        tail = np.flatnonzero(known < 0)
        pair = head.pair_crc[known] if len(head.pair_crc) else np.zeros(len(known), np.uint32)
        pair_bucket = head.pair_bucket[known] if len(head.pair_crc) else np.zeros(len(known), np.int64)
        pair[tail] = joined(crc[:-1][tail], spaced[1:][tail], sizes[1:][tail] + 1)
        pair_bucket[tail] = pair[tail] % self.buckets
        triple = joined(pair[:-1], spaced[2:], sizes[2:] + 1)
        return [(crc % self.buckets).astype(np.int64), pair_bucket, (triple % self.buckets).astype(np.int64)]


def _totals(head, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(head.value, buckets)
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, data, offsets in arrays.slices(batch.column(1)):
                for _, _, found, inside in features.of(_words(data, offsets)):
                    for bucket, there in zip(found, inside):
                        total += np.bincount(bucket[there], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    return run


def bucket_totals(texts: DataFrame, head, buckets: int) -> DataFrame:
    """(bucket, n): features of all ``texts`` per bucket. A task sends one row per bucket."""
    counted = texts.mapInArrow(_totals(head, buckets), "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def _weighed(head, gains, buckets: int):
    names = ["doc_id", "text_hash", "n_words", "n_features", "weight"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(head.value, buckets)
        gain = gains.value
        for batch in batches:
            n_words, weight = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for row, end, data, offsets in arrays.slices(batch.column(1)):
                words = _words(data, offsets)
                n_words[row:end] = np.diff(words.first)
                for low, high, found, inside in features.of(words):
                    worth = sum(np.where(there, gain[bucket], 0) for bucket, there in zip(found, inside))
                    edge = np.clip(words.first, low, high) - low
                    weight[row:end] += np.diff(np.r_[0, np.cumsum(worth)][edge])
            n_features = sum(np.maximum(n_words - k, 0) for k in range(3))
            columns = [batch.column(0), batch.column(2), *map(pa.array, (n_words, n_features, weight))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _gumbel(doc_id: Column, seed: int) -> Column:
    """A draw that depends on the id alone, in thousandths."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h.cast("double") + 0.5) / 4294967296.0)))


def drawn(scored: DataFrame, percent: int, min_words: int) -> DataFrame:
    """``rank`` of the highest scores of documents with ``min_words``: 1 to floor(percent * N / 100).

    Rows are dealt by ranges of the order and numbered within them, so no task
    sees them all; rows that are equal in everything are told apart by a number
    that is stored with them.
    """
    rows = durable(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    may = (F.col("n_words") >= min_words) & F.col("score").isNotNull()
    order = [F.desc("score"), F.asc("doc_id"), F.asc("text_hash"), F.asc("row")]
    rest = rows.filter(~may).withColumn("rank", F.lit(None).cast("long"))
    dealt = rows.filter(may).repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    dealt = durable(dealt, "score-ranges")
    # One row per range.
    sizes = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    before = F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    places = sizes.select("part", before.alias("before"))
    take = percent * dealt.count() // 100
    at = F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy(*order))
    numbered = dealt.join(F.broadcast(places), "part").withColumn("at", at)
    ranked = numbered.withColumn("rank", F.when(F.col("at") <= take, F.col("at")))
    return ranked.select(rest.columns).unionByName(rest).drop("row")


def importance_resampling(docs: DataFrame, target: DataFrame, settings: Resampling = Resampling()) -> DataFrame:
    """Weigh every document by its features and draw the highest of randomly raised scores.

    Returns (doc_id, n_words, n_features, weight, score, rank, text_hash) for
    every row of ``docs``. Features are all runs of 1 to 3 consecutive words; a
    bucket's gain compares its share in ``target`` with its share in ``docs``.
    ``weight`` is the sum of gains, ``score`` adds a Gumbel draw made from the id.
    Of the N documents with ``min_words`` words, floor(percent * N / 100) have a rank.

    A CRC-32 is looked up for frequent words and pairs, which every executor
    holds (a fixed number of both), and computed from the bytes for others; both
    are exact, and totals cover all documents. Besides them only the gains, one
    number per bucket, are sent to all.

    NULL, empty and wordless texts have no features and weight 0. A row without
    id counts in the totals but has no score and is not drawn. Rows that share
    an id share its draw; each is scored by its own text, and equal scores are
    ordered by text hash. Other columns are ignored; an empty ``docs`` gives no
    rows, an empty ``target`` counts 0 in every bucket.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    text = F.col("text").cast("string")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    items = target.select(F.lit(0).alias("item"), text.alias("text"))

    head = spark.sparkContext.broadcast(learn_head(texts.select("doc_id", "text"), settings))
    totals = [durable(bucket_totals(t, head, settings.buckets), "buckets") for t in (texts.select("doc_id", "text"), items)]
    all_s, all_t = (t.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] for t in totals)
    s, t = (t.withColumnRenamed("n", name) for t, name in zip(totals, "st"))
    double = lambda c, more: F.coalesce(F.col(c), F.lit(0)).cast("double") + more
    share = double("t", 1.0) * (float(all_s) + settings.buckets) / (double("s", 1.0) * (float(all_t) + settings.buckets))
    buckets = spark.range(settings.buckets).withColumnRenamed("id", "bucket").join(s, "bucket", "left").join(t, "bucket", "left")
    table = buckets.select("bucket", F.floor(1000 * F.log(share)).alias("gain")).orderBy("bucket").toArrow()
    gains = spark.sparkContext.broadcast(table.column("gain").to_numpy())

    schema = "doc_id long, text_hash long, n_words long, n_features long, weight long"
    weighed = texts.mapInArrow(_weighed(head, gains, settings.buckets), schema)
    scored = weighed.withColumn("score", F.col("weight") + _gumbel(F.col("doc_id"), settings.seed))
    columns = ["doc_id", "n_words", "n_features", "weight", "score", "rank", "text_hash"]
    return drawn(scored, settings.percent, settings.min_words).select(*columns)
