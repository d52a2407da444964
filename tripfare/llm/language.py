"""Language of documents: known words first, then ever shorter character n-grams."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tripfare.llm import arrays
from tripfare.llm.tables import bound_batches
from tripfare.operators.durable import durable

_U = np.uint64
# Characters that are worked on at a time (a longer text is a slice of its own).
SLICE_CHARS = 1 << 18
UNDETERMINED = "und"


@dataclass(frozen=True)
class LanguageSettings:
    """What the model learns from: about ``sample`` labelled documents of about ``sample_chars`` characters in all.

    This bounds the model, which keeps every word and n-gram of the sample.
    """

    sample: int = 5_000
    sample_chars: int = 15_000_000
    orders: tuple[int, ...] = (4, 3, 2, 1)
    smoothing: float = 0.5
    sharpness: float = 0.25


@lru_cache(maxsize=1)
def _not_letters() -> np.ndarray:
    return np.array([not chr(i).isalpha() for i in range(0x110000)])


def _slices(column: pa.Array):
    """Lower-cased texts as code points: first row, offsets, sums for hashing, words."""
    texts: list[str] = []
    low = held = 0

    def ready():
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        offsets = np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)
        starts, stops, first = arrays.words(codes, offsets, _not_letters())
        return low, len(texts), arrays.prefix_sums(arrays.mix(codes.astype(_U) + _U(1))), starts, stops, first

    for text in column:
        lower = (text.as_py() or "").lower()
        if texts and held + len(lower) > SLICE_CHARS:
            yield ready()
            low, held = low + len(texts), 0
            texts.clear()
        texts.append(lower)
        held += len(lower)
    if texts:
        yield ready()


def _inner(starts: np.ndarray, stops: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Start of each n-gram of each word, and the word it is in."""
    count = np.maximum(0, stops - starts - n + 1)
    owner = np.repeat(np.arange(len(starts)), count)
    return starts[owner] + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count), owner


def _counts(orders: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), dtype=object)
            for low, n, sums, starts, stops, first in _slices(batch.column(0)):
                of_text = langs[low : low + n]
                owner = np.repeat(np.arange(n), np.diff(first))
                word = arrays.summed_spans(sums, starts, stops)
                for lang in sorted(set(of_text)):
                    mine = np.flatnonzero(of_text[owner] == lang) if len(owner) else np.zeros(0, np.int64)
                    kinds, at, times = np.unique(word[mine], return_index=True, return_counts=True)
                    found = [(0, kinds, times)]
                    a, b = starts[mine][at], stops[mine][at]
                    for order in orders:
                        p, which = _inner(a, b, order)
                        gram, inverse = np.unique(arrays.summed_spans(sums, p, p + order, order), return_inverse=True)
                        found.append((order, gram, np.bincount(inverse, weights=times[which], minlength=len(gram)).astype(np.int64)))
                    for order, keys, count in found:
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(keys), order, np.int32)),
                                pa.array([lang] * len(keys), pa.string()),
                                pa.array(arrays.signed(keys)),
                                pa.array(count.astype(np.int64)),
                            ],
                            ["order", "lang", "key", "n"],
                        )

    return run


class _Weights(NamedTuple):
    """Log frequencies of the keys of one order.

    Only the languages that a key occurs in are listed, by how far it lies above
    ``absent``, the log frequency of a key that a language doesn't have.
    """

    index: arrays.HashIndex
    first: np.ndarray
    lang: np.ndarray
    above: np.ndarray
    absent: np.ndarray


class LanguageModel:
    """Log frequency of words and n-grams per language."""

    def __init__(self, table_of: Callable[[int], pa.Table], totals: dict[tuple[int, str], int], settings: LanguageSettings):
        self.langs = sorted({lang for _, lang in totals})
        self.orders = settings.orders
        self.sharpness = settings.sharpness
        place = {lang: i for i, lang in enumerate(self.langs)}
        a, self.weights = settings.smoothing, {}
        for order in (0, *self.orders):
            table = table_of(order)
            mine = table.column("lang").combine_chunks().dictionary_encode()
            lang = np.array([place[x] for x in mine.dictionary.to_pylist()], np.int64)[mine.indices.to_numpy()]
            key, n = (table.column(c).to_numpy() for c in ("key", "n"))
            sort = np.lexsort((lang, key))
            keys, first = np.unique(key[sort], return_index=True)
            total = np.array([totals.get((order, lang), 0) for lang in self.langs], float) + a * (len(keys) + 1)
            above = np.log((n[sort] + a) / a)
            self.weights[order] = _Weights(
                arrays.HashIndex(keys.astype(np.int64).view(_U)), np.r_[first, len(sort)], lang[sort].astype(np.int32), above.astype(np.float32), np.log(a / total)
            )

    def scores(self, n: int, sums, starts, stops, first) -> np.ndarray:
        """Log score of every text for every language."""
        owner = np.repeat(np.arange(n), np.diff(first))
        total = np.zeros((n, len(self.langs)))
        cells = total.reshape(-1)

        def add(order: int, texts: np.ndarray, found: np.ndarray, share: np.ndarray) -> None:
            w = self.weights[order]
            total[:] += np.bincount(texts, weights=share, minlength=n)[:, None] * w.absent
            low, count = w.first[found], w.first[found + 1] - w.first[found]
            at = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
            values = w.above[at] * np.repeat(share, count)
            cells[:] += np.bincount(np.repeat(texts, count) * len(self.langs) + w.lang[at], weights=values, minlength=len(cells))

        found = self.weights[0].index.find(arrays.summed_spans(sums, starts, stops))
        known = found >= 0
        add(0, owner[known], found[known], np.ones(int(known.sum())))
        left = np.flatnonzero(~known)
        for order in self.orders:
            if not len(left):
                break
            p, which = _inner(starts[left], stops[left], order)
            at = self.weights[order].index.find(arrays.summed_spans(sums, p, p + order, order))
            hit = at >= 0
            times = np.bincount(which[hit], minlength=len(left))
            # A word counts once: the mean over its known n-grams.
            add(order, owner[left][which[hit]], at[hit], 1 / times[which[hit]])
            left = left[times == 0]
        return total

    def predict(self, batches: Iterator[pa.RecordBatch], no_language: str) -> Iterator[pa.RecordBatch]:
        """Best language of every text; ``no_language`` if none is known, ``und`` without letters."""
        names = np.array(self.langs, dtype=object)
        for batch in batches:
            for low, n, sums, starts, stops, first in _slices(batch.column(1)):
                worded = np.diff(first) > 0
                lang, score = np.full(n, UNDETERMINED, dtype=object), np.zeros(n)
                if not len(names):
                    lang[worded] = no_language
                else:
                    total = self.scores(n, sums, starts, stops, first) * self.sharpness
                    best = total.argmax(axis=1)
                    chance = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                    lang[worded], score[worded] = names[best[worded]], chance[worded]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, n), pa.array(lang, pa.string()), pa.array(score)], [batch.schema.names[0], "lang_pred", "score"]
                )


def remainder(divisor: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def fit_language(docs: DataFrame, learn_from: Column, settings: LanguageSettings = LanguageSettings()) -> LanguageModel:
    """Count the words and n-grams of a sample of labelled texts.

    All labelled documents are counted first; each is then drawn by a hash of
    its id and text, with the chance that makes ``settings.sample`` of them and
    ``settings.sample_chars`` of their characters.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    labelled = texts.filter("lang is not null and text is not null and doc_id is not null").filter(F.coalesce(learn_from, F.lit(False)))
    rows, chars = labelled.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.char_length("text")), F.lit(0))).first()
    share = min(1.0, settings.sample / max(1, rows), settings.sample_chars / max(1, chars))
    drawn = labelled.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < int(share * (1 << 30)))
    counted = drawn.select("text", "lang").mapInArrow(_counts(settings.orders), "order int, lang string, key long, n long")
    counts = durable(counted.groupBy("order", "lang", "key").agg(F.sum("n").alias("n")), "language-counts")
    totals = {(r["order"], r["lang"]): r["n"] for r in counts.groupBy("order", "lang").agg(F.sum("n").alias("n")).collect()}
    # One order at a time: what comes to the driver is bounded by the sample.
    return LanguageModel(lambda order: counts.filter(F.col("order") == order).select("lang", "key", "n").toArrow(), totals, settings)


def language_id(docs: DataFrame, learn_from: Column | None = None, settings: LanguageSettings = LanguageSettings()) -> DataFrame:
    """Predict the language of every whole text: (doc_id, lang_pred, score).

    ``docs`` has doc_id, text and lang; lang is read to learn only, from rows where
    ``learn_from`` holds. Known words are scored by their log frequency per
    language; a word that isn't known, by the mean of its known n-grams of the
    longest order that has any. ``score`` is the share of the best language when
    the scores, flattened by ``sharpness``, are taken as log odds; ties go to the
    first language by name.

    A NULL text, or one without letters, is ``und`` with score 0; so is every
    text if nothing is labelled. Rows without lang or id teach nothing. Repeated
    rows are scored each; other columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _predicted(docs, texts, learn_from, settings, UNDETERMINED)


def in_a_language(docs: DataFrame, settings: LanguageSettings = LanguageSettings()) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is in one of the languages it is labelled with.

    Texts that are NULL or without letters go. If nothing is labelled, no
    language is told from another, and all texts with a letter stay.
    """
    line = F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns]).alias("line")
    whole = docs.select(line, F.col("text").cast("string").alias("text"))
    return _predicted(docs, whole, None, settings, "any").filter(F.col("lang_pred") != UNDETERMINED).select("line.*")


def _predicted(docs: DataFrame, rows: DataFrame, learn_from: Column | None, settings: LanguageSettings, no_language: str) -> DataFrame:
    """The first column of ``rows`` with the language of the second, a text."""
    bound_batches(docs.sparkSession)
    model = fit_language(docs, F.lit(True) if learn_from is None else learn_from, settings)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([rows.schema.fields[0], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(lambda batches: sent.value.predict(batches, no_language), schema)
