"""Rates at which documents are taken so that domains reach target shares of the tokens."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tripfare.llm import arrays
from tripfare.llm.gradients import averaged
from tripfare.llm.tables import bound_batches
from tripfare.operators.durable import durable

_U = np.uint64

DOMAINS = ("good", "poor", "toxic")
TARGETS = {"good": 0.92, "poor": 0.08, "toxic": 0.0}
BATCH = 128
POSTERIORS = "doc_id long, n_tokens long, " + ", ".join(f"p_{d} double" for d in DOMAINS) + ", text_hash long"


@dataclass(frozen=True)
class MixingSettings:
    """The classifier learns from about ``sample`` labelled documents, drawn by a hash of their id."""

    sample: int = 20_000
    buckets: int = 1 << 15
    rounds: int = 4
    steps: int = 30  # of a task in a round, at least
    step: float = 0.1
    decay: float = 1e-4
    iterations: int = 25
    tolerance: float = 1e-4


def domain_of(quality, toxic):
    """A label row's domain; NULL where it says neither."""
    return F.when(toxic == 1, 2).when(quality == 1, 0).when(quality == 0, 1)


def _features(column: pa.Array, buckets: int):
    """Row range, number of words, and the distinct feature buckets of each text.

    Features are the words, their last two bytes, and in tenths how many words
    repeat the one before and how many end in a mark.
    """
    marks = np.ones(256, bool)
    marks[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
    for low, high, data, offsets in arrays.slices(column):
        starts, stops, first = arrays.words(data, offsets)
        n, size = high - low, np.diff(first)
        word = arrays.span_hashes(data, starts, stops, lower=True)
        tail = arrays.span_hashes(data, np.maximum(starts, stops - 2), stops, lower=True, salt=1)
        owner = np.repeat(np.arange(n), size)
        again = np.r_[False, (word[1:] == word[:-1]) & (owner[1:] == owner[:-1])] if len(word) else np.zeros(0, bool)
        marked = marks[data[stops - 1]] if len(word) else np.zeros(0, bool)
        shares = [np.bincount(owner, weights=x, minlength=n) * 10 // np.maximum(size, 1) for x in (again, marked)]
        extra = [arrays.mix(s.astype(_U) + _U(100 * (i + 1))) for i, s in enumerate(shares)]
        everyone = np.arange(n)
        texts = np.concatenate([owner, owner, everyone, everyone, everyone])
        cells = np.concatenate([word, tail, *extra, np.zeros(n, _U)])
        cells = np.where(cells == 0, 0, 1 + cells % _U(buckets - 1)).astype(np.int64)
        pairs = np.unique(texts * buckets + cells)
        yield low, high, size, pairs % buckets, np.searchsorted(pairs, np.arange(n + 1) * buckets)


def _featured(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, _, cells, begins in _features(batch.column(1), buckets):
                lists = pa.ListArray.from_arrays(begins.astype(np.int32), pa.array(cells.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), lists], ["domain", "cells"])

    return run


def _posteriors(weights: np.ndarray, cells: np.ndarray, begins: np.ndarray) -> np.ndarray:
    logits = np.add.reduceat(weights[cells], begins[:-1], axis=0)
    logits = np.exp(logits - logits.max(axis=1, keepdims=True))
    return logits / logits.sum(axis=1, keepdims=True)


def _learner(sent, settings: MixingSettings):
    def learn(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, float]:
        begin = sent.value
        weights, seen = begin.copy(), np.full(begin.shape, 1e-3, np.float32)
        # A share of the bounded sample; few rows are gone through more often.
        parts = [batch.slice(low, BATCH) for batch in batches for low in range(0, len(batch), BATCH)]
        for part in parts * -(-settings.steps // max(1, len(parts))):
            right, lists = part.column(0).to_numpy(), part.column(1)
            cells = lists.flatten().to_numpy()
            begins = np.r_[0, np.cumsum(np.diff(np.frombuffer(lists.buffers()[1], np.int32)[lists.offset : lists.offset + len(lists) + 1]))]
            off = _posteriors(weights, cells, begins)
            off[np.arange(len(right)), right] -= 1
            slope = np.zeros_like(weights)
            np.add.at(slope, cells, np.repeat(off, np.diff(begins), axis=0))
            rows = np.unique(cells)
            change = slope[rows] / len(right) + settings.decay * weights[rows]
            seen[rows] += change * change
            weights[rows] -= settings.step * change / np.sqrt(seen[rows])
        return weights - begin, float(sum(len(part) for part in parts))

    return learn


def fit_domains(docs: DataFrame, labels: DataFrame, settings: MixingSettings) -> np.ndarray:
    """Softmax weights of the domain classifier, by distributed gradient rounds."""
    bound_batches(docs.sparkSession)
    known = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min(domain_of(F.col("quality"), F.col("toxic"))).alias("domain")
    )
    known = known.filter("domain is not null")
    share = min(1.0, settings.sample / max(1, known.count()))
    drawn = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    labelled = texts.join(F.broadcast(drawn), "doc_id").select("domain", "text")
    featured = durable(labelled.mapInArrow(_featured(settings.buckets), "domain int, cells array<int>"), "labelled")
    weights = np.zeros((settings.buckets, len(DOMAINS)), np.float32)
    for _ in range(settings.rounds):
        sent = docs.sparkSession.sparkContext.broadcast(weights)
        weights = weights + averaged(featured, _learner(sent, settings), weights.shape)
    return weights


def posteriors(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """(doc_id, n_tokens, p_good, p_poor, p_toxic, text_hash) of every document; tokens are words."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    buckets = len(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, size, cells, begins in _features(batch.column(1), buckets):
                chance = _posteriors(sent.value, cells, begins).astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low),
                        pa.array(size.astype(np.int64)),
                        *[pa.array(np.ascontiguousarray(c)) for c in chance.T],
                        batch.column(2).slice(low, high - low),
                    ],
                    ["doc_id", "n_tokens", *[f"p_{d}" for d in DOMAINS], "text_hash"],
                )

    text = F.col("text").cast("string")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    return texts.mapInArrow(run, POSTERIORS)


def _rates(chances: np.ndarray, moves: list[np.ndarray]) -> np.ndarray:
    """Rates after the given moves: each is a gradient step and a projection to what is not negative."""
    rate = np.ones(len(chances))
    for move in moves:
        rate = np.maximum(0, rate - chances @ move)
    return rate


def fit_rates(table: DataFrame, targets: Mapping[str, float], settings: MixingSettings) -> list[np.ndarray]:
    """Gradient moves after which expected domain tokens meet ``targets``, for ``posteriors`` rows.

    Least squares over nonnegative rates, one per document, from 1. A document's
    gradient is its posterior times the residuals of the domains, so a few
    numbers per step tell every task how its rates move; they are applied by the
    tasks and never collected. Steps are scaled by the overlap of the domains,
    and a job sums the residuals. The total aimed at is what the wanted domains
    have at rate 1.
    """
    wanted = np.array([targets.get(d, 0.0) for d in DOMAINS])
    if (wanted < 0).any() or not wanted.sum():
        raise ValueError("target shares are not negative, and one is above zero")
    names = [f"p_{d}" for d in DOMAINS]
    overlap = [[F.sum(F.col("n_tokens") * F.col(a) * F.col(b)) for b in names] for a in names]
    first = table.agg(*[F.sum(F.col("n_tokens") * F.col(a)) for a in names], *[x for row in overlap for x in row]).first()
    have = np.array([x or 0.0 for x in first[: len(names)]])
    aim = wanted / wanted.sum() * have[wanted > 0].sum()
    scale = np.linalg.pinv(np.array([x or 0.0 for x in first[len(names) :]]).reshape(len(names), -1) + 1e-9 * max(1.0, have.sum()) * np.eye(len(names)))

    moves: list[np.ndarray] = []
    for _ in range(settings.iterations):
        residual = have - aim
        if np.abs(residual).max() <= settings.tolerance * max(1.0, aim.sum()):
            break
        moves.append(scale @ residual)
        have = _expected(table, moves)
    return moves


def _expected(table: DataFrame, moves: list[np.ndarray]) -> np.ndarray:
    """Expected tokens of every domain after ``moves``."""
    sums = rated(table, moves).agg(*[F.sum(F.col("rate") * F.col("n_tokens") * F.col(f"p_{d}")) for d in DOMAINS]).first()
    return np.array([x or 0.0 for x in sums])


def rated(table: DataFrame, moves: list[np.ndarray]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chances = np.stack([batch.column(2 + i).to_numpy() for i in range(len(DOMAINS))], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_rates(chances, moves))], [*batch.schema.names, "rate"])

    return table.mapInArrow(run, f"{POSTERIORS}, rate double")


def whole_copies(rate, *key):
    """Copies whose expected number is ``rate``: its whole part, and one more by a hash of ``key`` below the rest."""
    drawn = F.pmod(F.xxhash64(*key), F.lit(1 << 30)) / (1 << 30)
    return (F.floor(rate) + (drawn < rate - F.floor(rate)).cast("int")).cast("int")


def mix(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float] = TARGETS, settings: MixingSettings = MixingSettings()) -> DataFrame:
    """Rates that mix documents to target domain shares: posteriors, rate and copies of each.

    Returns (doc_id, n_tokens, p_good, p_poor, p_toxic, text_hash, rate, copies). ``labels``
    (doc_id, quality, toxic) teach a softmax classifier the domains; a document
    belongs to each by its posterior. ``rate`` is how often it should be taken
    so that expected tokens per domain have the shares of ``targets``; ``copies``
    is the whole part of the rate, and one more where a hash of id and text, as a
    fraction of 1, is below the rest; so copies have the rates on average, and
    are the same in every run. A domain with target 0 fades out; the fit ends
    after ``iterations`` moves where it can't be emptied, and ``reached_shares``
    tells how far it came.

    NULL, empty and wordless texts have no tokens; they are judged by the
    constant features alone. Rows without id are judged like others. A document
    with several labels takes the first domain in order; labels that say nothing
    are ignored, and without any label all domains are equally likely. Repeated
    rows are rated each. Other columns are ignored; an empty table gives no rows.
    """
    table = durable(posteriors(docs, fit_domains(docs, labels, settings)), "posteriors")
    done = rated(table, fit_rates(table, targets, settings))
    return done.withColumn("copies", whole_copies(F.col("rate"), "doc_id", "text_hash"))


def reached_shares(mixed: DataFrame, targets: Mapping[str, float] = TARGETS) -> DataFrame:
    """(domain, target, by_rate, by_copies): shares of the tokens that the rates and the copies of ``mix`` give.

    A target can be out of reach: every document belongs to each domain a little,
    so a domain with target 0 only fades out as far as others are not emptied.
    """
    counted = [F.sum(F.col(by) * F.col("n_tokens") * F.col(f"p_{d}")).alias(f"{by}_{d}") for by in ("rate", "copies") for d in DOMAINS]
    sums = mixed.agg(*counted)
    whole = {by: sum((F.col(f"{by}_{d}") for d in DOMAINS), F.lit(0.0)) for by in ("rate", "copies")}
    wanted = sum(targets.get(d, 0.0) for d in DOMAINS)
    rows = [
        F.struct(
            F.lit(d).alias("domain"),
            F.lit(targets.get(d, 0.0) / wanted).alias("target"),
            F.try_divide(F.col(f"rate_{d}"), whole["rate"]).alias("by_rate"),
            F.try_divide(F.col(f"copies_{d}"), whole["copies"]).alias("by_copies"),
        )
        for d in DOMAINS
    ]
    return sums.select(F.inline(F.array(*rows)))
