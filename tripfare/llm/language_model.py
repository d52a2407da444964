"""Log probability of whole texts under a hashed maximum-entropy model."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tripfare.llm import arrays
from tripfare.llm.gradients import averaged
from tripfare.llm.tables import bound_batches
from tripfare.operators.durable import durable

_U = np.uint64

# The token that ends every text. No word hashes to it but by a 64-bit collision.
END = _U(0x5851F42D4C957F2D)
FEATURES = 5
# Tokens whose kinds are counted together before they leave a task.
COUNTED = 1 << 20


@dataclass(frozen=True)
class ModelSettings:
    """Shape of the model: buckets x classes weights, whatever the corpus.

    ``frequent`` words have their counts sent to the executors; those of all
    others are joined. Each training token takes part in one of the ``rounds``.
    """

    classes: int = 32
    buckets: int = 1 << 13
    frequent: int = 1 << 17
    rounds: int = 2
    step: float = 0.1
    batch: int = 4096


def _tokens(data: np.ndarray, offsets: np.ndarray, classes: int):
    """Hash and class of all tokens, an end after each text; first token of each text.

    The class of a word is drawn from its last two bytes, so a word never met
    before has one too. The end has the last class to itself.
    """
    starts, stops, first = arrays.words(data, offsets)
    word = arrays.span_hashes(data, starts, stops, lower=True)
    tail = arrays.span_hashes(data, np.maximum(starts, stops - 2), stops, lower=True)
    kind = ((tail >> _U(32)) % _U(classes - 1)).astype(np.int64)
    return np.insert(word, first[1:], END), np.insert(kind, first[1:], classes - 1), first + np.arange(len(first))


def _features(token: np.ndarray, kind: np.ndarray, first: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of each token's context: n-grams and skips of the words and classes before it."""
    age = np.arange(len(token)) - np.repeat(first[:-1], np.diff(first))

    def before(values, n, missing):
        moved = np.full_like(values, missing)
        moved[n:] = values[:-n]
        return np.where(age >= n, moved, missing)

    w1, w2 = before(token, 1, END), before(token, 2, END)
    c1, c2, c3 = (before(kind, n, -1).astype(_U) for n in (1, 2, 3))
    contexts = (w1 + _U(1), w2 + _U(2), arrays.mix(w1 + _U(3)) + w2, arrays.mix(arrays.mix(c1 + _U(4)) + c2) + c3)
    hashed = [1 + (arrays.mix(c) % _U(buckets - 1)).astype(np.int64) for c in contexts]
    return np.stack([np.zeros(len(token), np.int64), *hashed], axis=1)


def _chances(weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Log probability of every class."""
    logits = weights[features[:, 0]]
    for j in range(1, FEATURES):
        logits = logits + weights[features[:, j]]
    logits -= logits.max(axis=1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def _counted(classes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told():
            tokens, kinds = np.concatenate(held[0]), np.concatenate(held[1])
            unique, at, n = np.unique(tokens, return_index=True, return_counts=True)
            held[0].clear(), held[1].clear()
            columns = [arrays.signed(unique), kinds[at].astype(np.int32), n.astype(np.int64)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["token", "kind", "n"])

        held: tuple[list, list] = ([], [])
        size = 0
        for batch in batches:
            for _, _, data, offsets in arrays.slices(batch.column(0)):
                token, kind, _ = _tokens(data, offsets, classes)
                held[0].append(token)
                held[1].append(kind)
                size += len(token)
                if size >= COUNTED:
                    yield told()
                    size = 0
        if size:
            yield told()

    return run


def _learner(sent, settings: ModelSettings, turn: int):
    def learn(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, float]:
        begin = sent.value
        weights, seen, used, block = begin.copy(), np.full(settings.buckets, 1e-3, np.float32), 0, 0
        for batch in batches:
            for _, _, data, offsets in arrays.slices(batch.column(0)):
                block += 1
                if block % settings.rounds != turn:
                    continue
                token, kind, first = _tokens(data, offsets, settings.classes)
                features = _features(token, kind, first, settings.buckets)
                for low in range(0, len(token), settings.batch):
                    some, right = features[low : low + settings.batch], kind[low : low + settings.batch]
                    off = np.exp(_chances(weights, some))
                    off[np.arange(len(right)), right] -= 1
                    cells = some.reshape(-1)
                    order = np.argsort(cells, kind="stable")
                    rows, at = np.unique(cells[order], return_index=True)
                    slope = np.add.reduceat(off[order // FEATURES], at, axis=0)
                    seen[rows] += (slope * slope).mean(axis=1)
                    weights[rows] -= settings.step * slope / np.sqrt(seen[rows])[:, None]
                used += len(token)
        return weights - begin, float(used)

    return learn


def train(texts: DataFrame, start: np.ndarray, settings: ModelSettings) -> np.ndarray:
    """Weights after ``rounds`` distributed gradient rounds over ``texts`` (text)."""
    weights = start
    for turn in range(settings.rounds):
        sent = texts.sparkSession.sparkContext.broadcast(weights)
        weights = weights + averaged(texts, _learner(sent, settings, turn), weights.shape)
    return weights


def _scored(sent, settings: ModelSettings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, log_counts, log_class, weights = sent.value
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for low, high, data, offsets in arrays.slices(batch.column(2)):
                token, kind, first = _tokens(data, offsets, settings.classes)
                n = high - low
                owner = np.repeat(np.arange(n), np.diff(first))
                features = _features(token, kind, first, settings.buckets)
                model = np.empty(len(token))
                for at in range(0, len(token), settings.batch):
                    part = slice(at, at + settings.batch)
                    chances = _chances(weights, features[part])
                    model[part] = chances[np.arange(len(chances)), kind[part]] / np.log(10)
                model -= log_class[kind]
                found = index.find(token)
                known = found >= 0
                counted = np.where(known, log_counts[found], 0)
                rare = np.flatnonzero(~known)
                # Rare words of each text, once each.
                order = rare[np.lexsort((token[rare], owner[rare]))]
                fresh = np.ones(len(order), dtype=bool)
                fresh[1:] = (token[order][1:] != token[order][:-1]) | (owner[order][1:] != owner[order][:-1])
                at = np.flatnonzero(fresh)
                times = np.diff(np.r_[at, len(order)])
                lists = np.searchsorted(owner[order[at]], np.arange(n + 1)).astype(np.int32)
                columns = [
                    pa.array(row + np.arange(n)),
                    batch.column(0).slice(low, n),
                    batch.column(1).slice(low, n),
                    pa.array(np.diff(first).astype(np.int64)),
                    pa.array(np.bincount(owner[known], minlength=n).astype(np.int64)),
                    pa.array(np.bincount(owner, weights=counted, minlength=n)),
                    pa.array(np.bincount(owner, weights=model, minlength=n)),
                    pa.ListArray.from_arrays(lists, pa.array(arrays.signed(token[order[at]]))),
                    pa.ListArray.from_arrays(lists, pa.array(times.astype(np.int32))),
                ]
                row += n
                yield pa.RecordBatch.from_arrays(columns, SCORED_NAMES)

    return run


SCORED = "line long, doc_id long, held_out boolean, n_tokens long, n_known long, counted double, model double, rare array<long>, times array<int>"
SCORED_NAMES = [part.split()[0] for part in SCORED.split(", ")]


def score_texts(docs: DataFrame, learn_from: Column, settings: ModelSettings = ModelSettings()) -> DataFrame:
    """Score every whole text: (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    ``learn_from`` marks the training rows. A text is its words, A-Z lower case,
    and one end. ``base_score`` is the add-one unigram log10 probability.
    ``score`` is that of the model: the class of a token given its context, by a
    softmax over hashed n-gram and skip features, times the add-one probability
    of the token in its class, where one further token stands for all unknown
    ones. Both add up to 1 over the known tokens and the unknown one.

    Counts of words are exact and cover all training texts. Those of the most
    frequent words are sent to the executors, up to a fixed number; rarer words
    of each text are joined with the full table, in which no key is hot.

    A NULL text is empty and just ends. A row without id teaches nothing and is
    not held out. Repeated rows are scored, and learned from, each. Without
    training texts all probabilities come from the end of the formula: scores
    are then 0 for the base, and those of an untrained softmax for the model.
    Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    learns = F.coalesce(learn_from, F.lit(False))
    held = ~learns & F.col("doc_id").isNotNull()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), F.col("text").cast("string").alias("text"))
    training = docs.filter(learns).select(F.col("text").cast("string").alias("text"))

    counted = training.mapInArrow(_counted(settings.classes), "token long, kind int, n long")
    counts = durable(counted.groupBy("token").agg(F.min("kind").alias("kind"), F.sum("n").alias("n")), "word-counts")
    kinds = counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    tokens, vocabulary = sum(r["n"] for r in kinds), sum(r["v"] for r in kinds)
    size = np.ones(settings.classes)
    for r in kinds:
        size[r["kind"]] += r["n"] + r["v"]
    top = counts.orderBy(F.desc("n"), "token").limit(settings.frequent).select("token", "n").toArrow()
    index = arrays.HashIndex(top["token"].to_numpy().astype(np.int64).view(_U))
    log_counts = np.r_[np.log10(top["n"].to_numpy() + 1.0), 0.0]

    start = np.zeros((settings.buckets, settings.classes), np.float32)
    start[0] = np.log(size / size.sum())
    weights = train(training, start, settings)

    sent = spark.sparkContext.broadcast((index, log_counts, np.log10(size), weights))
    scored = durable(texts.mapInArrow(_scored(sent, settings), SCORED), "scored")
    rare = scored.select("line", F.inline(F.arrays_zip("rare", "times"))).withColumnRenamed("rare", "token")
    met = rare.join(counts.select("token", "n"), "token").groupBy("line").agg(
        F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more")
    )
    total = F.col("counted") + F.coalesce("more", F.lit(0.0))
    return scored.join(met, "line", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (total - F.col("n_tokens") * float(np.log10(tokens + vocabulary + 1))).alias("base_score"),
        (total + F.col("model")).alias("score"),
    )
