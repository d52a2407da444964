"""Exact top-k by inner product: term-at-a-time accumulation over whole tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tripfare.llm.tables import bound_batches
from tripfare.operators.durable import durable

# Queries and vectors in a block: their dense scores take 8 bytes a pair.
QUERY_BLOCK = 1024
VECTOR_BLOCK = 2048
# The score of a query with itself: below all others, and with a negation that fits.
NEVER = np.iinfo(np.int64).min + 1


def integer_vectors(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """(vec_id, weights): floor(scale * x) of each component, of vectors that are whole."""
    parts = F.col("embedding").cast("array<double>")
    bad = F.exists(parts, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(~bad)
    return whole.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(parts, lambda x: F.floor(x * scale)).alias("weights"))


def postings(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Non-zero weights by term: terms, where the postings of each begin, vectors, weights."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]).astype(np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    term = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    some = values != 0
    order = np.argsort(term[some], kind="stable")
    owner, weight, term = owner[some][order], values[some][order], term[some][order]
    terms, begins = np.unique(term, return_index=True)
    return terms, np.r_[begins, len(term)], owner, weight


def accumulate(query, candidates, n_queries: int, n_candidates: int) -> np.ndarray:
    """Scores of all pairs. Term by term, each query weight scatters the weighted postings."""
    scores = np.zeros((n_queries, n_candidates), dtype=np.int64)
    q_terms, q_begins, q_owner, q_weight = query
    terms, begins, owner, weight = candidates
    shared, at_q, at_c = np.intersect1d(q_terms, terms, assume_unique=True, return_indices=True)
    for i, j in zip(at_q, at_c):
        whom, values = owner[begins[j] : begins[j + 1]], weight[begins[j] : begins[j + 1]]
        rows, factors = q_owner[q_begins[i] : q_begins[i + 1]], q_weight[q_begins[i] : q_begins[i + 1]]
        if len(whom) == n_candidates and len(rows) == n_queries:
            scores += factors[:, None] * values
        else:
            scores[np.ix_(rows, whom)] += factors[:, None] * values
    return scores


def _packed(size: int):
    """Vectors in blocks of ``size`` rows: their ids, and their postings as flat arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), size):
                part = batch.slice(low, size)
                arrays_ = (part.column(0).to_numpy(), *postings(part.column(1)))
                yield pa.RecordBatch.from_arrays([pa.array([x.astype(np.int64).tobytes()], pa.binary()) for x in arrays_], PARTS)

    return run


PARTS = ["ids", "terms", "begins", "owner", "weight"]
BLOCK = ", ".join(f"{name} binary" for name in PARTS)


def _blocks(vectors: DataFrame, size: int, label: str) -> DataFrame:
    return durable(vectors.mapInArrow(_packed(size), BLOCK), label)


def _best(k: int):
    """The k best candidates of each query among the pairs of blocks of a task."""

    def merged(ids, old, scores, candidates):
        if len(candidates) > k:
            # All that reach the k-th score stay, so that ties are settled by id.
            edge = np.partition(scores, len(candidates) - k, axis=1)[:, len(candidates) - k]
            keep = np.flatnonzero((scores >= edge[:, None]).any(axis=0))
            scores, candidates = scores[:, keep], candidates[keep]
        scores = np.hstack([old[0], scores])
        found = np.hstack([old[1], np.broadcast_to(candidates, (len(ids), len(candidates)))])
        order = np.lexsort((found, -scores), axis=1)[:, :k]
        return np.take_along_axis(scores, order, 1), np.take_along_axis(found, order, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Queries of a block → their best scores and candidates so far.
        held: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                ids, *query = (np.frombuffer(x, np.int64) for x in row[: len(PARTS)])
                candidates, *others = (np.frombuffer(x, np.int64) for x in row[len(PARTS) :])
                scores = accumulate(query, others, len(ids), len(candidates))
                scores[ids[:, None] == candidates] = NEVER
                none = np.zeros((len(ids), 0), np.int64)
                held[row[0]] = merged(ids, held.get(row[0], (none, none)), scores, candidates)
        for name, (score, found) in held.items():
            ids, real = np.frombuffer(name, np.int64), score > NEVER
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.broadcast_to(ids[:, None], found.shape)[real]), pa.array(found[real]), pa.array(score[real])],
                ["query_id", "vec_id", "score"],
            )

    return run


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024) -> DataFrame:
    """The ``k`` best other vectors of each query: (query_id, rank, vec_id, score).

    Scores are inner products of floor(scale * x); ties go to the smaller
    vec_id. Queries and vectors are packed into stored blocks of bounded size.
    Each pair of a block of queries and a block of vectors is a row, scored as
    one dense array; a task sends on ``k`` rows per query, which are then
    merged. So the work is queries times vectors, spread evenly over the pairs,
    and nothing passes through the driver.

    Vectors that are NULL, or hold a NULL or non-finite component, or have no
    id, take no part. A shorter vector counts as zero beyond its end. Rows that
    repeat a vec_id count once, and never as a result of that id; where their
    vectors differ, the one with the least weights in order of components
    counts, as query and as candidate. Other columns are ignored; an empty table
    gives no rows.
    """
    spark = vectors.sparkSession
    bound_batches(spark)
    # One row per vec_id before anything is cut to k: of different vectors of one id the least.
    whole = durable(integer_vectors(vectors, scale).groupBy("vec_id").agg(F.min("weights").alias("weights")), "vectors")
    queries = _blocks(whole.filter(is_query), QUERY_BLOCK, "query-blocks")
    others = _blocks(whole, VECTOR_BLOCK, "vector-blocks")
    # A stated set of queries against all rows, block by block: a row holds some megabytes.
    pairs = queries.crossJoin(others.select(*[F.col(c).alias(f"other_{c}") for c in PARTS]))
    found = pairs.mapInArrow(_best(k), "query_id long, vec_id long, score long")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
