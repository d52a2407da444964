"""Removal of repeated word spans along compacted paths of a de Bruijn graph."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tripfare.llm import arrays
from tripfare.llm.repeats import Grain, blocks, keyed, repeated_segments, spans_of
from tripfare.llm.suffix_dedup import merged
from tripfare.operators.durable import durable

_U = np.uint64

# Edges that a task compares at a time (an anchor with more is one block).
BLOCK_EDGES = 100_000
ANCHOR_WORDS = 5
SECOND_SALT = 7

PATH = "doc_id long, doc_key long, begin long, stop long, from_doc long, from_key long, from_begin long"
_NAMES = [part.split()[0] for part in PATH.split(", ")]


def _paths(*columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], _NAMES)


def _block(table: pa.Table, k: int) -> Iterator[pa.RecordBatch]:
    """Edges of one block that also lie in a document with a smaller id, as unbranched paths."""
    doc, key, start, windows = (table.column(i).to_numpy() for i in (1, 2, 3, 4))
    owner = np.repeat(np.arange(len(windows)), windows)
    inner = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    # 128 bits name an edge: two hashes of its words.
    named: tuple[list, list] = ([], [])
    for low, high, data, offsets in arrays.slices(pa.concat_arrays(table.column(6).chunks)):
        starts, stops, first = arrays.words(data, offsets)
        part = slice(*np.searchsorted(owner, (low, high)))
        at = first[owner[part] - low] + inner[part]
        for found, salt in zip(named, (0, SECOND_SALT)):
            found.append(arrays.run_hashes(arrays.span_hashes(data, starts, stops, salt=salt), k, salt=salt)[at])
    names = [np.concatenate(found) for found in named]
    place = np.lexsort((start[owner] + inner, key[owner], doc[owner], names[1], names[0]))
    fresh = np.r_[True, (names[0][place][1:] != names[0][place][:-1]) | (names[1][place][1:] != names[1][place][:-1])]
    source = place[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
    least = np.empty(len(place), dtype=np.int64)
    least[place] = source
    from_doc, from_key, from_at = doc[owner[least]], key[owner[least]], start[owner[least]] + inner[least]
    again = np.flatnonzero(doc[owner] > from_doc)
    if not len(again):
        return
    # An edge continues the path before it where both its document and its source move on by one word.
    o, i, d, k, s = owner[again], inner[again], from_doc[again], from_key[again], from_at[again]
    turn = (o[1:] != o[:-1]) | (i[1:] != i[:-1] + 1) | (d[1:] != d[:-1]) | (k[1:] != k[:-1]) | (s[1:] != s[:-1] + 1)
    head = np.r_[0, np.flatnonzero(turn) + 1]
    last = np.r_[head[1:] - 1, len(again) - 1]
    yield _paths(doc[o[head]], key[o[head]], start[o[head]] + i[head], start[o[last]] + i[last] + 1, d[head], k[head], s[head])


def _bucketed(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        findings: list[pa.RecordBatch] = []

        def told() -> Iterator[pa.RecordBatch]:
            while findings:
                b = findings.pop()
                start, windows = b.column(3).to_numpy(), b.column(4).to_numpy()
                yield _paths(b.column(1), b.column(2), start, start + windows, *b.columns[7:])

        def contents() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                findings.append(batch.filter(pc.is_null(batch.column(6))))
                yield batch.filter(pc.is_valid(batch.column(6)))

        for table in blocks(contents(), BLOCK_EDGES):
            yield from _block(table, k)
            yield from told()
        yield from told()

    return run


def repeated_paths(docs: DataFrame, k: int = 13) -> DataFrame:
    """Maximal repeated paths: (doc_id, doc_key, begin, stop, from_doc, from_key, from_begin), in edges.

    Every run of ``k`` words is an edge of the graph, between its first and its
    last ``k - 1`` words. Edges are compared in the bucket of their anchor, and
    each is given its least source (document, place). Edges that follow each
    other in a document and in their source are one unbranched path; a bucket
    joins the ones it holds. Pieces from different buckets are then compacted by
    a join of path ends with path beginnings, at equal source coordinates.
    """
    grain = Grain(length=k, k=min(ANCHOR_WORDS, k), of_words=True)
    segments = repeated_segments(keyed(docs).filter("doc_id is not null and text is not null"), grain)
    line = ["doc_id", "doc_key", "from_doc", "from_key", "offset"]
    pieces = durable(segments.mapInArrow(_bucketed(k), PATH), "paths").withColumn("offset", F.expr("begin - from_begin"))
    ends = pieces.select(*line, F.col("stop").alias("begin"), F.lit(True).alias("goes_on")).distinct()
    joined = pieces.join(ends, [*line, "begin"], "left")
    along = Window.partitionBy(*line).orderBy("begin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = joined.withColumn("path", F.count_if(F.col("goes_on").isNull()).over(along))
    paths = numbered.groupBy(*line, "path").agg(F.min("begin").alias("begin"), F.max("stop").alias("stop"))
    return paths.select("doc_id", "doc_key", "begin", "stop", "from_doc", "from_key", (F.col("begin") - F.col("offset")).alias("from_begin"))


def _cut(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column(1), batch.column(2)
            rows = []
            for i in range(len(batch)):
                words = (texts[i].as_py() or "").encode().split()
                found = spans[i].values
                n = len(words)
                if found is not None and len(found):
                    begin, stop = merged(found.field(0).to_numpy(), found.field(1).to_numpy() + k - 1)
                    for a, b in zip(begin[::-1].tolist(), stop[::-1].tolist()):
                        del words[a:b]
                kept = b" ".join(words)
                rows.append((n, n - len(words), hashlib.sha256(kept).hexdigest(), kept.decode()))
            columns = list(zip(*rows)) or [()] * 4
            types = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types)]],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
            )

    return run


def graph_dedup(docs: DataFrame, k: int = 13) -> DataFrame:
    """Remove every word covered by ``k`` words that also stand in a document with a smaller id.

    Returns (doc_id, n_words, n_removed, kept_sha256, kept), ``kept`` being the
    remaining words joined by single spaces. Windows are judged on the input.
    NULL, empty and wordless texts have no words. Repeats inside one document
    stay, and so do those of texts that share an id, each of which is judged by
    itself. A row without id is neither judged nor judges others. Other columns
    are ignored; an empty table gives no rows.
    """
    joined = spans_of(keyed(docs), repeated_paths(docs, k))
    return joined.mapInArrow(_cut(k), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
