"""Removal of repeated byte strings by blockwise suffix sorting with a difference cover."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tripfare.llm import arrays
from tripfare.llm.repeats import Grain, blocks, keyed, repeated_segments, spans_of

_U = np.uint64

# A difference cover modulo 31: every difference is one of two members, so any two
# positions reach a pair of sampled ones by one and the same shift below 31.
PERIOD = 31
COVER = (0, 1, 3, 8, 12, 18)
WORD = 8
# Bytes that are sorted directly before ties are resolved by ranks of the sample.
PREFIX = 4 * WORD
# Windows in one suffix bucket that is sorted at a time.
BUCKET_WINDOWS = 250_000
ANCHOR_BYTES = 30

_IN_COVER = np.isin(np.arange(PERIOD), COVER)
_SHIFT = np.array(
    [[next(d for d in range(PERIOD) if _IN_COVER[(a + d) % PERIOD] and _IN_COVER[(b + d) % PERIOD]) for b in range(PERIOD)] for a in range(PERIOD)]
)


def _ranked(keys: list[np.ndarray]) -> np.ndarray:
    """Dense rank of each row in the order of ``keys``, the first being the most significant."""
    order = np.lexsort(keys[::-1])
    fresh = np.zeros(len(order), dtype=np.int64)
    for key in keys:
        fresh[1:] |= key[order[1:]] != key[order[:-1]]
    ranks = np.empty(len(order), dtype=np.int64)
    ranks[order] = np.cumsum(fresh)
    return ranks


def equal_windows(data: np.ndarray, ends: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Class of each position in ``at``: equal exactly when the ``length`` bytes from there are.

    ``ends[p]`` is where the text around byte p ends; every window is whole.
    Suffixes are sorted by their first 32 bytes. Ties are split again and again
    around one of their members: first by the rank of the sampled suffix that
    both reach by the same shift, then by the last bytes of the window.
    """
    depth = length - PREFIX
    if depth < PERIOD + WORD:
        raise ValueError(f"windows have at least {PREFIX + PERIOD + WORD} bytes")
    padded = np.r_[data, np.zeros(WORD, np.uint8)]
    # The word of eight bytes from each position on; its order is that of the bytes.
    word = np.lib.stride_tricks.sliding_window_view(padded, WORD)[: len(data)].copy().view(">u8").reshape(-1).astype(_U)

    group = _ranked([word[at + o] for o in range(0, PREFIX, WORD)])
    tied = np.bincount(group)[group] > 1
    result = group.copy()
    place = np.flatnonzero(tied)
    if not len(place):
        return result
    taken = int(group.max()) + 1

    sample = np.flatnonzero(_IN_COVER[np.arange(len(data)) % PERIOD] & (np.arange(len(data)) + depth <= ends))
    rank = np.zeros(len(data), dtype=np.int64)
    rank[sample] = _ranked([word[sample + o] for o in [*range(0, depth - WORD, WORD), depth - WORD]])
    tail = [length - PREFIX + o for o in range(0, PREFIX, WORD)]

    group = group[place]
    while len(place):
        _, first, group = np.unique(group, return_index=True, return_inverse=True)
        size = np.bincount(group)
        order = np.argsort(group, kind="stable")
        middle = order[np.r_[0, np.cumsum(size)[:-1]] + size // 2]
        p, q = at[place], at[place[middle]][group]
        shift = _SHIFT[p % PERIOD, q % PERIOD]
        sign = np.sign(rank[p + shift] - rank[q + shift])
        for o in tail:
            same = np.flatnonzero(sign == 0)
            x, y = word[p[same] + o], word[q[same] + o]
            sign[same] = (x > y).astype(np.int64) - (x < y)
        result[place] = taken + 3 * group + sign + 1
        taken += 3 * len(size)
        # Members equal to the middle one are done; so is a member left alone.
        split = 3 * group + sign + 1
        left = (sign != 0) & (np.bincount(split)[split] > 1)
        place, group = place[left], split[left]
    return result


def _bucket(table: pa.Table, length: int) -> Iterator[pa.RecordBatch]:
    """Windows of a bucket that also start earlier, as runs of bytes."""
    doc, key, start, windows, lead = (table.column(i).to_numpy() for i in (1, 2, 3, 4, 5))
    content = pa.concat_arrays(table.column(6).chunks)
    data, offsets = arrays.flat(content)
    ends = np.repeat(offsets[1:], np.diff(offsets))
    by_doc = _ranked([doc, key])
    # Equal windows stand equally far before their anchor. A bucket too large for
    # one sort is sorted in slices of that distance.
    share = max(1, int(windows.sum()) // (4 * BUCKET_WINDOWS))
    span = -(-length // share)
    for low in range(0, length, span):
        low_at, high_at = np.maximum(0, lead - (low + span - 1)), np.minimum(windows, lead - low + 1)
        n = np.maximum(0, high_at - low_at)
        if not n.sum():
            continue
        owner = np.repeat(np.arange(len(n)), n)
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + low_at[owner]
        kind = equal_windows(data, ends, offsets[owner] + inner, length)
        place = by_doc[owner] << 40 | (start[owner] + inner)
        least = np.full(int(kind.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, kind, place)
        again = np.flatnonzero(place > least[kind])
        if not len(again):
            continue
        cut = np.flatnonzero((owner[again][1:] != owner[again][:-1]) | (inner[again][1:] != inner[again][:-1] + 1)) + 1
        head, last = again[np.r_[0, cut]], again[np.r_[cut - 1, len(again) - 1]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(doc[owner[head]]),
                pa.array(key[owner[head]]),
                pa.array(start[owner[head]] + inner[head]),
                pa.array(start[owner[last]] + inner[last] + length),
            ],
            ["doc_id", "doc_key", "begin", "stop"],
        )


def _sorted_buckets(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def contents():
            for batch in batches:
                findings.append(batch.filter(pc.is_null(batch.column(6))))
                yield batch.filter(pc.is_valid(batch.column(6)))

        findings: list[pa.RecordBatch] = []
        for table in blocks(contents(), BUCKET_WINDOWS):
            yield from _bucket(table, length)
            while findings:
                yield told(findings.pop())
        while findings:
            yield told(findings.pop())

    def told(batch: pa.RecordBatch) -> pa.RecordBatch:
        start, windows = batch.column(3).to_numpy(), batch.column(4).to_numpy()
        columns = [batch.column(1), batch.column(2), pa.array(start), pa.array(start + windows - 1 + length)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "doc_key", "begin", "stop"])

    return run


def repeated_spans(docs: DataFrame, length: int = 100) -> DataFrame:
    """(doc_id, doc_key, begin, stop): bytes of windows that also start earlier; spans may overlap."""
    grain = Grain(length=length, k=ANCHOR_BYTES, of_words=False)
    segments = repeated_segments(keyed(docs).filter("doc_id is not null and text is not null"), grain)
    return segments.mapInArrow(_sorted_buckets(length), "doc_id long, doc_key long, begin long, stop long")


def merged(begin: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of spans, as ascending spans that don't touch."""
    if not len(begin):
        return begin, stop
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(stop[order])
    head = np.r_[True, begin[1:] > reach[:-1]]
    return begin[head], reach[np.r_[np.flatnonzero(head)[1:] - 1, len(reach) - 1]]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = arrays.flat(batch.column(1))
        spans = batch.column(2)
        rows = []
        for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
            text = data[a:b]
            found = spans[i].values
            if found is None or not len(found):
                begin = stop = np.zeros(0, np.int64)
            else:
                begin, stop = merged(found.field(0).to_numpy(), found.field(1).to_numpy())
            keep = np.ones(len(text), dtype=bool)
            for x, y in zip(begin, stop):
                keep[x:y] = False
            kept = text[keep].tobytes()
            rows.append((len(text), len(text) - len(kept), len(begin), hashlib.sha256(kept).hexdigest(), kept))
        columns = list(zip(*rows)) or [()] * 5
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types)]],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
        )


def suffix_dedup(docs: DataFrame, length: int = 100) -> DataFrame:
    """Remove every byte covered by a ``length``-byte string that also starts earlier.

    Earlier means in a document with a smaller id, or earlier in the same one.
    Returns (doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept); ``kept``
    holds the remaining bytes, which may cut a character in two.

    Buckets of suffixes are dealt by the anchor of their window and sorted one
    at a time (``equal_windows``), so a task holds one bucket and no more. The
    first windows of all equal strings stay, the others are removed, judged on
    the input. NULL is an empty text. Rows that repeat both id and text are one
    document; texts that share an id come in the order of their hashes, each
    judged by itself. A row without id is neither judged nor judges others.
    Other columns are ignored; an empty table gives no rows.
    """
    joined = spans_of(keyed(docs), repeated_spans(docs, length))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return joined.mapInArrow(_cut, schema)
