"""Find what a corpus holds more than once, at the cost of a sample of it.

A text is a run of items (bytes, or words). Of each window of ``length`` items
the k-gram with the least hash is the anchor. Equal windows have equal anchors,
so a window can only be repeated if its anchor is. Consecutive windows with one
anchor form a segment. Only segments of repeated anchors travel, as texts, to
the bucket of their anchor, where their windows are compared in full.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tripfare.llm import arrays
from tripfare.llm.tables import bound_batches
from tripfare.operators.durable import durable

_U = np.uint64

# Bits of the filter of repeated anchors: 16 per anchor, within these bounds.
# Past the upper one (32 MiB) the filter lets more segments through; it never holds one back.
FILTER_BITS = (1 << 20, 1 << 28)
FILTER_PART_BITS = 1 << 18
# Distinct segments that a task remembers in order to send each only once.
REMEMBERED = 100_000

# A text is known by its document and by a hash of its own: rows may share an id.
SEGMENT = (
    "anchor long, doc_id long, doc_key long, start long, windows int, lead int, content binary, from_doc long, from_key long, from_start long"
)
_NAMES = [part.split()[0] for part in SEGMENT.split(", ")]
_TYPES = [*[pa.int64()] * 4, pa.int32(), pa.int32(), pa.binary(), *[pa.int64()] * 3]


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, doc_key) of every row."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("doc_key"))


def spans_of(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc_id, text, spans): each text with what was found in it, NULL if nothing."""
    own = ["doc_id", "doc_key"]
    found = spans.groupBy(*own).agg(F.collect_list(F.struct("begin", "stop")).alias("spans"))
    return texts.join(found.hint("shuffle_hash"), own, "left").select("doc_id", "text", "spans")


@dataclass(frozen=True)
class Grain:
    """``length`` items make a window, ``k`` of them an anchor; items are bytes or words.

    An anchor is hot if batches hold at least ``hot`` segments of it that differ.
    """

    length: int
    k: int
    of_words: bool
    hot: int = 4096

    def names(self, hashes, begin, end) -> np.ndarray:
        """Hash of segments from window ``begin`` to ``end`` by their first and last grams: equal ones have one name."""
        return arrays.mix(hashes[begin] + (end - begin).astype(_U)) ^ arrays.mix(hashes[end - 1 + self.length - self.k] + _U(1))

    def grams(self, data, offsets):
        """Anchor candidates, first item of each text, and the byte span of each item."""
        if not self.of_words:
            return arrays.gram_hashes(data, self.k), offsets, None, None
        starts, stops, first = arrays.words(data, offsets)
        return arrays.run_hashes(arrays.span_hashes(data, starts, stops), self.k), first, starts, stops

    def segments(self, hashes, first):
        """Begin and end of each segment, in windows, and the place of its anchor."""
        anchor = arrays.sliding_argmin(hashes, self.length - self.k + 1)
        if not len(anchor):
            return (np.zeros(0, np.int64),) * 3
        index = np.arange(len(anchor))
        whole = index + self.length <= np.repeat(first[1:], np.diff(first))[: len(anchor)]
        fresh = np.r_[True, (anchor[1:] != anchor[:-1]) | ~whole[:-1]]
        begin = np.flatnonzero(whole & fresh)
        breaks = np.r_[np.flatnonzero(fresh | ~whole), len(anchor)]
        return begin, breaks[np.searchsorted(breaks, begin, side="right")], anchor[begin]


def _counted(grain: Grain):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(np.zeros(0, _U), np.zeros(0, _U))]
            for _, _, data, offsets in arrays.slices(batch.column(1)):
                hashes, first, _, _ = grain.grams(data, offsets)
                begin, end, anchor = grain.segments(hashes, first)
                if len(begin):
                    found.append((hashes[anchor], grain.names(hashes, begin, end)))
            anchors, contents = (np.concatenate(c) for c in zip(*found))
            values, place, n = np.unique(anchors, return_inverse=True, return_counts=True)
            # Segments of an anchor that differ: each would travel by itself.
            rows = np.ones(len(values), np.int64)
            again = np.flatnonzero(n[place] > 1)
            kinds = np.unique(arrays.mix(anchors[again]) ^ contents[again], return_index=True)[1]
            np.add.at(rows, place[again[kinds]], 1)
            rows[n > 1] -= 1
            columns = [pa.array(arrays.signed(values)), pa.array(n > 1), pa.array(rows)]
            yield pa.RecordBatch.from_arrays(columns, ["anchor", "many", "rows"])

    return run


def _hot_windows(grain: Grain, hot):
    """Every window of a hot anchor by its hash, and whether a batch holds it twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros(0, _U)]
            for _, _, data, offsets in arrays.slices(batch.column(1)):
                hashes, first, _, _ = grain.grams(data, offsets)
                begin, end, anchor = grain.segments(hashes, first)
                chosen = _held(hot.value, hashes[anchor])
                window = _windows(begin[chosen], end[chosen])
                if len(window):
                    found.append(grain.names(hashes, window, window + 1))
            values, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(arrays.signed(values)), pa.array(n > 1)], ["anchor", "many"])

    return run


def _windows(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All windows of some segments."""
    n = end - begin
    return np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _held(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether a filter holds each hash."""
    slot = hashes & _U(len(bits) * 8 - 1)
    return (bits[(slot >> _U(3)).astype(np.int64)] >> (slot & _U(7)).astype(np.uint8) & 1).astype(bool)


def _filter_parts(part_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            slot = batch.column(0).to_numpy()
            which = slot // part_bits
            for part in np.unique(which):
                bits = parts.setdefault(int(part), np.zeros(part_bits, dtype=bool))
                bits[slot[which == part] % part_bits] = True
        for part, bits in parts.items():
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([np.packbits(bits, bitorder="little").tobytes()])], ["part", "bits"])

    return run


def _bit_filter(anchors: DataFrame):
    """A broadcast bit filter that holds every hash of a stored table."""
    spark = anchors.sparkSession
    bits = min(max(FILTER_BITS[0], 1 << (16 * anchors.count()).bit_length()), FILTER_BITS[1])
    slots = anchors.select(F.expr(f"pmod(anchor, {bits}L)").alias("slot"))
    dealt = slots.repartition(F.expr(f"slot div {FILTER_PART_BITS}"))
    whole = np.zeros(bits // 8, dtype=np.uint8)
    size = FILTER_PART_BITS // 8
    # At most FILTER_BITS[1] bits come back, whatever the corpus holds.
    for row in dealt.mapInArrow(_filter_parts(FILTER_PART_BITS), "part long, bits binary").collect():
        whole[row["part"] * size : (row["part"] + 1) * size] |= np.frombuffer(row["bits"], np.uint8)
    return spark.sparkContext.broadcast(whole)


def repeated_anchors(texts: DataFrame, grain: Grain):
    """Filters of the anchors that occur twice, of the hot ones, and of their windows that do; the last two may be None."""
    twice = (F.bool_or("many") | (F.count(F.lit(1)) > 1)).alias("many")
    counted = texts.mapInArrow(_counted(grain), "anchor long, many boolean, rows long")
    counted = counted.groupBy("anchor").agg(twice, F.sum("rows").alias("rows")).filter("many")
    repeated = durable(counted.select("anchor", (F.col("rows") >= grain.hot).alias("hot")), "anchors")
    hot = durable(repeated.filter("hot").select("anchor"), "hot-anchors")
    every = _bit_filter(repeated.select("anchor"))
    if hot.isEmpty():
        return every, None, None
    held = _bit_filter(hot)
    windows = texts.mapInArrow(_hot_windows(grain, held), "anchor long, many boolean")
    windows = durable(windows.groupBy("anchor").agg(twice).filter("many").select("anchor"), "hot-windows")
    return every, held, _bit_filter(windows)


def _sent(grain: Grain, held, hot=None, repeated=None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = held.value
        # content → [id, places (key, start) in that id, ...]: the least id seen in this
        # task, and for bytes its least place; the rest is known to repeat it.
        seen: dict[bytes, list] = {}
        rows: list[tuple] = []

        def told(doc, place, windows, source):
            # No content: a finding. Dealt by document, as its anchor may be hot.
            (key, start), (from_key, from_start) = place, min(source[1])
            if rows:
                _, d, k, s, n, _, content, fd, fk, fs = rows[-1]
                # It goes on where the one before ends, in its document and in its source.
                if content is None and (d, k, s + n, fd, fk, fs + n) == (doc, key, start, source[0], from_key, from_start):
                    rows[-1] = (doc, doc, key, s, n + windows, 0, None, fd, fk, fs)
                    return
            rows.append((doc, doc, key, start, windows, 0, None, source[0], from_key, from_start))

        def flush():
            for content, (doc, places, anchor, windows, lead) in seen.items():
                rows.extend((anchor, doc, *place, windows, lead, content, None, None, None) for place in places)
            seen.clear()

        def ready():
            columns = zip(*rows)
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], _NAMES)
            rows.clear()
            return batch

        for batch in batches:
            ids, keys = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for low, _, data, offsets in arrays.slices(batch.column(1)):
                hashes, first, starts, stops = grain.grams(data, offsets)
                begin, end, anchor = grain.segments(hashes, first)
                name = hashes[anchor]
                hit = _held(bits, name)
                begin, end, lead, name = begin[hit], end[hit], (anchor - begin)[hit], name[hit]
                if hot is not None and (warm := _held(hot.value, name)).any():
                    window = _windows(begin[warm], end[warm])
                    own = grain.names(hashes, window, window + 1)
                    window, own = (x[_held(repeated.value, own)] for x in (window, own))
                    begin, end, lead, name = (
                        np.r_[x[~warm], y] for x, y in ((begin, window), (end, window + 1), (lead, np.zeros(len(window), np.int64)), (name, own))
                    )
                owner = np.searchsorted(first, begin, side="right") - 1
                last = end - 1 + grain.length - 1
                left, right = (begin, last + 1) if starts is None else (starts[begin], stops[last])
                raw = data.tobytes()
                named = arrays.signed(name)
                for doc, start, windows, lead, h, a, b in zip(
                    owner.tolist(), (begin - first[owner]).tolist(), (end - begin).tolist(), lead.tolist(), named.tolist(), left.tolist(), right.tolist()
                ):
                    doc, place = ids[low + doc], (keys[low + doc], start)
                    content = raw[a:b]
                    if grain.of_words:
                        content = b" ".join(content.split())
                    known = seen.get(content)
                    if known is None:
                        seen[content] = [doc, [place], h, windows, lead]
                    elif grain.of_words and doc == known[0]:
                        if place not in known[1]:
                            known[1].append(place)
                    elif (doc, place) > (known[0], known[1][0]):
                        told(doc, place, windows, known)
                    elif (doc, place) < (known[0], known[1][0]):
                        old, known[0], known[1] = (known[0], known[1]), doc, [place]
                        for at in old[1]:
                            told(old[0], at, windows, known)
                if len(seen) > REMEMBERED:
                    flush()
                if len(rows) > 20_000:
                    yield ready()
        flush()
        while rows:
            yield ready()

    return run


def repeated_segments(texts: DataFrame, grain: Grain) -> DataFrame:
    """Segments of repeated anchors, at the bucket of their anchor, sorted by it.

    ``texts`` is (doc_id, text, doc_key) without NULL ids. A task sends equal
    segments once, with their least place; the other places come as findings:
    rows without content that name the place they repeat.
    """
    bound_batches(texts.sparkSession)
    sent = texts.mapInArrow(_sent(grain, *repeated_anchors(texts, grain)), SEGMENT)
    return sent.repartition("anchor").sortWithinPartitions("anchor")


def blocks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.Table]:
    """Whole anchors at a time: tables of about ``limit`` windows, or one larger anchor."""
    pending: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        anchor = batch.column(0).to_numpy()
        if pending and pending[-1].column(0)[-1].as_py() != anchor[0]:
            total = sum(int(np.sum(b.column(4).to_numpy())) for b in pending)
            if total >= limit:
                yield pa.Table.from_batches(pending)
                pending = []
        edge = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
        running = np.cumsum(batch.column(4).to_numpy().astype(np.int64))
        at = 0
        held = sum(int(np.sum(b.column(4).to_numpy())) for b in pending)
        while True:
            spent = running[at - 1] if at else 0
            later = edge[(edge > at) & (running[edge - 1] - spent + held >= limit)]
            if not len(later):
                break
            pending.append(batch.slice(at, later[0] - at))
            yield pa.Table.from_batches(pending)
            pending, at, held = [], int(later[0]), 0
        pending.append(batch.slice(at))
    if pending:
        yield pa.Table.from_batches(pending)
