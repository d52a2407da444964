"""Phrase collocations by dynamic itemset counting: lengths interleave in cyclic scans of shards."""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tripfare.llm import arrays
from tripfare.llm.tables import bound_batches
from tripfare.operators.durable import durable

_U = np.uint64

# Bytes that part the words of a piece, and those that end a piece.
BLANKS, ENDS = b"\x20\x09", b".,;:!?\x0a\x0b\x0c\x0d"
_IS_END = np.zeros(256, dtype=bool)
_IS_END[list(ENDS)] = True
_SEPARATORS = _IS_END.copy()
_SEPARATORS[list(BLANKS)] = True

NEVER = 255
SLOT_PART = 1 << 18
# Counts that a task holds before it merges them, and sends what is left.
HELD_COUNTS = 1 << 21
# Phrases with their counts are sent to every executor up to this many bytes.
BROADCAST_BYTES = 32 << 20
# Counts travel packed, by the upper bits of the hash: one bucket for so many bytes of text.
BUCKET_TEXT = 4 << 20
BUCKET_BITS = (4, 16)

# Documents are dealt into so many groups; a phrase remembers one that holds it.
GROUPS = 256

# Counts of phrases of one size, active since one step, in the order of their hashes,
# with a group of documents each is found in; ``frequent`` holds the hashes of those
# that reach the threshold.
COUNTS = "bucket int, since int, size int, hashes binary, counts binary, groups binary, frequent binary"


@dataclass(frozen=True)
class Phrases:
    """Phrases of 2 to ``longest`` words that occur ``least`` times in their language.

    A phrase is known by a 64-bit hash of its words and language.

    The corpus is scanned in ``shards`` turns. ``slots`` is the length of the
    table that tells when a phrase was found frequent; a crowded table lets more
    phrases be counted than need be, but never one too few.
    """

    least: int = 30
    longest: int = 4
    shards: int = 4
    slots: int = 1 << 25
    scale: int = 2_000_000
    inside_percent: int = 80
    top: int = 2000

    def __post_init__(self):
        if self.slots % SLOT_PART or self.slots & (self.slots - 1):
            raise ValueError(f"slots is a power of two and at least {SLOT_PART}")
        if not 1 <= self.shards <= 50 or not 2 <= self.longest <= 5:
            raise ValueError("1 to 50 shards, phrases of up to 5 words")


def _lang_salt(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


class _Runs:
    """Words of the texts of one language, and the hashes of runs of them inside pieces."""

    def __init__(self, lang: str, data: np.ndarray, offsets: np.ndarray, groups: np.ndarray):
        self.data = data
        self.starts, self.stops, first = arrays.words(data, offsets, _SEPARATORS)
        self.hashes = arrays.mix(arrays.span_hashes(data, self.starts, self.stops, lower=True) ^ _U(_lang_salt(lang)))
        # A piece is told by its text and the ends of pieces before it.
        piece = np.cumsum(_IS_END[data], dtype=np.int64)[self.starts]
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        self.linked = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])
        self.groups = groups[text]

    def of(self, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each size, the hash of the run from each word on, and whether one piece holds it."""
        inside = np.ones(len(self.hashes), dtype=bool)
        for size in range(1, longest + 1):
            if size > 1:
                inside = inside[:-1] & self.linked[size - 2 :]
            if not len(inside):
                return
            yield size, self.hashes if size == 1 else arrays.run_hashes(self.hashes, size), inside


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, _Runs]]:
    """Slices of the texts of batches (lang, text, doc_group), each of one language."""
    for batch in batches:
        lang = batch.column(0).dictionary_encode()
        for code, name in enumerate(lang.dictionary.to_pylist()):
            mine = pa.array(lang.indices.to_numpy() == code)
            groups = batch.column(2).filter(mine).to_numpy().astype(np.uint8)
            for low, high, data, offsets in arrays.slices(batch.column(1).filter(mine)):
                yield name, _Runs(name, data, offsets, groups[low:high])


_unpacked: dict[str, np.ndarray] = {}


def _sent(spark, table: np.ndarray):
    """A table for all tasks of one job, packed: nearly all of it is one value."""
    return spark.sparkContext.broadcast((uuid.uuid4().hex, table.dtype.str, zlib.compress(table, 1)))


def _received(sent) -> np.ndarray:
    """The table, unpacked once in each worker."""
    name, kind, packed = sent.value
    if name not in _unpacked:
        _unpacked.clear()
        _unpacked[name] = np.frombuffer(zlib.decompress(packed), kind)
    return _unpacked[name]


def _slot(hashes: np.ndarray, slots: int) -> np.ndarray:
    return (hashes & _U(slots - 1)).astype(np.int64)


def _narrow(counts: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest takes."""
    width = next(w for w in (1, 2, 4, 8) if w == 8 or not len(counts) or counts.max() < 1 << 8 * w - 1)
    return counts.astype(f"<i{width}").tobytes()


def _widened(packed: bytes, n: int) -> np.ndarray:
    return np.frombuffer(packed, f"<i{len(packed) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


def _row(bucket: int, since: int, size: int, hashes, counts, groups, frequent) -> tuple:
    return bucket, since, size, hashes.tobytes(), _narrow(counts), groups.tobytes(), frequent.tobytes()


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [*[pa.int32()] * 3, *[pa.binary()] * 4]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [part.split()[0] for part in COUNTS.split(", ")])


def _totals(hashes: list, counts: list, groups: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each hash once, in order, with the sum of its counts and one of its groups."""
    joined, n = np.concatenate(hashes), np.concatenate(counts)
    order = np.argsort(joined, kind="stable")
    first = np.flatnonzero(np.r_[True, joined[order][1:] != joined[order][:-1]])
    if not len(joined):
        return joined, n, np.concatenate(groups)
    return joined[order[first]], np.add.reduceat(n[order], first), np.concatenate(groups)[order[first]]


class _Held:
    """Counts of a task, by size and first step; equal phrases are merged when many are held."""

    def __init__(self, bits: int):
        self.bits = bits
        self.parts: dict[tuple[int, int], tuple[list, list, list]] = {}
        self.rows = 0

    def add(self, hashes: np.ndarray, size: int, since: np.ndarray, groups: np.ndarray) -> None:
        for step in np.unique(since).tolist():
            mine = since == step
            found = _totals([hashes[mine]], [np.ones(int(mine.sum()), np.int64)], [groups[mine]])
            for held, new in zip(self.parts.setdefault((step, size), ([], [], [])), found):
                held.append(new)
            self.rows += len(found[0])

    def merge(self) -> None:
        self.parts = {kind: tuple([x] for x in _totals(*held)) for kind, held in self.parts.items()}
        self.rows = sum(len(held[0][0]) for held in self.parts.values())

    def take(self) -> Iterator[pa.RecordBatch]:
        """All counts, in rows of one bucket each."""
        self.merge()
        none = np.zeros(0, _U)
        for (since, size), ((keys,), (n,), (groups,)) in self.parts.items():
            bucket = (keys >> _U(64 - self.bits)).astype(np.int64)
            edges = np.r_[0, np.flatnonzero(np.diff(bucket)) + 1, len(keys)]
            rows = [_row(int(bucket[a]), since, size, keys[a:b], n[a:b], groups[a:b], none) for a, b in zip(edges[:-1], edges[1:]) if b > a]
            for low in range(0, len(rows), 500):
                yield _as_batch(rows[low : low + 500])
        self.parts, self.rows = {}, 0


def _summed(least: int, only_frequent: bool):
    """Sums of packed counts, which come bucket by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[list, list, list]] = {}

        def told(bucket: int) -> Iterator[pa.RecordBatch]:
            for (since, size), parts in held.items():
                keys, n, groups = _totals(*parts)
                often = n >= least
                if only_frequent:
                    keys, n, groups, often = keys[often], n[often], groups[often], often[often]
                yield _as_batch([_row(bucket, since, size, keys, n, groups, keys[often])])
            held.clear()

        at = None
        for batch in batches:
            for bucket, since, size, hashes, counts, groups, _ in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket != at:
                    if held:
                        yield from told(at)
                    at = bucket
                mine = held.setdefault((since, size), ([], [], []))
                keys = np.frombuffer(hashes, _U)
                for part, new in zip(mine, (keys, _widened(counts, len(keys)), np.frombuffer(groups, np.uint8))):
                    part.append(new)
        if held:
            yield from told(at)

    return run


def _in_buckets(counts: DataFrame, least: int, only_frequent: bool) -> DataFrame:
    return counts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_summed(least, only_frequent), COUNTS)


def _unpacked_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for size, hashes, counts in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4))):
            keys = np.frombuffer(hashes, np.int64)
            columns = [pa.array(keys), pa.array(np.full(len(keys), size, np.int32)), pa.array(_widened(counts, len(keys)))]
            yield pa.RecordBatch.from_arrays(columns, ["hash", "size", "n"])


def _by_group(hashes: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two keys of each phrase together with a group of documents."""
    key = arrays.mix(hashes + (groups.astype(_U) + _U(1)) * _U(0x9E3779B97F4A7C15))
    return key, arrays.mix(key + _U(1))


def _frequent_slots(slots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = np.frombuffer(b"".join(batch.column(0).to_pylist()), _U)
            yield pa.RecordBatch.from_arrays([pa.array(_slot(hashes, slots))], ["slot"])

    return run


def _grouped_slots(slots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, groups = (np.frombuffer(b"".join(c.to_pylist()), kind) for c, kind in zip(batch.columns, (_U, np.uint8)))
            yield pa.RecordBatch.from_arrays([pa.array(_slot(np.concatenate(_by_group(hashes, groups)), slots))], ["slot"])

    return run


def _scanned(step: int, found, settings: Phrases, bits: int):
    """Counts of the phrases that are active in this step.

    A word is active from step 0 on, a longer phrase from the step on in which
    both phrases that it extends were found frequent; each for one full cycle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, held = _received(found), _Held(bits)
        for _, runs in _by_language(batches):
            before = None
            for size, hashes, inside in runs.of(settings.longest):
                since = np.zeros(len(hashes), np.uint8) if size == 1 else np.maximum(before[:-1], before[1:])
                active = inside & (since <= step) & (since + np.int64(settings.shards) > step)
                held.add(hashes[active], size, since[active], runs.groups[: len(hashes)][active])
                if size < settings.longest:
                    if not (since <= step).any():
                        break
                    # Runs across pieces have no place in the table. Where phrases share
                    # a place, it may be marked before this one is even counted.
                    before = np.where(inside, np.maximum(table[_slot(hashes, settings.slots)], since), NEVER)
            if held.rows > HELD_COUNTS:
                held.merge()
                if held.rows > HELD_COUNTS // 2:
                    yield from held.take()
        yield from held.take()

    return run


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts: dict[int, np.ndarray] = {}
    for batch in batches:
        slot = batch.column(0).to_numpy()
        for part in np.unique(slot // SLOT_PART).tolist():
            mine = slot[slot // SLOT_PART == part]
            parts.setdefault(part, np.zeros(SLOT_PART, dtype=bool))[mine % SLOT_PART] = True
    for part, bits in parts.items():
        yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([np.packbits(bits).tobytes()])], ["part", "bits"])


def marked_slots(places: DataFrame, slots: int) -> np.ndarray:
    """Which of ``slots`` are among ``places`` (slot): at most slots / 8 bytes come back."""
    dealt = places.repartition(F.expr(f"slot div {SLOT_PART}"))
    marked = np.zeros(slots, dtype=bool)
    for row in dealt.mapInArrow(_bits, "part long, bits binary").collect():
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8)).view(bool)
        marked[row["part"] * SLOT_PART : (row["part"] + 1) * SLOT_PART] |= bits
    return marked


def slots_of(frequent: DataFrame, slots: int) -> np.ndarray:
    """Places of the packed hashes ``frequent``."""
    return marked_slots(frequent.select("frequent").mapInArrow(_frequent_slots(slots), "slot long"), slots)


def frequent_hashes(texts: DataFrame, settings: Phrases) -> DataFrame:
    """Packed counts of all runs of up to ``longest`` words that occur ``least`` times.

    ``texts`` is (lang, text, shard, doc_group). Step t scans shard t modulo ``shards`` and
    counts all active phrases of any length at once. A phrase is found frequent
    as soon as one shard holds it often enough, or else when its cycle is
    complete; from the next step on, phrases that it lets extend are active.
    A phrase that is frequent in the end has only frequent parts, each found at
    the end of its cycle at the latest, so none is missed; the scans end when
    every active phrase has completed its cycle, after ``longest`` cycles at most.
    """
    spark = texts.sparkSession
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(max(BUCKET_BITS[0], (size // BUCKET_TEXT).bit_length()), BUCKET_BITS[1])
    since = np.full(settings.slots, NEVER, dtype=np.uint8)
    tables: list[DataFrame] = []
    complete: list[DataFrame] = []
    latest = step = 0
    while step < latest + settings.shards:
        sent = _sent(spark, since)
        shard = texts.filter(F.col("shard") == step % settings.shards).select("lang", "text", "doc_group")
        scanned = shard.mapInArrow(_scanned(step, sent, settings, bits), COUNTS)
        tables.append(durable(_in_buckets(scanned, settings.least, False), "phrase-counts"))
        found = [tables[-1]]
        oldest = step - settings.shards + 1
        if oldest >= 0:
            cycle = reduce(DataFrame.unionByName, [t.filter(F.col("since") == oldest) for t in tables[oldest:]])
            complete.append(durable(_in_buckets(cycle, settings.least, True), "phrases-complete"))
            found.append(complete[-1])
        shorter = [t.filter(F.col("size") < settings.longest) for t in found]
        marked = slots_of(reduce(DataFrame.unionByName, shorter), settings.slots) & (since == NEVER)
        # What it was needed for is stored.
        sent.destroy()
        step += 1
        if marked.any():
            since = np.where(marked, np.uint8(step), since)
            latest = step
    return reduce(DataFrame.unionByName, complete)


def _named(found, settings: Phrases):
    """Words of the runs that are in the table with the group of their text, and the words of a language (phrase NULL)."""
    names = ["lang", "hash", "phrase", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _received(found)
        words: dict[str, int] = {}
        for lang, runs in _by_language(batches):
            words[lang] = words.get(lang, 0) + len(runs.starts)
            low = arrays.LOWER[runs.data].tobytes()
            for size, hashes, inside in runs.of(settings.longest):
                at = np.flatnonzero(inside)
                one, two = (_slot(key, settings.slots) for key in _by_group(hashes[at], runs.groups[at]))
                at = at[table[one] & table[two]]
                keys, first = np.unique(hashes[at], return_index=True)
                if not len(keys):
                    continue
                at = at[first]
                spans = [(runs.starts[at + j].tolist(), runs.stops[at + j].tolist()) for j in range(size)]
                parts = [[low[a:b] for a, b in zip(*span)] for span in spans]
                phrase = [p.decode() for p in (parts[0] if size == 1 else map(b" ".join, zip(*parts)))]
                columns = [pa.array([lang] * len(keys)), pa.array(arrays.signed(keys)), pa.array(phrase), pa.nulls(len(keys), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names)
        none = [None] * len(words)
        columns = [pa.array(words.keys(), pa.string()), pa.array(none, pa.int64()), pa.array(none, pa.string()), pa.array(words.values(), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names)

    return run


def frequent_phrases(texts: DataFrame, settings: Phrases) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, a) of all frequent runs of words, and (lang, n) of all words.

    The counts are by hash. One more scan reads the words of each run, in the
    documents of one group that is known to hold it: so it is named a few times
    at most, however many tasks there are.
    """
    packed = frequent_hashes(texts, settings)
    counts = packed.mapInArrow(_unpacked_counts, "hash long, size int, n long").withColumnRenamed("n", "a")
    places = packed.select("hashes", "groups").mapInArrow(_grouped_slots(settings.slots), "slot long")
    sent = _sent(texts.sparkSession, marked_slots(places, settings.slots))
    named = texts.select("lang", "text", "doc_group").mapInArrow(_named(sent, settings), "lang string, hash long, phrase string, n long")
    told = named.groupBy("hash", "lang", F.col("phrase").isNull().alias("whole")).agg(F.min("phrase").alias("phrase"), F.sum("n").alias("n"))
    told = durable(told, "named-runs")
    sent.destroy()
    kept = told.filter("not whole").join(counts, "hash").select("lang", "phrase", "size", "a")
    return durable(kept, "phrases"), told.filter("whole").select("lang", "n")


def _bounded(rows: DataFrame) -> DataFrame:
    """A stored table, marked for broadcast if its texts and counts are few enough."""
    size = rows.agg(F.sum(F.octet_length("phrase") + F.octet_length("lang") + 64)).first()[0] or 0
    return F.broadcast(rows) if size <= BROADCAST_BYTES else rows


def _exact(column: str) -> Column:
    return F.col(column).cast("decimal(20,0)")


def scored(frequent: DataFrame, settings: Phrases) -> DataFrame:
    """(lang, phrase, size, a, l, r, score) of every candidate, by its lowest cut."""
    part = _bounded(frequent.select(F.col("lang"), F.col("phrase"), F.col("a").alias("part_a")))
    candidates = frequent.filter("size > 1").withColumn("w", F.split("phrase", " "))
    cuts = candidates.select("lang", "phrase", "size", "a", "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "lang", "phrase", "size", "a", "k",
        F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("right"),
    )
    for side, count in (("left", "l"), ("right", "r")):
        cuts = cuts.join(part.select(F.col("lang"), F.col("phrase").alias(side), F.col("part_a").alias(count)), ["lang", side])
    # Decimals: the product may pass 64 bits.
    score = F.expr(f"(cast(a as decimal(20,0)) * {settings.scale}) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    lowest = cuts.withColumn("score", score).groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return lowest.select("lang", "phrase", "size", "a", "cut.l", "cut.r", "cut.score")


def not_inside(candidates: DataFrame, settings: Phrases) -> DataFrame:
    """Candidates that no longer one holds nearly as often."""
    longer = candidates.filter("size > 2").select("lang", "a", "size", F.split("phrase", " ").alias("w"))
    inner = [
        longer.filter(F.col("size") > size).select(
            "lang", "a", F.explode(F.transform(F.sequence(F.lit(1), F.col("size") - size + 1), lambda i: F.array_join(F.slice("w", i, size), " "))).alias("phrase")
        )
        for size in range(2, settings.longest)
    ]
    if not inner:
        return candidates
    most = reduce(DataFrame.unionByName, inner).groupBy("lang", "phrase").agg(F.max("a").alias("longer_a"))
    held = _exact("longer_a") * 100 >= _exact("a") * settings.inside_percent
    return candidates.join(most, ["lang", "phrase"], "left").filter(~F.coalesce(held, F.lit(False))).drop("longer_a")


def phrases(docs: DataFrame, settings: Phrases = Phrases()) -> DataFrame:
    """Highest-scoring phrases of each language: (lang, rank, phrase, a, l, r, n, score, size).

    Texts are lower-cased (A-Z), parted at ``.,;:!?`` and line ends into pieces,
    and those at blanks and tabs into words. ``a`` counts a phrase, ``l`` and
    ``r`` the parts of its weakest cut, ``n`` all words of the language.
    ``score`` is floor(scale * a / (l + r)). Phrases inside a longer candidate
    that is nearly as frequent are left out. Ties are ordered by ``a``, then by
    the bytes of the phrase.

    ``docs`` is scanned ``longest`` times and once more for the words of the
    phrases, so pass a stored table. Only a table of ``slots`` bytes, however
    large the corpus, passes through the driver and is sent to all executors;
    counts and phrases stay in Spark.

    A NULL lang is ``und``; NULL, empty and wordless texts have no words. Every
    row counts, also one without id or one that repeats another. Other columns
    are ignored; an empty table, or one without a frequent phrase, gives no rows.
    """
    bound_batches(docs.sparkSession)
    dealt = F.xxhash64(F.col("doc_id").cast("string"))
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.col("text").cast("string").alias("text"),
        F.pmod(dealt, F.lit(settings.shards)).alias("shard"),
        F.pmod(F.shiftright(dealt, 20), F.lit(GROUPS)).cast("int").alias("doc_group"),
    ).filter("text is not null")
    frequent, words = frequent_phrases(texts, settings)
    kept = not_inside(scored(frequent, settings), settings)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= settings.top)
    columns = ["lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "size"]
    return ranked.join(words, "lang").select(*columns)
