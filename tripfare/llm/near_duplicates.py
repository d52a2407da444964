"""Near-duplicate groups of documents: SuperMinHash, banding, verification, union-find."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tripfare.llm import arrays
from tripfare.llm.tables import bound_batches, components, small
from tripfare.operators.durable import durable

_U = np.uint64
_STEP = 0x9E3779B97F4A7C15
PARITY = tuple(f"parity_{i}" for i in range(8))


@dataclass(frozen=True)
class NearDuplicates:
    """Documents are linked at ``percent`` % of Jaccard similarity over ``shingle``-word runs.

    A pair at similarity s shares no band with probability (1 - s**rows)**bands:
    2e-8 at 0.85 and 7e-6 at 0.8 with the values below. ``rounds`` bounds the
    random rounds that come before the full comparison; it changes no result.
    """

    percent: int = 80
    shingle: int = 5
    bands: int = 30
    rows: int = 5
    rounds: int = 3


def shingle_sets(column: pa.Array, shingle: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row range, distinct shingle hashes of all its texts in text order, and the size of each set."""
    for low, high, data, offsets in arrays.slices(column):
        starts, stops, first = arrays.words(data, offsets)
        word = arrays.span_hashes(data, starts, stops, lower=True)
        runs = arrays.run_hashes(word, shingle)
        sets = []
        for a, b in zip(first[:-1], first[1:]):
            if b - a >= shingle:
                found = np.sort(runs[a : b - shingle + 1])
                sets.append(found[np.r_[True, found[1:] != found[:-1]]])
            elif b > a:
                sets.append(arrays.run_hashes(word[a:b], int(b - a)))
            else:
                sets.append(np.zeros(0, _U))
        yield low, high, np.concatenate(sets), np.array([len(s) for s in sets])


def super_minhash(elements: np.ndarray, sizes: np.ndarray, m: int) -> np.ndarray:
    """SuperMinHash signatures of consecutive sets: one row of ``m`` slots per set.

    Every element visits the slots in an order of its own, drawn step by step
    (a Fisher-Yates shuffle seeded by the element). At step j it offers j plus a
    random fraction to the j-th slot of its order; a slot keeps the least offer.
    Later steps can't win a filled slot, so a set stops as soon as all are filled.
    """
    owner = np.repeat(np.arange(len(sizes)), sizes)
    signature = np.full((len(sizes), m), np.iinfo(_U).max, dtype=_U)
    cells = signature.reshape(-1)
    pending = sizes > 0
    order = None

    def draw(x: np.ndarray, j: int) -> tuple[np.ndarray, np.ndarray]:
        bits = arrays.mix(x + _U((j + 1) * _STEP & (1 << 64) - 1))
        slot = (((bits >> _U(32)) * _U(m - j)) >> _U(32)).astype(np.int64) + j
        return slot, (bits & _U(0xFFFFFFFF)) | _U(j << 32)

    x = elements
    for j in range(m):
        if not pending.any():
            break
        if j:
            keep = pending[owner]
            if order is None:
                x, owner = x[keep], owner[keep]
                order = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.uint16), (len(x), 1))
                line = np.arange(len(x))
                slot, _ = draw(x, 0)
                order[line, slot], order[:, 0] = 0, slot
            elif 2 * keep.sum() < len(keep):
                x, owner, order = x[keep], owner[keep], order[keep]
                line = np.arange(len(x))
        slot, offer = draw(x, j)
        if j:
            chosen = order[line, slot]
            order[line, slot] = order[:, j]
            order[:, j] = chosen
            slot = chosen.astype(np.int64)
        np.minimum.at(cells, owner * m + slot, offer)
        pending = pending & (signature.max(axis=1) >> _U(32) > _U(j))
    return signature


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = signature.reshape(len(signature), bands, rows)
    total = np.broadcast_to(np.arange(1, bands + 1, dtype=_U) * _U(_STEP), parts.shape[:2]).copy()
    for j in range(rows):
        total = arrays.mix(total + parts[:, :, j])
    return total


def _set_keys(elements: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    return [hashlib.blake2b(elements[b - n : b].tobytes(), digest_size=16).digest() for b, n in zip(np.cumsum(sizes), sizes)]


def _signed(settings: NearDuplicates):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, elements, sizes in shingle_sets(batch.column(1), settings.shingle):
                signature = super_minhash(elements, sizes, settings.bands * settings.rows)
                bands = band_hashes(signature, settings.bands, settings.rows)[sizes > 0]
                counts = np.where(sizes > 0, settings.bands, 0)
                keys = _set_keys(elements, sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low),
                        batch.column(2).slice(low, high - low),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(keys, pa.binary()),
                        pa.ListArray.from_arrays(np.r_[0, np.cumsum(counts)].astype(np.int32), pa.array(arrays.signed(bands.reshape(-1)))),
                    ],
                    ["doc_id", "text_hash", "n_shingles", "set_key", "bands"],
                )

    return run


def parities(elements: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per set, 512 bits: is the number of elements that fall on the bit odd? As 8 longs."""
    bits = 64 * len(PARITY)
    cell = np.repeat(np.arange(len(sizes)), sizes) * bits + (elements & _U(bits - 1)).astype(np.int64)
    odd = (np.bincount(cell, minlength=bits * len(sizes)) & 1).astype(np.uint8).reshape(len(sizes), bits)
    return np.packbits(odd, axis=1, bitorder="little").view("<i8")


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, elements, sizes in shingle_sets(batch.column(2), shingle):
                lists = pa.ListArray.from_arrays(np.r_[0, np.cumsum(sizes)].astype(np.int32), pa.array(arrays.signed(elements)))
                odd = [pa.array(np.ascontiguousarray(c)) for c in parities(elements, sizes).T]
                found = pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), lists, *odd], ["node", "elements", *PARITY])
                # Texts that share id and hash with that of the node, but are not it, go.
                wanted = batch.column(1).slice(low, high - low).to_pylist()
                yield found.filter(pa.array([k == w for k, w in zip(_set_keys(elements, sizes), wanted)], pa.bool_()))

    return run


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) with the sizes of the full sets and of what they share."""
    of = lambda side: sets.select(F.col("node").alias(side), F.col("elements").alias(f"set_{side}"))
    # The pair waits at the larger id, so the set that travels is the other one's.
    met = pairs.join(of("a"), "a").join(of("b"), "b")
    return met.select(
        "a", "b", F.size("set_a").alias("n_a"), F.size("set_b").alias("n_b"), F.size(F.array_intersect("set_a", "set_b")).alias("shared")
    )


def _mixed(members: DataFrame, groups: DataFrame) -> DataFrame:
    """Members of buckets that hold several groups, with their group and the largest of the bucket."""
    grouped = members.join(groups, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    sizes = grouped.groupBy("band", "component").count()
    several = sizes.groupBy("band").agg(F.max_by("component", F.struct("count", "component")).alias("main"), F.count("*").alias("n"))
    return grouped.join(several.filter("n > 1").select("band", "main"), "band")


def _stars(groups: DataFrame) -> DataFrame:
    return groups.select(F.col("node").alias("u"), F.col("component").alias("v"))


def near_duplicates(docs: DataFrame, settings: NearDuplicates = NearDuplicates()) -> DataFrame:
    """Group near-duplicate documents: (doc_id, n_shingles, component_id, kept), as ``near_duplicate_rows`` does."""
    return near_duplicate_rows(docs, settings).drop("text_hash", "stays")


def near_duplicate_rows(docs: DataFrame, settings: NearDuplicates = NearDuplicates()) -> DataFrame:
    """Group near-duplicate documents: (doc_id, text_hash, n_shingles, component_id, kept, stays).

    1. One pass over the texts gives the size, a key of the whole shingle set,
       and the band hashes of its SuperMinHash signature.
    2. Documents with equal sets are one class, stood for by its row of least id
       (and hash of the text) under a number of its own; so a group of copies of
       any size takes part once, and rows that share an id stay apart.
    3. In each band bucket all members are compared with its least member, on
       full sets, and in further rounds with members drawn from its largest
       group. Members of a bucket that are not in one group after that are
       compared with each other, save those ruled out by the triangle inequality
       of the Jaccard distance (to the least member) or by the parity bits of
       their sets; both bounds are exact. No link between
       candidates is lost and no group of linked ones is expanded into pairs.
    4. Links go through union-find (``components``).

    NULL, empty and wordless texts have an empty set and are linked with
    nothing. Rows are told apart by id and text: rows that share an id are
    judged each by its own text. ``kept`` says that the id is the least of its
    group; ``stays`` also that, of several texts with that id, it is the first.
    Rows with equal id and text are all returned. A row without id is returned
    with its own NULL component, as one that is kept and stays. Other columns
    are ignored; an empty table gives no rows.
    """
    bound_batches(docs.sparkSession)
    text = F.col("text").cast("string")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    schema = "doc_id long, text_hash long, n_shingles long, set_key binary, bands array<long>"
    signed = durable(texts.mapInArrow(_signed(settings), schema), "signatures")

    usable = signed.filter("n_shingles > 0 and doc_id is not null")
    first = F.min(F.struct("doc_id", "text_hash")).alias("first")
    classes = usable.groupBy("set_key").agg(first).select("set_key", "first.*", F.monotonically_increasing_id().alias("node"))
    classes = durable(classes, "classes")
    leaders = usable.join(classes, ["set_key", "doc_id", "text_hash"]).select("node", "n_shingles", F.explode("bands").alias("band"))
    shared = leaders.groupBy("band").agg(F.min("node").alias("pivot"), F.max("node").alias("last")).filter("pivot < last")
    members = durable(leaders.join(shared.drop("last"), "band").dropDuplicates(["band", "node"]), "bucket-members")

    ids = durable(members.select("node").distinct().join(classes, "node"), "candidates")
    chosen = texts.join(small(ids), ["doc_id", "text_hash"]).select("node", "set_key", "text")
    sets = durable(chosen.mapInArrow(_sets(settings.shingle), f"node long, elements array<long>, {', '.join(f'{c} long' for c in PARITY)}"), "shingle-sets")
    # Only rows of one node, which have equal sets, are merged.
    sets = sets.dropDuplicates(["node"])
    star = members.filter("node > pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    known = durable(_compared(star, sets), "compared-with-pivot")
    is_link = F.col("shared") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("shared")) * settings.percent
    links = known.filter(is_link).select(F.col("a").alias("u"), F.col("b").alias("v"))
    groups = durable(components(links), "groups")

    # Members of one bucket in different groups, with the parity bits of their sets.
    # Two sets differ by at least as many elements as their parities differ by bits.
    apart = _mixed(members, groups).select("node").distinct()
    members = durable(members.join(apart, "node", "left_semi").join(sets.select("node", *PARITY), "node"), "open-members")

    def possible(x: str, y: str):
        differ = sum((F.bit_count(F.col(f"{x}{c}").bitwiseXOR(F.col(f"{y}{c}"))) for c in PARITY), F.lit(0))
        both = F.col(f"{x}n_shingles") + F.col(f"{y}n_shingles")
        return differ * (100 + settings.percent) <= both * (100 - settings.percent)

    # They meet members of the largest group of the bucket, drawn at random: a large
    # group of near copies falls together in a few rounds.
    compared = known
    for turn in range(settings.rounds):
        mixed = durable(_mixed(members, groups), "mixed-buckets")
        drawn = mixed.filter("component = main").groupBy("band").agg(
            F.min_by(F.struct("node", "n_shingles", *PARITY), F.xxhash64("node", "band", F.lit(turn))).alias("met")
        )
        pairs = (
            mixed.filter("component <> main")
            .join(drawn, "band")
            .filter(possible("", "met."))
            .select(F.least("node", "met.node").alias("a"), F.greatest("node", "met.node").alias("b"))
            .distinct()
            .join(compared, ["a", "b"], "left_anti")
        )
        found = durable(_compared(pairs, sets), "compared-at-random")
        new_links = found.filter(is_link).select(F.col("a").alias("u"), F.col("b").alias("v"))
        if new_links.isEmpty():
            break
        compared = compared.unionByName(found)
        groups = durable(components(_stars(groups).unionByName(new_links)), "groups")

    # What is left is compared in full, save what the triangle inequality rules out.
    distance = 1 - F.col("shared") / (F.col("n_a") + F.col("n_b") - F.col("shared"))
    away = known.select(F.col("a").alias("pivot"), F.col("b").alias("node"), distance.alias("away"))
    mixed = durable(_mixed(members.join(away, ["pivot", "node"]), groups), "mixed-buckets")
    radius = (100 - settings.percent) / 100 + 1e-9
    open_pairs = (
        mixed.filter("component <> main").alias("x").join(mixed.alias("y"), F.col("x.band") == F.col("y.band"))
        .filter("x.component <> y.component and (y.component = y.main or x.node < y.node)")
        .filter(F.abs(F.col("x.away") - F.col("y.away")) <= radius)
        .filter(possible("x.", "y."))
        .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
        .distinct()
        .join(compared, ["a", "b"], "left_anti")
    )
    more = _compared(open_pairs, sets).filter(is_link).select(F.col("a").alias("u"), F.col("b").alias("v"))
    final = durable(components(_stars(groups).unionByName(more)), "final-groups")

    # A group is named by its least id; of its classes with that id one is kept.
    whole = final.unionByName(final.select(F.col("component").alias("node"), "component").distinct())
    least = whole.join(classes, "node").groupBy("component").agg(F.min(F.struct("doc_id", "set_key")).alias("least"))
    named = whole.join(least, "component").select("node", "least")
    of_class = classes.join(named, "node", "left").select(
        "set_key",
        F.coalesce("least.doc_id", "doc_id").alias("component"),
        (F.coalesce("least.set_key", "set_key") == F.col("set_key")).alias("leads"),
        F.col("text_hash").alias("first_hash"),
    )
    linked = signed.join(of_class, "set_key", "left")
    judged = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    first = F.col("leads") & (F.col("doc_id") == F.col("component")) & (F.col("text_hash") == F.col("first_hash"))
    return linked.select(
        "doc_id",
        "text_hash",
        "n_shingles",
        F.when(judged, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(judged, F.col("doc_id") == F.col("component")).otherwise(F.lit(True)).alias("kept"),
        F.when(judged, first).otherwise(F.lit(True)).alias("stays"),
    )
