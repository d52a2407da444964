"""Each operator against brute force over odd texts, and on odd tables."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import passage
from tripfare.llm import arrays, exact_search, graph_dedup as gd, repeats, sharding, suffix_dedup as sd
from tripfare.llm.decontamination import decontamination
from tripfare.llm.exact_search import exact_top_k
from tripfare.llm.graph_dedup import graph_dedup, repeated_paths
from tripfare.llm.language import LanguageSettings, fit_language, in_a_language, language_id, remainder
from tripfare.llm.language_model import score_texts
from tripfare.llm.mixing import MixingSettings, fit_domains, fit_rates, mix, posteriors, rated
from tripfare.llm.near_duplicates import NearDuplicates, near_duplicates, super_minhash
from tripfare.llm.suffix_dedup import suffix_dedup
from tripfare.llm.token_files import BLOCKS, Encoder, pack, read_tokens, token_ids, token_table, unpack, write_tokens

ITEMS = [
    (1, passage(5, 12_000)[200:600]),
    (2, passage(4, 50).title()),
    (30, "one two three four"),
    (4, None),
    (5, "  "),
    (None, passage(100, 20)),
    (6, passage(777, 30)),
    (6, "One"),
]


def by_id(frame, *columns):
    return {r[0]: tuple(r[1:]) for r in frame.select("doc_id", *columns).collect()}


# ---- near duplicates -----------------------------------------------------

@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicate_groups(docs, texts, percent):
    found = by_id(near_duplicates(docs, NearDuplicates(percent=percent)), "n_shingles", "component_id", "kept")
    assert found == {d: (n, c, c == d) for d, (n, c) in brute.groups(texts, percent).items()}


def test_a_large_group_of_near_copies_with_outsiders(spark):
    """Most members differ from the least one in a tenth; some are linked only to others, some to none."""
    base = passage(50, 120).split(" ")
    rows = {}
    for i in range(150):
        words = list(base)
        for j in range(i % 12):
            words[(i * 7 + 11 * j) % 120] = f"w{i}x{j}"
        rows[i] = " ".join(words)
    frame = spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(6)
    found = by_id(near_duplicates(frame, NearDuplicates(percent=85)), "n_shingles", "component_id")
    assert found == brute.groups(rows, 85)


def test_near_duplicates_of_odd_rows(odd_rows, nothing):
    found = [tuple(r) for r in near_duplicates(odd_rows).collect()]
    assert Counter(found)[(7, 36, 7, True)] == 2
    assert sorted(r[2:] for r in found if r[0] is None) == [(None, True)] * 3
    assert near_duplicates(nothing).count() == 0


def test_super_minhash_estimates_similarity_and_fills_every_slot():
    draw = np.random.default_rng(0)
    pool = draw.integers(0, 1 << 63, 1200, dtype=np.uint64)
    a, b = pool[:900], pool[300:1200]
    signature = super_minhash(np.concatenate([a, b, pool[:1], pool[:3]]), np.array([900, 900, 1, 3]), 256)
    assert (signature < np.iinfo(np.uint64).max).all()
    assert abs((signature[0] == signature[1]).mean() - 0.5) < 0.1
    # One element visits all slots in an order of its own: each step once.
    assert sorted((signature[2] >> np.uint64(32)).tolist()) == list(range(256))


# ---- sharding ------------------------------------------------------------

def test_every_slot_is_taken_in_turn():
    table = sharding.lookup_table(["a", "b", "c"], 101)
    assert max(Counter(table).values()) - min(Counter(table).values()) <= 1
    with pytest.raises(ValueError):
        sharding.lookup_table(["a"], 100)
    with pytest.raises(ValueError):
        sharding.lookup_table(["a", "a"], 101)


def test_losing_a_shard_moves_little_else():
    before, after = sharding.lookup_table(list("abcdefgh"), 2039), sharding.lookup_table(list("abcdefg"), 2039)
    moved = sum("abcdefgh"[x] != "abcdefg"[y] for x, y in zip(before, after) if x != 7)
    assert moved < 0.25 * 2039


def test_placement(docs, odd_rows, nothing):
    table = sharding.lookup_table(sharding.SHARDS)
    for frame in (docs, odd_rows):
        placed = sharding.assign_shards(frame)
        assert placed.count() == frame.count() and "text" in placed.columns
        for r in placed.collect():
            key = "" if r.doc_id is None else str(r.doc_id)
            slot = int(hashlib.md5(key.encode()).hexdigest()[:12], 16) % sharding.TABLE_SIZE
            assert (r.slot, r.shard) == (slot, sharding.SHARDS[table[slot]])
    assert sharding.assign_shards(nothing).count() == 0


def test_columns_of_any_name_stay(spark):
    frame = spark.createDataFrame([(1, "x", 2, 3, 4), (None, "y", 5, 6, 7)], "doc_id long, `a.b` string, Slot int, shard int, input_shard int")
    placed = sharding.assign_shards(frame)
    assert placed.columns == ["doc_id", "a.b", "input_Slot", "input_input_shard", "input_shard", "slot", "shard"]
    assert {(r["a.b"], r.input_Slot, r.input_input_shard, r.input_shard) for r in placed.collect()} == {("x", 2, 3, 4), ("y", 5, 6, 7)}
    plain = {r.doc_id: r.shard for r in sharding.assign_shards(frame.select("doc_id")).collect()}
    assert {r.doc_id: r.shard for r in placed.collect()} == plain


def test_shard_folders(spark, docs, tmp_path):
    sharding.write_shards(docs.select("doc_id", "text"), f"{tmp_path}/s", shards=["x", "y"])
    assert spark.read.parquet(f"{tmp_path}/s").count() == docs.count()


# ---- languages -----------------------------------------------------------

def test_languages_of_held_out_documents(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    found = language_id(table, remainder(4) != 2).join(table.select("doc_id", "lang"), "doc_id")
    right = found.filter(remainder(4) == 2).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.95
    assert found.filter("score < 0 or score > 1 or score is null").count() == 0


def test_language_of_odd_texts(docs, odd_rows, nothing):
    found = by_id(language_id(docs), "lang_pred", "score")
    for d in (0, 1, 2, 17, 18):
        assert found[d] == ("und", 0.0)
    assert found[12][0] == "fr" and found[15][0] == "es"
    assert language_id(odd_rows).count() == 6 and language_id(nothing).count() == 0
    # Nothing to learn from: no language.
    assert {r.lang_pred for r in language_id(docs, F.lit(False)).collect()} == {"und"}


def test_languages_equal_a_plain_scorer(docs, texts):
    learned = [(r.lang, r.text) for r in docs.collect() if r.lang is not None and r.doc_id % 3]
    want = brute.languages(learned, texts)
    found = by_id(language_id(docs, F.col("doc_id") % 3 > 0), "lang_pred", "score")
    assert {d: lang for d, (lang, _) in found.items()} == {d: lang for d, (lang, _) in want.items()}
    for d, (_, score) in want.items():
        assert found[d][1] == pytest.approx(score, abs=1e-4), d


def test_rows_without_id_teach_nothing(spark):
    rows = [(None, "aaa bbb", "x")] * 9 + [(1, "aaa bbb", "y"), (2, "ccc", "z"), (3, "aaa", None)]
    found = language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert {r.doc_id: r.lang_pred for r in found.collect() if r.doc_id} == {1: "y", 2: "z", 3: "y"}


def test_a_sample_is_bounded_in_rows_and_characters(spark):
    rows = [(i, passage(i, 30), "en") for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    words = sum(len(t.split()) for _, t, _ in rows)
    for settings in (LanguageSettings(sample=40), LanguageSettings(sample_chars=sum(len(t) for _, t, _ in rows) // 10)):
        model = fit_language(frame, F.lit(True), settings)
        seen = np.exp(-model.weights[0].absent[0]) * settings.smoothing
        assert 0.02 * words < seen < 0.5 * words + len(model.weights[0].index.keys)


def test_a_corpus_without_labels_keeps_its_texts(spark):
    rows = [(1, "some text", None, 1), (2, "12 34", None, 2), (None, "more", None, 3), (4, None, None, 4)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, `n chars.x` int")
    kept = in_a_language(frame)
    assert kept.dtypes == frame.dtypes
    assert sorted(r["n chars.x"] for r in kept.collect()) == [1, 3]


def test_rows_in_a_language_keep_their_columns(docs, nothing):
    kept = in_a_language(docs)
    assert kept.dtypes == docs.dtypes
    assert {r.doc_id for r in docs.select("doc_id").collect()} - {r.doc_id for r in kept.collect()} == {0, 1, 2, 17, 18}
    assert in_a_language(nothing).count() == 0


# ---- repeated bytes and words ---------------------------------------------

def test_repeated_bytes(docs, texts):
    frame = suffix_dedup(docs)
    assert by_id(frame, "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.without_repeats(texts)
    for r in frame.collect():
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256


def test_equal_windows_are_equal_bytes(texts):
    rows = [(d, (t or "").encode()) for d, t in sorted(texts.items())]
    data = np.frombuffer(b"".join(t for _, t in rows), np.uint8)
    ends = np.repeat(np.cumsum([len(t) for _, t in rows]), [len(t) for _, t in rows])
    at = np.flatnonzero(np.arange(len(data)) + 100 <= ends)[::3]
    kind = sd.equal_windows(data, ends, at, 100)
    names = {}
    for k, p in zip(kind.tolist(), at.tolist()):
        assert names.setdefault(k, data[p : p + 100].tobytes()) == data[p : p + 100].tobytes()
    assert len(names) == len({data[p : p + 100].tobytes() for p in at.tolist()})


def in_one_process(texts, grain, buckets):
    """Spans per document, found without Spark: three tasks send, one task receives."""
    import pyarrow as pa
    from types import SimpleNamespace

    every = SimpleNamespace(value=np.full(1 << 10, 255, np.uint8))
    rows = [(d, t, hash(t)) for d, t in texts.items() if t]
    sent = []
    for task in range(3):
        columns = list(zip(*rows[task::3]))
        batch = pa.RecordBatch.from_arrays([pa.array(columns[0]), pa.array(columns[1]), pa.array(columns[2])], ["doc_id", "text", "doc_key"])
        sent += [r for b in repeats._sent(grain, every)(iter([batch])) for r in b.to_pylist()]
    sent.sort(key=lambda r: r["anchor"])
    schema = pa.schema(list(zip(repeats._NAMES, repeats._TYPES)))
    found = {}
    for batch in buckets(iter(pa.Table.from_pylist(sent, schema).to_batches(50))):
        for r in batch.to_pylist():
            found.setdefault(r["doc_id"], []).append((r["begin"], r["stop"]))
    return found, len(sent)


@pytest.mark.parametrize("room", [3, 100_000])
def test_little_room_loses_nothing(texts, monkeypatch, room):
    """Tasks that forget what they sent, and buckets sorted in slices, find the same."""
    short = {d: t and t[:9_000] for d, t in texts.items()}
    monkeypatch.setattr(repeats, "REMEMBERED", room)
    monkeypatch.setattr(sd, "BUCKET_WINDOWS", 20 * room)
    monkeypatch.setattr(gd, "BLOCK_EDGES", 20 * room)
    found, sent = in_one_process(short, repeats.Grain(length=100, k=30, of_words=False), sd._sorted_buckets(100))
    want = brute.without_repeats(short)
    covered = {d: len({p for a, b in spans for p in range(a, b)}) for d, spans in found.items()}
    assert covered == {d: r[1] for d, r in want.items() if r[1]}
    found, _ = in_one_process(short, repeats.Grain(length=13, k=5, of_words=True), gd._bucketed(13))
    covered = {d: len({p for a, b in spans for p in range(a, b + 12)}) for d, spans in found.items()}
    assert covered == {d: r[1] for d, r in brute.without_shared_words(short).items() if r[1]}
    if room == 3:
        monkeypatch.setattr(repeats, "REMEMBERED", 100_000)
        assert in_one_process(short, repeats.Grain(length=100, k=30, of_words=False), sd._sorted_buckets(100))[1] <= sent


@pytest.mark.parametrize("of_words", [False, True])
def test_the_windows_of_a_common_line_are_dealt_apart(spark, of_words):
    """One line in all documents, between words of their own: its anchor is no bucket of them all."""
    line = passage(4242, 14)
    rows = {i: f"{passage(5000 + i, 30, 'klmnopqrstu')} {line} {passage(9000 + i, 30, 'klmnopqrstu')}" for i in range(300)}
    rows |= {1000: rows[7], 1001: rows[7][50:], 1002: line, 1003: line + " " + line}
    frame = spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(6)
    size = {"length": 13, "k": 5} if of_words else {"length": 100, "k": 30}
    largest = {}
    for hot in (20, 10_000):
        grain = repeats.Grain(**size, of_words=of_words, hot=hot)
        segments = repeats.repeated_segments(repeats.keyed(frame), grain)
        largest[hot] = segments.filter("content is not null").groupBy("anchor").count().agg(F.max("count")).first()[0]
        found = {}
        spans = segments.mapInArrow(gd._bucketed(13), gd.PATH) if of_words else segments.mapInArrow(sd._sorted_buckets(100), "doc_id long, doc_key long, begin long, stop long")
        for r in spans.collect():
            found.setdefault(r.doc_id, set()).update(range(r.begin, r.stop + 12 * of_words))
        want = brute.without_shared_words(rows) if of_words else brute.without_repeats(rows)
        assert {d: len(p) for d, p in found.items()} == {d: r[1] for d, r in want.items() if r[1]}
    # A window is sent once by each task at most.
    assert largest[20] <= 6 < 100 < largest[10_000]


def test_texts_that_share_an_id_are_judged_by_themselves(spark):
    """What one of them repeats is not taken from the other."""
    a, b, c = (passage(70 + i, 60) for i in range(3))
    rows = [(1, a), (5, a), (5, b), (5, c), (5, c), (9, b + " " + c)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    size = {t: len(t.encode()) for t in (a, b, c)}
    gone = Counter((r.doc_id, r.n_bytes, r.n_removed) for r in suffix_dedup(frame).collect())
    both = size[b] + size[c] + 1
    assert gone == Counter({(1, size[a], 0): 1, (5, size[a], size[a]): 1, (5, size[b], 0): 1, (5, size[c], 0): 2, (9, both, both - 1): 1})
    gone = Counter((r.doc_id, r.kept) for r in graph_dedup(frame).collect())
    assert gone == Counter({(1, a): 1, (5, ""): 1, (5, b): 1, (5, c): 2, (9, ""): 1})


@pytest.mark.parametrize("a", range(31))
def test_the_cover_reaches_any_two_positions(a):
    for b in range(31):
        d = sd._SHIFT[a, b]
        assert (a + d) % 31 in sd.COVER and (b + d) % 31 in sd.COVER


def test_large_anchors_are_sorted_in_slices(monkeypatch):
    import pyarrow as pa

    text = passage(60, 300).encode()
    contents = [text[i : i + 170] for i in (0, 0, 5, 40, 5)]
    table = pa.table(
        {
            "anchor": pa.array([1] * 5), "doc_id": pa.array([9, 3, 4, 5, 4]), "doc_key": pa.array([0] * 5), "start": pa.array([0, 7, 0, 0, 500]),
            "windows": pa.array([71] * 5, pa.int32()), "lead": pa.array([70, 70, 65, 30, 65], pa.int32()), "content": pa.array(contents, pa.binary()),
        }
    )
    spans = lambda: sorted(tuple(r.values()) for b in sd._bucket(table, 100) for r in b.drop_columns("doc_key").to_pylist())
    whole = spans()
    monkeypatch.setattr(sd, "BUCKET_WINDOWS", 20)

    def covered(found):
        return {(d, p) for d, a, b in found for p in range(a, b)}

    assert covered(spans()) == covered(whole) and whole


def test_repeated_words(docs, texts):
    frame = graph_dedup(docs)
    assert by_id(frame, "n_words", "n_removed", "kept_sha256") == brute.without_shared_words(texts)
    for r in frame.collect():
        assert hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256


def test_paths_name_their_source(docs, texts):
    words = {d: brute.WORD.findall(t or "") for d, t in texts.items()}
    paths = repeated_paths(docs).collect()
    assert paths
    for r in paths:
        n = r.stop - r.begin + 12
        assert r.from_doc < r.doc_id
        assert words[r.doc_id][r.begin : r.begin + n] == words[r.from_doc][r.from_begin : r.from_begin + n]
    # A whole copy is one compacted path, whatever buckets its pieces came from.
    assert [(r.begin, r.stop) for r in paths if r.doc_id == 8] == [(0, 148)]


@pytest.mark.parametrize("operator", [suffix_dedup, graph_dedup])
def test_dedup_of_odd_rows(operator, odd_rows, nothing):
    found = operator(odd_rows).select("doc_id", "n_removed").collect()
    assert len(found) == 6 and all(r.n_removed == 0 for r in found)
    assert operator(nothing).count() == 0


def test_blocks_hold_whole_anchors():
    import pyarrow as pa

    anchors = np.repeat(np.arange(40), np.arange(40) % 7 + 1)
    rows = [pa.RecordBatch.from_arrays([pa.array(anchors[i : i + 9]), *[pa.array(anchors[i : i + 9])] * 3, pa.array(np.full(len(anchors[i : i + 9]), 3, np.int32))], list("abcde")) for i in range(0, len(anchors), 9)]
    blocks = [t.column(0).to_pylist() for t in repeats.blocks(iter(rows), 20)]
    assert [x for b in blocks for x in b] == anchors.tolist()
    assert all(not set(a) & set(b) for i, a in enumerate(blocks) for b in blocks[i + 1 :])


# ---- benchmark passages ---------------------------------------------------

def test_benchmark_passages(spark, docs, texts):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontamination(docs, items)
    want = brute.leaks(texts, [i for i in ITEMS if i[0] is not None])
    assert by_id(found, "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == want
    assert sum(w[4] for w in want.values()) >= 5


@pytest.mark.parametrize("bound", ["BROADCAST_ROWS", "BROADCAST_BYTES"])
def test_benchmark_passages_without_broadcasts(spark, docs, texts, monkeypatch, bound):
    from tripfare.llm import decontamination as dc

    monkeypatch.setattr(dc, bound, 0)
    assert "roadcast" not in dc._small(docs.select("text"))._jdf.queryExecution().logical().toString()
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = by_id(decontamination(docs, items), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert found == brute.leaks(texts, [i for i in ITEMS if i[0] is not None])


def test_benchmark_of_odd_tables(spark, odd_rows, docs, nothing):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontamination(odd_rows, items).collect()
    assert len(found) == 4  # rows that repeat id and text count once
    assert decontamination(nothing, items).count() == 0
    assert decontamination(docs, items.limit(0)).filter("contaminated or n_hit > 0").count() == 0


# ---- exact search ----------------------------------------------------------

VECTORS = [
    (0, [0.5, -0.25, 0.0]), (100, [0.5, -0.25, 0.0]), (1, [0.5, -0.25, 0.0]), (2, [1.0]), (3, []), (4, None), (5, [0.1, None, 0.2]),
    (6, [float("nan"), 0.0, 0.0]), (7, [float("inf"), 0.0, 0.0]), (8, [-0.0001, 0.0, 3.0]), (None, [1.0, 1.0, 1.0]), (9, [0.0, 0.0, 0.0]), (200, [0.0, 0.0, -1.0]),
]


def test_exact_search(spark, monkeypatch):
    extra = [(10 + i, [math.sin(i), math.cos(3 * i), (i % 5) / 4]) for i in range(60)]
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in VECTORS + extra], "vec_id long, embedding array<float>, score string, rank int").repartition(4)
    whole = {}
    for i, v in VECTORS + extra:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole[i] = [math.floor(1024 * float(np.float32(x))) for x in v]
    want = set()
    for q in (i for i in whole if i % 100 == 0):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)[:10]
        want |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)}
    assert set(map(tuple, exact_top_k(frame, F.col("vec_id") % 100 == 0).collect())) == want
    monkeypatch.setattr(exact_search, "QUERY_BLOCK", 1)
    monkeypatch.setattr(exact_search, "VECTOR_BLOCK", 7)
    assert set(map(tuple, exact_top_k(frame, F.col("vec_id") % 100 == 0).collect())) == want
    assert exact_top_k(frame.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert exact_top_k(frame.unionByName(frame), F.col("vec_id") % 100 == 0).count() == len(want)
    assert set(map(tuple, exact_top_k(frame.unionByName(frame), F.col("vec_id") % 100 == 0).collect())) == want


def test_a_query_takes_no_place_in_its_own_task():
    import pyarrow as pa

    column = pa.array([[20 - i, 1] for i in range(15)], pa.list_(pa.int64()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(15), pa.int64()), column], ["vec_id", "weights"])
    (query,) = exact_search._packed(10)([batch.slice(0, 1)])
    others = list(exact_search._packed(5)([batch]))
    pairs = [pa.RecordBatch.from_arrays([*query.columns, *o.columns], [f"c{i}" for i in range(10)]) for o in others]
    (found,) = exact_search._best(10)(iter(pairs))
    assert len(others) == 3 and found.column(1).to_pylist() == list(range(1, 11))


def test_a_hundred_blocks_of_queries_are_one_plan(spark, monkeypatch):
    rows = [(i, [math.sin(i * j) for j in range(1, 6)]) for i in range(300)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    want = sorted(map(tuple, exact_top_k(frame, F.col("vec_id") % 3 == 0, 4).collect()))
    monkeypatch.setattr(exact_search, "QUERY_BLOCK", 1)
    monkeypatch.setattr(exact_search, "VECTOR_BLOCK", 20)
    found = exact_top_k(frame, F.col("vec_id") % 3 == 0, 4)
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert sorted(map(tuple, found.collect())) == want and len(want) == 400


def test_repeated_vectors_take_no_place_of_others(spark):
    """Copies of the best vector fill more than k rows of the only task; one id has two vectors."""
    vectors = [(i, [float(200 - i), 1.0]) for i in range(100, 121)]
    rows = vectors + [vectors[1]] * 40 + [(120, [70.0, 9.0])]
    want = {(100, r + 1, i, 1024 * 1024 * (100 * (200 - i) + 1)) for r, i in enumerate(range(101, 111))}
    for order in (rows, rows[::-1]):
        frame = spark.createDataFrame(order, "vec_id long, embedding array<float>").coalesce(1)
        assert set(map(tuple, exact_top_k(frame, F.col("vec_id") == 100).collect())) == want
        assert exact_top_k(frame, F.col("vec_id") == 120).filter("vec_id = 100").first().score == 1024 * 1024 * (70 * 100 + 9)


# ---- token files -----------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return public_tokenizers.path("byte_bpe_50k.json"), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_token_files_round_trip(spark, docs, texts, tokenizer, tmp_path):
    path, plain = tokenizer
    write_tokens(docs, f"{tmp_path}/t", path, block_ids=500)
    found = by_id(read_tokens(spark, f"{tmp_path}/t"), "start", "n_tokens", "ids_crc32")
    start = 0
    for d in sorted(texts):
        ids = np.array(plain.encode(texts[d] or "", add_special_tokens=False).ids + [2], "<u4")
        assert found[d] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
        if d in (0, 7, 12, 15):
            assert [x.tolist() for x in token_ids(spark, f"{tmp_path}/t", d)] == [ids.tolist()]
    assert token_ids(spark, f"{tmp_path}/t", 25) == []
    blocks = spark.read.schema(BLOCKS).parquet(f"{tmp_path}/t")
    assert blocks.filter("low_doc <> array_min(doc_ids) or high_doc <> array_max(doc_ids)").count() == 0
    assert blocks.count() > 3 and blocks.filter("width <> 16").count() == 0


def test_tokens_of_odd_rows(odd_rows, nothing):
    found = token_table(odd_rows).collect()
    assert len(found) == 6 and [r.doc_id for r in found].count(None) == 3
    assert sorted(r.start for r in found)[0] == 0
    assert token_table(nothing).count() == 0


def test_pieces_give_the_ids_of_the_whole(tokenizer):
    path, plain = tokenizer
    parts = [" ", "  ", "\n", "\t", " ", "a", "bc", "it's", "'s", ".", ",", "!!", "é", "12", "|", "\x1c", "...", "漢字", "🙂", "<|endoftext|>", "_"]
    draw = np.random.default_rng(1)
    tool = Encoder(path)
    for _ in range(1500):
        text = "".join(draw.choice(parts, draw.integers(0, 25)))
        assert np.frombuffer(tool.encode([text])[0], "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_what_a_worker_remembers_is_bounded(tokenizer, monkeypatch):
    from tripfare.llm import token_files

    path, plain = tokenizer
    monkeypatch.setattr(token_files, "REMEMBERED", 50)
    tool = Encoder(path)
    texts = [passage(i, 40) + " " + "漢" * 200 + str(i) for i in range(30)]
    for again in range(3):
        for t, found in zip(texts, tool.encode(texts)):
            assert np.frombuffer(found, "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids
        for memory in (tool.known, tool.older):
            assert len(memory) <= 100 and max(map(len, memory), default=0) <= token_files.PIECE_BYTES


def test_unknown_pieces_reach_the_tokenizer_a_few_at_a_time(tokenizer, monkeypatch):
    from types import SimpleNamespace

    from tripfare.llm import token_files

    path, plain = tokenizer
    monkeypatch.setattr(token_files, "TEXTS", 3, raising=False)
    monkeypatch.setattr(token_files, "LAID_PIECES", 7, raising=False)
    monkeypatch.setattr(token_files, "TOGETHER", 4)
    tool = Encoder(path)
    taken = []

    def encode(texts, **how):
        taken.append(len(texts))
        return plain.encode_batch_fast(texts, **how)

    tool.tokenizer = SimpleNamespace(encode_batch_fast=encode)
    texts = ["", *[passage(i, 30) for i in range(20)], "", "one", None, "a b " * 9]
    for _ in range(2):
        for t, found in zip(texts, tool.encode(texts), strict=True):
            assert np.frombuffer(found, "<u4").tolist() == plain.encode(t or "", add_special_tokens=False).ids
    assert sum(taken) > 20 and max(taken) <= 3


@pytest.mark.parametrize("width", [1, 5, 8, 13, 16, 17, 31, 32])
def test_bit_packing(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 1001, dtype=np.uint64)
    packed = pack(ids, width)
    assert len(packed) == -(-1001 * width // 8)
    assert (unpack(packed, width, 0, 1001) == ids).all() and (unpack(packed, width, 333, 100) == ids[333:433]).all()
    assert len(unpack(pack(ids[:0], width), width, 0, 0)) == 0


# ---- language model ---------------------------------------------------------

def test_counts_and_base_scores(docs, texts):
    found = by_id(score_texts(docs, remainder(7) != 2), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    tokens = {d: brute.WORD.findall(brute.lower(t)) + [None] for d, t in texts.items()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
    counts = Counter(t for d, ts in tokens.items() if not held[d] for t in ts)
    total = sum(counts.values())
    for d, ts in tokens.items():
        base = sum(math.log10((counts[t] + 1) / (total + len(counts) + 1)) for t in ts)
        assert found[d][:4] == (held[d], len(ts), sum(counts[t] > 0 for t in ts), total)
        assert found[d][4] == pytest.approx(base) and found[d][5] < 0


def test_rare_words_are_joined(docs):
    from tripfare.llm.language_model import ModelSettings

    few = score_texts(docs, remainder(7) != 2, ModelSettings(frequent=5))
    many = score_texts(docs, remainder(7) != 2)
    a, b = by_id(few, "n_known", "base_score"), by_id(many, "n_known", "base_score")
    assert all(a[d][0] == b[d][0] and a[d][1] == pytest.approx(b[d][1]) for d in b)


def test_the_model_beats_single_words_on_held_out_texts(spark, sf):
    found = score_texts(spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet"), remainder(7) != 2)
    base, model = found.filter("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert model > base


def test_classes_add_up_to_one(docs):
    """All one-word texts: the model's chance of word and end, over the vocabulary and one unknown word."""
    from tripfare.llm import language_model as lm

    weights = np.random.default_rng(0).normal(size=(64, 8)).astype(np.float32)
    chances = lm._chances(weights, np.random.default_rng(1).integers(0, 64, (50, lm.FEATURES)))
    assert np.exp(chances).sum(axis=1) == pytest.approx(1)


def test_scores_of_odd_rows(odd_rows, nothing):
    assert score_texts(odd_rows, remainder(7) != 2).count() == 6
    assert score_texts(nothing, remainder(7) != 2).count() == 0
    alone = score_texts(odd_rows, F.lit(False)).collect()
    assert all(r.base_score == 0 and r.train_tokens == 0 and r.n_known == 0 for r in alone)


# ---- mixing -----------------------------------------------------------------

def test_domains_and_rates(spark, sf):
    folder = sf.replace("0.001", "0.1")
    table, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    train, test = labels.filter("doc_id % 5 <> 0"), labels.filter("doc_id % 5 = 0")
    chances = posteriors(table, fit_domains(table, train, MixingSettings()))
    judged = chances.join(test, "doc_id").collect()
    right = [max((r.p_good, 0), (r.p_poor, 1), (r.p_toxic, 2))[1] == (2 if r.toxic else 0 if r.quality else 1) for r in judged]
    assert sum(right) / len(right) > 0.85

    targets = {"good": 0.7, "poor": 0.2, "toxic": 0.1}
    stored = spark.createDataFrame(chances.collect(), chances.schema)
    done = rated(stored, fit_rates(stored, targets, MixingSettings()))
    sums = done.agg(*[F.sum(F.col("rate") * F.col("n_tokens") * F.col(f"p_{d}")) for d in targets]).first()
    assert [x / sum(sums) for x in sums] == pytest.approx(list(targets.values()), abs=0.005)
    assert done.filter("rate < 0 or rate is null").count() == 0


def test_rates_of_targets_within_reach_meet_them(spark):
    """Against the same projected gradient over all documents in one array."""
    from tripfare.llm.mixing import POSTERIORS, reached_shares, whole_copies

    draw = np.random.default_rng(3)
    n, p = draw.integers(1, 90, 50), draw.dirichlet([0.6, 0.5, 0.4], 50)
    table = spark.createDataFrame([(i, int(n[i]), *map(float, p[i]), i) for i in range(50)], POSTERIORS).repartition(4)
    targets = {"good": 0.5, "poor": 0.3, "toxic": 0.2}
    moves = fit_rates(table, targets, MixingSettings(iterations=200, tolerance=1e-6))
    mixed = rated(table, moves).withColumn("copies", whole_copies(F.col("rate"), "doc_id"))
    report = {r.domain: (r.target, r.by_rate) for r in reached_shares(mixed, targets).collect()}
    assert all(reached == pytest.approx(target, abs=1e-4) for target, reached in report.values()) and len(moves) < 200

    rate, aim = np.ones(50), np.array(list(targets.values())) * n.sum()
    step = np.linalg.inv((p * n[:, None]).T @ p)
    for _ in range(5000):
        rate = np.maximum(0, rate - p @ (step @ ((n * rate) @ p - aim)))
    found = {r.doc_id: r.rate for r in mixed.collect()}
    assert [found[i] for i in range(50)] == pytest.approx(rate.tolist(), abs=1e-3)


def test_a_target_out_of_reach_is_told(spark, sf):
    from tripfare.llm.mixing import reached_shares

    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    report = {r.domain: r for r in reached_shares(mix(docs, labels)).collect()}
    assert sum(r.by_rate for r in report.values()) == pytest.approx(1) and sum(r.target for r in report.values()) == pytest.approx(1)
    assert report["toxic"].target == 0 < report["toxic"].by_rate < 0.02
    empty = reached_shares(mix(docs.limit(0), labels)).collect()
    assert [r.by_rate for r in empty] == [None] * 3


def test_mixing_of_odd_tables(spark, docs, odd_rows, nothing, sf):
    labels = spark.createDataFrame([(5, 1, 0), (10, 0, 0), (12, None, 1), (13, None, None), (None, 1, 1), (999, 1, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    found = mix(docs, labels).collect()
    assert len(found) == docs.count()
    assert all(r.rate >= 0 and abs(r.p_good + r.p_poor + r.p_toxic - 1) < 1e-5 for r in found)
    assert mix(odd_rows, labels).count() == 6
    assert mix(docs, labels.limit(0)).count() == docs.count()
    assert mix(nothing, labels).count() == 0
    with pytest.raises(ValueError):
        mix(docs, labels, {"good": -1.0})


# ---- arrays -----------------------------------------------------------------

def test_hash_index_finds_what_it_holds():
    draw = np.random.default_rng(2)
    keys = np.unique(np.r_[draw.integers(0, 1 << 63, 3000, dtype=np.uint64), np.arange(50, dtype=np.uint64) << np.uint64(40)])
    index = arrays.HashIndex(keys)
    assert (index.find(keys) == np.arange(len(keys))).all()
    assert (index.find(keys + np.uint64(7)) == -1).sum() >= len(keys) - 2
    assert (arrays.HashIndex(keys[:0]).find(keys) == -1).all()


def test_equal_words_hash_alike_wherever_they_stand():
    import pyarrow as pa

    column = pa.array(["abc  abc", None, "", "ABC\nxabc", "abc"])
    (_, _, data, offsets), = arrays.slices(column)
    starts, stops, first = arrays.words(data, offsets)
    assert first.tolist() == [0, 2, 2, 2, 4, 5]
    h = arrays.span_hashes(data, starts, stops, lower=True)
    assert h[0] == h[1] == h[2] == h[4] != h[3]
