"""Phrases, token counts and importance resampling against brute force, and on odd tables."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import passage
from tests.llm.test_operators import ITEMS, by_id
from tripfare.llm import arrays, checksums, importance, phrases as ph, token_counts as tc
from tripfare.llm.importance import Resampling, importance_resampling
from tripfare.llm.phrases import Phrases, phrases
from tripfare.llm.queries import QUERIES
from tripfare.llm.token_counts import token_counts

SLOTS = 1 << 18
RESULT = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def phrase_rows(frame):
    return [tuple(r) for r in frame.select(*RESULT).collect()]


def talk(seed, pieces, words=12):
    draw = random.Random(seed)
    chosen = [" ".join(draw.choice("a bb The NEW york é".split()) for _ in range(draw.randint(0, words))) for _ in range(pieces)]
    return "".join(c + draw.choice([". ", ", ", "\n", "\x0b", " ! ", "\t;"]) for c in chosen)


# ---- phrases -------------------------------------------------------------

@pytest.mark.parametrize("shards", [1, 2, 5])
def test_phrases_of_every_language(spark, shards):
    rows = [(i, talk(i, 6), [None, "und", "en"][i % 3]) for i in range(60)] + [(99, None, "de"), (98, "", "de"), (97, ".,;", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    found = phrase_rows(phrases(docs, Phrases(least=8, shards=shards, slots=SLOTS)))
    assert len(found) == len(set(found)) > 50
    assert set(found) == brute.phrases([(lang, t) for _, t, lang in rows], least=8)


def test_phrases_that_become_frequent_late(spark):
    """Each shard holds a phrase fewer times than is asked for: lengths are activated one cycle after another."""
    text = "one two three four five"
    rows = [(i, text if i % 2 else text + ". two three", "en") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    settings = Phrases(least=12, shards=6, slots=SLOTS)
    per_shard = docs.groupBy(F.expr("pmod(xxhash64(cast(doc_id as string)), 6)")).count().agg(F.max("count")).first()[0]
    assert per_shard * 2 < settings.least
    assert set(phrase_rows(phrases(docs, settings))) == brute.phrases([(lang, t) for _, t, lang in rows], least=12)


def test_a_crowded_table_loses_no_phrase(spark, monkeypatch):
    """More frequent phrases than slots can tell apart: more is counted, the result is the same."""
    rows = [(i, passage(300 + i % 90, 60, "abc"), "en") for i in range(180)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2)
    full = ph.marked_slots
    monkeypatch.setattr(ph, "marked_slots", lambda places, slots: full(places, slots) | (np.arange(slots) % 3 > 0))
    assert set(phrase_rows(phrases(docs, Phrases(least=2, slots=SLOTS)))) == brute.phrases([(lang, t) for _, t, lang in rows], least=2)


def test_scores_are_exact_beyond_64_bits(spark):
    big = 9_000_000_000_000_000_001
    rows = [("en", "a", 1, big), ("en", "b", 1, big), ("en", "a b", 2, big - 5), ("en", "c", 1, big), ("en", "b c", 2, big - 7), ("en", "a b c", 3, big - 9)]
    frequent = spark.createDataFrame(rows, "lang string, phrase string, size int, a long")
    found = {r.phrase: (r.l, r.r, r.score) for r in ph.scored(frequent, Phrases(slots=SLOTS)).collect()}
    f = {p: a for _, p, _, a in rows}
    assert found["a b"] == (big, big, 2_000_000 * (big - 5) // (2 * big))
    # Both cuts of three words floor to one score: the first is taken.
    assert found["a b c"] == (f["a"], f["b c"], 2_000_000 * f["a b c"] // (f["a"] + f["b c"]))
    assert {r.phrase for r in ph.not_inside(ph.scored(frequent, Phrases(slots=SLOTS)), Phrases(slots=SLOTS)).collect()} == {"a b c"}


def test_only_the_best_phrases_are_listed(spark):
    docs = spark.createDataFrame([(i, talk(i, 9), "en") for i in range(20)], "doc_id long, text string, lang string")
    settings = Phrases(least=4, slots=SLOTS, top=7)
    assert set(phrase_rows(phrases(docs, settings))) == brute.phrases([(r.lang, r.text) for r in docs.collect()], least=4, top=7)


def test_phrases_of_odd_tables(docs, odd_rows, nothing):
    settings = Phrases(least=2, slots=SLOTS)
    for frame in (docs, odd_rows):
        rows = [(r.lang, r.text) for r in frame.collect()]
        assert set(phrase_rows(phrases(frame, settings))) == brute.phrases(rows, least=2)
    assert phrase_rows(phrases(nothing, settings)) == []
    assert phrase_rows(phrases(docs, Phrases(least=10**6, slots=SLOTS))) == []
    with pytest.raises(ValueError):
        Phrases(slots=1000)


def test_packed_counts_add_up():
    draw = np.random.default_rng(0)
    hashes = draw.integers(0, 1 << 63, 300, dtype=np.uint64) * np.uint64(2)
    every, sent = Counter(), []
    for task in range(4):
        held = ph._Held(5)
        for size in (1, 2):
            some = draw.choice(hashes, 900)
            since = (some % np.uint64(3)).astype(np.uint8)
            held.add(some, size, since, (some % np.uint64(7)).astype(np.uint8))
            every.update((int(h), size, int(s)) for h, s in zip(some, since))
        held.merge()
        sent += list(held.take())
        assert list(held.take()) == []
    rows = sorted((r for b in sent for r in zip(*(c.to_pylist() for c in b.columns))), key=lambda r: r[0])
    assert {r[0] for r in rows} == set(range(32))
    for only in (False, True):
        found, frequent = {}, set()
        for b in ph._summed(12, only)(iter([ph._as_batch(rows[i : i + 7]) for i in range(0, len(rows), 7)])):
            for _, since, size, keys, counts, groups, often in zip(*(c.to_pylist() for c in b.columns)):
                keys = np.frombuffer(keys, np.uint64)
                assert (np.frombuffer(groups, np.uint8) == keys % np.uint64(7)).all()
                found.update({(int(h), size, since): int(n) for h, n in zip(keys, ph._widened(counts, len(keys)))})
                frequent.update((int(h), size, since) for h in np.frombuffer(often, np.uint64))
        assert frequent == {k for k, n in every.items() if n >= 12}
        assert found == {k: n for k, n in every.items() if not only or n >= 12}
    for top in (1, 127, 128, 40_000, 3_000_000_000):
        assert ph._widened(ph._narrow(np.array([0, top])), 2).tolist() == [0, top]


# ---- token counts --------------------------------------------------------

VOCABULARIES = ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"]
ODD = ["<|endoftext|>", "<|startoftext|>", "<s>", "</s>", "'re", "'s", " ", "  ", "\n", "\t", "word", "Ünï", "漢字。漢", "12", "…", "　", "́", "\x1c", "​", "!", "|", "<|", "▁", "\x00"]


def encoded(name):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=path).encode
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(path)
    return lambda text: tool.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", VOCABULARIES)
def test_texts_cut_anywhere_safe_have_the_tokens_of_the_whole(name, texts):
    draw, tool, ids = random.Random(4), tc.counter(public_tokenizers.path(name)), encoded(name)
    assert tool.boundary is not None
    tried = [t or "" for t in texts.values()] + ["".join(draw.choice(ODD) for _ in range(draw.randint(0, 200))) for _ in range(150)]
    expected = [len(ids(t)) for t in tried]
    for piece in (1, 9, 100, tc.PIECE_CHARS):
        assert tc.token_lengths(tried, tool, batch=300, piece=piece).tolist() == expected
    assert tool.splits == (name == "byte_bpe_50k.json")
    if tool.splits:
        assert tc.counted_once(pa.array(tried), tool).tolist() == expected


def test_cutting_keeps_every_character():
    text = "one  two\n\nthree" * 50 + "x" * 500 + " end"
    for boundary in (tc.AT_SPACE, tc.AT_SPACE_OR_MARK, tc.BETWEEN_WORDS, None):
        for limit in (1, 10, 10_000):
            parts = list(tc.cut_texts(text, boundary, limit))
            assert "".join(parts) == text and all(len(p) >= limit for p in parts[:-1])
    assert list(tc.cut_texts("", tc.AT_SPACE, 1)) == [""]


def test_vocabularies_without_a_proof_are_not_cut():
    plan = {"normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "Whitespace"}}
    assert tc._Words._boundary(plan) is tc.AT_SPACE
    for change in (
        {"pre_tokenizer": None},
        {"pre_tokenizer": {"type": "Metaspace"}},
        {"pre_tokenizer": {"type": "ByteLevel", "use_regex": True, "add_prefix_space": True}},
        {"normalizer": {"type": "Sequence", "normalizers": [{"type": "Prepend"}]}},
        {"added_tokens": [{"content": "a b", "single_word": False, "rstrip": False}]},
        {"added_tokens": [{"content": "<m>", "single_word": False, "rstrip": True}]},
    ):
        assert tc._Words._boundary(plan | change) is None


@pytest.mark.parametrize("name", VOCABULARIES)
def test_token_counts(docs, texts, name):
    ids = encoded(name)
    found = by_id(token_counts(docs, name, limit=50), "n_bytes", "n_tokens", "over_limit")
    expected = {d: (len((t or "").encode()), len(ids(t or ""))) for d, t in texts.items()}
    assert found == {d: (b, n, n > 50) for d, (b, n) in expected.items()}


def test_token_counts_of_odd_tables(spark, odd_rows, nothing):
    assert Counter(r[0] for r in token_counts(odd_rows).collect()) == Counter({None: 3, 7: 2, 9: 1})
    assert token_counts(nothing).count() == 0
    # Several megabytes in one row, with words and without.
    long = [(1, passage(8, 400_000)), (2, "ab" * 40_000), (3, "漢字。" * 200_000)]
    ids = encoded("byte_bpe_50k.json")
    found = by_id(token_counts(spark.createDataFrame(long, "doc_id long, text string")), "n_tokens")
    assert found == {d: (len(ids(t)),) for d, t in long}


# ---- checksums and importance resampling ---------------------------------

def test_checksums_of_spans_and_joins():
    draw = random.Random(0)
    data = np.frombuffer(draw.randbytes(30_000), np.uint8)
    starts = np.array([draw.randint(0, 20_000) for _ in range(400)])
    sizes = np.array([draw.choice([0, 1, 2, 7, 63, 64, 65, 66, 200, 5000]) for _ in range(400)])
    found = checksums.crc32_spans(data, starts, starts + sizes)
    spans = [data[a : a + n].tobytes() for a, n in zip(starts, sizes)]
    assert found.tolist() == [zlib.crc32(s) for s in spans]
    other = np.array(draw.sample(range(400), 400))
    assert checksums.joined(found, found[other], sizes[other]).tolist() == [zlib.crc32(s + spans[q]) for s, q in zip(spans, other)]
    assert len(checksums.crc32_spans(data, starts[:0], starts[:0])) == 0


def resampled(frame):
    return by_id(frame, "n_features", "weight", "score", "rank")


@pytest.mark.parametrize("settings", [Resampling(), Resampling(head_words=0, head_pairs=0), Resampling(head_words=9, head_pairs=5, head_at_least=1)], ids=["head", "tail", "mixed"])
def test_documents_are_drawn_alike_with_any_head(spark, docs, texts, settings):
    target = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = resampled(importance_resampling(docs, target, settings))
    assert found == brute.resampled(texts, [t for _, t in ITEMS])
    assert sum(r[3] is not None for r in found.values()) == 2


def test_features_of_long_texts_come_in_ranges(monkeypatch):
    monkeypatch.setattr(importance, "CHUNK_WORDS", 7)
    texts = [passage(1, 40).encode(), b"", b"one", passage(2, 9).encode(), b"a" * 100 + b" bb"]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    none = importance.Head(*[np.zeros(0, t) for t in (np.uint64, np.uint64, np.uint32, np.uint64, np.uint32, np.int64)])
    got = Counter()
    for _, _, found, inside in importance.Features(none, 997).of(importance._words(data, offsets)):
        for bucket, there in zip(found, inside):
            got.update(bucket[there].tolist())
    assert got == Counter(zlib.crc32(f) % 997 for t in texts for f in brute.features(t.decode())[1])


def test_draws_of_odd_tables(spark, docs, odd_rows, nothing):
    target = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = importance_resampling(odd_rows, target, Resampling(percent=50)).collect()
    assert Counter(r.doc_id for r in rows) == Counter({None: 3, 7: 2, 9: 1})
    assert all(r.score is None and r.rank is None for r in rows if r.doc_id is None)
    assert [r.rank for r in rows if r.rank] == [1]
    assert importance_resampling(nothing, target).count() == 0
    # Without a target every bucket only counts against a document.
    assert importance_resampling(docs, nothing).filter("weight > 0 and n_features > 5000").count() == 0
    assert set(resampled(importance_resampling(docs, nothing))) == set(by_id(docs))


def test_ranks_are_told_apart_by_id_text_and_row(spark):
    rows = [(9, 30, 5, 1), (3, 30, 5, 2), (3, 30, 5, 1), (4, 30, 7, 1), (3, 30, 5, 1), (8, 19, 99, 1)]
    scored = spark.createDataFrame(rows, "doc_id long, n_words long, score long, text_hash long").repartition(3)
    found = importance.drawn(scored, 100, 20)
    assert sorted((r["rank"], r.doc_id, r.text_hash) for r in found.collect() if r["rank"]) == [(1, 4, 1), (2, 3, 1), (3, 3, 1), (4, 3, 2), (5, 9, 1)]
    assert importance.drawn(scored, 59, 20).filter("rank is not null").count() == 2


def test_words_up_to_sixteen_bytes_are_told_apart_by_their_bytes():
    words = ["a", "ab", "abcdefgh", "abcdefghi", "abcdefghijklmnop", "é" * 8, "zzzzzzzz" + "é"]
    raw = np.frombuffer("".join(words).encode(), np.uint8)
    sizes = np.array([len(w.encode()) for w in words])
    low, high = importance._numbers(raw, np.cumsum(sizes) - sizes, sizes)
    assert len(set(zip(low.tolist(), high.tolist()))) == len(words)
    assert arrays.LOWER[ord("Z")] == ord("z") and arrays.LOWER[ord("[")] == ord("[")


def test_whole_tables_give_the_rows_of_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    ids = encoded("byte_bpe_50k.json")
    expected = {
        "op11_phrases": brute.phrases([(r.lang, r.text) for r in docs]),
        "op12_token_counts": {(r.doc_id, len((r.text or "").encode()), n := len(ids(r.text or "")), n > 1024) for r in docs},
        "op13_importance_resampling": {(d, *r) for d, r in brute.resampled({r.doc_id: r.text for r in docs}, items).items()},
    }
    for name, rows in expected.items():
        assert set(map(tuple, QUERIES[name](spark, sf).collect())) == rows, name
