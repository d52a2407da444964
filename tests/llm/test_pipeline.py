"""The stages of the corpus pipeline against brute force, and on odd tables."""

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm import brute
from tests.llm.conftest import passage
from tests.llm.test_operators import ITEMS
from tripfare.llm.mixing import TARGETS, mix, whole_copies
from tripfare.llm.near_duplicates import NearDuplicates, near_duplicate_rows, near_duplicates
from tripfare.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def folder(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    labels = [(d, int(d % 4 > 0), int(d % 5 == 0)) for d in range(30, 70)] + [(None, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def ids(frame):
    return sorted(r.doc_id for r in frame.select("doc_id").collect())


def test_every_stage_by_itself(spark, docs, texts, folder):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "near_dedup", "decontaminate", "mixing", "tokens"]
    for name in ("language", "near_dedup", "decontaminate", "mixing"):
        assert stages[name](spark, docs, folder).dtypes == docs.dtypes, name
    assert set(ids(docs)) - set(ids(stages["language"](spark, docs, folder))) == {0, 1, 2, 17, 18}
    kept = [d for d, (_, c) in brute.groups(texts, 80).items() if c == d]
    assert ids(stages["near_dedup"](spark, docs, folder)) == sorted(kept)
    clean = [d for d, found in brute.leaks(texts, [i for i in ITEMS if i[0] is not None]).items() if not found[4]]
    assert ids(stages["decontaminate"](spark, docs, folder)) == sorted(clean)
    assert stages["tokens"](spark, docs, folder).count() == docs.count()


def test_each_stage_works_on_what_the_one_before_kept(spark, folder, texts):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    counts = []
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.durable(stage(spark, docs, folder), "stage")
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) or counts[3] >= counts[2]
    found = docs.collect()
    import public_tokenizers
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    # A document may be given out in several copies: one follows the other.
    start = 0
    for r in sorted(found, key=lambda r: (r.doc_id, r.start)):
        n = len(tool.encode(texts[r.doc_id], add_special_tokens=False).ids) + 1
        assert (r.start, r.n_tokens) == (start, n)
        start += n
    assert max(Counter(r.doc_id for r in found).values()) > 1


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_stages_on_odd_tables(spark, stage, odd_rows, nothing, folder):
    name, function = stage
    assert function(spark, nothing, folder).count() == 0
    left = function(spark, odd_rows, folder)
    wanted = {"language": 5, "near_dedup": 5, "decontaminate": 6, "tokens": 6}.get(name)
    assert wanted is None or left.count() == wanted


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf, name):
    frame = QUERIES[name](spark, sf)
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    answer = connection.sql(ORACLE[name])
    assert sorted(answer.columns) == sorted(frame.columns)
    where = [answer.columns.index(c) for c in frame.columns]
    assert set(map(tuple, frame.collect())) == {tuple(r[i] for i in where) for r in answer.fetchall()}


def test_whole_tables_give_the_rows_of_brute_force(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    expected = {
        "op1_near_duplicates": {(d, n, c, c == d) for d, (n, c) in brute.groups(texts, 85).items()},
        "op4_suffix_dedup": {(d, *r) for d, r in brute.without_repeats(texts).items()},
        "op10_substring_dedup": {(d, *r) for d, r in brute.without_shared_words(texts).items()},
    }
    for name, rows in expected.items():
        assert set(map(tuple, QUERIES[name](spark, sf).collect())) == rows, name


def test_all_operators_are_registered():
    names = entry.queries()
    assert all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 14)) and "pipeline" in names
    assert corpus_pipeline.ORACLE_SQL is None


def test_mixed_rows_have_the_target_shares(spark, sf):
    """Tokens of the rows that the stage gives out, each domain by its posterior, against the targets."""
    folder = sf.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    taken = corpus_pipeline.mixing(spark, docs, folder).groupBy("doc_id").count()
    chances = mix(docs, labels).join(taken, "doc_id")
    sums = chances.agg(*[F.sum(F.col("count") * F.col("n_tokens") * F.col(f"p_{d}")) for d in TARGETS]).first()
    assert [x / sum(sums) for x in sums] == pytest.approx(list(TARGETS.values()), abs=0.01)


def test_copies_have_the_rates_on_average(spark):
    drawn = spark.range(20_000).withColumn("rate", F.element_at(F.array(*map(F.lit, (0.0, 0.3, 0.63, 1.0, 1.4, 2.75))), (F.col("id") % 6 + 1).cast("int")))
    found = drawn.withColumn("copies", whole_copies(F.col("rate"), "id")).groupBy("rate").agg(F.avg("copies"), F.min("copies"), F.max("copies")).collect()
    for rate, mean, low, high in found:
        assert mean == pytest.approx(rate, abs=0.03) and (low, high) == (int(rate), -int(-rate // 1))


def test_rows_that_share_an_id_are_judged_by_their_own_text(spark, folder):
    one, two, three, four = (passage(900 + i, 60) for i in range(4))
    near = one.split(" ")
    near[59] = "other"
    rows = [(3, one), (7, one), (7, two), (7, two), (7, three), (8, two.upper()), (9, " ".join(near)), (9, four), (9, four.upper())]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    judged = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(frame, NearDuplicates(percent=80)).collect()}
    assert {(3, 56, 3, True), (7, 56, 3, False), (7, 56, 7, True), (8, 56, 7, False), (9, 56, 3, False), (9, 56, 9, True)} <= judged
    left = sorted(tuple(r) for r in corpus_pipeline.near_dedup(spark, frame, folder).collect())
    linked = spark.createDataFrame([(9, one), (9, " ".join(near))], "doc_id long, text string")
    assert {tuple(r) for r in near_duplicates(linked, NearDuplicates(percent=80)).collect()} == {(9, 56, 9, True)}
    assert sorted(r.stays for r in near_duplicate_rows(linked, NearDuplicates(percent=80)).collect()) == [False, True]
    fours = [r for r in left if r[0] == 9]
    assert [r for r in left if r[0] != 9] == sorted([(3, one), (7, two), (7, three)])
    assert len(fours) == 1 and fours[0][1].lower() == four
