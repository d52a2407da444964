import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, n_tokens string, score string, component_id string, "
    "slot string, rate string, copies string, key string, u string, line string"
)


def passage(seed, words, letters="abcdefgh"):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice(letters) for _ in range(draw.randint(2, 7))) for _ in range(words))


def corpus():
    """Texts with every oddity: (id, text, lang)."""
    base = passage(1, 160)
    near = base.split(" ")
    near[80] = "other"
    tail = passage(2, 60)
    odd = [
        (0, None, None),
        (1, "", "en"),
        (2, " \t\n\x0b ", "en"),
        (3, "One", "en"),
        (4, "one", "de"),
        (5, base, "en"),
        (6, base.upper(), "en"),
        (7, " ".join(near), "en"),
        (8, base, None),
        (9, base.replace(" ", "\n "), "en"),
        (10, passage(3, 50) + " " + tail, "de"),
        (11, tail + " " + passage(4, 50), "de"),
        (12, "éÉß 漢字 \U0001f642 " * 40, "fr"),
        (13, "a" * 700, "fr"),
        (14, "ab " * 400, "fr"),
        (15, passage(5, 12_000), "es"),
        (16, passage(5, 12_000)[9_000:30_000], "es"),
        (17, "12 34, 56!", "en"),
        (18, "\x00\x1f\x7f|", None),
        (19, "one two three four", "en"),
        (20, "one two three four", "en"),
    ]
    return odd + [(30 + i, passage(100 + i, 30 + i % 40), "ende"[2 * (i % 2) :][:2]) for i in range(40)]


@pytest.fixture(scope="session")
def texts():
    return {d: t for d, t, _ in corpus()}


@pytest.fixture(scope="session")
def docs(spark):
    """The corpus with columns whose names the operators use themselves."""
    rows = [(d, t, lang, f"s{d % 3}", len(t or ""), *["x"] * 9) for d, t, lang in corpus()]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def odd_rows(spark):
    """NULL ids, and rows that are there twice."""
    text = passage(9, 40)
    rows = [(None, text), (None, None), (7, text), (7, text), (9, passage(10, 40)), (None, text)]
    return spark.createDataFrame([(d, t, "en", *[None] * 11) for d, t in rows], SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
