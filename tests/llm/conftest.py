"""Small tables with every odd case: nulls, empty and long texts, ties, repeats, clashing columns."""

import random

import pytest

SYLLABLES = "the er ion an nd st ha re wh ou ti ing ed en on".split()


def prose(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text, lang, source, n_chars, score, kept, h)."""
    rng = random.Random(5)
    a, b, shared = prose(rng, 200), prose(rng, 90), prose(rng, 60)
    texts = [(1, None), (2, ""), (3, " \n\t "), (4, a), (5, a), (5, a), (6, a + " end"), (7, b), (None, b), (8, "!!! ... 123"),
             (9, prose(rng, 30) + " " + shared + " " + prose(rng, 30)), (10, prose(rng, 40) + " " + shared + " " + prose(rng, 5)),
             (11, "one two"), (12, "One TWO"), (13, prose(rng, 30_000)), (14, "mail x.y@example.com or 10.20.30.40 now"), (None, None),
             (15, "Été naïve \U0001f600 " + b[:200]), (16, "ab\x00cd ef\x00gh")]
    return [(i, t, "en", "src0", len(t or ""), 9.5, "yes", 3) for i, t in texts]


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, kept string, h int"


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
