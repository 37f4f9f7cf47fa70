import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, key string, block int, score double, __copies int, h string"


@pytest.fixture(scope="session")
def docs(spark):
    """Builds documents from (doc_id, text, lang, source); the other columns
    have names that operators use inside."""

    def build(rows):
        full = [(i, t, lang, source, len(t) if t is not None else None, 7, "k", 1, 0.5, 3, "x") for i, t, lang, source in rows]
        return spark.createDataFrame(full, SCHEMA)

    return build


def _words(seed, n, kinds=400):
    import random

    r = random.Random(seed)
    parts = ["the", "and", "of", "re", "tion", "an", "er", "in", "ou", "st", "le", "ba", "ko"]
    vocabulary = ["".join(r.choice(parts) for _ in range(r.randint(1, 4))) for _ in range(kinds)]
    return [r.choice(vocabulary) for _ in range(n)]


@pytest.fixture(scope="session")
def words():
    return _words


@pytest.fixture(scope="session")
def odd(words):
    """Rows that every operator must take: nulls in every column, empty, white
    space only, a very long text, ties and repeated rows."""
    long = " ".join(words(5, 30_000, 3_000))
    plain = " ".join(words(6, 120))
    return [
        (1, plain, "en", "a"),
        (1, plain, "en", "a"),
        (2, plain, "en", "b"),
        (3, None, "en", "a"),
        (4, "", None, None),
        (5, " \t\n\x0b\x0c\r ", "fr", "b"),
        (6, long, "en", "a"),
        (None, plain + " more", "en", None),
        (None, None, None, None),
        (7, "one", "en", "a"),
        (8, "One two", "en", "a"),
        (9, "ÉTÉ İstanbul ﬁn ½ x² 漢字 😀 \xa0 a\x85b", "fr", "b"),
    ]
