import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _prose(seed: int, words: int) -> str:
    """Words that hardly repeat, from a fixed rule."""
    state, out = seed * 7919 + 13, []
    for _ in range(words):
        state = (state * 1103515245 + 12345) % (1 << 31)
        out.append("".join("bcdfglmnprst"[(state >> s) % 12] + "aeiou"[(state >> (s + 4)) % 5] for s in (3, 9, 15)))
    return " ".join(out)


@pytest.fixture(scope="session")
def prose():
    return _prose


@pytest.fixture(scope="session")
def hard_docs(spark):
    """Null, empty, blank, short, very long, repeated and copied texts, and null and repeated ids."""
    base = _prose(1, 200)
    rows = [
        (1, base, "en"),
        (2, base, "en"),
        (2, base, "en"),  # a repeated row
        (3, base.replace(base.split()[100], "CHANGED"), None),
        (4, None, "en"),
        (5, "", "en"),
        (6, " \t\n\x0b\f\r", "en"),
        (7, "Two words", None),
        (8, _prose(2, 60_000), "de"),
        (None, _prose(3, 120), "en"),
        (None, None, None),
        (9, "É à la « carte » ok\nok\nok 日本 🙂 don't", "fr"),
        (10, base.upper(), "en"),
    ]
    return spark.createDataFrame([(i, t, g, None, None) for i, t, g in rows], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


#: Names that the operators use inside or return.
CLASHING = "badness counts kept found score row key node component bucket slot piece start length sequence_id _n _text"


@pytest.fixture(scope="session")
def clashing():
    from pyspark.sql import functions as F

    def add(df):
        return df.withColumns({name: F.lit("x") for name in CLASHING.split()})

    return add
