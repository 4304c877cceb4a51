import random

import pytest

pytest.importorskip("kgloom.llm")

#: documents with whatever may go wrong: nulls, blanks, long words and texts, repeated rows, odd letters
LONG = " ".join(f"w{i % 977}x{i % 89}" for i in range(30_000))
EDGE_DOCS = [
    (1, None, "en", "a", None),
    (2, "", None, None, 0),
    (3, " \n\t\x0b\x0c\r ", "en", "a", 7),
    (4, "one two", "en", None, 7),
    (5, LONG, "en", "a", len(LONG)),
    (6, "x" * 50_000, None, "a", 50_000),
    (7, "same words here\nsame words here\n" * 40, "en", "a", 1),
    (7, "same words here\nsame words here\n" * 40, "en", "a", 1),
    (8, "same words here\nsame words here\n" * 40, "en", "b", 1),
    (None, "text of a row that has no id " * 9, "en", "b", 1),
    (9, "Żółć 😀 é   \xa0 ünïcode \x00 <|endoftext|> </s>[INST] \\ <\\/s> 'll  12345", "pl", "b", 1),
    (-3, "1234 5678 !!", "en", "b", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ["k1", "k2", "fp", "ids", "decoded", "score", "predicted", "lang_pred", "places", "kept", "n_words", "part", "range", "held_out", "toxic", "h", "n", "key", "root"]


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(EDGE_DOCS, SCHEMA)


@pytest.fixture(scope="session")
def clashing_docs(edge_docs):
    """The same rows with columns named as operators name theirs."""
    from pyspark.sql import functions as F

    return edge_docs.withColumns({c: F.lit("theirs") for c in CLASHES})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def prose():
    """Texts of invented words, the same for equal seeds."""

    def write(seed, n_words, syllables=("ba", "ko", "ri", "tu", "sel", "mo", "nde", "pla")):
        draw = random.Random(seed)
        return " ".join("".join(draw.choices(syllables, k=draw.randint(1, 4))) for _ in range(n_words))

    return write
