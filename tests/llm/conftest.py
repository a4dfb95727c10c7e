import random

import pytest

LONG = "palabra " * 20_000


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, very long, tied and repeated texts."""
    r = random.Random(11)
    words = ["the", "of", "and", "tion", "was", "Ünder", "été", "x1", "über,", "a@b.example", "12", "#"]
    made = [" ".join(r.choice(words) for _ in range(r.randint(1, 120))) for _ in range(40)]
    return [None, "", " ", "\n\n", "\t a  b \r\n c\x0b", LONG, "x" * 50_000, "日本語 テキスト", "a\x00b", *made, *made[:3]]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_texts):
    """Rows with those texts, a row without id, and columns whose names results have, too."""
    rows = [(None if i == 12 else i, t, "en" if i % 3 else None, i, True) for i, t in enumerate(odd_texts)]
    rows += rows[20:23]
    schema = "doc_id long, text string, lang string, n_words long, kept boolean"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
