from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, part string, row long, print long, key string, size long"

LONG = "Some words, here and there. " * 4000
TEXTS = [
    (0, "The quick brown fox jumps over the lazy dog. It was late."), (1, "the quick  brown fox\njumps over the lazy dog.It was late."), (2, ""), (3, None), (4, " \n\t "), (5, LONG), (6, LONG + "end"),
    (7, "ein kurzer Satz über Äpfel, 😀 und ﬁn"), (8, "THE QUICK!! BROWN!! FOX!!"), (9, "<|endoftext|> special </s>[INST] x"), (10, "The quick brown fox jumps over the lazy dog. It was late."), (None, "no id here at all, or is there"), (12, "a"),
]


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, blanks, very long texts, copies, a repeated row, and extra columns whose names operators use inside."""
    rows = [(i, t, None if i == 7 else "en", None if i in (3, 8) else f"s{(i or 0) % 3}", None, "p", 5, 6, "k", 7) for i, t in [*TEXTS, TEXTS[0]]]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def none(docs):
    return docs.where("false")


@pytest.fixture(scope="session")
def path():
    import public_tokenizers

    return public_tokenizers.path
