import public_tokenizers
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

#: Texts that every operator has to stand: null, empty, blank, one word, long, repeated.
EDGES = [None, "", " \n\t ", "word", "A long one. " * 4000, "same text here", "same text here", "Ünï çödé   日本 🎉", "x" * 3000]


@pytest.fixture
def documents(spark):
    """Documents of the given texts, ids from 0 on; a pair gives its own id."""

    def make(texts, extra=()):
        rows = []
        for k, t in enumerate(texts):
            key, text = t if isinstance(t, tuple) else (k, t)
            rows.append((key, text, "en", "src", None if text is None else len(text), *[0] * len(extra)))
        return spark.createDataFrame(rows, SCHEMA + "".join(f", {c} int" for c in extra))

    return make


@pytest.fixture(scope="session")
def byte_bpe():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def word_bpe():
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture
def edges():
    return list(EDGES)
