import pytest


@pytest.fixture(scope="session")
def texts():
    """Cases every text operator must bear: null, empty, spaces, very long, ties, other scripts."""
    return [None, "", "   ", "\n\t ", "a", "a b", "Hello   world.\n\n two  spaces \n end ", "é ß 中文 字 1234 !!", "word " * 9000 + "end", "x" * 30_000, "same text here now", "same text here now", "<|endoftext|> is text"]


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = [(i, t, "en", "src", 0, "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, spans string")
