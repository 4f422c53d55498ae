import pytest

EDGE_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, extra int"


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty and long texts, ties and repeated rows."""
    words = " ".join(f"w{i % 977}x{i // 977}" for i in range(30_000))
    shared = " ".join(f"shared{i}" for i in range(60))
    return [
        (1, "The Same text, twice.", "en", "a", 1, 1), (2, "the same TEXT, twice.", "en", "a", 1, 1),
        (3, None, None, None, None, None), (4, "", "en", "b", 0, 2), (5, " \t\r\n\x0b\x0c ", "de", "b", 7, 2),
        (6, words, "en", "c", 1, 3), (7, "lead " + shared + " tail", "en", "a", 1, 3),
        (8, "other " + shared + " end", "fr", "a", 1, 3), (9, "É é ÀB ab", "fr", "d", 1, 3),
        (10, "é É Àb AB", "fr", "d", 1, 3), (11, "same row", "en", "a", 1, 1),
        (11, "same row", "en", "a", 1, 1), (None, "no id " + shared, "en", None, 3, None),
        (12, "1234 5678 | ###", None, "e", 3, None), (13, "x" * 100_000, "en", "e", 3, None),
        (14, "rep " * 400, "en", "e", 3, 9), (15, "nb sp   <|endoftext|> a  b 'Ll", "en", "e", 1, 1),
    ]


@pytest.fixture()
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, EDGE_SCHEMA).repartition(3)


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)
