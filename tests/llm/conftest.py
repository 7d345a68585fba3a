import pytest

#: Texts that operators must stand: null, empty, blank, very short, very long, repeated rows, ties.
LONG = " ".join(f"wort{i % 977}" for i in range(40_000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with odd texts, a repeated row, a null id, and extra columns whose names operators use inside."""
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "eins"), (5, LONG), (6, "a b c d e f g h i j k"), (6, "a b c d e f g h i j k"), (7, "a b c d e f g h i j k"), (None, "ohne Nummer und Ende"), (8, "Ünï <|im_end|> \u2028 çödé"), (9, "!!! ???")]
    return spark.createDataFrame([(i, t, "de" if i and i % 2 else None, None, 1, "x", "y", 0.5, "z") for i, t in rows], "doc_id bigint, text string, lang string, source string, id int, fp string, key string, score double, row string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
