import pytest

SF_SMALL = "/root/testdata/sf0.001"

LONG = " ".join(f"w{i}" for i in range(30_000))
CLASHES = ("key", "n", "sig", "short", "block", "shard", "bucket", "size", "total", "matches", "words", "spans", "base_spans",
           "_copies", "_bucket", "ids", "score", "tile", "label", "_key")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows and ids,
    and columns named like those the operators use inside."""
    rows = [(1, "one two three four five six seven", "en", "a", 33), (1, "one two three four five six seven", "en", "a", 33),
            (2, "One, two three four five six SEVEN!", None, None, None), (None, "no id here but seven words", "en", "b", 1),
            (None, None, None, None, None), (3, "", "en", "a", 0), (4, None, "de", "a", 0), (5, "one", "en", "a", 3),
            (6, "one", "en", "a", 3), (7, LONG, "en", "c", len(LONG)), (8, LONG + " tail", "en", "c", 1),
            (9, "x" * 50_000, "en", "c", 1), (10, " \n\t ", "en", "c", 1), (11, "é漢字 \U0001f600 ünï", "fr", "c", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame(rows, schema)
    for c in CLASHES:
        df = df.selectExpr("*", f"'{c}' AS `{c}`")
    return df


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
