import pytest

LONG = "lorem ipsum dolor sit amet " * 8000

ODD = [
    (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n\t ", None, None, 3),
    (4, "One two three four five six seven eight nine ten eleven.", "en", "a", 54),
    (4, "One two three four five six seven eight nine ten eleven.", "en", "a", 54),
    (5, "One two three four five six seven eight nine ten eleven.", "de", "b", 54),
    (6, LONG, "en", "b", len(LONG)), (None, "no id here", "fr", "b", 10), (7, "É ß 日本", "ja", None, 6),
]
COLUMNS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
CLASH = ", fp BIGINT, n_words STRING, size INT, row STRING, kept INT, h BIGINT, word STRING"


@pytest.fixture
def odd_docs(spark):
    """Nulls, empty and long texts, repeats, and extra columns with names the operators use."""
    rows = [(*r, 1, "x", 2, "y", 3, 4, "z") for r in ODD]
    return spark.createDataFrame(rows, COLUMNS + CLASH)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def tables(spark):
    """Reads a small table whole."""
    return lambda name, sf="sf0.001": spark.read.parquet(f"/root/testdata/{sf}/{name}.parquet")
