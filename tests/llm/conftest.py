import pytest

LONG = "lorem ipsum dolor sit amet " * 4000 + "end"
COPY = "the cat sat on the mat and looked at the moon over the old town hall today"
#: Nulls in every column, empty and very long texts, repeated rows and ids, equal texts, clashing extra columns.
ROWS = [
    (1, COPY, "en", "a", 7, "x"),
    (2, COPY + " ", "en", "a", 7, "x"),
    (3, COPY.replace(" ", "\n"), None, "b", None, None),
    (3, COPY.replace(" ", "\n"), None, "b", None, None),
    (4, COPY + " again", "de", None, 1, "y"),
    (5, "", "en", "a", 0, ""),
    (6, None, None, None, None, None),
    (None, "only one", "fr", "c", 2, "z"),
    (7, LONG, "en", "b", 3, "x"),
    (8, " \t\n ", "en", "b", 3, "x"),
    (9, "Ünï çödé 漢字 𝔸 ▁ a▁b c", "fr", "c", 3, "x"),
    (9, "another text under the same id, with eleven words in it now", "fr", "c", 3, "x"),
    (10, COPY.upper(), "en", "a", 7, "x"),
]
SCHEMA = "doc_id long, text string, lang string, source string, ids long, metrics string"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
