import duckdb
import pytest

from tenureframe.llm.common import prepare_workers

TESTDATA = "/root/testdata"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    prepare_workers(spark)


@pytest.fixture(scope="session")
def small_dir():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def small_docs(small_dir):
    """(doc_id, text) of the smallest documents, by id."""
    sql = f"SELECT doc_id, text FROM '{small_dir}/documents.parquet' ORDER BY doc_id"
    return duckdb.execute(sql).fetchall()


# Nulls in any column, empty and very long texts, ties, repeated rows.
LONG = "lorem ipsum dolor " * 20_000
ODD = [
    (1, None, None, None),
    (2, "", "en", "s"),
    (3, "one two three four five six", "en", "s"),
    (4, "one two three four five six", None, "s"),
    (4, "one two three four five six", None, "s"),
    (5, LONG, "fr", None),
    (6, " \t\n ", "fr", "s"),
    (None, "no id here", "en", "s"),
    (7, "Ünï­cödé 한국어 😀 \u0000 end", "de", "s"),
    (8, "x" * 5000, "de", "s"),
]
# Further columns, some with names the operators use inside.
EXTRA = (
    "doc_id long, text string, lang string, source string, id long, digest string, bucket int, "
    "row long, item string, range long, guest boolean, host string, path string, score double, "
    "lang_pred string, fp long, doc long, tag string, start long, shard string, kept boolean"
)


@pytest.fixture(scope="session")
def odd(spark):
    rest = (9, "d", 1, 2, "i", 3, True, "h", "p", 0.5, "zz", 4, 5, "t", 6, "sh", False)
    return spark.createDataFrame([row + rest for row in ODD], EXTRA)


@pytest.fixture(scope="session")
def none(odd):
    return odd.filter("false")
