import pytest

from bedwatch.session import build_session

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def documents(spark):
    return [(r["doc_id"], r["text"], r["source"]) for r in
            spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, row int, ids string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, columns whose names operators use themselves."""
    long_text = "the quick brown fox token = abcdefghijkl0123 " * 4000
    rows = [(1, "Hello World again", "en", "a", 17, "x", 1, "y"), (1, "Hello World again", "en", "a", 17, "x", 1, "y"),
            (2, None, None, None, None, None, None, None), (3, "", "en", "a", 0, "x", 1, "y"),
            (4, long_text, "en", "b", len(long_text), "x", 1, "y"), (None, "Hello World again", "en", None, 17, "x", 1, "y"),
            (5, "   \n\t ", "en", "b", 6, "x", 1, "y"), (6, "▁ literal ▁▁ marker  é   🙂", "en", "b", 9, "x", 1, "y"),
            (7, "hello world AGAIN", "en", "c", 17, "x", 1, "y")]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
