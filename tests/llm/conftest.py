import duckdb
import pytest

SF = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def rows(documents):
    return [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def db():
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    return connection


@pytest.fixture(scope="session")
def awkward(spark):
    """NULLs in every column, empty and very long texts, ties, repeated rows, and columns named as the operators name theirs."""
    long = " ".join(f"word{i * 7919 % 4001}" for i in range(60_000))
    texts = [None, "", "   \t\n ", "a", "Ünïcode ñandú 東京\x85x\xa0y", long, long, "same text again " * 9, "same text again " * 9, "\n".join(["A line that is long enough to count as one, surely."] * 3)]
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [(None, "no id here, but a text of more than fifty bytes, all the same", None, None, None), (7, "same text again " * 9, "en", None, 144), (7, "same text again " * 9, "en", None, 144)]
    frame = spark.createDataFrame(rows, DOCUMENTS)
    for name in ("hash", "chunk", "keys", "prefix", "ticket", "bits", "side", "length", "doc", "copies"):
        frame = frame.withColumn(name, frame["doc_id"].cast("string"))
    return frame


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)
