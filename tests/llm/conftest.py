import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make(spark):
    """A documents table from texts, or from (doc_id, text) pairs."""

    def made(texts, schema=DOCS):
        rows = [x if isinstance(x, tuple) else (k, x) for k, x in enumerate(texts)]
        return spark.createDataFrame(
            [(i, t, "en", "a", len(t or "")) for i, t in rows], schema
        ).repartition(3)

    return made


@pytest.fixture(scope="session")
def given(spark):
    def read(table):
        return spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet")

    return read


def by_id(df):
    return {row["doc_id"]: row for row in df.collect()}
