import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that the operators use for columns of their own.
        T.StructField("score", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("rewritten", T.StringType()),
        T.StructField("place", T.StringType()),
    ]
)
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes documents of texts or (doc_id, text) pairs, with extra columns of clashing names."""

    def make(texts, lang="en"):
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        rows = [(i, t, lang, "s", len(t) if t is not None else None, "x", "y", "z", "p") for i, t in pairs]
        return spark.createDataFrame(rows, DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def labels(spark):
    return lambda rows: spark.createDataFrame(rows, LABELS)


@pytest.fixture(scope="session")
def small(spark):
    """The documents, pages, labels and conversations of the smallest tables."""
    return lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")


AWKWARD = [None, "", " \n\t", "a", "Ünïcode ß 한국어 🙂", "x" * 30_000, "one two " * 5_000, "same text", "same text"]


@pytest.fixture(scope="session")
def awkward():
    return AWKWARD
