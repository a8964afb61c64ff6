import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "the quick brown fox jumps over the lazy dog " * 20_000
#: Null, empty, wordless, one-word, repeated and very long texts, nulls in every column, ties.
EDGES = [
    (1, None, None, None, None),
    (2, "", "en", "web", 0),
    (3, " \t\n", "en", None, 3),
    (4, "Word", "en", "web", 4),
    (5, "word", None, "web", 4),
    (6, LONG, "en", "web", len(LONG)),
    (7, LONG.upper(), "en", "books", len(LONG)),
    (8, "a b c d e f g h", "en", "books", 15),
    (8, "a b c d e f g h", "en", "books", 15),
    (9, "Ünïcödé \U0001f600 \u0000 é </s>", "fr", "", 20),
]


@pytest.fixture(scope="session")
def edges(spark):
    """The edge rows, with further columns whose names the operators use themselves."""
    rows = spark.createDataFrame(EDGES, SCHEMA)
    clash = ["size", "pattern", "rep", "component", "bytes", "prefix", "spans", "hashes", "bucket", "member_id", "kept", "mix_times"]
    return rows.select("*", *[F.lit("x").alias(c) for c in clash])


@pytest.fixture(scope="session")
def no_rows(edges):
    return edges.filter("false")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}
