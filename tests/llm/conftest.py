import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that the operators use inside or return, here as extra columns of the input.
CLASHING = ("size", "key", "rank", "shard", "fp", "fingerprint", "component_id", "letters", "kept", "batch", "base", "pos")


@pytest.fixture(scope="session")
def small(spark):
    """Documents of the smallest table with awkward rows: nulls, empty, long, repeated, without letters."""
    rows = [(None, None, None, None, None), (None, "a text without an id, and with some more words", "en", None, 3),
            (90001, None, "en", "src1", 0), (90002, "", None, "src1", 0), (90003, " \t\n ", "en", "", 4),
            (90004, "word " * 30_000, "en", "src2", 1), (90005, "12345 67 ...", "en", "src2", 1),
            (90006, "éàü ñ " * 40 + "x" * 200, "fr", "src3", 1), (7, "The same id with another text.", "en", "src3", 1)]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", F.col("n_chars").cast("long"))
    docs = docs.union(spark.createDataFrame(rows, SCHEMA)).union(docs.filter("doc_id in (3, 4)")).union(docs.filter("doc_id = 3"))
    for c in CLASHING:
        docs = docs.withColumn(c, F.lit("other"))
    return docs.coalesce(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def items(spark):
    rows = [(None, None), (9001, None), (9002, ""), (9003, "two words"), (9003, "two words")]
    own = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text")
    return own.union(spark.createDataFrame(rows, own.schema))
