"""Documents that are awkward in every way an operator must bear."""

import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use for columns of their own
    T.StructField("digest", T.StringType()), T.StructField("shard", T.StringType()), T.StructField("score", T.StringType()),
    T.StructField("keep_id", T.StringType()), T.StructField("predicted", T.StringType()),
    T.StructField("group_size", T.StringType()), T.StructField("ids", T.StringType())])

LONG = " ".join(f"word{k % 977} of{k % 31}" for k in range(60_000)) + "."
BASE = " ".join(f"w{k * k % 101}x{k}" for k in range(60))


def edge_rows():
    texts = [
        (1, "Hello there, it's a fine day. We'll see!"), (2, "HELLO there, it's a fine day. We'll see!"),
        (3, None), (4, ""), (5, None), (6, "   \n\t "), (7, LONG), (8, "x"), (9, "hello THERE, it's a fine day. We'll see!"),
        (10, "Ä ö ü ß É — 漢字。日本語！ 😀😀"), (11, "ä ö ü ß É — 漢字。日本語！ 😀😀"), (12, BASE), (13, BASE + " tail"),
        (14, "one two three four"), (15, "One two THREE four"), (16, "one two three four five"),
        (17, "  no-break　ideographic  two  blanks \r\n"), (18, "a" * 5000), (18, "a" * 5000), (None, "x"), (None, None),
        (19, "12 345 6789 ½ ² ١٢٣"), (20, "''s 's'll'd don't 'tis o'clock")]
    return [(d, t, ["en", "de", None][k % 3], ["src0", None][k % 2], None if t is None else len(t), "d", None, "s", "k", "p", "g", "i")
            for k, (d, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
