import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that operators use themselves, and one that differs from ``text`` by case only
    T.StructField("uid", T.StringType()), T.StructField("digest", T.StringType()),
    T.StructField("id", T.StringType()), T.StructField("TEXT", T.StringType()),
])

PROSE = ("the quick brown fox jumps over a lazy dog while seven wise owls read long books about "
         "quiet rivers and old bridges near the northern town where nobody ever sleeps before dawn")


def row(doc_id, text, source="s"):
    return (doc_id, text, None, source, None if text is None else len(text), "u", None, "x", "other")


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    long_text = " ".join(f"w{i % 977} {PROSE}" for i in range(3000))
    return [
        row(5, PROSE), row(3, PROSE.replace(" ", " \n\t")), row(3, PROSE.replace(" ", " \n\t")), row(9, PROSE.upper()),
        row(None, PROSE), row(None, None), row(7, None), row(8, ""), row(11, "   "), row(12, "one"),
        row(13, long_text), row(14, long_text + " end"), row(None, "only here without an id " + PROSE[:40]),
        row(15, "été übung ñandú 日本 \U0001f600 mixed"), row(15, "a second text under one id"),
        (None,) * 9,
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOCS)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(pairs):
        return spark.createDataFrame([row(i, t) for i, t in pairs], DOCS)

    return make
