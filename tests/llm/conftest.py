import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def docs(spark):
    """Documents from ``(doc_id, text)`` pairs."""

    def make(*pairs):
        rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in pairs]
        return spark.createDataFrame(rows, DOCS)

    return make


#: Texts that every operator must take: null, empty, blank, marks, controls, other scripts, very long.
ODD_TEXTS = [None, "", " ", "  two  blanks ", "▁mark", "\x00\t\n", "日本語 text", "<s> </s> <unk>", "é e\u0301 ß İ", "x" * 5000, "word " * 30000]
