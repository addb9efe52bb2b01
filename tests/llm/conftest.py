import pytest

#: doc_id, text, lang, source: nulls, empty and long texts, ties, repeated rows, clashing extra columns.
DOCS = [
    (1, "a b c d e f g h i j k l", "en", "s1"),
    (2, None, None, None),
    (3, "", "en", "s1"),
    (4, "one two three four five one two three four five six seven eight nine ten", "en", "s2"),
    (5, "a b c d e f g h i j k l", "en", "s1"),
    (5, "a b c d e f g h i j k l", "en", "s1"),
    (6, "line\nline\n  \nline # * $\x0b\x1fx", "fr", "s3"),
    (7, "word " * 3000, "de", "s3"),
    (8, "éa ÀB <|endoftext|> it's 12 345 +1 (743) 555-3824 x@y.example.com 10.0.0.1 \u00a0\u2003", "fr", None),
    (9, " ".join(f"w{i}" for i in range(4000)), "en", "s2"),
    (10, "cc by cc by GENERAL Public LICENSE all rights reserved", "en", "s2"),
    (None, "no id here", "en", "s2"),
    (11, "\n \t", "en", "s9"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def docs(spark):
    frame = spark.createDataFrame(DOCS, SCHEMA)
    from pyspark.sql import functions as F

    # names that the operators return or use themselves
    return frame.selectExpr("*", "1 as n_words", "'x' as kept", "2 as size", "3 as component_id", "4 as label", "5 as score", "length(text) as n_chars").repartition(3, F.col("doc_id"))


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
