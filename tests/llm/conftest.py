import pytest
from pyspark.sql import types as T

LONG = "the quick brown fox jumps over the lazy dog " * 6000
NOISE = "".join(chr(0x4E00 + i * 7 % 5000) for i in range(30000))

DOCS = [
    (1, None, "en", "a", 1),
    (2, "", None, None, None),
    (3, "Released under the MIT License. mit license mit license", "en", "a", 2),
    (3, "Released under the MIT License. mit license mit license", "en", "a", 2),
    (None, "no id here but some words in a line\nno id here but some words in a line\n", "en", "b", 3),
    (4, LONG, "en", "hot", 4),
    (5, "x" * 200_000, "de", "hot", 5),
    (6, NOISE + " <|endoftext|> " + NOISE, "fr", "hot", 6),
    (7, "tab\there\x00nul ▁ \U0001F600 end  of   it \r\n", "es", "hot", 7),
    (8, "12345 67890 !!! ***", "en", "b", 8),
    (9, "The GNU Genral Public Licence, version 3. Apache  Licens", "en", "b", 9),
]
COLUMNS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])
# Names the operators use inside or put out themselves.
CLASHING = ("id", "host", "key", "t", "n_words", "matches", "spans", "piece_ids", "items",
            "class_id", "kept", "score")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, repeated rows and clashing extra columns."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(DOCS, COLUMNS).repartition(3)
    return df.withColumns({c: F.lit(c) for c in CLASHING})


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
