"""Small tables with the awkward rows that every operator must take."""

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
LONG = " ".join(f"word{i % 977}" for i in range(40_000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog. " * 12, "en", "a", 1),
    (2, "The quick brown fox jumps over the lazy dog. " * 12, "en", "a", 1),
    (2, "The quick brown fox jumps over the lazy dog. " * 12, "en", "a", 1),
    (3, None, None, None, None),
    (4, "", "en", "b", 0),
    (5, " \t\n ", "en", "b", 4),
    (6, "Ünïcödé straße — 漢字かな 🙂 x́ don't 12 ³ ½", "de", "b", 5),
    (7, LONG, "en", "c", len(LONG)),
    (None, "a text without an id", "en", "c", 20),
    (None, None, "en", None, None),
    (8, "a" * 5_000, "en", "ü", 5_000),
    (9, "one", "en", "c", 3),
]


def docs(spark, rows=ROWS):
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def clashing(spark):
    """Extra columns under names that operators use themselves."""
    from pyspark.sql import functions as F
    names = ("fp", "score", "ids", "row", "key", "h", "rank", "token", "size", "rule", "verdict", "host", "path", "slots", "block", "n", "w")
    return docs(spark).withColumns({c: F.lit(c) for c in names})
