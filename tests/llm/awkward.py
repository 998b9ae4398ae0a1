"""Tables that hold what operators must not stumble over."""

from pyspark.sql import DataFrame, SparkSession

LONG = " ".join(f"word{i % 5000}" for i in range(60_000))
PLAIN = "the quick brown fox jumps over the lazy dog and runs far away from here today"


def awkward_docs(spark: SparkSession) -> DataFrame:
    """Nulls in every column, empty, blank and very long texts, repeated rows, ties, columns with clashing names."""
    rows = [
        (1, PLAIN, "en"),
        (1, PLAIN, "en"),
        (2, PLAIN, "en"),
        (3, None, None),
        (4, "", "en"),
        (5, " \t\n", None),
        (None, PLAIN, "en"),
        (None, None, None),
        (6, LONG, "en"),
        (7, LONG + " more", "en"),
        (8, "x" * 300_000, "en"),
        (9, "ÀÉ ñandú 日本語 \U0001f600 é", "es"),
        (10, "one", "en"),
        (11, "one", "en"),
    ]
    rows = [(*r, "s", 0, None, 1, 2.0, [1], 1, "k", 3) for r in rows]
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long, component long, shard int, toxicity double, token_ids array<int>,"
        " n int, text_key string, done int"
    )
    return spark.createDataFrame(rows, schema)


def empty_docs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
