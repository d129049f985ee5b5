"""Fixtures shared by the tests of this folder."""

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: Rows with nulls, empty and very long texts, ties, repeated rows and odd characters.
EDGE = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, "one two three", "en", "a", 13),
    (4, "one two three", "en", "a", 13),
    (5, "Ünïcode wörds \t and\x0bspaces é́ 😀 more words than ten are in this line of text", "en", "b", None),
    (6, "a b c d e f g h i j k l m n o p " * 40, "en", "b", 1),
    (6, "a b c d e f g h i j k l m n o p " * 40, "en", "b", 1),
    (7, " ".join(f"w{i}" for i in range(30000)), "en", "b", 1),
    (8, "same line here\n\nsame line here\nother # $ line\n", "en", "c", 5),
    (9, " \n\t ", "en", "c", 4),
]


def edge(spark):
    """EDGE with columns whose names clash with results."""
    extra = ["component_id", "kept", "shard", "slot", "score", "n_words", "items", "hits", "fp", "key", "block", "size", "_text", "_row", "t", "c0", "c1", "h1", "n"]
    return spark.createDataFrame(EDGE, DOCS).withColumns({c: F.lit("x") for c in extra})


def nothing(spark):
    return spark.createDataFrame([], DOCS)


def table(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")
