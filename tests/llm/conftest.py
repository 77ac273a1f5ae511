import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"

#: Nulls in any column, empty and white texts, ties and repeated rows, a very long text.
ODD = [
    (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n\t ", None, "a", 3), (4, "one two", "en", None, 7), (None, "no id here at all", "fr", "b", None),
    (6, "same text here with more than five words", "en", "a", 40), (6, "same text here with more than five words", "en", "a", 40), (7, "same text here with more than five words", "de", "b", 40),
    (8, "wörter über köpfe 12 !? " * 3000, "de", "b", 9), (9, "x" * 40000, "en", "b", 40000), (10, "12 34 $$ ##", "en", "c", 11), (0, "Ünïcode \U0001f600 ▁ text\x00 end", "fr", "c", 20),
]


@pytest.fixture(scope="module")
def odd(spark):
    from pyspark.sql import functions as F

    # extra columns whose names clash with the operators' own
    extra = ["_slice", "node", "part", "key", "size", "_group", "digest", "rank", "quality", "n_words", "shard", "mix_slot", "_text", "_kept", "_row", "counts", "sig", "_id", "_hash", "_times", "_rank", "_source"]
    return spark.createDataFrame(ODD, DOC).select("*", *[F.lit("x").alias(c) for c in extra])


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)
