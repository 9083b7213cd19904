"""Edge-case tables shared by the tests of this folder."""

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])

PLAIN = "the quick brown fox jumps over the lazy dog while the other dogs look on and bark at it"


def docs(spark, texts, first=0, lang="en", extra=None):
    """A documents table over ``texts``; ids count up from ``first``."""
    rows = [(first + i, t, lang, "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    for name, value in (extra or {}).items():
        from pyspark.sql import functions as F
        df = df.withColumn(name, F.lit(value))
    return df


def odd_texts():
    return [None, "", " ", "\n\t \r\n", "a", "<|endoftext|>", "x <|endoftext|>\n y", "漢字かな交じり" * 9,
            "É  \x1c\x85 ½²", "🙂👍🏽" * 5, PLAIN, PLAIN, "a" * 70_000,
            "word " * 30_000, " " * 66_000, "thequickbrown" * 9_000 + " tail", "0" * 3_000 + "x"]


def empty(spark):
    return spark.createDataFrame([], DOCS)


def as_dict(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}
