"""Small document tables with the edge cases that every operator has to bear."""

from pyspark.sql import types as T

DOC_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # columns whose names clash with those that operators add
    T.StructField("rank", T.LongType()), T.StructField("key", T.StringType()),
    T.StructField("fp", T.StringType()), T.StructField("_key", T.StringType()),
    T.StructField("_maybe", T.StringType()), T.StructField("sequence_id", T.StringType())])

LONG = " ".join(f"word{i % 997} and{i}" for i in range(30000))

EDGE_TEXTS = [
    (1, "One two  three four five six.\nSeven eight nine ten eleven.", "en", "a"),
    (2, "One two three four five six. Seven eight nine ten eleven.", "en", "a"),
    (3, "", "en", "a"), (4, None, None, "b"), (5, " \t\n ", "de", None), (6, None, "fr", "b"),
    (7, LONG, "en", "a"), (8, LONG, "en", "c"), (9, LONG + " more", "en", "c"),
    (10, "ÄÖÜ ß straße <|endoftext|> it's 3 ½", "de", "c"), (11, "tie tie tie tie tie", "en", "a"),
    (12, "tie tie tie tie tie", "en", "a"), (12, "tie tie tie tie tie", "en", "a"),
    (13, "\x0b\x0cx\r\ny\x1cz w", "es", "b"), (None, "no id here at all, none", "en", "b"),
    (None, None, None, None), (16, "1234 !!! ???", "en", "d")]


def edge_docs(spark, rows=EDGE_TEXTS):
    full = [(d, t, lang, s, None if t is None else len(t), 1, "k", "f", "x", "m", "q") for d, t, lang, s in rows]
    return spark.createDataFrame(full, DOC_SCHEMA)


def docs_of(spark, texts):
    return edge_docs(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])


def empty_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
