import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use for columns of their own
    *(T.StructField(name, T.StringType()) for name in ("_row", "_doc", "key", "size", "digest", "row", "score", "unit", "u", "m", "n"))])

LONG = " ".join(f"word{i % 977} of,the;long text{i % 13}" for i in range(30_000))

TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away.", "a"), (2, "The quick  brown fox jumps over the lazy dog\nand runs away.", "a"),
    (3, "the quick brown fox jumps over the lazy dog and runs away.", "b"), (4, "", "b"), (5, None, None), (6, " \t\r\n", "c"),
    (7, "one", None), (8, "one two", "c"), (None, "no id here, at all", "d"), (None, None, "d"), (9, LONG, "a"), (10, LONG + " more", "b"),
    (11, "x" * 5000, "a"), (12, "Licensed under the Apache License, Version 2.0. MIT license; cc-by cc by", "a"),
    (13, "<|endoftext|> special <|startoftext|>text <|endoftext|>", "é"), (14, "Éa Σς ǅ ﬁ é́ 東京   x\x1cy​z 🤖\U0010ffff", "z"),
    (15, "same row", "a"), (15, "same row", "a"), (16, "same row", "b"), (17, "same  row", "b"),
    (18, "one two", "c"), (19, "don't we've I'll  it's\n\n\ttabs  ", "a"), (20, "a" + " b" * 3000, None),
]


@pytest.fixture
def documents(spark):
    def make(rows=TEXTS):
        return spark.createDataFrame(
            [(i, text, "en", source, None, *("clash",) * (len(SCHEMA) - 5)) for i, text, source in rows], SCHEMA).repartition(3)
    return make


@pytest.fixture
def labels(spark):
    def make(rows=()):
        return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")
    return make


@pytest.fixture
def plan(capsys):
    def text(df):
        capsys.readouterr()
        df.explain("formatted")
        return capsys.readouterr().out

    return text
