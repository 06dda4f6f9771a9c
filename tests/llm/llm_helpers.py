"""Edge-case rows shared by the tests of this folder."""
import random

import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

# Columns besides those of documents carry names that operators use inside.
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("score", T.StringType()),
    T.StructField("key", T.LongType()), T.StructField("kept", T.StringType()),
    T.StructField("shard", T.StringType()), T.StructField("__row", T.StringType()),
    T.StructField("rank", T.StringType()), T.StructField("c0", T.StringType())])


def edge_rows():
    rng = random.Random(3)
    prose = [" ".join(rng.choice("the of and river stone light evening water under bridge over many old words "
                                 "were written near a quiet harbour".split()) + str(rng.randint(0, 9)) * rng.randint(0, 1)
                      for _ in range(60)) for _ in range(4)]
    giant = " ".join(f"wort{rng.randint(0, 3000)}" for _ in range(40_000))
    texts = [(1, None), (2, ""), (3, " \n\t  "), (4, prose[0]), (4, prose[0]), (5, prose[0] + " end"), (6, giant),
             (None, prose[1]), (7, prose[1]), (8, "12 34 ++ 56"), (9, "naïve  café\u3000中文 😀\r\nzwei  Leerzeichen "),
             (10, "a" * 5000), (11, "one two three"), (12, "one two three"), (13, prose[2].replace("the", "THE")),
             (14, prose[3]), (15, prose[3]), (16, "x\n" * 200), (None, None), (17, prose[3][::-1])]
    langs = ["en", None, "de", "en", "fr"]
    return [(i, t, langs[n % 5], None if n % 3 else f"s{n}", None, f"sc{n}", n, "k", None, "r", "1", f"c{n}")
            for n, (i, t) in enumerate(texts)]


def rows_of(df):
    return [r.asDict() for r in df.collect()]


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")
