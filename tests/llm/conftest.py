import sys
from pathlib import Path

import pytest
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType())]
)
SMALL = "/root/testdata/sf0.001"


def prose(seed, n):
    """n words that hardly repeat."""
    import random

    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(3, 7))) for _ in range(n))


# Nulls in every column, empty, blank, repeated rows, ties, other alphabets, one very long text.
AWKWARD = [
    (1, None, "en", "s1"),
    (2, "", None, None),
    (3, " \n\t ", "en", "s1"),
    (None, prose(4, 120), "en", "s1"),
    (5, prose(5, 120), "en", None),
    (5, prose(5, 120), "en", None),
    (6, prose(5, 120), "en", "s2"),
    (7, "one", "de", "s2"),
    (8, "ж" * 900 + " 漢字 é́  x", None, "s2"),
    (9, prose(9, 40_000), "en", "s1"),
    (10, "same words " * 300, "en", "s3"),
]


@pytest.fixture(scope="session")
def batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return spark


@pytest.fixture()
def awkward(batches):
    return batches.createDataFrame(AWKWARD, DOCS)


@pytest.fixture()
def empty(batches):
    return batches.createDataFrame([], DOCS)


@pytest.fixture()
def make(batches):
    def build(texts):
        rows = [(i, t, "en", f"s{i % 3}") for i, t in enumerate(texts)]
        return batches.createDataFrame(rows, DOCS)

    return build


@pytest.fixture()
def folder(batches, tmp_path):
    """Writes frames as the tables of a data folder; returns its path."""

    def write(**tables):
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
