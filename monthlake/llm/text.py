"""Column expressions several operators share. All of them read whole texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthlake.session import configure

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
GAP_CHARS = " \t\n\x0b\x0c\r"
#: Rows of the learn folds of the classifiers: crc32(doc_id as text) mod 3 is not 1.
HELD_OUT = 1


#: Rows and bytes of a batch that travels to a Python worker; both bound its memory.
BATCH_ROWS, BATCH_BYTES = "2000", "16m"


def settings(spark):
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning; a null id belongs to the fold of the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == HELD_OUT


def count_of(text: Column, chars: str) -> Column:
    """How many code points of the text are among `chars`."""
    return F.char_length(text) - F.char_length(F.translate(text, chars, ""))


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
