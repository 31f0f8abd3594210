"""Corpus pipeline: quality classifier, near-dedup, repeated passages, source mix, packing.

Each stage takes (spark, docs, sf_dir), where docs is what the stage before kept, and returns a
DataFrame; all but the last return the columns of documents. `run` writes each stage's rows as
Parquet to the shared folder and reads them for the next one.

Defined cases: rows with null text pass through the stages as their operators say (scored like an
empty text, links with nothing, size 0, so the mix never takes it); near-dedup goes by rows, so a null
or repeated doc_id makes no difference there; an empty table gives an empty result; extra columns are
kept up to the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthlake.llm import minhash, mixing, packing, quality_classifier, suffix_dedup
from monthlake.llm import text as tx
from monthlake.plans.joins import dimension
from monthlake.session import shared_folder

SHINGLE_WORDS = 5
#: Bytes of a repeated passage that is cut. Of the runs of 51 words in sf0.01 and sf0.1, 99 in 100 have as many.
PASSAGE = 232
DROPPED_IDS = 500_000  # up to so many ids are broadcast; more take a shuffled join


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    tx.settings(spark)
    model = quality_classifier.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = quality_classifier.score(docs, model).filter(F.col("predicted") == 1)
    return kept.select("_row.*").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that of the smallest doc_id, null last.

    Rows count, not ids: each row gets a saved id of its own, so rows that repeat a doc_id and rows
    without one are copies or unique like any other.
    """
    tx.settings(spark)
    path = shared_folder(spark, "rows")
    columns = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    docs.select(F.monotonically_increasing_id().alias("row_id"), columns).write.parquet(path)
    rows = spark.read.parquet(path)
    found = minhash.near_duplicates(rows.select(F.col("row_id").alias("doc_id"), "row.text"), k=SHINGLE_WORDS)
    path = shared_folder(spark, "groups")
    found.select(F.col("doc_id").alias("row_id"), "component_id").write.parquet(path)
    order = F.struct(F.col("row.doc_id").isNull().alias("without"), F.col("row.doc_id").alias("doc_id"), "row_id")
    grouped = rows.select("row_id", order.alias("order")).join(spark.read.parquet(path), "row_id")
    kept = grouped.groupBy("component_id").agg(F.min("order").alias("order")).select("order.row_id")
    path = shared_folder(spark, "dropped")
    grouped.select("row_id").join(kept, "row_id", "left_anti").write.parquet(path)
    return rows.join(dimension(spark.read.parquet(path), DROPPED_IDS), "row_id", "left_anti").select("row.*")


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that repeat elsewhere in the corpus."""
    tx.settings(spark)
    return suffix_dedup.remove(docs, PASSAGE)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    tx.settings(spark)
    return mixing.mixed_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document, with its sequence and place there."""
    tx.settings(spark)
    return packing.pack(docs, packing.default_tokenizer())


STAGES = [
    ("quality_classifier", quality),
    ("minhash_dedup", near_dedup),
    ("suffix_dedup", passages),
    ("source_mix", mix),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tx.documents(spark, sf_dir)
    for name, stage in STAGES:
        path = shared_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


#: Learnt scores, hash signatures and a tokenizer are not SQL; tests compare with brute force.
ORACLE_SQL = None
