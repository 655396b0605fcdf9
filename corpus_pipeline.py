"""From raw documents to packed sequences: five stages, each over all rows that the one before kept.

A stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the next one's docs. All but the
last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope.llm.line_dedup import dedup_lines
from shelfscope.llm.ngram_join import one_of_each_group
from shelfscope.llm.packing import pack_documents
from shelfscope.llm.quality import score_quality
from shelfscope.llm.queries import mixed, quality_model
from shelfscope.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return score_quality(docs, quality_model(docs, spark, sf_dir)).where("predicted = 1").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that are repeated across documents; n_chars follows the text."""
    return dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    return one_of_each_group(docs).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sample that follows the target shares."""
    return mixed(docs).where("kept").select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in the training sequences."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("line dedup", lines), ("near copies", near_copies), ("mixing", mixing), ("packing", packing)]

#: The classifier and the tokenizer cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
