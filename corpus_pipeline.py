"""The corpus pipeline: documents in, training sequences out.

Each stage takes what its predecessor kept, written as Parquet and read again, so that a lost
executor costs the running stage only. Stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeflow.llm import language, linededup, packing, pii, simhash
from lodgeflow.llm.common import read_table
from lodgeflow.session import scratch_path

#: A document stays if this share of its letters is in one language.
MIN_SHARE = 0.4


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text."""
    return docs.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter and texts that no language has ``MIN_SHARE`` of. Where no row
    has a language to learn from, only the former go."""
    model = language.train(docs)
    if model is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    labelled = docs.withColumn("__lang", language.label(docs, model))
    return labelled.filter((F.col("__lang.lang_pred") != language.UNKNOWN) & (F.col("__lang.score") >= MIN_SHARE)).drop("__lang")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out runs of lines that stand earlier in the corpus."""
    return _measured(linededup.dedup(docs, chunks_out="__chunks", lines_out="__lines").drop("__chunks", "__lines"))


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of SimHash near-duplicates."""
    return simhash.keep_one(docs)


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out personal data and the terms that disclose it."""
    return _measured(pii.sanitise(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places every document in training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash_dedup", dedup_documents),
    ("pii", remove_personal_data),
    ("packing", pack_sequences),
]

#: Hashing by content, a learned model and bin packing aren't SQL; tests/llm/test_pipeline.py holds
#: every stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = scratch_path(spark, f"pipeline-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
