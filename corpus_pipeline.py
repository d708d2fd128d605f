"""A training corpus from the documents table, in four stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept. Toxic documents go, one document
of each class of near duplicates stays, personal data is replaced by its kind in brackets, and what is left is packed
into sequences of 4096 tokens (rows as in op9).

Defined results: a null text is the empty text, which is not toxic, a copy of other empty texts, and one piece of its end
token; rows with equal or null doc_id are rows of their own, and of copies with one doc_id one stays; texts of any length
are read whole; an empty table gives no rows. All stages but the last keep all columns of their input, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestry.llm import neardup, packing, pii, toxicity
from harvestry.llm.common import staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_first(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

#: Compression distances, minhash classes and packing are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, name)
    return docs
