"""The queries of this subpackage over the driver's tables, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestry.llm import chat, infilling, lexical, mpegts, mtree, neardup, packing, pii, sentencepieces, sharding, substrings, toxicity, warc
from harvestry.llm.common import table


def op1_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op2_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.find(table(spark, sf_dir, "documents"))


def op3_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


def op4_mpeg_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mpegts.digest(table(spark, sf_dir, "documents"))


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op7_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.appended_and_compacted(table(spark, sf_dir, "documents"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.encode(table(spark, sf_dir, "documents"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_range_maximum_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 20)


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infilling.digest(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_pii_bootstrap,
        op2_dart_minhash,
        op3_chat_rotation,
        op4_mpeg_ts,
        op5_exact_topk,
        op6_warc,
        op7_compaction,
        op8_sentencepiece,
        op9_best_fit_packing,
        op10_toxicity,
        op11_range_maximum_search,
        op12_substring_dedup,
        op13_fill_in_middle,
    )
}
ORACLES = {"op3_chat_rotation": chat.ORACLE, "op5_exact_topk": mtree.ORACLE, "op6_warc": warc.oracle(), "op11_range_maximum_search": lexical.ORACLE, "op12_substring_dedup": substrings.ORACLE, "op13_fill_in_middle": infilling.ORACLE}
