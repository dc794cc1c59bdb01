"""Registered queries of this subpackage: each runs its operator over the whole
table with production parameters. ``ORACLES`` holds DuckDB SQL where SQL can
express the result; the others are tested against brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (crosstok, filter_audit, langid, mips, mixing, neardup, packing, piece, repair, rules, slots,
                         token_count, warc)
from tessera.llm.common import new_folder, read_table
from tessera.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(read_table(spark, sf_dir, "documents"))


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mips.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece.encode_documents(read_table(spark, sf_dir, "documents"))


def op4_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = slots.shard_documents(read_table(spark, sf_dir, "documents"), new_folder(spark, "slot-map"))
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard",
                      F.col("vslot").alias("virtual_slot"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.encode_and_read(read_table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs.filter(~langid.held_out())))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rules.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return out.select("doc_id", *rules.COUNTS, "base_failed", "kept", F.col("stratum"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(read_table(spark, sf_dir, "pages"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read_table(spark, sf_dir, "documents"), words=2)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op11_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosstok.align_documents(read_table(spark, sf_dir, "documents"))


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", F.col("source"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_exact_topk, op3_sentencepiece, op4_virtual_slots, op5_token_files, op6_language_id,
    op7_quality_rules, op8_warc, op9_near_duplicates, op10_packing,
    op11_cross_tokenizer, op12_source_mix, op13_filter_audit)}
