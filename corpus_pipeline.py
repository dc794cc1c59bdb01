"""The corpus pipeline: quality rules, language ID, near-duplicates, packing.

Each stage reads the table its predecessor wrote. All but the last return the
columns of ``documents`` (and any others the table has, whatever their names);
the last returns the packed pieces. Null, empty and very short texts fail the
base rule and go in the first stage; very long texts are read whole by all.
In near-duplicate removal, texts that share a doc_id are judged one by one, rows
without a doc_id are in no group, and of rows equal in doc_id and text (also
without a doc_id) one stays. An empty table gives an empty result at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import langid, neardup, packing, rules
from tessera.llm.common import cut, read_table

#: DuckDB SQL for run()'s rows: the cutoffs, the classifier and the packing
#: can't be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: rows that fail the base rule or a certified cutoff go."""
    return rules.keep_good(docs, read_table(spark, sf_dir, "labels", "doc_id", "quality"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: rows without letters or without a clear language go."""
    return langid.keep_identified(docs, langid.train(docs.filter(~langid.held_out())))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9, five-word shingles, text by text: the first text of each
    group stays (smallest doc_id); texts that share a doc_id are judged apart.
    Of rows equal in doc_id and text, also without a doc_id, one stays: the
    first by a hash of its other columns."""
    names = docs.columns
    rows = docs.toDF(*[f"c{i}" for i in range(len(names))])  # so that no name can clash or holds a dot
    doc, text = (f"c{names.index(c)}" for c in ("doc_id", "text"))
    gone, copies = neardup.repeated(rows.select(F.col(doc).alias("doc_id"), F.col(text).alias("text")), words=5, percent=80)
    again = copies.groupBy("doc_id", "text_hash").count().filter("count > 1").select("doc_id", "text_hash")
    marks = gone.withColumn("gone", F.lit(1)).unionByName(again.withColumn("gone", F.lit(0)))
    marks = marks.groupBy("doc_id", "text_hash").agg(F.max("gone").alias("gone")).select(
        F.col("doc_id").alias("mark_id"), F.col("text_hash").alias("mark_hash"), "gone")
    # what is marked grows with the corpus: one plan at every size, no broadcast
    same = F.col(doc).cast("long").eqNullSafe(F.col("mark_id")) & F.xxhash64(text).eqNullSafe(F.col("mark_hash"))
    left = rows.join(marks.hint("shuffle_hash"), same, "left").filter("gone IS NULL OR gone = 0")
    one = left.filter("gone IS NULL").select(*rows.columns)
    rest = [c for c in rows.columns if c not in (doc, text)]
    other = F.struct(*rest) if rest else F.lit(0)
    first = left.filter("gone = 0").groupBy(doc, text).agg(
        F.min_by(other, F.xxhash64(F.to_json(F.struct(other.alias("r"))))).alias("other"))
    first = first.select(*[F.col(c) if c in (doc, text) else F.col("other")[c].alias(c) for c in rows.columns])
    return one.unionByName(first).toDF(*names)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: pieces in sequences of at most 2048 tokens."""
    return packing.pack(docs)


STAGES = [("quality", quality), ("language", language), ("near_duplicates", near_duplicates), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
