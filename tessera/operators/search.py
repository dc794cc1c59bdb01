"""FIL3 with an index: containment search without a full scan.

The index is a posting table of character trigrams, ``(gram, id)``, in hash
buckets of the gram and sorted by it, so a search reads the folders of its own
grams and, of those, the row groups that can hold them. What a pattern must
contain gives the grams; rows that have all of them are candidates, and the
filter itself decides. Characters are folded so that the grams of any text that
a case-insensitive pattern matches are among the text's own.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.audit import audit
from tessera.operators.common import checked_side

BUCKETS = 256
MOST_GRAMS = 16  # of a long pattern the first ones are looked up: the filter decides in any case


def folded(text) -> Column:
    """Lower case of the upper case, as a case-insensitive match compares.
    (Spark drops an upper() that stands directly inside a lower().)"""
    return F.lower(F.translate(F.upper(text), "İ", "I"))


def bucket_of(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def build_text_index(df: DataFrame, path: str, id_col: str = "id", text_col: str = "text") -> None:
    """Write the posting table of all texts (NULL and texts of under three
    characters have no gram). Range partitions spread a gram that most texts
    have over many files. ``id_col`` is unique."""
    grams = F.array_distinct(F.regexp_extract_all(folded(F.col(text_col)), F.lit("(?s)(?=(...))"), F.lit(1)))
    rows = df.select(F.col(id_col).alias("id"), F.explode(grams).alias("gram")).withColumn("bucket", bucket_of(F.col("gram")))
    order = ["bucket", "gram", "id"]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows.repartitionByRange(n, *order).sortWithinPartitions(*order).write.mode("overwrite").partitionBy("bucket").parquet(path)


def required_text(pattern: str) -> list[str]:
    """Runs of ASCII characters that any match of the regular expression holds,
    lower-cased. A pattern that uses more than both engines' common syntax gives
    none, as does one whose parts are all optional."""
    if "(?" in pattern or "\\Q" in pattern or "&&" in pattern:
        return []
    try:
        tree = re._parser.parse(pattern)
    except (re.error, OverflowError, RecursionError):
        return []
    runs: list[str] = []

    def walk(items, run: str) -> str:
        for op, arg in items:
            name = str(op)
            if name == "LITERAL" and arg < 128:
                run += chr(arg).lower()
                continue
            if name == "SUBPATTERN" and not arg[1] and not arg[2]:
                run = walk(arg[3], run)
                continue
            runs.append(run)
            run = ""
            if name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and arg[0] >= 1:
                runs.append(walk(arg[2], ""))  # once at least; what it borders on is not known
        return run
    runs.append(walk(tree, ""))
    return [r for r in runs if len(r) >= 3]


def required_grams(pattern: str, literal: bool = False) -> list[str]:
    """Trigrams that every matching text has. Empty: the index can't help."""
    runs = re.findall(r"[\x00-\x7f]{3,}", pattern.lower()) if literal else required_text(pattern)
    return list(dict.fromkeys(r[i:i + 3] for r in runs for i in range(len(r) - 2)))[:MOST_GRAMS]


def candidates(spark, path: str, grams: list[str], id_type: str = "long") -> DataFrame:
    """Ids whose text has all ``grams``."""
    index = spark.read.schema(f"id {id_type}, gram string, bucket int").parquet(path)
    buckets = [r["b"] for r in spark.createDataFrame([(g,) for g in grams], "g string").select(
        bucket_of(F.col("g")).alias("b")).distinct().collect()]
    hits = index.filter(F.col("bucket").isin(buckets) & F.col("gram").isin(grams))
    return hits.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == len(grams)).select("id")


def search(df: DataFrame, path: str, pattern: str, literal: bool = False, id_col: str = "id", text_col: str = "text",
           **filters) -> DataFrame:
    """The rows of ``audit(df, text=pattern, ...)``, of which only the
    candidates' texts are compared. A pattern without a required trigram is
    answered by the scan: that is decided by the pattern, not by sizes."""
    if text_col != "text":
        raise ValueError("audit filters the column text")
    grams = required_grams(pattern, literal)
    if grams:
        found = candidates(df.sparkSession, path, grams, dict(df.dtypes)[id_col]).withColumnRenamed("id", "_hit")
        df = df.join(checked_side(found), F.col(id_col) == F.col("_hit"), "left_semi")
    return audit(df, text=pattern, literal=literal, **filters)
