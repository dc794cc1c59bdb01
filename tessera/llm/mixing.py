"""Mixing sources to target weights.

Each source gets a budget of words by weight, at most ``limit`` times what it
has; what it can't take is shared again among the others. Documents get
hash-random keys, are range-sorted by source and key, and a distributed prefix
sum of their sizes says which lie before the source's budget: the budget is cut
exactly, within one document. A source whose budget exceeds its size is taken
whole as often as it fits (epochs), and the rest is cut from one more epoch.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tessera.llm.common import cut
from tessera.operators.common import with_row_id

WORD = r"[^\x20\x09-\x0D]+"
PATTERN = (1, 2, 3)
LIMIT = 3
SEED = "mix"


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          seed: str = SEED) -> DataFrame:
    """``(doc_id, source, size, key)`` per row: words of the whole text, and a
    hash-random key of id and text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
                       F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")),
                                         text)).alias("key"))


def weighted(rows: DataFrame, pattern: tuple[int, ...] = PATTERN) -> DataFrame:
    """``(source, source_size, weight)``: the sources by code point, null last,
    weigh as ``pattern`` says, repeating."""
    sources = cut(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    order = [F.col("source").isNull(), F.col("source")]
    table = F.array(*[F.lit(w) for w in pattern])
    return with_row_id(sources, order, "_no").select(
        "source", "source_size", F.element_at(table, (F.col("_no") % len(pattern)).cast("int") + 1).alias("weight"))


def targets(sources: DataFrame, total: int, limit: int = LIMIT) -> DataFrame:
    """Adds ``target``: shares of ``total`` by ``weight``, none above ``limit``
    times ``source_size``. Each round is one aggregate over the source table:
    sources whose share exceeds their limit stop there, and the excess is shared
    anew. Shares only grow, so a stopped source never starts again; the rounds
    end when no further source stops."""
    cap = F.col("source_size") * limit
    wide = "decimal(38,0)"
    left, weights = total, sources.agg(F.sum("weight")).first()[0] or 0
    while weights:
        above = F.col("weight").cast(wide) * F.lit(Decimal(left)) > cap.cast(wide) * F.lit(Decimal(weights))
        r = sources.agg(F.coalesce(F.sum(F.when(above, cap)), F.lit(0)), F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0))).first()
        if (total - r[0], r[1]) == (left, weights):
            return sources.withColumn("target", F.when(above, cap.cast("double")).otherwise(
                F.lit(float(left)) * F.col("weight") / F.lit(float(weights))))
        left, weights = total - r[0], r[1]
    return sources.withColumn("target", cap.cast("double"))


def with_prefix(rows: DataFrame) -> DataFrame:
    """Adds ``pid`` and ``before``: sizes of the same source's rows before this
    one within its range partition, by key. Written once, since a repeated
    range shuffle may draw other borders; equal rows are told apart by position,
    so a group of copies spreads over partitions too."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("source").isNull(), F.col("source"), F.col("key"), F.col("_at")]
    rows = rows.withColumn("_at", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    rows = rows.select("doc_id", "source", "size", F.spark_partition_id().alias("pid"))
    schema = StructType([*rows.schema.fields, StructField("before", LongType())])

    def run(batches):
        last, carry = (), 0
        for b in batches:
            if not b.num_rows:
                continue
            source = b.column(1)
            size = b.column(2).to_numpy()
            no = source.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            start = np.flatnonzero(np.r_[True, no[1:] != no[:-1]])
            before = np.cumsum(size) - size
            before -= np.repeat(before[start], np.diff(np.r_[start, len(size)]))
            if (source[0].as_py(),) == last:
                before[:start[1] if len(start) > 1 else len(size)] += carry
            last, carry = (source[-1].as_py(),), int(before[-1] + size[-1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(before)], names=[*b.schema.names, "before"])

    return cut(rows.mapInArrow(run, schema), "prefix")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        pattern: tuple[int, ...] = PATTERN, share: float = 1.0, limit: int = LIMIT, seed: str = SEED) -> DataFrame:
    """Per row: ``doc_id, source, size, source_size, target, taken`` (words the
    mix takes, repeats counted). ``share``: the mix's size as a share of all
    words.

    A source's rows add up to its target rounded to whole words; one row per
    source may be taken in part. Null and empty texts have size 0 and are never
    taken; a null source is a source; repeated rows and rows without an id count
    each. Only the named columns are read, so others can't clash; an empty table
    gives no row. Which rows are taken depends on ids, texts and the seed alone.
    """
    rows = cut(sized(docs, id_col, text_col, source_col, seed), "sizes")
    total = round((rows.agg(F.sum("size")).first()[0] or 0) * share)
    budget = F.round("target").cast("long")
    has = F.greatest("source_size", F.lit(1))
    plan = targets(cut(weighted(rows, pattern), "weights"), total, limit).select(
        "source", "source_size", "target", F.floor(budget / has).cast("long").alias("epochs"),
        (budget % has).alias("part"))
    rows = with_prefix(rows)
    # at most one row per range partition and source border
    w = Window.partitionBy("source").orderBy("pid")
    pieces = rows.groupBy("pid", "source").agg(F.sum("size").alias("held"))
    pieces = pieces.withColumn("offset", F.sum("held").over(w) - F.col("held"))
    pieces = pieces.join(plan, pieces["source"].eqNullSafe(plan["source"])).select(
        F.col("pid").alias("_pid"), pieces["source"].alias("_source"), "offset", "source_size", "target", "epochs", "part")
    same = (F.col("pid") == F.col("_pid")) & F.col("source").eqNullSafe(F.col("_source"))
    rest = F.col("part") - F.col("offset") - F.col("before")
    taken = F.col("epochs") * F.col("size") + F.greatest(F.lit(0), F.least(rest, F.col("size")))
    return rows.join(pieces, same).select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))


def epochs(mixed: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The mix itself: one row per document and epoch that takes it,
    ``(doc_id, epoch, words)``; fewer words than the size where the budget cuts
    the document. At most ``limit`` rows of one document."""
    left = F.col("taken") - F.col("epoch") * F.col("size")
    rows = mixed.filter("taken > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(limit - 1))))
    return rows.filter(left > 0).select("doc_id", "epoch", F.least(left, F.col("size")).alias("words"))
