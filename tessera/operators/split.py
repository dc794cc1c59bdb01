"""Deterministic splits and folds: MLD1 MLD2 MLD3 AGG13.

Randomness is ``md5(id ':' seed)``: independent of partitioning and identical
in any SQL engine, unlike ``rand()`` / ``randomSplit``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.common import md5_key
from tessera.operators.common import checked_side, cut, small_side, with_row_id


def rank_within(df: DataFrame, group: str, order, tiebreak: str) -> DataFrame:
    """0-based rank of each row inside its ``group`` by ``(order, tiebreak)``,
    plus the group size, as ``_rank`` / ``_class_n``.

    No ``Window.partitionBy(group)``: rows get a global id in
    ``(group, order, tiebreak)`` order through range partitioning (a group
    holding a third of the rows is spread over many partitions), and the
    rank is that id minus the group's first id, taken with a partial
    ``min`` and joined back through a checked broadcast.
    """
    keyed = df.withColumn("_ord", order)
    ided = with_row_id(keyed, [group, "_ord", tiebreak], name="_gid")
    first = ided.groupBy(group).agg(F.min("_gid").alias("_first"), F.count(F.lit(1)).alias("_class_n"))
    out = ided.join(small_side(first), group)
    return out.withColumn("_rank", F.col("_gid") - F.col("_first")).drop("_ord", "_gid", "_first")


# Hex digits of the md5 that one pass of the selection resolves.
DIGITS = 3


def quota_limits(df: DataFrame, label: str, key, test_frac: float) -> DataFrame:
    """``(label, limit)``: the rows of a class whose ``key`` (32 hex digits)
    begins with at most ``limit`` are its ``floor(test_frac * n + 0.5)``
    smallest.

    Selection by refining a histogram: a pass counts each class by the next
    ``DIGITS`` digits of the keys that begin like the one looked for, and the
    bin in which the quota falls goes into the next pass, until a bin ends just
    at the quota. A class is at most 16^DIGITS counts a pass, whatever its rows;
    each pass after the first sees 16^DIGITS times fewer rows."""
    rows = df.select(F.col(label).alias("_class"), key.alias("_key"))
    size = rows.groupBy("_class").agg(F.count(F.lit(1)).alias("n"))
    quota = F.floor(F.lit(test_frac) * F.col("n") + F.lit(0.5)).cast("long")
    open_ = cut(size.select("_class", F.lit("").alias("prefix"), quota.alias("left")).filter("left > 0"), "quota")
    done, width = None, 0
    while width < 32 and open_.limit(1).count():
        width = min(32, width + DIGITS)
        part = rows.join(checked_side(open_.withColumnRenamed("_class", "_c")), F.col("_class").eqNullSafe(F.col("_c")))
        part = part.filter(F.col("_key").startswith(F.col("prefix")))
        bins = part.groupBy("_class", "left", F.substring("_key", 1, width).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
        w = Window.partitionBy("_class").orderBy("bin")
        bins = bins.withColumn("upto", F.sum("n").over(w))
        hit = bins.filter((F.col("upto") >= F.col("left")) & (F.col("upto") - F.col("n") < F.col("left")))
        hit = cut(hit.select("_class", F.col("bin").alias("prefix"), (F.col("left") - F.col("upto") + F.col("n")).alias("left"), "n"),
                  "quota")
        ends = hit.filter(F.lit(width == 32) | (F.col("left") == F.col("n"))).select("_class", F.col("prefix").alias("limit"))
        done = ends if done is None else done.unionByName(ends)
        open_ = hit.filter(F.col("left") < F.col("n")).select("_class", "prefix", "left")
    return done if done is not None else df.sparkSession.createDataFrame([], "_class string, limit string")


def stratified_split(df: DataFrame, label: str = "label", id_col: str = "id", test_frac: float = 0.2,
                     seed: int = 42, name: str = "split") -> DataFrame:
    """MLD1. Per class, the ``floor(test_frac * n + 0.5)`` rows with the
    smallest ``md5(id:seed)`` are ``test``, the rest ``train``. Classes of one
    or two rows stay in train and never raise; NULL is a class like any other.
    ``id_col`` is unique (rows that share an id go the same way).

    The rows stay where they are: :func:`quota_limits` finds each class's last
    test key, and a row compares its own key with it. Only ids and classes are
    read for that, no ranks are made, and no text is in any exchange as long as
    the limits, one row per class, are small enough to broadcast."""
    key = md5_key(id_col, seed)
    limits = cut(quota_limits(df.select(id_col, label), label, key, test_frac), "limits")
    limits = limits.select(F.col("_class").alias("_limit_class"), F.col("limit").alias("_limit"))
    test = F.substring(key, F.lit(1), F.length("_limit")) <= F.col("_limit")
    out = df.join(checked_side(limits), F.col(label).eqNullSafe(F.col("_limit_class")), "left")
    return out.select(*df.columns, F.when(test, F.lit("test")).otherwise(F.lit("train")).alias(name))


def hash_threshold(frac: float) -> str:
    """First 8 hex digits of md5 below which a row falls in a ``frac`` slice
    (``g``, above every hash, for the whole)."""
    n = int(frac * 2 ** 32)
    return f"{n:08x}" if n < 2 ** 32 else "g"


def random_split(df: DataFrame, id_col: str = "id", test_frac: float = 0.2, seed: int = 42,
                 name: str = "split") -> DataFrame:
    """MLD2. Seeded plain split: a row is ``test`` when the first 8 hex digits
    of ``md5(id:seed)`` fall below ``test_frac`` of the range. Narrow, no
    shuffle."""
    h = F.substring(md5_key(id_col, seed), 1, 8)
    return df.withColumn(name, F.when(h < F.lit(hash_threshold(test_frac)), F.lit("test")).otherwise(F.lit("train")))


def kfold(df: DataFrame, k: int = 5, id_col: str = "id", seed: int = 42, name: str = "fold") -> DataFrame:
    """MLD3. Shuffled k-fold assignment: rows in ``md5(id:seed)`` order get
    ``row_id % k``, so fold sizes differ by at most one (11 rows, k=5 ->
    3,2,2,2,2). Row ids come from range partitioning, not a global window.
    ``id_col`` is unique; only ids are ranked and written, other columns get
    their fold by a join on the id."""
    keyed = df.select(id_col, md5_key(id_col, seed).alias("_ord"))
    ided = with_row_id(keyed, ["_ord", id_col], name="_rid")
    folds = ided.select(id_col, (F.col("_rid") % k).cast("int").alias(name))
    if df.columns == [id_col]:
        return folds
    return df.join(small_side(folds), id_col).select(*df.columns, name)


def split_sizes(df: DataFrame, col: str = "split") -> DataFrame:
    """AGG13."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n_rows"))
