"""Class balance and augmentation bookkeeping: WIN1 FIL7 AGG1-AGG6 IMB1 IMB2."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.common import md5_key
from tessera.operators.common import checked_side, cut, small_side


def class_counts(df: DataFrame, col: str = "code", name: str = "count") -> DataFrame:
    """Rows per class (partial aggregation: a hot class collapses map-side)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name))


def with_class_count(df: DataFrame, col: str = "code", name: str = "count") -> DataFrame:
    """WIN1. Class size on every row. Computed as a partial ``groupBy`` joined
    back (the per-class table is checked, then broadcast) rather than a
    window, so a class with a third of the rows is never sorted in one task."""
    return df.join(small_side(class_counts(df, col, name)), col)


def rare_codes(df: DataFrame, max_count: int = 10, col: str = "code") -> DataFrame:
    """FIL7. Rows of classes with at most ``max_count`` rows."""
    return with_class_count(df, col).filter(F.col("count") <= max_count)


def slice_counts(df: DataFrame, col: str = "code") -> DataFrame:
    """AGG1. Rows and distinct codes of a slice."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(col).alias("n_codes"))


def distinct_sketches(df: DataFrame, keys, col: str, lg_k: int = 12) -> DataFrame:
    """AGG1, mergeable: ``(*keys, n_rows, sketch)`` with a HyperLogLog sketch
    of the distinct values of ``col`` per slice (a few KB each, NULLs don't
    count), to be stored and merged for any coarser slice without the rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.hll_sketch_agg(col, F.lit(lg_k)).alias("sketch"))


def merged_distinct(sketches: DataFrame, *keys: str) -> DataFrame:
    """``(*keys, n_rows, approx_distinct)`` of the union of stored sketches; a
    relative standard error of about 1.04 / sqrt(2^lg_k), 1.6 % by default."""
    return sketches.groupBy(*keys).agg(F.sum("n_rows").alias("n_rows"),
                                       F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("approx_distinct"))


def augmentation_stats(aug: DataFrame, rare_count=None) -> DataFrame:
    """AGG2. Codes, rows, accepted rows, accepted % (1 dp), rows per code
    (1 dp) and, given the number of rare codes, the share of codes augmented
    ``100 * a / (a + rare)``. ANSI-safe: an empty store gives NULL ratios.

    ``rare_count`` may be an int or a one-column DataFrame (e.g. the
    ``n_codes`` of ``slice_counts(rare_codes(...))``)."""
    acc = F.count_if(F.coalesce(F.col("include"), F.lit(False)))
    stats = aug.agg(
        F.countDistinct("code").alias("n_codes"),
        F.count(F.lit(1)).alias("n_rows"),
        acc.alias("n_accepted"),
        F.bround(F.try_divide(100.0 * acc, F.count(F.lit(1))), 1).alias("accepted_pct"),
        F.bround(F.try_divide(F.count(F.lit(1)).cast("double"), F.countDistinct("code")), 1).alias("rows_per_code"),
    )
    if rare_count is None:
        return stats
    if isinstance(rare_count, DataFrame):
        rare = rare_count.select(F.col(rare_count.columns[0]).alias("_rare"))
        stats = stats.withColumn("_rare", rare.limit(1).scalar())
    else:
        stats = stats.withColumn("_rare", F.lit(int(rare_count)))
    share = F.bround(F.try_divide(100.0 * F.col("n_codes"), F.col("n_codes") + F.col("_rare")), 1)
    return stats.withColumn("augmented_share_pct", share).drop("_rare")


def rare_share(df: DataFrame, total=None, col: str = "code") -> DataFrame:
    """AGG3. Distinct codes of the rare slice ``df`` and their share
    ``-100 * distinct codes / total`` (1 dp). ``total``: a number, or the table
    whose distinct codes are counted (a one-row subquery of the same job);
    left out, the slice's own."""
    n = F.countDistinct(col)
    if total is None:
        total = df
    if isinstance(total, DataFrame):
        total = total.agg(F.countDistinct(col)).scalar()
    else:
        total = F.lit(float(total))
    return df.agg(n.alias("n_codes"), F.bround(F.try_divide(-100.0 * n, total), 1).alias("share_pct"))


def frequency_table(df: DataFrame, col: str = "code") -> DataFrame:
    """AGG4. Rows per code with ``log2`` of the count (sorted by code at the sink)."""
    return class_counts(df, col).withColumn("count_log2", F.log2("count"))


def class_distribution(df: DataFrame, col: str = "label") -> DataFrame:
    """AGG5. Normalised class distribution: per-class share of all rows. The
    total is a one-row scalar subquery, not a driver round trip."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return class_counts(df, col).withColumn("share", F.col("count") / total)


def class_weights(df: DataFrame, col: str = "label") -> DataFrame:
    """AGG6. ``1 - n_c / n`` per class."""
    return class_distribution(df, col).select(col, (F.lit(1.0) - F.col("share")).alias("weight"))


def with_class_weight(df: DataFrame, col: str = "label", name: str = "weight") -> DataFrame:
    """AGG6 as a ``weightCol`` for Spark ML estimators. The weights, one row per
    class, are written and measured: Spark can't foresee that they are few, and
    would shuffle the rows by class, into as many tasks as there are classes,
    each time they are read."""
    w = cut(class_weights(df, col).withColumnRenamed("weight", name), "class-weights")
    return df.join(checked_side(w), col)


# Largest number of copies of one row produced inside one task.
COPIES_PER_TASK = 4096


def oversample(df: DataFrame, col: str = "label", target: int | None = None,
               copies_per_task: int | None = None) -> DataFrame:
    """IMB1. Repeat each row of class c ``ceil(target / n_c)`` times (target
    defaults to the largest class). Adds ``copy`` (1-based).

    A row of a tiny class next to a huge one needs a huge number of copies.
    Copies come in chunks of ``copies_per_task`` (conf
    ``tessera.sample.copiesPerTask``): a row's first chunk is expanded where
    the row is; further chunks are hash-spread over the shuffle partitions and
    each task expands only its own, so no task emits a hot group of copies
    alone. The default target is a one-row subquery of the same job.
    """
    chunk = copies_per_task or int(df.sparkSession.conf.get("tessera.sample.copiesPerTask", str(COPIES_PER_TASK)))
    counts = class_counts(df, col, "_n")
    tgt = F.lit(int(target)) if target else counts.agg(F.max("_n")).scalar()
    counts = counts.select(col, F.ceil(tgt / F.col("_n")).cast("int").alias("_copies"))
    j = df.join(small_side(counts), col)
    cols = [c for c in j.columns if c != "_copies"]
    first = j.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("_copies", F.lit(chunk))))).drop("_copies")
    more = j.filter(F.col("_copies") > chunk) \
        .withColumn("_chunk", F.explode(F.sequence(F.lit(1), F.floor((F.col("_copies") - 1) / chunk).cast("int"))))
    # an explicit partition count: the chunk rows are tiny, and AQE must not
    # coalesce them back into one task before they expand
    n_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    more = more.repartition(n_parts, F.xxhash64(*cols, "_chunk"))
    lo = F.col("_chunk") * chunk + 1
    hi = F.least(F.col("_copies"), (F.col("_chunk") + 1) * chunk)
    more = more.withColumn("copy", F.explode(F.sequence(lo, hi))).drop("_copies", "_chunk")
    return first.unionByName(more)


def undersample(df: DataFrame, cap: int, id_col: str = "id", col: str = "label", seed: int = 42) -> DataFrame:
    """IMB2. Keep at most ``cap`` rows per class: those with the smallest
    ``md5(id:seed)``, ties to the smaller id. A per-class top-k: each map task
    sends at most ``cap`` rows of a class, so neither a hot class nor the rows
    that go are sorted or written whole."""
    from tessera.operators.topk import topk_per_key
    ranked = topk_per_key(df.withColumn("_md5", md5_key(id_col, seed)), col, "_md5", cap, id_col, rank="_rank",
                          ascending=True)
    return ranked.drop("_rank", "_md5")
