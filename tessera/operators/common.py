"""Plan-shape helpers shared by the operators: size-checked broadcast, stable
row ids without a single-partition window, first-row-per-key without a window.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.common import as_col

# Largest side (rows, and bytes of its rows as JSON text) broadcast in "checked"
# mode after measuring it.
DEFAULT_BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20


def broadcast_limit(df: DataFrame) -> int:
    conf = df.sparkSession.conf.get("tessera.broadcast.maxRows", None)
    return int(conf) if conf else DEFAULT_BROADCAST_ROWS


def fits(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``BROADCAST_BYTES``
    bytes (each task stops after ``max_rows + 1`` rows). Costs a job: use on
    inputs that are small or cheap to scan, not on large aggregates."""
    size = F.octet_length(F.to_json(F.struct(*[F.col(c) for c in df.columns])))
    r = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()
    return r["n"] <= max_rows and r["b"] <= BROADCAST_BYTES


def small_side(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """The build side of a lookup join, broadcast only behind a size check.

    ``tessera.broadcast.mode``:

    * ``runtime`` (default): no hint. The side is a dimension or an
      aggregate; AQE measures its materialised size and converts the join to
      a broadcast hash join only under
      ``spark.sql.adaptive.autoBroadcastJoinThreshold``; above it the
      sort-merge join stays, with skewed partitions split. No extra job, no
      second evaluation of the side.
    * ``checked``: measure the side (rows, capped at ``max_rows + 1``, and
      bytes) and hint ``broadcast`` only when both fit; otherwise leave the
      join to Spark.
    """
    mode = df.sparkSession.conf.get("tessera.broadcast.mode", "runtime")
    if mode != "checked":
        return df
    limit = broadcast_limit(df) if max_rows is None else max_rows
    return F.broadcast(df) if fits(df, limit) else df


def checked_side(df: DataFrame) -> DataFrame:
    """A lookup side that is broadcast if it is measured (:func:`fits`) to be
    small, so that the other side's rows, which may hold texts, stay where they
    are. Beyond that the join is left to Spark. Costs a job over ``df``."""
    return F.broadcast(df) if fits(df, broadcast_limit(df)) else df


# A key of more than this share of the rows is hot; at most 1 / HOT_SHARE keys are.
HOT_SHARE = 1 / 1024
SALTS = 16


def spread_join(big: DataFrame, dim: DataFrame, key: str, how: str = "inner", also: Column | None = None,
                grows: bool = False) -> DataFrame:
    """Equi-join on ``key`` (both sides have it; inner or left) that no key of
    ``big`` can overload: rows of a hot key are dealt over ``SALTS`` tasks, and
    ``dim``'s rows of that key are repeated for each. The hot keys, a bounded
    table, are found by a partial count. ``also``: a further condition, which
    must not be an equality that Spark would take as a join key. ``grows``:
    ``dim`` grows with ``big``, so it is shuffled and never sent to the driver."""
    if how not in ("inner", "left"):
        raise ValueError(f"inner or left, not {how}")
    n = big.groupBy(F.col(key).alias("_hot")).agg(F.count(F.lit(1)).alias("_n"))
    total = big.agg(F.count(F.lit(1))).scalar()
    hot = F.broadcast(n.filter(F.col("_hot").isNotNull() & (F.col("_n") > F.greatest(F.lit(1.0), total * HOT_SHARE)))
                      .select("_hot"))
    left = big.join(hot, F.col(key) == F.col("_hot"), "left")
    # rows without a key never match: they may lie anywhere
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    left = left.withColumn("_salt", F.when(F.col("_hot").isNotNull() | F.col(key).isNull(), salt).otherwise(0)).drop("_hot")
    every = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    right = dim.join(hot, F.col(key) == F.col("_hot"), "left").withColumn("_salt2", F.explode(every)).drop("_hot")
    right = right.withColumnRenamed(key, "_key2")
    right = right.hint("merge") if grows else right
    same = (F.col(key) == F.col("_key2")) & (F.col("_salt") == F.col("_salt2"))
    return left.join(right, same if also is None else same & also, how).drop("_salt", "_salt2", "_key2")


def first_per_key(df: DataFrame, keys, order, cols=None) -> DataFrame:
    """WIN4 / WIN6. The first row per key by ``order`` (a column or list).

    Uses ``min_by`` so the aggregation is partial: a key holding a third of
    the rows is collapsed map-side instead of being sorted in one task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, (str, Column)) else list(order)
    cols = [c for c in (cols or df.columns) if c not in keys]
    if not cols:
        return df.select(*keys).distinct()
    payload = F.struct(*[F.col(c) for c in cols])
    okey = F.struct(*[as_col(o) for o in order]) if len(order) > 1 else as_col(order[0])
    best = df.groupBy(*keys).agg(F.min_by(payload, okey).alias("_best"))
    return best.select(*keys, *[F.col("_best")[c].alias(c) for c in cols])


def last_per_key(df: DataFrame, keys, order, cols=None) -> DataFrame:
    """The last row per key by ``order`` (``max_by``, partial aggregation)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, (str, Column)) else list(order)
    cols = [c for c in (cols or df.columns) if c not in keys]
    payload = F.struct(*[F.col(c) for c in cols])
    okey = F.struct(*[as_col(o) for o in order]) if len(order) > 1 else as_col(order[0])
    best = df.groupBy(*keys).agg(F.max_by(payload, okey).alias("_best"))
    return best.select(*keys, *[F.col("_best")[c].alias(c) for c in cols])


def with_row_id(df: DataFrame, order, name: str = "row_id", partitions: int | None = None) -> DataFrame:
    """ORD2. Dense 0-based row ids in ``order`` (which must be a total order
    for ids to be reproducible).

    Plan: range-partition on ``order`` (one shuffle, balanced by sampling, so
    no skewed or single partition), sort inside partitions, and take the local
    position from ``monotonically_increasing_id`` (partition index in the high
    bits). That layout is written once as a table under
    ``spark.checkpoint.dir``: range bounds come from a sample whose input
    order follows shuffle fetch order, so two evaluations of the exchange could
    disagree. From the table, the per-partition sizes (one row per partition,
    the only data that meets in one task) give each partition's offset, and
    every reader sees the same ids.
    """
    order = [order] if isinstance(order, (str, Column)) else list(order)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    base = (df.repartitionByRange(n, *order)
            .sortWithinPartitions(*order)
            .withColumn("_pid", F.spark_partition_id())
            .withColumn("_local", F.monotonically_increasing_id()))
    base = base.withColumn("_local", F.col("_local") - F.shiftleft(F.col("_pid").cast("long"), 33))
    base = cut(base, "row_ids")
    sizes = base.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    out = base.join(F.broadcast(offsets), "_pid")
    return out.withColumn(name, F.col("_off") + F.col("_local")).drop("_pid", "_local", "_off")


def running_sums(df: DataFrame, group: str, order: list, cols: list[str], partitions: int | None = None) -> DataFrame:
    """Inclusive running sums of integer columns within each ``group`` (NULL is
    a group), in ``order`` (a total order): adds ``run_<col>``.

    A group that holds most rows is spread: rows are range-partitioned by group
    and order, summed inside partitions, and that layout is written once (range
    borders may differ between evaluations); what lies in earlier partitions
    comes from a table with one row per partition and group in it."""
    import numpy as np
    import pyarrow as pa
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(group).isNull(), F.col(group), *order]
    rows = df.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn("_pid", F.spark_partition_id())
    at, of = rows.columns.index(group), [rows.columns.index(c) for c in cols]
    names = [f"run_{c}" for c in cols]

    def run(batches):
        last, carry = (), [0] * len(of)
        for b in batches:
            if not b.num_rows:
                continue
            no = b.column(at).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            start = np.flatnonzero(np.r_[True, no[1:] != no[:-1]])
            size = np.diff(np.r_[start, len(no)])
            goes_on = (b.column(at)[0].as_py(),) == last
            sums = []
            for i, c in enumerate(of):
                x = b.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                total = np.cumsum(x)
                total -= np.repeat(total[start] - x[start], size)
                if goes_on:
                    total[:size[0]] += carry[i]
                carry[i] = int(total[-1])
                sums.append(pa.array(total))
            last = (b.column(at)[-1].as_py(),)
            yield pa.RecordBatch.from_arrays([*b.columns, *sums], names=[*b.schema.names, *names])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    rows = cut(rows.mapInArrow(run, schema + "".join(f", `{c}` long" for c in names)), "running")
    w = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    held = rows.groupBy(group, "_pid").agg(*[F.sum(c).alias(f"_m{i}") for i, c in enumerate(cols)])
    held = held.select(F.col(group).alias("_group"), F.col("_pid").alias("_part"),
                       *[F.coalesce(F.sum(f"_m{i}").over(w), F.lit(0)).alias(f"_o{i}") for i in range(len(cols))])
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_pid") == F.col("_part"))
    out = rows.join(held, same)
    return out.select(*df.columns, *[(F.col(c) + F.col(f"_o{i}")).alias(c) for i, c in enumerate(names)])


def null_safe_key(col) -> list[Column]:
    """Two columns that together compare like ``col <=> other`` in an equi
    join (NULL equals NULL), so hash/sort-merge joins can be used."""
    c = as_col(col)
    return [c.isNull().alias("_k_null"), F.coalesce(c.cast("string"), F.lit("")).alias("_k_val")]


def not_in(df: DataFrame, other: DataFrame, keys) -> DataFrame:
    """Rows of ``df`` whose keys are not among those of ``other``; NULL equals
    NULL (a plain anti join never finds it), so repeated merges add nothing."""
    pairs = [null_safe_key(k) for k in keys]
    named = [(n.alias(f"_n{i}"), v.alias(f"_v{i}")) for i, (n, v) in enumerate(pairs)]
    tags = [t for i in range(len(pairs)) for t in (f"_n{i}", f"_v{i}")]
    left = df.select("*", *[c for pair in named for c in pair])
    return left.join(other.select(*[c for pair in named for c in pair]), tags, "left_anti").drop(*tags)


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Materialise ``df`` as a Parquet table under the session's
    ``spark.checkpoint.dir`` (shared storage on a cluster) and read it back.

    Used where one intermediate feeds several branches: every branch then
    scans the table instead of recomputing the upstream DAG, the lineage is
    cut (a lost executor re-reads files, it does not replay the DAG), and
    later joins get real file statistics for broadcast decisions. The table
    lives until the :func:`scratch_tables` block around the call ends (results
    must be written or collected inside it), else as long as the folder."""
    spark, path = df.sparkSession, scratch_folder(df.sparkSession, f"tables/{name}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Folders owned by the innermost scratch_tables block of this thread (or context).
_OWNED: ContextVar[list[str] | None] = ContextVar("tessera_scratch", default=None)


def scratch_folder(spark, name: str) -> str:
    """Path of a new folder (not made yet) under ``spark.checkpoint.dir``, owned
    by the :func:`scratch_tables` block around the call, if there is one."""
    from tessera.session import ensure_checkpoint_dir
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    owned = _OWNED.get()
    if owned is not None:
        owned.append(path)
    return path


@contextmanager
def scratch_tables(spark):
    """Own the folders that operators write inside the block (tables, archives,
    token files, slot maps, streams without a named folder), and delete them at
    its end::

        with scratch_tables(spark):
            build_corpus(...)[0].write.parquet(out)
    """
    token = _OWNED.set([])
    try:
        yield
    finally:
        owned = _OWNED.get()
        _OWNED.reset(token)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in owned:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)
