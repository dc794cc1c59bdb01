"""Structured Streaming surface: STR1 scoring, STR2 append-distinct, STR3
windowed acceptance.

Each job reads a file source and runs with ``Trigger.AvailableNow`` (process
everything present, then stop). A job's folder holds its state, its sink and
its store; a caller that names one can stop and call again, and the job goes on
where it ended: files already read are not read again and the state forgets
nothing. Without a name a fresh folder under ``spark.checkpoint.dir`` is used,
which a ``scratch_tables`` block around the call owns.
Results don't depend on how files fall into micro-batches, or on their order.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.common import scratch_folder, small_side

# Every so many epochs of windowed acceptance hold all windows.
COMPACT = 16


def _folder(spark: SparkSession, name: str, folder: str | None) -> str:
    if folder:
        return folder.rstrip("/")
    return scratch_folder(spark, f"streams/{name}")


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) on the driver, for any store that Spark reaches."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _epochs(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the ``epoch=<n>`` folders below ``path``."""
    fs, p = _hadoop(spark, path)
    names = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(n[6:]) for n in names if n.startswith("epoch="))


def _delete(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        fs, p = _hadoop(spark, path)
        fs.delete(p, True)


def _finish(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def _drain(stream_df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    spark = stream_df.sparkSession
    base = _folder(spark, name, folder)
    _finish(stream_df.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start(f"{base}/out"))
    return spark.read.schema(stream_df.schema).parquet(f"{base}/out")


def event_stream(spark: SparkSession, path: str, schema, max_files: int = 64) -> DataFrame:
    """File source with an explicit schema; ``timestamp_ntz`` event times are
    cast to ``timestamp`` (session zone UTC) so a watermark can use them."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if path.endswith(".parquet"):
        # A single file rather than a landing directory: the file source
        # wants a directory or a glob, so turn the name into a one-file glob.
        path = path[:-1] + "[" + path[-1] + "]"
    df = reader.parquet(path)
    for f in df.schema.fields:
        if f.dataType.typeName() == "timestamp_ntz":
            df = df.withColumn(f.name, F.col(f.name).cast("timestamp"))
    return df


def append_distinct(stream: DataFrame, delay: str, keys=("code", "text"), ts: str = "ts") -> DataFrame:
    """STR2, bounded form. Drops repeats of ``keys`` that arrive within
    ``delay`` of event time. It forgets older keys and drops rows later than
    ``delay``, so the caller states one that covers the stream's disorder;
    :func:`append_distinct_exact` never forgets."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def window_counts(stream: DataFrame, accepted, ts: str = "ts", window: str = "1 day") -> DataFrame:
    """STR3. Rows and accepted rows per tumbling window, and the latest event
    time in it. No watermark: late rows still count; the state is one row per
    window."""
    acc = F.coalesce(accepted, F.lit(False))
    return (stream.groupBy(F.window(ts, window).alias("w"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(acc).alias("n_accepted"), F.max(ts).alias("last_ts"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "n_rows", "n_accepted", "last_ts"))


def windowed_acceptance(stream: DataFrame, accepted, ts: str = "ts", window: str = "1 day", delay: str = "1 hour",
                        folder: str | None = None) -> DataFrame:
    """STR3. Acceptance rate of the closed windows, those that end at least
    ``delay`` before the latest event time seen.

    Each micro-batch writes the windows it changed (update mode) to its own
    ``epoch`` folder, a retried batch to the same one; the reader takes each
    window's latest row and picks the closed ones. Every ``COMPACT``-th epoch
    holds the latest row of all windows, so a reader starts there, and epochs
    before the last but one of these are deleted.
    """
    spark = stream.sparkSession
    base = _folder(spark, "acceptance", folder)
    counts = window_counts(stream, accepted, ts, window)

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in counts.schema.fields)
    cols = [c for c in counts.columns if c != "window_start"]

    def rows_before(epoch: int) -> DataFrame:
        """What a reader of the epochs before ``epoch`` needs: from the last
        compacted one on."""
        first = max(0, epoch // COMPACT * COMPACT - 1)
        rows = spark.read.schema(fields + ", epoch long").option("basePath", f"{base}/out")
        return rows.parquet(*[f"{base}/out/epoch={e}" for e in range(first, epoch)])

    def latest(rows: DataFrame) -> DataFrame:
        return rows.groupBy("window_start").agg(F.max_by(F.struct(*cols), "epoch").alias("r")).select("window_start", "r.*")

    def write(batch: DataFrame, epoch: int) -> None:
        if epoch % COMPACT == COMPACT - 1:
            batch = latest(rows_before(epoch).unionByName(batch.withColumn("epoch", F.lit(epoch).cast("long"))))
            done = epoch - COMPACT  # the compacted epoch that this one reads
            _delete(spark, *[f"{base}/out/epoch={e}" for e in range(max(0, done - COMPACT), done)])
        batch.repartition(1).write.mode("overwrite").parquet(f"{base}/out/epoch={epoch}")

    with disk_state(spark):
        _finish(counts.writeStream.outputMode("update").foreachBatch(write)
                .option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start())
    written = _epochs(spark, f"{base}/out")
    rows = rows_before(written[-1] + 1) if written else spark.createDataFrame([], fields + ", epoch long")
    last, seen = latest(rows), rows.agg(F.max("last_ts")).scalar()
    share = F.bround(F.try_divide(100.0 * F.col("n_accepted"), F.col("n_rows")), 1)
    return last.filter(F.col("window_end") <= seen - F.expr(f"INTERVAL {delay}")).select(
        "window_start", "window_end", "n_rows", "n_accepted", share.alias("accepted_pct"))


def run_append_distinct(spark: SparkSession, path: str, schema, code_expr: str, text_expr: str, delay: str,
                        ts: str = "ts", max_files: int = 64, folder: str | None = None) -> DataFrame:
    s = event_stream(spark, path, schema, max_files).selectExpr(f"{code_expr} AS code", f"{text_expr} AS text", ts)
    return _drain(append_distinct(s, delay, ("code", "text"), ts).select("code", "text"), "append_distinct", folder)


def run_acceptance(spark: SparkSession, path: str, schema, accepted_expr: str, ts: str = "ts",
                   window: str = "1 day", delay: str = "1 hour", max_files: int = 64,
                   folder: str | None = None) -> DataFrame:
    s = event_stream(spark, path, schema, max_files)
    return windowed_acceptance(s, F.expr(accepted_expr), ts, window, delay, folder)


def run_scoring(spark: SparkSession, model, path: str, schema, text: str = "text", k: int = 5,
                labels: DataFrame | None = None, max_files: int = 64, folder: str | None = None) -> DataFrame:
    """STR1. Unbounded text -> top-k with a fitted ``PipelineModel`` (the model
    is shipped to executors once per query; no per-row Python)."""
    from pyspark.ml.functions import vector_to_array

    from tessera.functions.arrays import topk_array
    s = event_stream(spark, path, schema, max_files).select(F.col(text))
    scored = model.transform(s).select(F.col(text).alias("input"), F.explode(
        topk_array(vector_to_array("probability"), k, apply_softmax=False)).alias("p"))
    flat = scored.select("input", F.col("p.rank").alias("rank"), F.col("p.label").alias("label"),
                         F.col("p.value").alias("value"))
    if labels is not None:
        # static dimension: materialised once (reliable checkpoint) so the
        # streaming plan only sees a scan of it
        dim = labels.select("label", "code").checkpoint()
        flat = flat.join(small_side(dim), "label", "left")
    return _drain(flat, "scoring", folder)


@contextmanager
def disk_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB (memory-bounded, and
    a batch uploads only what it changed), unless the session names a provider
    itself. A restarted job goes on with the provider of its first start."""
    names = {"providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
             "rocksdb.changelogCheckpointing.enabled": "true"}
    names = {f"spark.sql.streaming.stateStore.{k}": v for k, v in names.items()}
    own = spark.sparkContext.getConf().contains(next(iter(names)))
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in {} if own else names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def first_in_batches(stream: DataFrame, keys: list[str], order: str | None) -> DataFrame:
    """Of the rows of each Arrow batch, the first per key (by ``order``; NULL
    equals NULL): a key that holds much of the stream reaches the shuffle as one
    row a batch."""
    import pyarrow as pa

    names = stream.columns

    def run(batches):
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t.append_column("_at", pa.array(range(b.num_rows), pa.int64()))
            if order:
                t = t.sort_by([(order, "ascending"), ("_at", "ascending")])
                t = t.set_column(t.num_columns - 1, "_at", pa.array(range(b.num_rows), pa.int64()))
            first = t.select([*keys, "_at"]).group_by(keys, use_threads=False).aggregate([("_at", "min")])
            yield from t.take(first["_at_min"]).select(names).to_batches()

    return stream.mapInArrow(run, stream.schema)


def append_distinct_exact(stream: DataFrame, keys=("code", "text"), order: str | None = None,
                          folder: str | None = None) -> DataFrame:
    """STR2, exact form: a row is appended when its key (NULL equals NULL) has
    not been seen in this or any earlier batch; no key is ever forgotten.

    The keys seen are Spark's keyed state, partitioned by key hash: a batch looks
    up its own keys only and writes only the new ones, so its work doesn't grow
    with what is stored. State and output are committed per batch (a retried
    batch replaces its own part), so the effect is exactly-once. With ``order``,
    the row kept of a new key is the batch's first by that column (NULL last);
    without it any row of the key, which matters only for columns beyond the
    keys. ``order`` uses Python state functions, the plain form none beyond the
    thinning of repeats before the shuffle.
    """
    keys = list(keys)
    thin = first_in_batches(stream, keys, order)
    if order is None:
        fresh = thin.dropDuplicates(keys)
    else:
        names = stream.columns

        def first(key, frames, state):
            import pandas as pd
            if state.exists:
                for _ in frames:
                    pass
                return
            best = pd.concat([f.sort_values(order, kind="stable", na_position="last").head(1) for f in frames])
            state.update((True,))
            yield best.sort_values(order, kind="stable", na_position="last").head(1)[names]
        fresh = thin.groupBy(*keys).applyInPandasWithState(first, stream.schema, "seen boolean", "append", "NoTimeout")
    with disk_state(stream.sparkSession):
        return _drain(fresh, "append_distinct", folder)


def run_append_distinct_exact(spark: SparkSession, path: str, schema, code_expr: str, text_expr: str,
                              max_files: int = 64, folder: str | None = None) -> DataFrame:
    s = event_stream(spark, path, schema, max_files).selectExpr(f"{code_expr} AS code", f"{text_expr} AS text")
    return append_distinct_exact(s, ("code", "text"), folder=folder)
