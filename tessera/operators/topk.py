"""Top-k: WIN5 (per key), TOP1 (per score array), PRJ4/PRJ5 (wide <-> long)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.arrays import topk_array
from tessera.operators.common import small_side

DEFAULT_SALTS = 16


def topk_per_key(df: DataFrame, key, score: str, k: int, tiebreak: str, salts: int = DEFAULT_SALTS,
                 rank: str = "rank", ascending: bool = False) -> DataFrame:
    """WIN5. The ``k`` best rows per ``key`` by ``score`` desc (or ascending),
    ties to the lowest ``tiebreak``; adds a 1-based ``rank``.

    A hot key must never be sorted whole in one task:

    * ``k`` within ``spark.sql.optimizer.windowGroupLimitThreshold``: one
      window. Spark plans a partial ``WindowGroupLimit`` before the exchange,
      so each map task sends at most ``k`` rows per key and a key holding a
      third of the rows reaches its reducer as ``k`` x map tasks rows. One
      shuffle.
    * larger ``k``: two levels. Rows are first ranked inside ``(key, salt)``
      sub-groups (salt = hash of the tiebreak), keeping ``k`` per sub-group,
      then at most ``salts * k`` rows per key are ranked.

    Both give the same rows: the choice follows Spark's own threshold for
    partial limits, not the data's size.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [F.col(score).asc() if ascending else F.col(score).desc(), F.col(tiebreak).asc()]
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if k <= limit:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)
    salted = df.withColumn("_salt", F.pmod(F.hash(F.col(tiebreak)), F.lit(salts)))
    w1 = Window.partitionBy(*keys, "_salt").orderBy(*order)
    level1 = salted.withColumn("_r", F.row_number().over(w1)).filter(F.col("_r") <= k).drop("_r", "_salt")
    w2 = Window.partitionBy(*keys).orderBy(*order)
    return level1.withColumn(rank, F.row_number().over(w2)).filter(F.col(rank) <= k)


def score_topk(df: DataFrame, scores: str, k: int = 5, apply_softmax: bool = True,
               out: str = "prediction") -> DataFrame:
    """TOP1. Softmax (optional) then the ``k`` largest entries of a score
    array, per row, no shuffle: ``array<struct<rank, label, value>>``."""
    return df.withColumn(out, topk_array(scores, k, apply_softmax))


def attach_prediction_labels(df: DataFrame, labels: DataFrame, pred: str = "prediction",
                             key: str | None = None, how: str = "left") -> DataFrame:
    """Fill ``code``/``text`` into each prediction struct, in place: the label
    dimension (one row per class of the model; of a repeated label the
    smallest code counts) becomes one array in label order, a one-row subquery of
    the same job, and each row looks its ``k`` labels up: by position if the
    labels are dense from 0 (as WIN3 makes them), else in a map. No explode, no shuffle, and texts
    stay where they are. ``how='inner'`` drops unknown labels. ``key`` is not
    needed any more and accepted for older callers.
    """
    dim = labels.filter(F.col("label").isNotNull()).groupBy("label").agg(
        F.min(F.struct("code", "text")).alias("_d"))
    entries = F.sort_array(F.collect_list(F.struct("label", "_d")))
    whole = F.col("label").cast("string").rlike("^[0-9]+$")
    dense = F.min(whole) & (F.max(F.when(whole, F.col("label").cast("long"))) == F.count(F.lit(1)) - 1)
    table = dim.agg(F.struct(F.coalesce(dense, F.lit(False)).alias("dense"), F.transform(entries, lambda e: e["_d"]).alias("by_place"),
                             F.when(~F.coalesce(dense, F.lit(False)), F.map_from_entries(entries)).alias("by_label"))).scalar()
    kind = dict(labels.dtypes)["label"]

    def fill(p):
        place = F.when(p["label"] >= 0, p["label"].cast("int") + 1)
        d = F.when(F.col("_labels.dense"), F.try_element_at(F.col("_labels.by_place"), place)).otherwise(
            F.try_element_at(F.col("_labels.by_label"), p["label"].cast(kind)))
        return F.struct(p["rank"].alias("rank"), p["label"].alias("label"), d["code"].alias("code"),
                        d["text"].alias("text"), p["value"].alias("value"))
    filled = F.transform(F.col(pred), fill)
    if how == "inner":
        known = F.map_keys("_labels.by_label")
        filled = F.filter(filled, lambda p: F.when(
            F.col("_labels.dense"), (p["label"] >= 0) & (p["label"] < F.size("_labels.by_place"))).otherwise(
            F.array_contains(known, p["label"].cast(kind))))
    cols = [F.coalesce(filled, F.array().cast(_filled_type(df, labels, pred))).alias(pred) if c == pred else F.col(c)
            for c in df.columns]
    return df.withColumn("_labels", table).select(*cols)


def _filled_type(df: DataFrame, labels: DataFrame, pred: str) -> str:
    entry = {f.name: f.dataType.simpleString() for f in df.schema[pred].dataType.elementType.fields}
    dim = dict(labels.dtypes)
    return (f"array<struct<rank:{entry['rank']},label:{entry['label']},code:{dim['code']},text:{dim['text']},"
            f"value:{entry['value']}>>")


def topk_long(df: DataFrame, pred: str = "prediction") -> DataFrame:
    """PRJ5. Nested top-k -> one row per (row, rank)."""
    others = [c for c in df.columns if c != pred]
    # explode_outer + a filter on the generated value: the same rows as
    # explode, but no "size(pred) > 0" filter is inferred below the
    # projection, which would evaluate the prediction expression twice
    return (df.select(*others, F.explode_outer(pred).alias("_p")).filter(F.col("_p").isNotNull())
            .select(*others, "_p.*"))


def topk_wide(df: DataFrame, k: int, pred: str = "prediction", fields=("code", "text", "value")) -> DataFrame:
    """PRJ4. Nested top-k -> ``prediction_{i}_{field}`` columns (NULL when a
    row has fewer than ``i`` predictions)."""
    cols = [F.col(c) for c in df.columns if c != pred]
    for i in range(1, k + 1):
        for f in fields:
            cols.append(F.get(F.col(pred), i - 1)[f].alias(f"prediction_{i}_{f}"))
    return df.select(*cols)
