"""JOI1: order-preserving code-list crosswalk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import join_list
from tessera.operators.common import first_per_key, small_side


def crosswalk(df: DataFrame, list_col: str, dim: DataFrame, dim_key: str, dim_val: str,
              dim_order: str, out_list: str = "xw_list", out_join: str = "xw_join",
              key=None, sep: str = "; ") -> DataFrame:
    """Look up every element of the array ``list_col`` in ``dim``.

    * the *first* dimension row per key (by ``dim_order``) wins;
    * elements without a match are dropped; element order and repeats kept;
    * ``out_list`` is the array of values, ``out_join`` the ``sep``-joined
      string; a NULL or empty list gives ``[]`` and ``''``;
    * ``key`` must be unique: rows that share it become one. Without that
      promise leave it out, and rows are told apart by a tag.

    Plan: ``posexplode_outer`` (narrow) -> left join on the element (the
    deduplicated dimension is broadcast only after a row-count check) ->
    regroup by the row key. All elements of a row stay in the task that
    exploded them, so the partial aggregate collapses each row before the
    shuffle; when ``key`` is given and ``df`` is already hash-partitioned on
    it (e.g. it came out of a ``groupBy(key)``), the regroup needs no shuffle.
    """
    d = first_per_key(dim.select(dim_key, dim_val, dim_order), dim_key, dim_order, cols=[dim_val])
    d = d.select(F.col(dim_key).alias("_xk"), F.col(dim_val).alias("_xv"))

    if key is None:
        df = df.withColumn("_rid", F.monotonically_increasing_id())
        keys = ["_rid"]
    else:
        keys = [key] if isinstance(key, str) else list(key)
    carry = [c for c in df.columns if c not in keys]

    ex = df.select("*", F.posexplode_outer(list_col).alias("_pos", "_elem"))
    j = ex.join(small_side(d), ex["_elem"] == d["_xk"], "left")
    hit = F.when(F.col("_xv").isNotNull(), F.struct(F.col("_pos"), F.col("_xv")))
    agg = j.groupBy(*keys).agg(
        *[F.first(c).alias(c) for c in carry],
        F.sort_array(F.collect_list(hit)).alias("_pairs"),
    )
    out = agg.withColumn(out_list, F.transform("_pairs", lambda p: p["_xv"])) \
             .withColumn(out_join, join_list(out_list, sep)).drop("_pairs")
    if key is None:
        out = out.drop("_rid")
    return out
