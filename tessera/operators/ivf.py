"""VEC2 by a stored inverted-file index.

Centroids are fitted on a bounded sample; every row is indexed: its unit vector
lies in the list of its nearest centroid, lists being folders of one table. A
list's radius (the largest angle between its rows and its centroid) bounds the
cosine of a query with anything in it, so a query probes lists from the highest
bound down. Probing on while a bound reaches the k-th score found gives the exact
answer; stopping after a number of lists is approximate, and that number can be
chosen for a recall on a bounded sample of queries.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.common import cut, scratch_folder
from tessera.operators.topk import topk_per_key
from tessera.operators.vector import CELL_ITEMS, CELL_QUERIES, SCHEMA, _cell_topk, _unit_rows

SAMPLE = 20_000  # rows that centroids are fitted on, at most about so many
MOST_LISTS = 1_024
ROUNDS = 8
TUNE_QUERIES = 256


class Index(NamedTuple):
    """``path`` of the lists ``(id, unit, list)``; per list its centroid (unit
    length), radius and number of rows: at most ``MOST_LISTS`` of each."""
    path: str
    dim: int
    centroids: np.ndarray
    radius: np.ndarray
    rows: np.ndarray


def _rows(df: DataFrame, id_col: str, vec_col: str, dim: int) -> DataFrame:
    x = F.col(vec_col).cast("array<double>")
    return df.select(F.col(id_col).cast("long").alias("id"), x.alias("v")).filter(F.size("v") == dim)


def build_index(items: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", lists: int | None = None,
                path: str | None = None, seed: int = 42) -> Index:
    """Index all rows whose vector has the most frequent length (NULL and
    other vectors take no part). ``lists`` defaults to the root of the rows, at
    most ``MOST_LISTS``. A list that holds much of the table is written by
    several tasks."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    spark = items.sparkSession
    sizes = items.groupBy(F.size(vec_col).alias("d")).agg(F.count(F.lit(1)).alias("n")).filter("d > 0")
    top = sizes.orderBy(F.desc("n"), "d").first()
    path = path or scratch_folder(spark, "ivf")
    if top is None:
        return Index(path, 0, np.zeros((0, 0)), np.zeros(0), np.zeros(0, np.int64))
    dim, n = top["d"], top["n"]
    rows = _rows(items, id_col, vec_col, dim)
    k = max(1, min(lists or round(math.sqrt(n)), MOST_LISTS))
    part = max(1, n // SAMPLE)
    nonzero = F.exists("v", lambda c: c != 0)
    sample = rows.filter((F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(part)) == 0) & nonzero)
    sample = cut(sample.select(array_to_vector("v").alias("features")), "ivf-sample")
    fit = KMeans(k=k, maxIter=ROUNDS, seed=seed, distanceMeasure="cosine", initMode="random")
    centres = fit.fit(sample).clusterCenters() if k > 1 and sample.limit(2).count() > 1 else [np.eye(1, dim)[0]]
    centroids = np.unique(_unit_rows(np.array(centres)), axis=0)
    shared = spark.sparkContext.broadcast(centroids)

    def assign(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 4096):
                s = b.slice(lo, 4096)
                unit = _unit_rows(s.column(1).to_pylist())
                cos = unit @ shared.value.T
                at = cos.argmax(1)
                angle = np.arccos(np.clip(cos[np.arange(len(at)), at], -1, 1))
                yield pa.RecordBatch.from_arrays(
                    [s.column(0), pa.array(list(unit), pa.list_(pa.float64())), pa.array(angle), pa.array(at.astype(np.int32))],
                    names=["id", "unit", "angle", "list"])

    placed = rows.mapInArrow(assign, "id long, unit array<double>, angle double, list int")
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed.repartitionByRange(n_parts, "list", "id").write.mode("overwrite").partitionBy("list").parquet(path)
    stats = read_lists(spark, path).groupBy("list").agg(F.max("angle").alias("r"), F.count(F.lit(1)).alias("n")).collect()
    radius, held = np.zeros(len(centroids)), np.zeros(len(centroids), np.int64)
    for r in stats:
        radius[r["list"]], held[r["list"]] = r["r"], r["n"]
    return Index(path, dim, centroids, radius, held)


def read_lists(spark, path: str) -> DataFrame:
    return spark.read.schema("id long, unit array<double>, angle double, list int").parquet(path)


def probe_order(index: Index, queries: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(query_id, unit, place, list, bound)``: the non-empty lists of each
    query by descending bound, ``place`` from 0. Equal bounds go to the centroid
    that is nearer."""
    centroids, radius = index.centroids, index.radius
    live = np.flatnonzero(index.rows)

    def order(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                s = b.slice(lo, 1024)
                unit = _unit_rows(s.column(1).to_pylist())
                angle = np.arccos(np.clip(unit @ centroids[live].T, -1, 1))
                bound = np.cos(np.maximum(0.0, angle - radius[live]))
                at = np.lexsort((angle, -bound), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [s.column(0), pa.array(list(unit), pa.list_(pa.float64())),
                     pa.array([[{"place": p, "list": int(live[j]), "bound": float(bound[i, j])} for p, j in enumerate(row)]
                               for i, row in enumerate(at.tolist())],
                              pa.list_(pa.struct([("place", pa.int32()), ("list", pa.int32()), ("bound", pa.float64())])))],
                    names=["query_id", "unit", "probes"])

    rows = _rows(queries, id_col, vec_col, index.dim).withColumnRenamed("id", "query_id").mapInArrow(
        order, "query_id long, unit array<double>, probes array<struct<place:int,list:int,bound:double>>")
    return rows.select("query_id", "unit", F.explode("probes").alias("p")).select("query_id", "unit", "p.place", "p.list", "p.bound")


def _probe(index: Index, wanted: DataFrame, k: int, exclude_self: bool) -> DataFrame:
    """Best ``k`` of every list for each (query, list) of ``wanted``: cells of
    at most ``CELL_QUERIES`` x ``CELL_ITEMS`` rows, scored in numpy."""
    spark = wanted.sparkSession
    blocks = F.lit([max(1, -(-int(n) // CELL_ITEMS)) for n in index.rows]).cast("array<int>")
    n_blocks = F.element_at(blocks, F.col("list") + 1)
    asked = wanted.groupBy("list").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("list").alias("_list"), F.ceil(F.col("n") / CELL_QUERIES).cast("int").alias("q_blocks"))  # a row per list
    left = wanted.join(F.broadcast(asked), F.col("list") == F.col("_list")).select(
        F.col("query_id").alias("_qid"), F.col("unit").alias("_qv"), "list",
        F.pmod(F.xxhash64("query_id", "unit"), F.col("q_blocks")).cast("int").alias("_qb"),
        F.explode(F.sequence(F.lit(0), n_blocks - 1)).alias("_ib"))
    right = read_lists(spark, index.path).join(F.broadcast(asked), F.col("list") == F.col("_list")).select(
        F.col("id").alias("_iid"), F.col("unit").alias("_iv"), "list",
        F.explode(F.sequence(F.lit(0), F.col("q_blocks") - 1)).alias("_qb"),
        F.pmod(F.xxhash64("id", "unit"), n_blocks).cast("int").alias("_ib"))
    cell = ["list", "_qb", "_ib"]
    found = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInPandas(_cell_topk(k, exclude_self), SCHEMA)
    return topk_per_key(found, "query_id", "score", k, "item_id").drop("rank")


def search(index: Index, queries: DataFrame, k: int = 5, probes: int | None = None, id_col: str = "vec_id",
           vec_col: str = "embedding", exclude_self: bool = False, first: int = 4) -> tuple[DataFrame, DataFrame]:
    """``(query_id, item_id, score, rank)``, and the ``(query_id, list)`` pairs
    that were probed. ``probes``: so many lists per query; None: exact, by
    ``first`` lists and then all whose bound reaches the k-th score found."""
    spark = queries.sparkSession
    if not len(index.rows):
        return (spark.createDataFrame([], SCHEMA + ", rank int"), spark.createDataFrame([], "query_id long, list int"))
    order = cut(probe_order(index, queries, id_col, vec_col), "ivf-order")
    near = order.filter(F.col("place") < (first if probes is None else probes))
    found, done = cut(_probe(index, near, k, exclude_self), "ivf-found"), near
    if probes is None:
        least = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("s")).filter(F.col("n") >= k)
        rest = order.filter(F.col("place") >= first).join(least.select("query_id", "s"), "query_id", "left")
        # scores are rounded to 1e-12
        rest = rest.filter(F.col("s").isNull() | (F.col("bound") + 1e-9 >= F.col("s"))).select(*order.columns)
        rest = cut(rest, "ivf-rest")
        found = found.unionByName(_probe(index, rest, k, exclude_self))
        done = near.unionByName(rest)
    return topk_per_key(found, "query_id", "score", k, "item_id"), done.select("query_id", "list")


def probes_for(index: Index, queries: DataFrame, recall: float = 0.9, k: int = 5, id_col: str = "vec_id",
               vec_col: str = "embedding", exclude_self: bool = False, seed: int = 7) -> int:
    """The fewest lists a query must probe so that this share of the true
    neighbours is found, at each rank, among about ``TUNE_QUERIES`` queries drawn
    by hash and answered exactly."""
    part = max(1, queries.count() // TUNE_QUERIES)
    some = cut(queries.filter(F.pmod(F.xxhash64(id_col, F.lit(seed)), F.lit(part)) == 0), "ivf-tune")
    best, _ = search(index, some, k, None, id_col, vec_col, exclude_self)
    at = read_lists(some.sparkSession, index.path).select(F.col("id").alias("item_id"), "list")
    order = probe_order(index, some, id_col, vec_col).select("query_id", "list", "place")
    place = best.join(at, "item_id").join(order, ["query_id", "list"]).groupBy("query_id", "rank").agg(F.min("place").alias("place"))
    w = Window.partitionBy("rank").orderBy("place")
    place = place.withColumn("share", F.cume_dist().over(w))
    need = place.filter(F.col("share") >= recall).groupBy("rank").agg(F.min("place").alias("p")).agg(F.max("p")).first()[0]
    return 1 if need is None else int(need) + 1
