"""Exact top-k inner products over norm-sorted blocks.

Vectors are turned into integers, range-partitioned by descending length, and
cut into blocks. The first block (the longest vectors) gives every query a
first threshold. Then each pair of an item block and a query block that the
Cauchy-Schwarz bound (largest length times query length) does not rule out is
searched: vectors are rotated by the singular vectors of all data, so the first
coordinates hold most of the length; partial sums over them plus the product of
the residual lengths bound each score from above, and only pairs whose bound
reaches the threshold are scored exactly in integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import cut, with_slices

BLOCK = 8192  # vectors of an item block
QUERY_BLOCK = 2048
LARGEST = 2.0 ** 62  # scores reach this at most; beyond it the job raises
STEPS = (8, 24)  # coordinates after which bounds are taken


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """``(id, v array<bigint>, norm2)``: each component ``floor(scale * x)``.
    Null or empty vectors and vectors with a null, infinite or NaN component
    take no part; nor do null ids."""
    x = F.col("_v")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("_v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0)).filter(~bad)
    v = F.transform(x, lambda c: F.floor(c * scale).cast("bigint"))
    rows = rows.select("vec_id", v.alias("v"))
    return rows.withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double")))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def rotation(vectors: DataFrame, dim: int) -> np.ndarray:
    """Singular vectors of all rows (dim x dim, strongest first), from the
    Gram matrix: dim x dim sums reach the driver, whatever the row count."""
    def run(batches):
        gram = np.zeros((dim, dim))
        for b in with_slices(batches, 8192):
            m = _matrix(b.column(0), dim).astype(np.float64)
            gram += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim * dim)), pa.array(gram.ravel())], names=["i", "x"])

    sums = vectors.select("v").mapInArrow(run, "i long, x double").groupBy("i").agg(F.sum("x").alias("x")).toArrow()
    gram = np.zeros(dim * dim)
    gram[sums["i"].to_numpy()] = sums["x"].to_numpy()
    value, basis = np.linalg.eigh(gram.reshape(dim, dim))
    return np.ascontiguousarray(basis[:, np.argsort(-value)])


def _packed(rows: DataFrame, size: int, order: list, parts: int, dim: int, name: str) -> DataFrame:
    """Blocks of at most ``size`` vectors, one row each: ``(name, max_norm,
    n, ids, vecs)``; ``order`` is kept within and across blocks."""
    def run(batches):
        from pyspark import TaskContext
        at = TaskContext.get().partitionId() << 20
        ids, vecs, have = [], [], 0

        def block():
            i, v = np.concatenate(ids), np.concatenate(vecs)
            top = float(np.sqrt((v.astype(np.float64) ** 2).sum(1).max()))
            return pa.RecordBatch.from_arrays(
                [pa.array([at]), pa.array([top]), pa.array([len(i)]), pa.array([i.tobytes()], pa.binary()),
                 pa.array([v.tobytes()], pa.binary())], names=[name, "max_norm", "n", "ids", "vecs"])
        for b in with_slices(batches, size):
            i, v = b.column(0).to_numpy(), _matrix(b.column(1), dim)
            while len(i):
                take = size - have
                ids.append(i[:take])
                vecs.append(v[:take])
                have += len(ids[-1])
                i, v = i[take:], v[take:]
                if have == size:
                    yield block()
                    at, ids, vecs, have = at + 1, [], [], 0
        if have:
            yield block()

    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return rows.select("vec_id", "v").mapInArrow(
        run, f"{name} long, max_norm double, n long, ids binary, vecs binary")


def best_of(query_ids, queries, item_ids, items, basis, k, floor=None):
    """The k best items of each query in one pair of blocks: (query index,
    vec_id, score) arrays. ``floor``: scores below it are of no use (per
    query). Items with a query's own id don't count."""
    q, x = queries.astype(np.float64) @ basis, items.astype(np.float64) @ basis
    dim, nq = q.shape[1], len(q)
    low = np.full(nq, -np.inf) if floor is None else floor.astype(np.float64)
    out_q, out_i, out_s = [], [], []
    steps = [s for s in STEPS if s < dim]
    q_rest = [np.sqrt((q[:, s:] ** 2).sum(1)) for s in [0, *steps]]
    x_rest = [np.sqrt((x[:, s:] ** 2).sum(1)) for s in [0, *steps]]
    slack = 1e-9 * q_rest[0].max(initial=0) * x_rest[0].max(initial=0) + 1e-6
    for a in range(0, len(x), 1024):  # by descending length
        xs, ids = slice(a, a + 1024), item_ids[a:a + 1024]
        live = np.flatnonzero(q_rest[0] * x_rest[0][xs].max() + slack >= low)
        if not len(live):
            break  # the vectors to come are no longer
        bound_ok = np.ones((len(live), len(ids)), bool)
        part, done = np.zeros((len(live), len(ids))), 0
        for j, s in enumerate(steps, 1):
            part += q[live][:, done:s] @ x[xs, done:s].T
            done = s
            bound_ok &= part + np.outer(q_rest[j][live], x_rest[j][xs]) + slack >= low[live, None]
        bound_ok &= query_ids[live][:, None] != ids[None, :]
        qi, xi = np.nonzero(bound_ok)
        if not len(qi):
            continue
        score = np.empty(len(qi), np.int64)
        for c in range(0, len(qi), 1 << 16):
            score[c:c + (1 << 16)] = (queries[live[qi[c:c + (1 << 16)]]] * items[a + xi[c:c + (1 << 16)]]).sum(1)
        keep = score >= low[live[qi]]
        out_q.append(live[qi[keep]])
        out_i.append(ids[xi[keep]])
        out_s.append(score[keep])
        # keep the k best so far, which lifts the thresholds
        qa, ia, sa = np.concatenate(out_q), np.concatenate(out_i), np.concatenate(out_s)
        order = np.lexsort((ia, -sa, qa))
        qa, ia, sa = qa[order], ia[order], sa[order]
        first = np.r_[True, qa[1:] != qa[:-1]] if len(qa) else np.empty(0, bool)
        rank = np.arange(len(qa)) - np.maximum.accumulate(np.where(first, np.arange(len(qa)), 0))
        kth = rank == k - 1
        low[qa[kth]] = np.maximum(low[qa[kth]], sa[kth])
        out_q, out_i, out_s = [qa[rank < k]], [ia[rank < k]], [sa[rank < k]]
    if not out_q:
        none = np.empty(0, np.int64)
        return none, none, none, low
    return out_q[0], out_i[0], out_s[0], low


def top_k(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = 256, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """Exact top k of every query row: query_id, rank (from 1), vec_id, score.

    ``is_query``: condition on ``vec_id``. Candidates are all rows but those
    with the query's own id; equal scores go to the smaller id. Each dimension
    is searched on its own: a query meets the vectors of its own dimension.
    Repeated rows of one id and vector are one candidate; different vectors of
    one id are candidates each. Queries that share an id are one query, with
    the smallest vector. Vectors so long that a score could leave 64 bits raise
    an error before any search. Empty tables give no row; only id and vector are
    read, so other columns can't clash.
    """
    spark = vectors.sparkSession
    rows = integer_vectors(vectors, id_col, vector_col, scale)
    rows = cut(rows.dropDuplicates(["vec_id", "v"]), "vectors")
    asked = rows.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v"), F.min_by("norm2", "v").alias("norm2"))
    asked = cut(asked, "asked")
    # one row per dimension
    dims = asked.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy("d").collect()
    out = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    for r in dims:
        same = F.size("v") == r["d"]
        found = _top_k(rows.filter(same), asked.filter(same), r["n"], r["d"], k, block, query_block)
        out = found if len(dims) == 1 else out.unionByName(found)
    return out


def _top_k(rows: DataFrame, asked: DataFrame, n_asked: int, dim: int, k: int, block: int, query_block: int) -> DataFrame:
    """:func:`top_k` of vectors of one dimension."""
    spark = rows.sparkSession
    total = rows.count()
    # lengths bound every score, and every partial sum of one
    longest = [d.agg(F.max("norm2")).first()[0] or 0.0 for d in (rows, asked)]
    if longest[0] ** 0.5 * longest[1] ** 0.5 >= LARGEST:
        raise ValueError(f"scores of vectors with {dim} components may exceed 64 bits: lengths up to "
                         f"{longest[0] ** 0.5:.3g} and {longest[1] ** 0.5:.3g}")
    basis = rotation(rows, dim)
    parts = max(1, -(-total // block))
    items = cut(_packed(rows, block, [F.desc("norm2"), F.col("vec_id")], parts, dim, "iblk"), "items")
    queries = cut(_packed(asked, query_block, [F.xxhash64("vec_id"), F.col("vec_id")],
                          max(1, -(-n_asked // query_block)), dim, "qblk"), "queries")
    shared = spark.sparkContext.broadcast(basis)  # dim x dim
    # the longest vectors: one block, of a stated number of rows
    head = items.orderBy("iblk").select("iblk", "ids", "vecs").first()
    head_block = spark.sparkContext.broadcast((bytes(head["ids"]), bytes(head["vecs"])))

    def numbers(row, ids, vecs):
        return np.frombuffer(row[ids], np.int64), np.frombuffer(row[vecs], np.int64).reshape(-1, dim)

    def search(batches):
        for b in batches:
            for one in (b.slice(i, 1) for i in range(b.num_rows)):
                r = one.to_pylist()[0]
                if "ids" not in r:
                    r["ids"], r["vecs"] = head_block.value
                qid, q = numbers(r, "q_ids", "q_vecs")
                iid, x = numbers(r, "ids", "vecs")
                floor = np.frombuffer(r["floor"], np.float64) if r.get("floor") else None
                qi, vid, score, low = best_of(qid, q, iid, x, shared.value, k, floor)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["qblk"]], pa.int64()), pa.array([low.tobytes()], pa.binary()),
                     pa.array([qid[qi].tobytes()], pa.binary()), pa.array([vid.astype(np.int64).tobytes()], pa.binary()),
                     pa.array([score.astype(np.int64).tobytes()], pa.binary())],
                    names=["qblk", "floor", "query", "vec", "score"])

    found = "qblk long, floor binary, query binary, vec binary, score binary"
    q = queries.select("qblk", F.col("max_norm").alias("q_norm"), F.col("ids").alias("q_ids"),
                       F.col("vecs").alias("q_vecs"))
    first = cut(q.repartition(F.col("qblk")).mapInArrow(search, found), "head")

    def lowest(batches):
        for b in batches:
            f = [np.frombuffer(x, np.float64) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([float(x.min()) for x in f])],
                                             names=["qblk", "floor", "lowest"])
    floors = first.select("qblk", "floor").mapInArrow(lowest, "qblk long, floor binary, lowest double")
    # pairs of block numbers only; whole pairs fall here by the length bound
    norms = items.filter(F.col("iblk") != head["iblk"]).select("iblk", "max_norm")
    blocks = norms.agg(F.sort_array(F.collect_list(F.struct("iblk", "max_norm")))).scalar()
    wanted = q.select("qblk", "q_norm").join(floors.select("qblk", "lowest"), "qblk")
    wanted = wanted.select("qblk", "q_norm", "lowest", F.explode(blocks).alias("_b")).select(
        "qblk", F.col("_b.iblk").alias("iblk")).filter(
        F.col("q_norm") * F.col("_b.max_norm") * (1 + 1e-9) + 1e-6 >= F.col("lowest"))
    rest = wanted.join(items.select("iblk", "ids", "vecs"), "iblk").join(
        q.select("qblk", "q_ids", "q_vecs"), "qblk").join(floors.select("qblk", "floor"), "qblk")
    rest = rest.repartition(F.col("iblk"), F.col("qblk")).mapInArrow(search, found)

    def rows_of(batches):
        for b in batches:
            for x, y, z in zip(*(b.column(i).to_pylist() for i in (2, 3, 4))):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(c, np.int64)) for c in (x, y, z)],
                                                 names=["query_id", "vec_id", "score"])
    hits = first.unionByName(rest).mapInArrow(rows_of, "query_id long, vec_id long, score long")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
