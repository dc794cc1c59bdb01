"""Array-valued score helpers (NUM1, TOP1, cosine for VEC1).

All higher-order functions (``transform``/``aggregate``/``zip_with``) run in the
JVM, per row, with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.common import as_col


def log_sum_exp(col) -> Column:
    """Numerically stable ``log(sum(exp(x)))`` of an array in one pass (a
    running max and a rescaled running sum inside ``aggregate``)."""
    arr = as_col(col)
    init = F.struct(F.lit(float("-inf")).alias("m"), F.lit(0.0).alias("s"))

    def step(acc, x):
        x = x.cast("double")
        m = F.greatest(acc["m"], x)
        return F.struct(m.alias("m"), (acc["s"] * F.exp(acc["m"] - m) + F.exp(x - m)).alias("s"))

    return F.aggregate(arr, init, step, lambda acc: acc["m"] + F.log(acc["s"]))


def softmax(col) -> Column:
    """NUM1. Softmax of a numeric array. The normaliser is an expression, so
    inside one projection it is re-evaluated per element; on wide arrays use
    :func:`with_softmax`, which computes it once per row."""
    lse = log_sum_exp(col)
    return F.transform(as_col(col), lambda x: F.exp(x.cast("double") - lse))


def with_softmax(df, col: str, out: str):
    """NUM1 as a DataFrame step: the log-sum-exp is its own column (a
    separate projection Catalyst keeps, since it is not a cheap expression),
    then one ``transform`` gives the probabilities: O(n) per row."""
    tmp = f"_{out}_lse"
    return (df.withColumn(tmp, log_sum_exp(col))
              .withColumn(out, F.transform(col, lambda x: F.exp(x.cast("double") - F.col(tmp))))
              .drop(tmp))


def topk_array(col, k: int = 5, apply_softmax: bool = True) -> Column:
    """TOP1. The ``k`` largest entries of a score array as
    ``array<struct<rank:int, label:int, value:double>>``.

    Ties go to the lowest index. Softmax is monotone, so ranking uses the raw
    scores (one sort per row) and only the ``k`` winners are normalised:
    ``exp(x - logsumexp)``. ``apply_softmax=False`` returns the raw scores
    (e.g. probabilities a model already produced).
    """
    arr = as_col(col)
    # natural struct order (no comparator lambda per comparison); a NULL
    # score sorts after every real one
    keyed = F.transform(arr, lambda x, i: F.struct(
        F.coalesce(-x.cast("double"), F.lit(float("inf"))).alias("neg"), i.alias("label")))
    best = F.slice(F.sort_array(keyed), 1, k)
    lse = log_sum_exp(arr) if apply_softmax else None

    def value(s):
        return F.exp(-s["neg"] - lse) if apply_softmax else -s["neg"]

    return F.transform(best, lambda s, i: F.struct(
        (i + 1).alias("rank"), s["label"].alias("label"), value(s).alias("value")))


def dot(a, b) -> Column:
    prod = F.zip_with(as_col(a), as_col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prod, F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(a) -> Column:
    return F.sqrt(dot(a, a))


def normalize(a) -> Column:
    """Unit-length copy of a vector (zero vectors stay zero)."""
    n = l2_norm(a)
    return F.transform(as_col(a), lambda x: F.when(n > 0, x.cast("double") / n).otherwise(F.lit(0.0)))
