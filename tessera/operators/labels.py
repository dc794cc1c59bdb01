"""Label dimension lookups: JOI2, JOI6, MAP1, AGG12."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.common import first_per_key, last_per_key, small_side


def attach_labels(pred: DataFrame, labels: DataFrame, how: str = "inner", label: str = "label",
                  order: str | None = None, cols=("code", "text")) -> DataFrame:
    """JOI2. Label -> (code, text). ``how='inner'`` drops unknown labels,
    ``'left'`` keeps them with NULLs. The first label row wins (by ``order``,
    default the code) when the dimension repeats a label."""
    cols = [c for c in cols if c in labels.columns]
    dim = first_per_key(labels.select(label, *cols, *([order] if order else [])), label,
                        order or cols[0], cols=cols)
    return pred.join(small_side(dim), label, how)


def lookup_last(df: DataFrame, dim: DataFrame, key: str, value: str, order: str,
                out: str | None = None, how: str = "left") -> DataFrame:
    """JOI6. Dictionary lookup where the *last* duplicate key wins (like
    building a dict from pairs)."""
    d = last_per_key(dim.select(key, value, order), key, order, cols=[value])
    if out:
        d = d.withColumnRenamed(value, out)
    return df.join(small_side(d), key, how)


def label_maps(labels: DataFrame, label: str = "label", code: str = "code") -> DataFrame:
    """MAP1. ``(label, code)`` pairs: the id->label and label->id maps as one
    small table (use ``map_from_entries`` on it only when a map column is
    really needed)."""
    return labels.select(label, code).distinct()


def num_classes(df: DataFrame, col: str = "code") -> DataFrame:
    """AGG12. Number of classes."""
    return df.agg(F.countDistinct(col).alias("num_classes"))
