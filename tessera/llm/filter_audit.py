"""Filter interaction audit by contraction of a contingency tensor.

Each document either passes or fails each of five filters, so a part of the
corpus is one 2x2x2x2x2 tensor of counts (axis: filter; 0 pass, 1 fail), and
two more of its good and toxic documents. Whatever a filter does at a step of
an order is a contraction of that tensor: along each axis a selector takes the
passing entry, the failing one, or both. Documents are therefore read once, and
all orders and steps come from 32 numbers per part.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut, hot_lookup

FILTERS = "ABCDE"
WORD = r"[^\x20\x09-\x0D]+"
MARKS = "[#$%&*|]"
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def row_filters(text: Column) -> list[Column]:
    """Failure conditions A to D of a text that is not null."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    return [n < 200, 100 * distinct.cast("long") < 50 * n.cast("long"),
            100 * capitals > 3 * F.char_length(text).cast("long"), text.rlike(MARKS)]


def cell_of(*fails: Column) -> Column:
    """Index of a document's cell in the flattened tensor: first filter first."""
    return sum((F.when(f, 1 << (len(fails) - 1 - i)).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """Per row of ``docs``: ``doc_id, part, cell`` (see :func:`cell_of`).

    Filter E asks for the smallest id of each text. Texts meet as SHA-256
    digests, and only digests seen twice or more are looked up; a digest shared
    by a large part of all rows is broadcast, its rows stay where they are. Rows
    without an id never follow a smaller one, and pass E."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    rows = rows.select("doc_id", "part", cell_of(*row_filters(F.col("text"))).alias("four"),
                       F.sha2("text", 256).alias("digest"))
    rows = cut(rows, "filter-rows")
    copies = rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    out = hot_lookup(rows, copies.filter("n > 1"), "digest", "n", rows.count(), F.xxhash64("digest", "doc_id"))
    copy = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))
    return out.select("doc_id", "part", (F.col("four") * 2 + copy.cast("int")).alias("cell"))


def tensors(fails: DataFrame, labels: DataFrame, filters: int = len(FILTERS), id_col: str = "doc_id") -> DataFrame:
    """One row per part: ``part`` and ``documents, good, toxic``, each the
    flattened tensor of counts. Rows of one id meet its labels as at most one
    row per part and cell. Several labels of one id: good (toxic) if any says so."""
    marks = labels.select(F.col(id_col).cast("long").alias("label_id"), "quality", "toxic").groupBy("label_id").agg(
        F.max(F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0))).alias("good"),
        F.max(F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0))).alias("toxic"))
    rows = fails.groupBy("doc_id", "part", "cell").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.join(marks, F.col("doc_id") == F.col("label_id"), "left")
    n = {"documents": F.col("n"), "good": F.col("n") * F.coalesce("good", F.lit(0)),
         "toxic": F.col("n") * F.coalesce("toxic", F.lit(0))}
    return rows.groupBy("part").agg(*[
        F.array(*[F.sum(F.when(F.col("cell") == c, x).otherwise(0)) for c in range(1 << filters)]).alias(name)
        for name, x in n.items()])


def steps(filters: str = FILTERS) -> list[tuple[str, int, int, frozenset[int]]]:
    """Every step of every order: order, step from 1, its filter's axis and
    the axes of the filters before it."""
    return [("".join(filters[a] for a in order), k + 1, order[k], frozenset(order[:k]))
            for order in permutations(range(len(filters))) for k in range(len(filters))]


def contract(counts: np.ndarray, choices: list[list[tuple[int, int]]]) -> np.ndarray:
    """For each choice (one selector per axis), the selected total of each of
    the stacked tensors ``counts``: (choices, tensors)."""
    pick = np.array(choices, np.int64)
    axes = "abcdefghij"[:pick.shape[1]]
    spec = f"z{axes}," + ",".join(f"y{a}" for a in axes) + "->yz"
    return np.einsum(spec, counts, *(pick[:, i] for i in range(pick.shape[1])))


def audit_part(counts: np.ndarray, filters: str = FILTERS) -> dict[str, np.ndarray]:
    """``COUNTS`` of every step of every order, from the stacked tensors of
    documents, good and toxic ones (shape 3, 2, 2, ...)."""
    plan = steps(filters)
    axes = range(len(filters))
    kept = contract(counts, [[PASS if a in done or a == at else ALL for a in axes] for _, _, at, done in plan])
    gone = contract(counts, [[FAIL if a == at else PASS if a in done else ALL for a in axes] for _, _, at, done in plan])
    failed = contract(counts, [[FAIL if a == f else ALL for a in axes] for f in axes])[:, 0]
    alone = contract(counts, [[FAIL if a == f else PASS for a in axes] for f in axes])[:, 0]
    at = np.array([p[2] for p in plan])
    total = np.zeros(len(filters), np.int64)
    np.add.at(total, at, gone[:, 0])
    return {"kept": kept[:, 0], "removed": gone[:, 0], "redundant": failed[at] - gone[:, 0], "unique_fails": alone[at],
            "good_lost": gone[:, 1], "toxic_lost": gone[:, 2], "shapley": total[at]}


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "lang") -> DataFrame:
    """One row per part, order of the five filters and step: ``part,
    filter_order, step`` and ``COUNTS``.

    Null texts are empty; a null part is the empty string. Repeated rows count
    each; rows without an id have no label. Only the named columns are read, so
    others can't clash; an empty table gives no row. A part's tensors are one
    row of 96 numbers, contracted where it lies.
    """
    table = tensors(failures(docs, id_col, text_col, part_col), labels, id_col=id_col)
    plan = steps()
    order, step = pa.array([p[0] for p in plan]), pa.array([p[1] for p in plan], pa.int32())

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                counts = np.array([r["documents"], r["good"], r["toxic"]], np.int64)
                found = audit_part(counts.reshape(3, *[2] * len(FILTERS)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["part"]] * len(plan)), order, step, *(pa.array(found[c]) for c in COUNTS)],
                    names=["part", "filter_order", "step", *COUNTS])

    return table.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS))
