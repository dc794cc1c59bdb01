"""Packing by first-fit decreasing over a tournament tree of bin capacities.

Documents are tokenised, ended, and cut at multiples of the sequence length.
Full pieces are sequences of their own. The last pieces are dealt into
randomised groups of documents of bounded size; each group is packed on its own
with first-fit decreasing, where a tournament tree over the bins' free space
finds the first bin that fits in O(log bins).
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut, with_slices
from tessera.llm.vocab import byte_bpe, vocabulary

CAPACITY = 2048
GROUP_DOCS = 4096  # documents a group holds on average; bounds a task's memory and padding alike


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """Bin number of each item (sizes 1..capacity). Items go by descending
    size, ties by position. The tree's leaves are the bins' free space, its
    inner nodes the larger of their children: walking down to the left child
    whenever it fits ends at the first bin that fits."""
    n = len(sizes)
    out = [0] * n
    leaves = 1
    while leaves < n:
        leaves *= 2
    tree = [capacity] * (2 * leaves)
    for i in sorted(range(n), key=lambda i: (-sizes[i], i)):
        need, node = sizes[i], 1
        while node < leaves:
            node *= 2
            if tree[node] < need:
                node += 1
        out[i] = node - leaves
        tree[node] -= need
        node //= 2
        while node:
            top = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == top:
                break
            tree[node] = top
            node //= 2
    return out


def cut_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1,
               capacity: int = CAPACITY, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Token pieces of at most ``capacity`` ids of every whole text, the end id
    included; with ``with_ids`` each carries its ids (little-endian, 32 bit).
    ``_row`` numbers a task's documents, ``_full`` its full pieces."""
    path = path or vocabulary("byte_bpe_50k.json")
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (f"`{id_col}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, _row long, _full long"
              + (", ids binary" if with_ids else ""))

    def run(batches):
        ids_of = byte_bpe(path).ids
        task = TaskContext.get().partitionId() << 33
        row, full = task, task
        names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "_row", "_full"] + ["ids"] * with_ids
        for b in with_slices(batches, 512):
            at, cols = [], [[] for _ in range(7)]
            for i, text in enumerate(b.column(1).to_pylist()):
                ids = np.append(ids_of(text), end_id).astype("<u4")
                raw = ids.tobytes()
                for s in range(0, len(ids), capacity):
                    n = min(capacity, len(ids) - s)
                    piece = raw[4 * s:4 * (s + n)]
                    at.append(i)
                    whole = n == capacity
                    for c, v in zip(cols, (s, n, zlib.crc32(piece), len(ids), row, full if whole else None, piece)):
                        c.append(v)
                    full += whole
                row += 1
            arrays = [b.column(0).take(pa.array(at, pa.int64()))] + [pa.array(c, pa.int64()) for c in cols[:6]]
            if with_ids:
                arrays.append(pa.array(cols[6], pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, capacity: int = CAPACITY,
         group_docs: int = GROUP_DOCS, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset`` (and ``ids``).

    Null and empty texts are one piece, the end id alone. Repeated rows and
    null ids are documents of their own (groups are drawn by id and row
    number, so equal ids don't gather in one). Only id and text are read, so
    other columns can't clash; an empty table gives no row. The pieces are
    written once; only last pieces (a few numbers each) are shuffled.
    """
    pieces = cut(cut_pieces(docs, id_col, text_col, end_id, capacity, path, with_ids), "pieces")
    last = pieces.filter(F.col("_full").isNull())
    groups = max(1, -(-last.count() // group_docs))
    kind = docs.schema[id_col].dataType.simpleString()
    cols = [id_col, "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids

    def run(batches):
        held, now = [], None
        for b in with_slices(batches, 4096):
            group = b.column(b.schema.get_field_index("_group")).to_pylist()
            lo = 0
            for i in range(1, len(group) + 1):
                if i == len(group) or group[i] != group[lo]:
                    if held and now != group[lo]:
                        yield placed(held, now)
                        held = []
                    now = group[lo]
                    held.append(b.slice(lo, i - lo))
                    lo = i
        if held:
            yield placed(held, now)

    def placed(held, group):
        t = pa.Table.from_batches(held).combine_chunks()
        size = t.column("length").to_pylist()
        bins = np.array(first_fit_decreasing(size, capacity), np.int64)
        size = np.array(size, np.int64)
        order = np.lexsort((np.arange(len(size)), -size, bins))
        ends = np.cumsum(size[order])
        before = ends - size[order]
        first = np.r_[True, np.diff(bins[order]) != 0]
        offset = np.empty(len(size), np.int64)
        offset[order] = before - np.maximum.accumulate(np.where(first, before, 0))
        t = t.select(cols)
        t = t.append_column("sequence_id", pa.array(((group << 33) | bins) * 2))
        return t.append_column("offset", pa.array(offset)).to_batches()[0]

    fields = {f.name: f.dataType.simpleString() for f in pieces.schema.fields}
    schema = ", ".join(f"`{c}` {kind if c == id_col else fields[c]}" for c in cols) + ", sequence_id long, offset long"
    group = F.pmod(F.xxhash64(F.col(id_col), F.col("_row")), F.lit(groups))
    packed = (last.select(*cols, group.alias("_group"), "_row").repartition(F.col("_group"))
              .sortWithinPartitions("_group", "_row").mapInArrow(run, schema))
    whole = pieces.filter(F.col("_full").isNotNull()).select(
        *cols, (F.col("_full") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return whole.unionByName(packed)
