"""Token-id files compressed by Re-Pair grammars.

Documents are put in id order by a range partitioning, tokenised, and written
as shard files of bounded size. In each shard, frequent pairs of adjacent ids
are replaced by new symbols (nonterminals), again and again; the file stores
the rules, each symbol's expansion length and each document's first symbol, so
one document can be decoded without reading the others. A pair never spans two
documents.

File: 8 bytes magic, u32 length of a JSON head, the head, then the arrays named
there in order: ``doc_ids`` i64, ``id_null`` u8, ``first`` u64 (symbol offset of
each document, and the end), ``left`` / ``right`` (the rules; symbol ``base + i``
stands for pair i), ``length`` u32 (ids that symbol ``base + i`` expands to),
``symbols``. All little-endian.
"""

from __future__ import annotations

import json
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import cut, fs_of, new_folder, with_slices
from tessera.llm.vocab import byte_bpe, vocabulary

MAGIC = b"IDSREPR1"
SHARD_IDS = 1 << 21  # ids after which a shard file is closed
MIN_COUNT = 16  # a rule is made for pairs found this often at least
LEAST_RULES = 256  # rules of a pass, if so many pairs are frequent and so many symbols left
HASH_BITS = 20


def compress(ids: np.ndarray, ends: np.ndarray, base: int, min_count: int = MIN_COUNT):
    """Re-Pair in passes: each counts all adjacent pairs, gives the most
    frequent ones a symbol (half of the symbols left, or ``LEAST_RULES``),
    and replaces their occurrences from left to right, until no pair is found
    ``min_count`` times or no symbol is left.
    ``ends``: position after each document's last id. Returns symbols, document
    ends in symbols, and the rules' left and right parts."""
    narrow = base <= 0xF000
    sym_type, code_type, shift = (np.uint16, np.uint32, 16) if narrow else (np.uint32, np.uint64, 32)
    factor = code_type(0x9E3779B1 if narrow else 0x9E3779B97F4A7C15)
    down = code_type(8 * code_type().itemsize - HASH_BITS)
    border_code = code_type(2 ** (2 * shift) - 1)  # no pair of symbols: the last symbol is never used
    room = (1 << shift) - 1 - base
    sym = ids.astype(sym_type)
    ends = ends.astype(np.int64)
    left, right = [], []
    while room > 0 and len(sym) > 1:
        code = sym[:-1].astype(code_type)
        code <<= code_type(shift)
        code |= sym[1:]
        border = np.unique(ends[(ends > 0) & (ends < len(sym))]) - 1  # a pair here would span two documents
        code[border] = border_code
        ordered = np.sort(code)[:len(code) - len(border)]
        if not len(ordered):
            break
        first = np.flatnonzero(ordered[1:] != ordered[:-1]) + 1
        first = np.concatenate([[0], first, [len(ordered)]])
        count = np.diff(first)
        want = min(max(room // 2, LEAST_RULES), room, 1 << 14)
        common = np.flatnonzero(count >= min_count)
        common = common[np.lexsort((ordered[first[common]], -count[common]))][:want]
        if not len(common):
            break
        pair = ordered[first[common]]
        # table from a hash of the pair to its rule; of two in one place the rarer one waits
        place = (pair * factor) >> down
        _, keep = np.unique(place, return_index=True)
        keep.sort()
        pair, place = pair[keep], place[keep]
        table = np.full(1 << HASH_BITS, -1, np.int16)
        table[place] = np.arange(len(pair))
        spot = code * factor
        spot >>= down
        rule = table[spot]
        at = np.flatnonzero(rule >= 0)
        rule = rule[at]
        hit = pair[rule] == code[at]
        at, rule = at[hit], rule[hit]
        if not len(at):
            break
        # overlapping hits: every second one of a run
        head = np.flatnonzero(np.diff(at) != 1) + 1
        size = np.diff(np.concatenate([[0], head, [len(at)]]))
        lead = np.repeat(np.concatenate([[0], head]), size)
        use = (np.arange(len(at)) - lead) % 2 == 0
        at, rule = at[use], rule[use]
        sym[at] = (base + len(left) + rule.astype(np.int64)).astype(sym_type)
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        ends = ends - np.searchsorted(at + 1, ends)
        sym = sym[keep]
        left.extend((pair >> code_type(shift)).tolist())
        right.extend((pair & code_type((1 << shift) - 1)).tolist())
        room -= len(pair)
    return sym, ends, np.array(left, sym_type), np.array(right, sym_type)


def rule_lengths(left: np.ndarray, right: np.ndarray, base: int) -> np.ndarray:
    """Ids that each rule expands to; a rule only uses earlier ones."""
    out = [0] * len(left)
    for i, (a, b) in enumerate(zip(left.tolist(), right.tolist())):
        out[i] = (1 if a < base else out[a - base]) + (1 if b < base else out[b - base])
    return np.array(out, np.uint32)


class Expander:
    """Flat expansions of all symbols, so that symbols decode by array gathers."""

    def __init__(self, left: np.ndarray, right: np.ndarray, length: np.ndarray, base: int):
        self.size = np.concatenate([np.ones(base, np.int32), length.astype(np.int32)])
        self.start = (np.cumsum(self.size, dtype=np.int64) - self.size).astype(np.int32)
        self.flat = np.empty(int(self.start[-1] + self.size[-1]), "<u4")
        flat, start, size = self.flat, self.start.tolist(), self.size.tolist()
        flat[:base] = np.arange(base)
        for i, (a, b) in enumerate(zip(left.tolist(), right.tolist()), base):
            o, n = start[i], size[a]
            flat[o:o + n] = flat[start[a]:start[a] + n]
            flat[o + n:o + size[i]] = flat[start[b]:start[b] + size[b]]

    def sizes(self, sym: np.ndarray) -> np.ndarray:
        return self.size[sym]

    def ids(self, sym: np.ndarray, size: np.ndarray | None = None) -> np.ndarray:
        size = self.size[sym] if size is None else size
        ends = np.cumsum(size, dtype=np.int64)
        if not len(ends):
            return np.empty(0, "<u4")
        at = np.repeat(self.start[sym] - (ends - size), size)
        at += np.arange(ends[-1])
        return self.flat[at]


def shard_bytes(doc_ids: list[int | None], ids: np.ndarray, ends: np.ndarray, base: int) -> bytes:
    sym, sym_ends, left, right = compress(ids, ends, base)
    arrays = {"doc_ids": np.array([d or 0 for d in doc_ids], "<i8"),
              "id_null": np.array([d is None for d in doc_ids], np.uint8),
              "first": np.r_[0, sym_ends].astype("<u8"), "left": left, "right": right,
              "length": rule_lengths(left, right, base).astype("<u4"), "symbols": sym}
    head = {"base": base, "arrays": [[k, a.dtype.newbyteorder("<").str, len(a)] for k, a in arrays.items()]}
    head = json.dumps(head).encode()
    return MAGIC + struct.pack("<I", len(head)) + head + b"".join(
        a.astype(a.dtype.newbyteorder("<"), copy=False).tobytes() for a in arrays.values())


class Shard:
    """Reader of one shard file's bytes."""

    def __init__(self, raw: bytes):
        if raw[:8] != MAGIC:
            raise ValueError("not a token-id file")
        n = struct.unpack_from("<I", raw, 8)[0]
        head, at, self.part = json.loads(raw[12:12 + n]), 12 + n, {}
        for name, kind, size in head["arrays"]:
            self.part[name] = np.frombuffer(raw, kind, size, at)
            at += size * np.dtype(kind).itemsize
        p = self.part
        self.expander = Expander(p["left"], p["right"], p["length"], head["base"])

    def doc_ids(self) -> list[int | None]:
        return [None if z else d for d, z in zip(self.part["doc_ids"].tolist(), self.part["id_null"].tolist())]

    def document(self, i: int) -> np.ndarray:
        """Ids of the i-th document alone."""
        a, b = int(self.part["first"][i]), int(self.part["first"][i + 1])
        return self.expander.ids(self.part["symbols"][a:b])

    def all_ids(self) -> tuple[np.ndarray, np.ndarray]:
        """All ids and the position after each document's last one."""
        sym = self.part["symbols"]
        size = self.expander.sizes(sym)
        ends = np.r_[0, np.cumsum(size)][self.part["first"][1:].astype(np.int64)]
        return self.expander.ids(sym, size), ends


def write_ids(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0,
              shard_ids: int = SHARD_IDS, path: str | None = None) -> DataFrame:
    """Tokenise every whole text, append the end id, and write shard files in
    ascending id order (nulls first; equal ids by a hash of the text). Returns
    the manifest ``(part, seq, file, n_docs, n_ids, n_bytes)``, already
    written as a table. File names carry the task attempt: what a lost attempt
    leaves behind is in no manifest."""
    path = path or vocabulary("byte_bpe_50k.json")

    def run(batches):
        bpe = byte_bpe(path)
        fs, root = fs_of(folder)
        ctx = TaskContext.get()
        part, seq, held, names, total = ctx.partitionId(), 0, [], [], 0

        def close():
            ids = np.concatenate(held)
            ends = np.cumsum([len(x) for x in held])
            raw = shard_bytes(names, ids, ends, bpe.size)
            file = f"part-{part:06d}-{seq:05d}-{ctx.taskAttemptId()}.ids"
            with fs.open_output_stream(f"{root}/{file}") as f:
                f.write(raw)
            return pa.RecordBatch.from_pylist([{
                "part": part, "seq": seq, "file": file, "n_docs": len(names), "n_ids": total, "n_bytes": len(raw)}],
                schema=pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("file", pa.string()),
                                  ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("n_bytes", pa.int64())]))

        for b in with_slices(batches, 256):
            for d, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = np.append(bpe.ids(text), bpe.dtype.type(end_id))
                held.append(ids)
                names.append(d)
                total += len(ids)
                if total >= shard_ids:
                    yield close()
                    seq, held, names, total = seq + 1, [], [], 0
        if held:
            yield close()

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    order = [F.col("_id").asc_nulls_first(), F.xxhash64("_text")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return cut(rows.mapInArrow(run, "part int, seq int, file string, n_docs long, n_ids long, n_bytes long"), "manifest")


def read_documents(manifest: DataFrame, folder: str, id_col: str = "doc_id") -> DataFrame:
    """Decode the shard files: per document its id, ``start`` (ids of all
    documents before it), ``n_tokens`` and ``ids_crc32``. Starts come from the
    manifest: a running sum over parts (one row each) and one within a part."""
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("_part_start"))
    inner = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.withColumn("_inner", F.coalesce(inner, F.lit(0))).join(parts, "part")
    files = files.select("file", (F.col("_inner") + F.col("_part_start")).alias("start"))

    def run(batches):
        fs, root = fs_of(folder)
        for b in with_slices(batches, 64):
            for row in b.to_pylist():
                with fs.open_input_file(f"{root}/{row['file']}") as f:
                    shard = Shard(f.read())
                ids, ends = shard.all_ids()
                view, starts = memoryview(ids.tobytes()), np.r_[0, ends[:-1]]
                crc = [zlib.crc32(view[4 * a:4 * e]) for a, e in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.doc_ids(), pa.int64()), pa.array(starts + row["start"], pa.int64()),
                     pa.array(ends - starts, pa.int64()), pa.array(crc, pa.int64())],
                    names=[id_col, "start", "n_tokens", "ids_crc32"])

    # a stated number: AQE would put the small file list into one task
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(n, F.col("file")).mapInArrow(
        run, f"`{id_col}` long, start long, n_tokens long, ids_crc32 long")


def encode_and_read(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0) -> DataFrame:
    """Write all documents to shard files and read them back.

    Null and empty texts: the end id alone. Repeated rows and null ids are
    documents of their own. Only id and text are read, so other columns can't
    clash; an empty table gives no file and no row.
    """
    folder = new_folder(docs.sparkSession, "token-ids")
    return read_documents(write_ids(docs, folder, id_col, text_col, end_id), folder, id_col)
