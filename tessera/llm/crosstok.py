"""Alignment of two tokenizers over a corpus.

Both encode the same bytes. Offsets where tokens of both end cut a text into
groups, and the two tokens that end a group are linked. Most groups hold one
token of each side with the same bytes: an array made once maps each A id to the
B id of the same bytes, and these groups are counted in a vector as long as A's
vocabulary. Only the last pairs of the other groups are counted as pairs.

The shorter token of any linked pair is a suffix of the longer one, so the
vocabularies alone bound the pairs that can occur; they are numbered once, and
the corpus-wide counts are one array.
"""

from __future__ import annotations

import functools
import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut, with_slices
from tessera.llm.piece import BLANK
from tessera.llm.vocab import byte_alphabet, byte_bpe, vocabulary

SLICE = 1 << 18  # characters aligned at once; a longer text is aligned alone


def byte_level_tokens(path: str) -> list[bytes]:
    """Bytes of each id of a byte-level vocabulary file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    value = {c: i for i, c in enumerate(byte_alphabet())}
    special = {t["id"] for t in spec["added_tokens"]}
    out = [b""] * (1 + max(spec["model"]["vocab"].values()))
    for token, i in spec["model"]["vocab"].items():
        if i not in special:
            out[i] = bytes(value[c] for c in token)
    return out


def piece_tokens(lib) -> list[bytes]:
    """Bytes of each id of a SentencePiece model: none for control ids."""
    out = []
    for i in range(lib.get_piece_size()):
        p = lib.id_to_piece(i)
        out.append(b"" if lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i) else bytes([int(p[3:5], 16)]) if lib.is_byte(i)
                   else p.replace(BLANK, " ").encode())
    return out


class Aligner:
    """Groups and links of texts under two vocabularies."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        lib = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.a, self._encode_b = byte_bpe(path_a, plain=True), functools.partial(lib.encode, num_threads=1)
        bytes_a, bytes_b = byte_level_tokens(path_a), piece_tokens(lib)
        self.n_a, self.n_b = len(bytes_a), len(bytes_b)
        self.len_a, self.len_b = (np.array([len(t) for t in x], np.int64) for x in (bytes_a, bytes_b))
        self._bytes_a, self._bytes_b = (np.array(x, object) for x in (bytes_a, bytes_b))
        # pieces before byte tokens: a character that is a piece never falls back to bytes
        ids_b: dict[bytes, list[int]] = {}
        for i in sorted(range(self.n_b), key=lib.is_byte):
            if bytes_b[i]:
                ids_b.setdefault(bytes_b[i], []).append(i)
        ids_a = {t: i for i, t in enumerate(bytes_a) if t}
        self.same = np.array([ids_b[t][0] if t in ids_b else -1 for t in bytes_a], np.int64)
        pairs = {i * self.n_b + j for t, i in ids_a.items() for k in range(len(t)) for j in ids_b.get(t[k:], ())}
        pairs |= {ids_a[t[k:]] * self.n_b + j for t, js in ids_b.items() for k in range(len(t)) if t[k:] in ids_a for j in js}
        pairs -= {i * self.n_b + int(j) for i, j in enumerate(self.same) if j >= 0}
        #: link number: an A id (linked with ``same``), or ``n_a`` + place in ``pairs``
        self.pairs = np.array(sorted(pairs), np.int64)
        self.n_links = self.n_a + len(self.pairs)
        self._print_a = self._printed(self.n_a, ",", "|")
        self._print_b = self._printed(self.n_b, ",", ";")

    @staticmethod
    def _printed(n: int, inner: str, last: str) -> np.ndarray:
        return np.array([f"{i}{inner}" for i in range(n)] + [f"{i}{last}" for i in range(n)], object)

    def link_ids(self, link: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A and B ids of link numbers."""
        a, b = link.copy(), np.empty_like(link)
        odd = link >= self.n_a
        a[odd], b[odd] = np.divmod(self.pairs[link[odd] - self.n_a], self.n_b)
        b[~odd] = self.same[link[~odd]]
        return a, b

    def link_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Link numbers of pairs of ids that can be linked."""
        return np.where(self.same[a] == b, a, self.n_a + np.searchsorted(self.pairs, a * self.n_b + b))

    def encode_all(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray, int] | None]:
        """Ids of both sides and the number of bytes of each text; None if it
        has no tokens here."""
        ids = iter(self._encode_b([t for t in texts if t]))
        return [self._checked(t, next(ids)) if t else None for t in texts]

    def _checked(self, text: str, ids: list[int]) -> tuple[np.ndarray, np.ndarray, int] | None:
        raw = (" " + text).encode()
        a, b = self.a.ids(" " + text).astype(np.int64), np.array(ids, np.int64)
        if b"".join(self._bytes_a[a].tolist()) != raw or b"".join(self._bytes_b[b].tolist()) != raw:
            return None
        return a, b, len(raw)

    def align(self, a: np.ndarray, b: np.ndarray, size: np.ndarray):
        """Of the joined tokens of some texts (``size``: bytes of each): the
        link of each group, the text's groups, tokens of both sides per text,
        and the printed groups of each text."""
        end_a, end_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        at = np.searchsorted(end_b, end_a)  # both end with the last text, so this is a place of b
        last_a = np.flatnonzero(end_b[at] == end_a)
        last_b = at[last_a]
        wide_a, wide_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        x, y = a[last_a], b[last_b]
        link = np.where(self.same[x] == y, x, -1)
        odd = np.flatnonzero((wide_a != 1) | (wide_b != 1) | (link < 0))
        link[odd] = self.n_a + np.searchsorted(self.pairs, x[odd] * self.n_b + y[odd])
        text_end = np.cumsum(size)
        groups = np.searchsorted(end_a[last_a], text_end) + 1  # groups up to each text's end
        n_a, n_b = last_a[groups - 1] + 1, last_b[groups - 1] + 1
        # print order: each group's A tokens, then its B tokens
        group_a = np.repeat(np.arange(len(last_a)), wide_a)
        group_b = np.repeat(np.arange(len(last_b)), wide_b)
        printed = np.empty(len(a) + len(b), object)
        before_b, before_a = np.r_[0, last_b + 1], last_a + 1
        tail_a, tail_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        tail_a[last_a], tail_b[last_b] = self.n_a, self.n_b
        printed[np.arange(len(a)) + before_b[group_a]] = self._print_a[a + tail_a]
        printed[np.arange(len(b)) + before_a[group_b]] = self._print_b[b + tail_b]
        ends = n_a + n_b
        starts = np.r_[0, ends[:-1]]
        texts = ["".join(printed[s:e].tolist())[:-1] for s, e in zip(starts, ends)]
        return link, np.diff(groups, prepend=0), np.diff(n_a, prepend=0), np.diff(n_b, prepend=0), texts


@functools.cache
def aligner(path_a: str, path_b: str) -> Aligner:
    """One instance per worker and pair of files."""
    return Aligner(path_a, path_b)


def _some_texts(batches):
    """Lists of (id, text) of about ``SLICE`` characters."""
    held, chars = [], 0
    for b in with_slices(batches):
        for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            held.append(row)
            chars += len(row[1] or "")
            if chars >= SLICE or len(held) >= 4096:
                yield held
                held, chars = [], 0
    if held:
        yield held


def aligned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None,
            path_b: str | None = None) -> DataFrame:
    """One pass over the texts, written as a table. Rows of documents hold
    ``id, n_a, n_b, n_groups, groups, links`` (the link numbers as 32-bit
    integers); each task adds its link counts: rows ``a, n`` (its vector of
    one-to-one groups) and ``a, b, n`` (its other pairs)."""
    path_a, path_b = path_a or vocabulary("byte_bpe_50k.json"), path_b or vocabulary("piece_bpe_32k.model")
    names = ["id", "n_a", "n_b", "n_groups", "groups", "links", "a", "b", "n"]
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_a long, n_b long, n_groups long, groups string, links binary, a int, b int, n long"

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type
        id_type = to_arrow_type(docs_id_type)
        it = aligner(path_a, path_b)
        same, other = np.zeros(it.n_a, np.int64), np.zeros(len(it.pairs), np.int64)

        def table(columns, rows):
            full = {n: pa.nulls(rows, t) for n, t in (
                ("id", id_type), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                ("groups", pa.string()), ("links", pa.binary()), ("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64()))}
            return pa.RecordBatch.from_arrays([columns.get(n, full[n]) for n in names], names=names)

        for rows in _some_texts(batches):
            found = it.encode_all([t for _, t in rows])
            n_a, n_b, n_groups = (np.zeros(len(rows), np.int64) for _ in range(3))
            groups, links = [""] * len(rows), [b""] * len(rows)
            have = [i for i, x in enumerate(found) if x is not None]
            if have:
                a, b = (np.concatenate([found[i][side] for i in have]) for side in (0, 1))
                size = np.array([found[i][2] for i in have])
                link, n_groups[have], n_a[have], n_b[have], texts = it.align(a, b, size)
                same += np.bincount(link[link < it.n_a], minlength=it.n_a)
                other += np.bincount(link[link >= it.n_a] - it.n_a, minlength=len(it.pairs))
                ends = np.cumsum(n_groups[have])
                raw = link.astype("<i4").tobytes()
                for i, text, end, n in zip(have, texts, ends.tolist(), n_groups[have].tolist()):
                    groups[i], links[i] = text, raw[4 * (end - n):4 * end]
            yield table({"id": pa.array([r[0] for r in rows], id_type), "n_a": pa.array(n_a), "n_b": pa.array(n_b),
                         "n_groups": pa.array(n_groups), "links": pa.array(links, pa.binary()),
                         "groups": pa.array([sha256(g.encode()).hexdigest() if g else "" for g in groups])}, len(rows))
        at = np.flatnonzero(same)
        yield table({"a": pa.array(at.astype(np.int32)), "n": pa.array(same[at])}, len(at))
        at = np.flatnonzero(other)
        a, b = it.link_ids(at + it.n_a)
        yield table({"a": pa.array(a.astype(np.int32)), "b": pa.array(b.astype(np.int32)), "n": pa.array(other[at])}, len(at))

    docs_id_type, sha256 = docs.schema[id_col].dataType, hashlib.sha256
    return cut(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema),
               "aligned")


def pair_counts(rows: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """``(a, b, n)``: the corpus-wide links of :func:`aligned` rows. The tasks'
    vectors of one-to-one groups add up by A id; only pairs of other groups are
    shuffled as pairs."""
    path_a, path_b = path_a or vocabulary("byte_bpe_50k.json"), path_b or vocabulary("piece_bpe_32k.model")
    counts = rows.filter("n IS NOT NULL")
    plain = counts.filter("b IS NULL").groupBy("a").agg(F.sum("n").alias("n"))
    other = counts.filter("b IS NOT NULL").groupBy("a", "b").agg(F.sum("n").alias("n"))

    def named(batches):
        same = aligner(path_a, path_b).same
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(same[b.column(0).to_numpy()].astype(np.int32)), b.column(1)], names=["a", "b", "n"])
    return plain.mapInArrow(named, "a int, b int, n long").unionByName(other)


def align_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None,
                    path_b: str | None = None) -> DataFrame:
    """Per row: id, ``n_a, n_b`` (tokens), ``n_groups, n_links, n_best,
    count_sum, groups_sha256``.

    Null and empty texts, and texts whose tokens of a side don't join to the
    text's own bytes (B writes a blank as U+2581, so that character is lost),
    have no tokens: zeros and an empty string. Repeated rows and null ids count
    each. Only id and text are read, so other columns can't clash; an empty
    table gives no row. Texts are encoded once and never shuffled. What the
    driver sees are corpus-wide counts, one number a possible link: fewer than
    the bytes of both vocabularies' tokens, whatever the input.
    """
    path_a, path_b = path_a or vocabulary("byte_bpe_50k.json"), path_b or vocabulary("piece_bpe_32k.model")
    rows = aligned(docs, id_col, text_col, path_a, path_b)
    table = pair_counts(rows, path_a, path_b).toArrow()
    it = aligner(path_a, path_b)
    a, b, n = (table[c].to_numpy().astype(np.int64) for c in ("a", "b", "n"))
    count, top = np.zeros(it.n_links, np.int64), np.zeros(it.n_b, np.int64)
    link = it.link_of(a, b)
    count[link] = n
    np.maximum.at(top, b, n)
    best = np.zeros(it.n_links, bool)
    best[link] = n == top[b]
    shared = docs.sparkSession.sparkContext.broadcast((count, best))
    kind = docs.schema[id_col].dataType.simpleString()
    cols = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]

    def run(batches):
        count, best = shared.value
        for b in batches:
            links = b.column(4)
            link = np.frombuffer(b"".join(links.to_pylist()), "<i4")
            ends = np.cumsum(b.column(3).to_numpy())
            def total(x):
                run = np.r_[0, np.cumsum(x[link], dtype=np.int64)]
                return pa.array(np.diff(run[ends], prepend=0))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), b.column(3), b.column(3), total(best), total(count), b.column(5)],
                names=[id_col, *cols, "groups_sha256"])

    schema = f"`{id_col}` {kind}, " + ", ".join(f"{c} long" for c in cols) + ", groups_sha256 string"
    return rows.filter("n IS NULL").select("id", "n_a", "n_b", "n_groups", "links", "groups").mapInArrow(run, schema)
