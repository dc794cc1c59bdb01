"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased, every run of non-letters becomes one blank, and the
n-grams of 1 to ``ORDER`` characters hash into ``BUCKETS``. Training counts
buckets per language in Spark and writes the log-probability matrix in blocks of
languages, one file each. Scoring broadcasts the matrix (its first blocks, 64 MB
at most; further ones are read by the tasks, one after another), gathers the rows
of a batch's n-grams in numpy and sums them per document.
"""

from __future__ import annotations

import functools
import sys
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut, fs_of, map_batches, new_folder, with_slices
from tessera.operators.common import checked_side, with_row_id

ORDER = 3
BUCKETS = 1 << 16
#: Labelled documents used per language, on average: a bounded, hash-drawn sample.
TRAIN_DOCS = 8_000
CHUNK = 1 << 18  # characters handled at once
GROUP = 1 << 22  # characters of the texts whose code points are held at once
UNKNOWN = "und"
BLOCK_LANGS = 64  # languages of a block of the model: 16 MB
SHARED_BLOCKS = 4  # blocks that are broadcast
#: n-grams that count as independent evidence when a posterior is stated.
EVIDENCE = 64


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def _codes(text: str) -> np.ndarray:
    """Code points: letters lower-cased, each run of others one blank, one
    blank at each end. Empty if there is no letter."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    ok = _letters()[c]
    if not ok.any():
        return np.empty(0, np.uint32)
    c = np.where(ok, c, np.uint32(32))
    c = np.concatenate([[np.uint32(32)], c, [np.uint32(32)]])
    blank = c == 32
    return c[~(blank & np.r_[False, blank[:-1]])]


def buckets_of(codes: np.ndarray) -> np.ndarray:
    """Buckets of all n-grams of 1..ORDER characters of one code array."""
    out, h = [], np.zeros(len(codes), np.uint32)
    for n in range(ORDER):
        if len(codes) <= n:
            break
        h = h[:len(codes) - n] * np.uint32(0x01000193) + codes[n:] + np.uint32(n + 1)
        m = h * np.uint32(0x9E3779B1)
        m ^= m >> np.uint32(15)
        m *= np.uint32(0x85EBCA6B)
        out.append(m >> np.uint32(32 - BUCKETS.bit_length() + 1))
    return np.concatenate(out) if out else np.empty(0, np.uint32)


def _chunks(codes: np.ndarray):
    """Pieces of a long code array that together hold each n-gram once."""
    if len(codes) <= CHUNK:
        yield buckets_of(codes)
        return
    for a in range(0, len(codes), CHUNK):
        piece = codes[a:a + CHUNK + ORDER - 1]
        grams = buckets_of(piece)
        if len(piece) > CHUNK:  # drop the shorter n-grams that start in the next piece
            keep, at = [], 0
            for n in range(ORDER):
                size = len(piece) - n
                keep.append(grams[at:at + CHUNK])
                at += size
            grams = np.concatenate(keep)
        yield grams


class Block:
    """Log-probabilities of some languages, ``(BUCKETS, languages)`` float32:
    the array itself, or the file that holds it."""

    def __init__(self, langs: list[str], logp: np.ndarray | None = None, file: tuple[str, str] | None = None):
        self.langs, self.file = langs, file
        self._logp = None if logp is None else np.ascontiguousarray(logp, np.float32)

    def logp(self) -> np.ndarray:
        return self._logp if self.file is None else _loaded(*self.file, len(self.langs))


@functools.lru_cache(maxsize=2)
def _loaded(folder: str, name: str, langs: int) -> np.ndarray:
    fs, root = fs_of(folder)
    with fs.open_input_stream(f"{root}/{name}", compression=None) as f:
        return np.frombuffer(f.read(), np.float32).reshape(BUCKETS, langs)


class Model:
    """Blocks of at most ``BLOCK_LANGS`` languages, in name order. Texts are
    scored block by block, so a worker holds the broadcast ones and two more
    (16 MB each), whatever the number of languages."""

    def __init__(self, langs: list[str], logp: np.ndarray | None = None, blocks: list[Block] | None = None):
        self.langs = langs
        self.blocks = blocks if blocks is not None else [Block(langs, logp)] if langs else []

    @property
    def logp(self) -> np.ndarray:
        """The whole matrix, ``(BUCKETS, langs)``."""
        return np.concatenate([b.logp() for b in self.blocks], axis=1) if self.blocks else np.zeros((BUCKETS, 0), np.float32)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and its posterior for each text. The likelihood is the
        mean over the text's n-grams times ``EVIDENCE`` (n-grams of one text
        are far from independent, and a raw posterior would always be 0 or 1).
        Ties go to the first language in name order. Code points are held for a
        group of texts at a time, however long the texts of a slice are."""
        names, scores = [], []
        group = np.cumsum([len(t) if t else 0 for t in texts], dtype=np.int64) // GROUP
        starts = np.flatnonzero(np.diff(group, prepend=-1)).tolist()
        for lo, hi in zip(starts, [*starts[1:], len(texts)]):
            some = self._predict(texts[lo:hi])
            names += some[0]
            scores += some[1]
        return names, scores

    def _predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        codes = [_codes(t) if t else () for t in texts]
        best, top = [UNKNOWN] * len(texts), np.full(len(texts), -np.inf)
        mass = np.zeros(len(texts))  # sum of exp(z - top) over the languages so far
        for block in self.blocks:
            logp = block.logp()
            for i, c in enumerate(codes):
                if not len(c):
                    continue
                total, n = np.zeros(len(block.langs)), 0
                for grams in _chunks(c):
                    total += logp[grams].sum(0, dtype=np.float64)
                    n += len(grams)
                z = total * (min(n, EVIDENCE) / n)
                at = int(z.argmax())
                if z[at] > top[i]:
                    mass[i] *= np.exp(top[i] - z[at])
                    best[i], top[i] = block.langs[at], z[at]
                mass[i] += np.exp(z - top[i]).sum()
        return best, [1 / m if m else 0.0 for m in mass.tolist()]


def shared(spark, model: Model):
    """A function that gives the model inside tasks."""
    n = SHARED_BLOCKS
    first = spark.sparkContext.broadcast([(b.langs, b.logp()) for b in model.blocks[:n]])
    rest, langs = model.blocks[n:], model.langs
    return lambda: Model(langs, blocks=[Block(*b) for b in first.value] + rest)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          train_docs: int = TRAIN_DOCS) -> Model:
    """Fit on labelled rows (null languages and texts don't count), every
    language. About ``train_docs`` documents per language take part, drawn by a
    hash of the id (and text, for rows that share an id); all, if a language has
    fewer. Counts add up by (language, bucket) in Spark; each block of languages
    becomes one file, written by the task that holds its counts. The driver sees
    the names of the languages and of the files."""
    labelled = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col), F.col(text_col).alias("_text"), F.col(lang_col).cast("string").alias("_l"))
    sizes = cut(labelled.groupBy("_l").agg(F.count(F.lit(1)).alias("n")), "languages")
    numbered = cut(with_row_id(sizes, ["_l"], "no").select(
        "_l", F.col("no").cast("int").alias("no"),
        F.least(F.lit(1 << 30), F.floor(F.lit(float(train_docs) * (1 << 30)) / F.col("n"))).cast("long").alias("draw")), "draws")
    langs = [r["_l"] for r in numbered.orderBy("no").collect()]
    if not langs:
        return Model([])
    hit = F.pmod(F.xxhash64(id_col, F.length("_text")), F.lit(1 << 30)) < F.col("draw")
    sample = labelled.join(checked_side(numbered.withColumnRenamed("_l", "_n")), F.col("_l") == F.col("_n")).filter(hit)

    def count(batches):
        held = {}  # at most BLOCK_LANGS arrays; a further language sends what there is
        for b in with_slices(batches):
            for no, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if no not in held:
                    if len(held) >= BLOCK_LANGS:
                        yield counted(held)
                        held = {}
                    held[no] = np.zeros(BUCKETS, np.int64)
                for grams in _chunks(_codes(t)):
                    held[no] += np.bincount(grams, minlength=BUCKETS)
        if held:
            yield counted(held)

    def counted(held):
        lang = np.array(list(held), np.int32)
        at, bucket = np.nonzero(np.stack(list(held.values())))
        n = np.stack(list(held.values()))[at, bucket]
        return pa.RecordBatch.from_arrays([pa.array(lang[at]), pa.array(bucket.astype(np.int32)), pa.array(n)],
                                          names=["lang", "bucket", "n"])

    counts = sample.select("no", "_text").mapInArrow(count, "lang int, bucket int, n long").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n"))
    folder, total = new_folder(docs.sparkSession, "language-model"), len(langs)

    def write(batches):
        fs, root = fs_of(folder)
        held, block = None, None

        def done():
            logp = np.log(held + 0.5) - np.log(held.sum(0) + 0.5 * BUCKETS)
            name = f"block-{block:06d}-{uuid.uuid4().hex[:12]}"
            with fs.open_output_stream(f"{root}/{name}", compression=None) as f:
                f.write(np.ascontiguousarray(logp, np.float32).tobytes())
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([name])], names=["block", "file"])
        for b in batches:
            lang, bucket, n = (b.column(i).to_numpy() for i in range(3))
            of = lang // BLOCK_LANGS
            for k in np.unique(of).tolist():  # sorted by language, so blocks follow one another
                if k != block:
                    if block is not None:
                        yield done()
                    block, held = k, np.zeros((BUCKETS, min(BLOCK_LANGS, total - k * BLOCK_LANGS)))
                mine = of == k
                held[bucket[mine], lang[mine] - k * BLOCK_LANGS] += n[mine]
        if block is not None:
            yield done()

    # every language counts, also one without a letter
    every = numbered.select(F.col("no").alias("lang"), F.lit(0).alias("bucket"), F.lit(0).cast("long").alias("n"))
    of = F.floor(F.col("lang") / BLOCK_LANGS)
    dealt = counts.unionByName(every).repartition(of).sortWithinPartitions("lang")
    files = cut(dealt.mapInArrow(write, "block int, file string"), "model-files").collect()
    names = {r["block"]: r["file"] for r in files}
    return Model(langs, blocks=[Block(langs[k * BLOCK_LANGS:(k + 1) * BLOCK_LANGS], file=(folder, names[k]))
                                for k in sorted(names)])


def held_out(id_col: str = "doc_id"):
    """Column: the document is kept out of training."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``held_out``, ``lang_pred``, ``score``.

    Null, empty and letterless texts: ``und`` with score 0. Repeated rows and
    null ids are scored like any row; only id and text are read, so other
    columns can't clash; an empty table gives no row. No shuffle.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    load = shared(docs.sparkSession, model)

    def run(batches):
        m = load()
        for b in with_slices(batches):
            names, scores = m.predict(b.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(names, pa.string()),
                                              pa.array(scores, pa.float64())],
                                             names=[id_col, "held_out", "lang_pred", "score"])

    return docs.select(F.col(id_col), held_out(id_col).alias("held_out"), F.col(text_col)).mapInArrow(
        run, f"`{id_col}` {kind}, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all their columns) whose text has a language with
    a score of at least ``least``; one pass, no shuffle."""
    at = docs.columns.index(text_col)
    load = shared(docs.sparkSession, model)

    def run(batches):
        m = load()
        for b in with_slices(batches):
            names, scores = m.predict(b.column(at).to_pylist())
            yield b.filter(pa.array([n != UNKNOWN and s >= least for n, s in zip(names, scores)], pa.bool_()))

    return map_batches(docs, run)
