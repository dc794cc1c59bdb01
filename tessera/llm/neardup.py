"""Near-duplicate documents: one-permutation MinHash with optimal densification.

1. Each text becomes its set of word-shingle hashes (64 bit); texts with equal
   sets are one class with a number of its own, stated as its smallest doc_id.
2. Each class gets a one-permutation sketch: the hash range is cut into
   ``BINS``, each bin keeps its smallest hash; an empty bin copies a filled one
   chosen by a fixed random order of its own (optimal densification).
3. Bands of ``ROWS`` bins make bucket keys. In a bucket, candidates are a star:
   the centre (the class that meets most others) and each other member. So
   candidates are at most as many as bucket memberships.
4. Stars are confirmed on full sets. Members that are not linked with their
   centre are then compared, inside blocks and on full sets, with all members
   of the star, so a link between two spokes is not lost; only links leave a
   block, and only those that join two groups.
5. Connected components over links: min-label propagation with pointer
   jumping, each round written to shared storage.

With similarity 0.8, 40 bands of 6 rows miss a pair with probability 5e-6.
"""

from __future__ import annotations

import functools
import hashlib
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut, hot_lookup, with_slices

BANDS, ROWS = 40, 6
BINS = BANDS * ROWS
CHUNK = 512  # sets held at once in a task
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_S = np.uint64(33)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S)) * _M1
    x = (x ^ (x >> _S)) * _M2
    return x ^ (x >> _S)


class Shingler:
    """Sorted distinct 64-bit hashes of a text's word shingles. A-Z are
    lower-cased; words are runs of non-white-space. A text with fewer words
    than a shingle is one shingle, the whole word sequence; without words the
    set is empty."""

    WORDS = 250_000

    def __init__(self, words: int):
        self.words = words
        self._hash: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        w = text.encode().lower().split() if text else []
        if not w:
            return np.empty(0, np.uint64)
        known = self._hash
        if len(known) > self.WORDS:
            known.clear()
        for x in set(w).difference(known):
            known[x] = xxhash.xxh64_intdigest(x)
        h = np.fromiter(map(known.__getitem__, w), np.uint64, len(w))
        k = min(self.words, len(h))
        n = len(h) - k + 1
        out = np.full(n, k, np.uint64)
        for i in range(k):
            out = _mix(out * _STEP + h[i:i + n])
        return np.unique(out)


@functools.cache
def _shingler(words: int) -> Shingler:
    return Shingler(words)


@functools.cache
def _edges(bins: int) -> np.ndarray:
    return np.array([(i << 64) // bins for i in range(bins)], np.uint64)


@functools.cache
def _donor_order(bins: int) -> np.ndarray:
    """For each bin, a random order of all bins (fixed by a seed): an empty
    bin copies the first filled one in its order."""
    return np.random.default_rng(20240229).permuted(
        np.tile(np.arange(bins, dtype=np.uint16), (bins, 1)), axis=1)


def sketch(shingles: np.ndarray, bins: int = BINS) -> np.ndarray:
    """One-permutation MinHash of a non-empty sorted hash set."""
    at = np.searchsorted(shingles, _edges(bins))
    filled = at < np.r_[at[1:], len(shingles)]
    out = np.zeros(bins, np.uint64)
    out[filled] = shingles[at[filled]]
    if not filled.all():
        empty, full = np.flatnonzero(~filled), np.flatnonzero(filled)
        order = _donor_order(bins)
        out[empty] = out[full[order[np.ix_(empty, full)].argmin(1)]]
    return out


def band_keys(sk: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band, different bands never sharing a key space."""
    m = sk.reshape(bands, rows)
    key = np.arange(1, bands + 1, dtype=np.uint64) * _STEP
    for i in range(rows):
        key = _mix(key * _STEP + m[:, i])
    return key.view(np.int64)


def sketches(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """Per row: ``doc_id``, ``text_hash``, ``n_shingles``, ``cls`` (hash of the
    set, null if empty) and ``keys``. One pass over the texts; nothing wide leaves it."""
    def run(batches):
        of = _shingler(words)
        for b in with_slices(batches, 512):
            n, cls, keys = [], [], []
            for text in b.column(1).to_pylist():
                s = of(text)
                n.append(len(s))
                cls.append(hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else None)
                keys.append(band_keys(sketch(s)) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array(cls, pa.string()),
                 pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "text_hash", "n_shingles", "cls", "keys"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col), F.xxhash64(text_col)).mapInArrow(
        run, "doc_id long, text_hash long, n_shingles long, cls string, keys array<long>")


def star_edges(classes: DataFrame) -> DataFrame:
    """Distinct ``(hub, spoke)`` of all buckets of two or more classes.
    ``classes``: ``rep`` (the class's number), ``keys``. Buckets are counted with
    partial aggregation; a bucket's centre is the class with the largest sum of
    bucket sizes (ties: smaller id). Pairs whose set sizes alone rule out the
    similarity are left to the block comparison of their star."""
    member = classes.select("rep", F.explode("keys").alias("key"))
    buckets = member.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    total = classes.count() * BANDS
    member = cut(hot_lookup(member, buckets.withColumn("size", F.col("m")), "key", "m", total, F.col("rep"))
                 .filter("size is not null"), "members")
    weight = member.groupBy("rep").agg(F.sum("size").alias("w"))
    member = cut(member.join(weight, "rep").select("key", "rep", "w", "size"), "weighted")
    hubs = member.groupBy("key").agg(F.max(F.struct("w", (-F.col("rep")).alias("r"))).alias("h"),
                                     F.count(F.lit(1)).alias("m"))
    hubs = hubs.select("key", "m", (-F.col("h.r")).alias("hub"))
    out = hot_lookup(member.select("key", "rep"), hubs, "key", "m", total, F.col("rep"))
    return out.select("hub", F.col("rep").alias("spoke")).distinct().filter("hub != spoke")


class Postings:
    """Sets of a block, inverted: exact intersection sizes of one set with all
    of them by one lookup and one count."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets], np.int64)
        flat = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), self.size)
        order = np.argsort(flat, kind="stable")
        flat, self.owner = flat[order], owner[order]
        self.first = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
        self.value = flat[self.first]
        self.first = np.r_[self.first, len(flat)]

    def shared(self, s: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.value, s), len(self.value) - 1)
        at = at[self.value[at] == s]
        a, n = self.first[at], self.first[at + 1] - self.first[at]
        step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        return np.bincount(self.owner[np.repeat(a, n) + step], minlength=len(self.size))

    def linked(self, s: np.ndarray, percent: int) -> np.ndarray:
        both = self.shared(s)
        return 100 * both >= percent * (self.size + len(s) - both)


def joining_links(ids: np.ndarray, first: list[int], sets: list[np.ndarray], others: list[int],
                  group: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links between ``first`` and ``others`` (positions) that join two groups;
    ``group`` is the groups known so far and is updated. A member whose group
    holds all others already is not compared."""
    if not first or not others:
        return []
    post, at, out = Postings([sets[i] for i in others]), np.array(others), []
    for i in first:
        if (group[at] == group[i]).all():
            continue
        for j in at[post.linked(sets[i], percent)].tolist():
            if group[i] != group[j]:
                out.append((int(ids[i]), int(ids[j])))
                group[group == group[j]] = group[i]
    return out


LINK = "a long, b long"
_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    a = np.array(links, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], schema=_LINKS)


def _grouped(batches, *key):
    """(key, rows) of sorted rows; the rows of a block are few by design."""
    def rows():
        for b in with_slices(batches, 256):
            yield from b.to_pylist()
    for k, group in groupby(rows(), key=lambda r: tuple(r[c] for c in key)):
        yield k, list(group)


def _set_of(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint64)


def confirm(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of all star edges, and of the pairs of one star that no link to
    the centre explains. ``sets``: ``rep``, ``shingles``."""
    edges = cut(edges, "edges")
    stars = cut(edges.groupBy("hub").agg(F.count(F.lit(1)).alias("m")), "stars")
    # a star goes to chunks of about CHUNK members; its centre to each of them
    chunk = F.pmod(F.xxhash64("spoke"), F.ceil(F.col("m") / CHUNK)).cast("int")
    spokes = hot_lookup(edges, stars.withColumn("size", F.col("m")), "hub", "m", edges.count(), F.col("spoke"))
    spokes = spokes.withColumn("m", F.col("size")).withColumn("chunk", chunk).select("hub", "chunk", "m", F.col("spoke").alias("rep"))
    centres = stars.select("hub", F.explode(F.sequence(F.lit(0), (F.ceil(F.col("m") / CHUNK) - 1).cast("int"))).alias("chunk"),
                           "m", F.col("hub").alias("rep"))
    rows = spokes.unionByName(centres).join(sets, "rep")
    order = ["hub", "chunk", "rep"]

    def star(batches):
        for (hub, _), group in _grouped(batches, "hub", "chunk"):
            m = group[0]["m"]
            ids = np.array([r["rep"] for r in group], np.int64)
            have = [_set_of(r["shingles"]) for r in group]
            centre = [i for i, r in enumerate(group) if r["rep"] == hub]
            rest = [i for i, r in enumerate(group) if r["rep"] != hub]
            mark = np.arange(len(ids))
            links = joining_links(ids, centre, have, rest, mark, percent)
            if m <= CHUNK:  # the whole star is here: compare what is not joined yet
                loose = [i for i in rest if mark[i] != mark[centre[0]]]
                links += joining_links(ids, loose, have, rest, mark, percent)
            yield _batch(links)

    dealt = rows.repartition(F.col("hub"), F.col("chunk")).sortWithinPartitions(*order)
    links = cut(dealt.select(*order, "m", "shingles").mapInArrow(star, LINK), "links")

    # Large stars: spokes not linked with the centre against all members, in
    # blocks of pairs of chunks.
    large = stars.filter(F.col("m") > CHUNK).select("hub", "m")
    joined = links.select(F.col("a").alias("hub"), F.col("b").alias("rep"), F.lit(1).alias("joined"))
    member = spokes.join(large.select("hub"), "hub", "left_semi").join(joined, ["hub", "rep"], "left")
    member = cut(member.select("hub", "rep", "chunk", "joined"), "large-stars")
    loose = member.filter(F.col("joined").isNull())
    n_chunks = large.select("hub", F.ceil(F.col("m") / CHUNK).cast("int").alias("chunks"))
    n_loose = loose.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("blocks"))
    plan = cut(n_chunks.join(n_loose, "hub"), "plan")  # one row per large star
    left = loose.join(plan, "hub").select(
        "hub", F.pmod(F.xxhash64("rep", F.lit(1)), F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(0).alias("side"), "rep", "joined")
    right = member.join(plan, "hub").select(
        "hub", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "chunk", F.lit(1).alias("side"),
        "rep", "joined")
    pairs = left.unionByName(right).join(sets, "rep")

    def block(batches):
        for (hub, _, _), group in _grouped(batches, "hub", "block", "chunk"):
            ids = np.array([r["rep"] for r in group], np.int64)
            have = [_set_of(r["shingles"]) for r in group]
            mark = np.where([r["joined"] is not None for r in group], -1, ids)  # -1: the centre's group
            lhs = [i for i, r in enumerate(group) if r["side"] == 0]
            rhs = [i for i, r in enumerate(group) if r["side"] == 1]
            yield _batch(joining_links(ids, lhs, have, rhs, mark, percent))

    dealt = pairs.repartition(F.col("hub"), F.col("block"), F.col("chunk")).sortWithinPartitions(
        "hub", "block", "chunk", "side", "rep")
    more = dealt.select("hub", "block", "chunk", "side", "rep", "joined", "shingles").mapInArrow(block, LINK)
    return links.unionByName(more)


def shingle_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """``(rep, shingles)`` of the wanted classes: ``rep`` (the class's number),
    ``cls``, and ``doc_id`` and ``text_hash`` of one of its rows."""
    def run(batches):
        of = _shingler(words)
        for b in with_slices(batches, 512):
            rep, cls, out = [], b.column(2).to_pylist(), []
            for i, (c, text) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                raw = of(text).tobytes()
                if hashlib.blake2b(raw, digest_size=16).hexdigest() == cls[i]:  # another text may share id and hash
                    rep.append(c)
                    out.append(raw)
            yield pa.RecordBatch.from_arrays([pa.array(rep, pa.int64()), pa.array(out, pa.binary())],
                                             names=["rep", "shingles"])

    # the wanted ids grow with the corpus: one plan at every size, no broadcast
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                       F.col(text_col).alias("_text")).join(wanted.hint("shuffle_hash"), ["doc_id", "text_hash"])
    return rows.select("rep", "_text", "cls").mapInArrow(run, "rep long, shingles binary").dropDuplicates(["rep"])


def components(links: DataFrame) -> DataFrame:
    """``(node, label)`` for all nodes with links; the label is the smallest
    node reachable. Each round takes the smallest label among a node and its
    neighbours, then the label of that label; it ends when nothing changes."""
    links = links.filter("a != b")
    both = cut(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "graph")
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("node")).agg(
            F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        new = step.join(jump, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("up", "label")).alias("label"))
        new = cut(new, "labels")
        changed = new.filter("old != label").limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels


def _linked_classes(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int):
    """``rows`` of :func:`sketches`; ``classes``, one row per set: ``node`` (its
    number), ``cls``, ``rep`` and ``text_hash`` (its first row), ``copies``; and
    the ``links`` between their numbers."""
    rows = cut(sketches(docs, id_col, text_col, words), "sketches")
    known = rows.filter(F.col("doc_id").isNotNull() & F.col("cls").isNotNull())
    classes = known.groupBy("cls").agg(F.min(F.struct("doc_id", "text_hash")).alias("_f"),
                                       F.count(F.lit(1)).alias("copies"))
    classes = cut(classes.select("cls", F.col("_f.doc_id").alias("rep"), F.col("_f.text_hash").alias("text_hash"), "copies",
                                 F.monotonically_increasing_id().alias("node")), "classes")
    first = classes.select("cls", F.col("rep").alias("doc_id"), "text_hash", "node")
    keys = known.join(first, ["cls", "doc_id", "text_hash"]).dropDuplicates(["cls"])
    keys = cut(keys.select("cls", "doc_id", "text_hash", F.col("node").alias("rep"), "keys"), "keys")
    edges = cut(star_edges(keys), "stars")
    ends = edges.select(F.col("hub").alias("rep")).union(edges.select("spoke")).distinct()
    wanted = keys.select("rep", "cls", "doc_id", "text_hash").join(ends, "rep", "left_semi")
    sets = cut(shingle_sets(docs, wanted, id_col, text_col, words), "sets")
    return rows, classes, cut(confirm(edges, sets, percent), "class-links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                    percent: int = 80) -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    Documents are linked if ``100 * |A and B| >= percent * |A or B|`` for their
    shingle sets, confirmed on full sets. Null, empty and wordless texts have
    an empty set and are linked with nothing. Rows that share a doc_id are one
    node of the graph, each with its own set; rows without a doc_id have no
    node: component null, kept true. Only id and text are read, so other
    columns can't clash; an empty table gives no row.
    """
    rows, classes, links = _linked_classes(docs, id_col, text_col, words, percent)
    known = rows.filter(F.col("doc_id").isNotNull() & F.col("cls").isNotNull())
    for end in ("a", "b"):  # from classes to documents
        links = links.join(classes.select(F.col("node").alias(end), F.col("rep").alias(f"_{end}")), end)
    links = cut(links.select(F.col("_a").alias("a"), F.col("_b").alias("b")), "links")
    # a document of a class of several is linked with its representative
    copies = hot_lookup(known.select("doc_id", "cls"), classes.select("cls", "rep", "copies").filter("copies > 1"), "cls",
                        "copies", known.count(), F.col("doc_id"))
    copies = copies.filter(F.col("rep").isNotNull() & (F.col("rep") != F.col("doc_id"))).select(
        F.col("rep").alias("a"), F.col("doc_id").alias("b")).distinct()
    labels = components(links)
    # copies hang on their representatives; ids whose rows have several sets join them
    hung = copies.join(labels, F.col("a") == F.col("node"), "left").select(
        F.col("b").alias("node"), F.coalesce("label", "a").alias("label"))
    several = labels.select("node").join(copies.select(F.col("b").alias("node")), "node", "left_semi").limit(1).count()
    twice = copies.groupBy("b").agg(F.countDistinct("a").alias("n")).filter("n > 1").limit(1).count()
    shared = rows.filter(F.col("cls").isNotNull()).groupBy("doc_id").agg(F.min("cls").alias("x"), F.max("cls").alias("y"))
    if several or twice or shared.filter("x != y").limit(1).count():
        labels = components(links.unionByName(copies))
    else:
        labels = labels.unionByName(hung)
    out = rows.select("doc_id", "n_shingles").join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("label", "doc_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
             percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """``gone``: ``(doc_id, text_hash)`` (``xxhash64`` of the text) of all texts
    but the first of each group of linked texts, and ``copies``: the rows'
    ``doc_id`` and ``text_hash``. Texts are judged one by one here, also those
    that share a doc_id; the first one has the smallest doc_id, then the
    smallest hashes of its set and text. Rows without a doc_id are in no group.
    """
    rows, classes, links = _linked_classes(docs, id_col, text_col, words, percent)
    labels = components(links)
    group = classes.join(labels, "node", "left").select(F.coalesce("label", "node").alias("_g"), "rep", "cls", "text_hash")
    first = group.groupBy("_g").agg(F.min(F.struct("rep", "cls", "text_hash")).alias("_f"))
    first = first.select(F.col("_f.rep").alias("doc_id"), F.col("_f.text_hash").alias("text_hash"))
    known = rows.filter(F.col("doc_id").isNotNull() & F.col("cls").isNotNull()).select("doc_id", "text_hash").distinct()
    gone = known.join(first.hint("shuffle_hash"), ["doc_id", "text_hash"], "left_anti")
    return gone, rows.select("doc_id", "text_hash")
