"""Sharding by fixed virtual slots.

Records hash into a fixed number of slots (thousands, never changed); only the
slot-to-shard map is edited. Bytes are aggregated per slot, so the map is
edited from a table of at most ``slots`` rows, whatever the input's size. Each
edit is stored as a new version, and older versions stay readable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import cut, hot_lookup

SLOTS = 4096
MAP_SCHEMA = "version int, slot int, shard int"


def key_of(*cols):
    """Hash of a record's key columns (nulls hash like any value)."""
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in cols])


def slot_of(*cols, slots: int = SLOTS):
    """Slot number of a record by its key columns."""
    return F.pmod(key_of(*cols), F.lit(slots)).cast("int")


def slot_bytes(records: DataFrame, slot: str = "vslot", size: str = "size") -> dict[int, int]:
    """Bytes per slot: one row per slot reaches the driver, ``SLOTS`` at most."""
    rows = records.groupBy(slot).agg(F.sum(size).alias("b")).collect()
    return {r[slot]: int(r["b"] or 0) for r in rows}


def first_map(shards: int, slots: int = SLOTS) -> list[int]:
    """Version 0: contiguous runs of slots, as many for each shard."""
    return [s * shards // slots for s in range(slots)]


def rebalanced(shard_of: list[int], weight: dict[int, int], shards: int) -> list[int]:
    """The map edited until no move of one slot from the fullest to the
    emptiest shard narrows their gap: each edit moves the largest slot that
    fits half the gap (else the smallest that is less than the gap)."""
    import bisect
    out = list(shard_of)
    held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for s, k in enumerate(out):
        if weight.get(s, 0):
            held[k].append((weight[s], s))
    for h in held:
        h.sort()
    load = [sum(w for w, _ in h) for h in held]
    while True:
        hi = max(range(shards), key=lambda k: (load[k], -k))
        lo = min(range(shards), key=lambda k: (load[k], k))
        gap = load[hi] - load[lo]
        i = bisect.bisect_right(held[hi], (gap // 2, len(out))) - 1
        if i < 0:
            i = 0
        if not held[hi] or held[hi][i][0] >= gap:
            break
        w, s = held[hi].pop(i)
        bisect.insort(held[lo], (w, s))
        out[s], load[hi], load[lo] = lo, load[hi] - w, load[lo] + w
    # single moves end in a local optimum; swaps of two slots close the rest
    for _ in range(len(out)):
        hi = max(range(shards), key=lambda k: (load[k], -k))
        lo = min(range(shards), key=lambda k: (load[k], k))
        gap, best = load[hi] - load[lo], None
        for w, s in held[hi]:
            j = bisect.bisect_left(held[lo], (w - gap // 2, -1))
            for c in (j - 1, j):
                if 0 <= c < len(held[lo]):
                    d = w - held[lo][c][0]
                    if 0 < d < gap and (best is None or abs(gap - 2 * d) < best[0]):
                        best = (abs(gap - 2 * d), (w, s), held[lo][c])
        if best is None:
            break
        _, a, b = best
        held[hi].remove(a), held[lo].remove(b)
        bisect.insort(held[lo], a), bisect.insort(held[hi], b)
        out[a[1]], out[b[1]] = lo, hi
        load[hi], load[lo] = load[hi] - a[0] + b[0], load[lo] + a[0] - b[0]
    return out


def grown(shard_of: list[int], weight: dict[int, int], shards: int) -> list[int]:
    """The map with one more shard: slots move into the new shard only, from
    the fullest shards, until it holds its share."""
    out, total = list(shard_of), sum(weight.values())
    held = [sorted((weight.get(s, 0), s) for s, k in enumerate(out) if k == j) for j in range(shards)]
    load, got, share = [sum(w for w, _ in h) for h in held], 0, total / (shards + 1)
    while True:
        hi = max(range(shards), key=lambda k: (load[k], -k))
        fits = [x for x in held[hi] if 0 < x[0] <= share - got]
        if not fits or load[hi] <= share:
            return out
        w, s = fits[-1]
        held[hi].remove((w, s))
        out[s], load[hi], got = shards, load[hi] - w, got + w


def store_map(spark: SparkSession, path: str, version: int, shard_of: list[int]) -> None:
    """Write one version of the map; a repeated write of a version replaces it."""
    rows = [(s, k) for s, k in enumerate(shard_of)]
    spark.createDataFrame(rows, "slot int, shard int").coalesce(1).write.mode("overwrite").parquet(
        f"{path}/version={version}")


def load_map(spark: SparkSession, path: str, version: int | None = None) -> list[int]:
    """A version of the stored map (the newest by default)."""
    df = spark.read.schema(MAP_SCHEMA).parquet(path)
    if version is None:
        version = df.agg(F.max("version")).first()[0]
    rows = df.filter(F.col("version") == version).select("slot", "shard").collect()
    return [r["shard"] for r in sorted(rows, key=lambda r: r["slot"])]


def assign(records: DataFrame, shard_of: list[int], slot: str = "vslot", name: str = "shard") -> DataFrame:
    """Shard of each record by its slot: an array literal of ``SLOTS`` entries,
    no join."""
    table = F.lit(shard_of).cast("array<int>")
    return records.withColumn(name, F.element_at(table, F.col(slot) + 1))


def with_position(records: DataFrame, shard_of: list[int], order: list[str], slot: str = "vslot",
                  name: str = "slot") -> DataFrame:
    """Gapless position from 0 of each record within its shard. A record's
    position is its slot's offset plus its rank in the slot, so the ranking
    works on slots (thousands of groups), never on whole shards."""
    rows = {r[slot]: r["n"] for r in records.groupBy(slot).agg(F.count(F.lit(1)).alias("n")).collect()}
    offset, seen = [], {}
    for s, k in enumerate(shard_of):
        offset.append(seen.get(k, 0))
        seen[k] = seen.get(k, 0) + rows.get(s, 0)
    w = Window.partitionBy(slot).orderBy(*order)
    start = F.element_at(F.lit(offset).cast("array<bigint>"), F.col(slot) + 1)
    return records.withColumn(name, start + F.row_number().over(w) - 1)


def shard_documents(docs: DataFrame, map_path: str, shards: int = 8, slots: int = SLOTS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Documents in ``shards`` shards of near equal bytes (law ``bytes``).

    Size: UTF-8 bytes of the text (null: none) plus 1. Slot: hash of id and
    text, so rows that share an id but not the text spread too; rows equal in
    both are told apart by their position in the table, so any number of them
    spreads. Groups of equal texts are not kept together: a group may exceed a
    shard. Version 0 of the map under ``map_path`` deals the
    slots evenly, version 1 is edited from the measured bytes. Columns beyond
    id and text are not read (none can clash); nulls, empty texts and empty
    tables need no special case. Only narrow rows (no text) are shuffled.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rec = docs.select(F.col(id_col), (F.octet_length(text) + 1).cast("long").alias("size"),
                      F.crc32(text.cast("binary")).alias("text_crc32"),
                      key_of(id_col, text_col).alias("_key"), F.monotonically_increasing_id().alias("_at"))
    rec = cut(rec, "records")
    again = rec.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").withColumn("_again", F.lit(True))
    rec = hot_lookup(rec, again, "_key", "_n", rec.count(), F.col("_at"))
    place = F.when(F.col("_again"), F.xxhash64("_key", "_at")).otherwise(F.col("_key"))
    rec = cut(rec.withColumn("vslot", F.pmod(place, F.lit(slots)).cast("int")).drop("_key", "_at", "_again"), "slots")
    weight = slot_bytes(rec)
    spark = docs.sparkSession
    store_map(spark, map_path, 0, first_map(shards, slots))
    store_map(spark, map_path, 1, rebalanced(load_map(spark, map_path, 0), weight, shards))
    shard_of = load_map(spark, map_path)
    out = with_position(assign(rec, shard_of), shard_of, [id_col, "text_crc32", "size"])
    return out.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))
