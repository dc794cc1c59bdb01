"""Operators 2, 4 and 8: vectors, shards, archives."""

import base64
import hashlib
import io
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import common, mips, queries, slots, warc
from tessera.llm.common import hot_lookup, new_folder

from llm_cases import SF_CHECK, SF_SMALL, edge_docs, edge_rows, no_docs  # noqa: F401

# ------------------------------------------------------------ operator 2 --


def brute_top(rows, is_query, k=5):
    vecs = {i: np.floor(256 * np.array(v, np.float64)).astype(np.int64) for i, v in rows}
    ids = np.array(sorted(vecs))
    m = np.stack([vecs[i] for i in ids])
    out = {}
    for q in ids[[is_query(i) for i in ids]]:
        s = m @ vecs[q]
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
        out[int(q)] = [(r + 1, int(ids[j]), int(s[j])) for r, j in enumerate(order)]
    return out


def found(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(v) for q, v in out.items()}


def test_op2_query_equals_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_CHECK}/embeddings.parquet").collect()]
    assert found(queries.op2_exact_topk(spark, SF_CHECK)) == brute_top(rows, lambda i: i % 50 == 0)


def test_topk_many_blocks_ties_and_odd_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=12) * rng.choice([0.1, 1, 3])).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[3][1]) for i in range(100)]  # a third of all rows is one vector
    rows += [(2000, [0.0] * 12)]
    odd = [(3000, None), (3001, [None] * 12), (3002, [float("nan")] * 12), (3003, [float("inf")] * 12),
           (3004, [1.0, 2.0]), (3005, []), (None, rows[0][1]), rows[5], rows[5]]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    got = found(mips.top_k(df.repartition(5), F.col("vec_id") % 7 == 0, block=64, query_block=16))
    assert got == brute_top(rows, lambda i: i % 7 == 0)
    # fewer candidates than k
    few = spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>")
    assert found(mips.top_k(few, F.col("vec_id") == 0)) == brute_top(rows[:3], lambda i: i == 0)
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert mips.top_k(none, F.col("vec_id") == 0).count() == 0
    assert mips.top_k(few, F.col("vec_id") == 99).count() == 0


def test_topk_takes_every_vector_of_an_id_and_every_dimension(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.5, 0.0]), (2, [3.0, 0.0]), (2, [3.0, 0.0]), (3, [2.0, 0.0]), (3, [1.0, 1.0]),
            (4, [1.0, 0.0, 0.0]), (5, [0.0, 1.0, 0.0]), (5, [2.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = found(mips.top_k(df.repartition(3), F.col("vec_id").isin(1, 4), k=3, scale=1, block=2))
    assert got == {1: [(1, 2, 3), (2, 3, 2), (3, 3, 1)], 4: [(1, 5, 2), (2, 5, 0)]}


def test_topk_of_huge_vectors_raises_or_is_exact(spark):
    big = spark.createDataFrame([(0, [3e9, 0.0]), (1, [3e9, 0.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="64 bits"):
        mips.top_k(big, F.col("vec_id") == 0)
    huge = spark.createDataFrame([(0, [1e300, 0.0]), (1, [1e300, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="64 bits"):
        mips.top_k(huge, F.col("vec_id") == 0)
    x = 2.0 ** 30 / 256  # length 2^30: scores of 2^60
    edge = spark.createDataFrame([(0, [x, 0.0]), (1, [x, 0.0]), (2, [-x, 0.0]), (3, [0.0, x])], "vec_id long, embedding array<double>")
    assert found(mips.top_k(edge, F.col("vec_id") == 0)) == {0: [(1, 1, 1 << 60), (2, 3, 0), (3, 2, -(1 << 60))]}


def test_topk_plans_no_keyless_join(spark):
    df = queries.op2_exact_topk(spark, SF_SMALL)
    assert "NestedLoop" not in df._jdf.queryExecution().executedPlan().toString()


def test_pruning_skips_but_keeps_the_best():
    rng = np.random.default_rng(3)
    items = np.floor(rng.normal(size=(3000, 16)) * np.geomspace(400, 1, 3000)[:, None]).astype(np.int64)
    items = items[np.argsort(-(items.astype(float) ** 2).sum(1))]
    q = items[::100].copy()
    basis = np.linalg.svd(items.astype(float), full_matrices=False)[2].T
    qi, vid, score, low = mips.best_of(np.arange(0, 3000, 100), q, np.arange(3000), items, basis, 5)
    want = q @ items.T
    want[np.arange(len(q)), np.arange(0, 3000, 100)] = -2 ** 62
    for i in range(len(q)):
        order = np.lexsort((np.arange(3000), -want[i]))[:5]
        assert sorted(zip((-score[qi == i]).tolist(), vid[qi == i].tolist())) == [(-want[i, j], j) for j in order]
        assert low[i] == want[i, order[-1]]


# ------------------------------------------------------------ operator 4 --

def test_op4_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()}
    rows = queries.op4_virtual_slots(spark, SF_CHECK).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    load, at, slot_shard = Counter(), defaultdict(list), {}
    for r in rows:
        raw = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        load[r["shard"]] += r["size"]
        at[r["shard"]].append(r["slot"])
        assert slot_shard.setdefault(r["virtual_slot"], r["shard"]) == r["shard"]
    assert set(load) == set(range(8))
    for s in at.values():
        assert sorted(s) == list(range(len(s)))
    assert max(load.values()) - min(load.values()) <= 0.01 * sum(load.values()) / 8


def test_equal_rows_spread_over_shards(spark):
    rows = [(None, "one text " * 5)] * 1500 + [(i, f"t{i} " * 9) for i in range(1000)] + [(7, "again")] * 500
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    out = slots.shard_documents(df, new_folder(spark, "slot-map")).collect()
    size, at = Counter(), defaultdict(set)
    for r in out:
        size[r["shard"]] += r["size"]
        at[r["shard"]].add(r["slot"])
    assert len(out) == len(rows) and max(size.values()) - min(size.values()) < 0.02 * sum(size.values()) / 8
    assert all(s == set(range(len(s))) for s in at.values()) and sum(map(len, at.values())) == len(rows)


def test_folders_of_spark_schemes():
    assert common.arrow_uri("s3a://bucket/x") == "s3://bucket/x"
    assert common.arrow_uri("hdfs://host:8020/x") == "hdfs://host:8020/x"
    with pytest.raises(ValueError, match="s3a"):
        common.arrow_uri("ftp://host/x")


def test_map_versions_and_growth(spark):
    rnd = random.Random(4)
    weight = {s: rnd.randint(1, 100) for s in range(500)}
    path = new_folder(spark, "map")
    m0 = slots.first_map(8, 500)
    slots.store_map(spark, path, 0, m0)
    m1 = slots.rebalanced(m0, weight, 8)
    slots.store_map(spark, path, 1, m1)
    slots.store_map(spark, path, 1, m1)  # a repeated write changes nothing
    assert slots.load_map(spark, path) == m1 and slots.load_map(spark, path, 0) == m0
    load = Counter()
    for s, k in enumerate(m1):
        load[k] += weight[s]
    assert max(load.values()) - min(load.values()) <= 1
    m2 = slots.grown(m1, weight, 8)
    assert all(b in (a, 8) for a, b in zip(m1, m2))
    new = sum(weight[s] for s, k in enumerate(m2) if k == 8)
    assert abs(new - sum(weight.values()) / 9) <= 100


def test_op4_edges(spark, edge_docs, no_docs):
    out = slots.shard_documents(edge_docs, new_folder(spark, "map"), shards=3)
    got = Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out.collect())
    assert got == Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in edge_rows())
    for k in range(3):
        s = sorted(r["slot"] for r in out.filter(F.col("shard") == k).collect())
        assert s == list(range(len(s)))
    assert slots.shard_documents(no_docs, new_folder(spark, "map")).count() == 0


# ------------------------------------------------------------ operator 8 --

PAGES = "page_id long, url string, html string"


def archive_of(payloads):
    raw = b"".join(warc.record_bytes("response", f"urn:page:{i}", "http://x/", p, warc.sha1_32(p), "2000-01-01T00:00:00Z")
                   for i, p in enumerate(payloads))
    return raw


class Trickle(io.BytesIO):
    def read(self, n=-1):
        return super().read(min(7, n))


def test_reader_round_trip_in_any_block_size():
    rnd = random.Random(8)
    payloads = [b"", b"\r\n\r\n", b"WARC/1.1\r\n\r\n", bytes(rnd.randrange(256) for _ in range(5000)), b"x" * 3_000_000]
    raw = archive_of(payloads)
    for source in (io.BytesIO(raw), *([Trickle(archive_of(payloads[:4]))])):
        got = [r.payload for r in warc.read_records(source)]
        assert got == payloads[:len(got)] and len(got) >= 4
    assert list(warc.read_records(io.BytesIO(b""))) == []


def test_reader_reports_damage():
    raw = archive_of([b"hello", b"world"])
    with pytest.raises((warc.WarcError, zlib.error)):
        list(warc.read_records(io.BytesIO(raw[:-5])))
    one = zlib.decompressobj(31)
    plain = one.decompress(archive_of([b"hello"]))

    def member(data):
        z = zlib.compressobj(6, zlib.DEFLATED, 31)
        return z.compress(data) + z.flush()
    for bad in (plain.replace(b"hello", b"hellO"), plain.replace(b"Content-Length: ", b"Content-Length: 9"),
                plain.replace(b"WARC/1.1", b"HTTP/1.1"), plain.replace(b"Content-Length", b"Content-Size")):
        with pytest.raises(warc.WarcError):
            list(warc.read_records(io.BytesIO(member(bad))))
    assert [r.payload for r in warc.read_records(io.BytesIO(member(plain)))] == [b"hello"]


def warc_reference(rows):
    groups = defaultdict(list)
    for p, _, h in rows:
        groups[(h or "").encode()].append(p)
    out = Counter()
    for p, _, h in rows:
        raw = (h or "").encode()
        ids = [x for x in groups[raw] if x is not None]
        top = max(ids) if ids and len(groups[raw]) > 1 else None
        revisit = top is not None and top != p
        out[p, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response",
            top if revisit else None] += 1
    return out


def warc_rows(df):
    return Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                   for r in df.collect())


def test_op8_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "url", "html").collect()]
    assert warc_rows(queries.op8_warc(spark, SF_SMALL)) == warc_reference(rows)


def test_op8_copies_nulls_and_clashing_columns(spark, monkeypatch):
    rows = [(i, f"http://h/{i}\r\nX: y", "<html>é😀</html>" * (i % 3)) for i in range(60)]
    rows += [(100 + i, None, "copy") for i in range(80)] + [(None, "u", None), (None, None, "alone"), (7, "u", "copy")]
    rows += [(179, "again", "copy")]
    df = spark.createDataFrame(rows, PAGES).withColumn("digest", F.lit("x")).withColumn("canonical", F.lit("x"))
    assert warc_rows(warc.archive_and_read(df.repartition(4))) == warc_reference(rows)
    folder = new_folder(spark, "arc")
    back = warc.read_pages(warc.write_pages(warc.with_canonical(df), folder), folder, with_payload=True)
    whole = {r["page_id"]: bytes(r["payload"]) for r in back.filter("record_type = 'response'").collect()}
    assert whole[179] == b"copy" and whole[59] == ("<html>é😀</html>" * 2).encode()
    assert warc.archive_and_read(spark.createDataFrame([], PAGES)).count() == 0


def test_hot_lookup_matches_a_plain_join(spark):
    big = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 40}") for i in range(5000)] + [(1, None)], "id long, k string")
    dim = big.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("v")).filter("k != 'k3'")
    got = hot_lookup(big, dim, "k", "n", big.count(), F.col("id"))
    want = big.join(dim.drop("n"), "k", "left").select("id", "k", "v")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
