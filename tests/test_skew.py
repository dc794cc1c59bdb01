"""Hot-key fixtures: one key holds a third of all rows. Results are checked
against a brute-force pandas computation of the same semantics."""

import hashlib

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators import corpus as CO
from tessera.operators.common import with_row_id
from tessera.operators.crosswalk import crosswalk
from tessera.operators.split import stratified_split
from tessera.operators.topk import topk_per_key

N = 6000


@pytest.fixture(scope="module")
def skewed(spark):
    data = []
    for i in range(N):
        code = "H01" if i % 3 == 0 else f"C{(i * 7919) % 500:03d}"
        text = "hot text" if i % 3 == 0 else f"text {(i * 31) % 2500}"
        origin = ["icpc2_description", "icpc2_short", "icpc2_inclusion", "icd10_description"][i % 4]
        data.append((i, code, text, origin, float((i * 2654435761) % 1000) / 10.0))
    pdf = pd.DataFrame(data, columns=["id", "code", "text", "origin", "score"])
    return spark.createDataFrame(pdf).repartition(7), pdf


def test_topk_hot_key(spark, skewed):
    df, pdf = skewed
    got = topk_per_key(df, "code", "score", 4, "id")
    got = {(r["code"], r["rank"]): r["id"] for r in got.collect()}
    exp = pdf.sort_values(["code", "score", "id"], ascending=[True, False, True]).groupby("code").head(4)
    exp = exp.assign(rank=exp.groupby("code").cumcount() + 1)
    assert got == {(r.code, r.rank): r.id for r in exp.itertuples()}


def test_stratified_split_hot_class(spark, skewed):
    df, pdf = skewed
    got = {r["id"]: r["split"] for r in stratified_split(df, "code", "id").collect()}
    pdf = pdf.assign(h=[hashlib.md5(f"{i}:42".encode()).hexdigest() for i in pdf["id"]])
    pdf = pdf.sort_values(["code", "h", "id"])
    pdf["rk"] = pdf.groupby("code").cumcount()
    pdf["n"] = pdf.groupby("code")["id"].transform("count")
    pdf["exp"] = ["test" if rk < int(0.2 * n + 0.5) else "train" for rk, n in zip(pdf["rk"], pdf["n"])]
    assert got == dict(zip(pdf["id"], pdf["exp"]))


def test_drop_shadowed_hot_text(spark, skewed):
    df, pdf = skewed
    got = sorted(r["id"] for r in CO.drop_shadowed(df).collect())
    dup = pdf.duplicated(subset=["text"], keep=False)
    exp = sorted(pdf[~(dup & (pdf["origin"] == "icpc2_short"))]["id"])
    assert got == exp


def test_encode_labels_hot_code(spark, skewed):
    df, pdf = skewed
    out, _ = CO.encode_labels(df.select("id", "code", "text"))
    got = {r["id"]: r["label"] for r in out.collect()}
    exp = dict(zip(pdf["id"], pdf["code"].astype("category").cat.codes))
    assert got == exp


def test_row_ids_with_hot_leading_key(spark, skewed):
    df, pdf = skewed
    got = {r["id"]: r["row_id"] for r in with_row_id(df, ["code", "id"], partitions=5).collect()}
    exp = {i: k for k, i in enumerate(pdf.sort_values(["code", "id"])["id"])}
    assert got == exp


def test_crosswalk_hot_dimension_key(spark):
    lists = spark.createDataFrame([(i, ["K1"] * 3 + [f"K{i % 5}"]) for i in range(2000)], "id int, l array<string>")
    dim = spark.createDataFrame([("K1", "one", 1), ("K1", "uno", 2), ("K2", "two", 1)], "k string, v string, o int")
    out = {r["id"]: r["xw_join"] for r in crosswalk(lists, "l", dim, "k", "v", "o", key="id").collect()}
    for i in range(2000):
        tail = {1: "; one", 2: "; two"}.get(i % 5, "")
        assert out[i] == "one; one; one" + tail
    assert lists.select(F.size("l")).first()[0] == 4


def test_oversample_spreads_a_large_group_of_copies(spark):
    """A one-row class next to a 5000-row class needs 5000 copies of one row:
    they are produced in chunks spread over tasks, and the copy numbers are
    exactly 1..5000, the same as the unchunked expansion."""
    from pyspark.sql import functions as F

    from tessera.operators.balance import oversample
    df = spark.createDataFrame([(i, 0) for i in range(5000)] + [(99999, 1)], "id long, label int")
    chunked = oversample(df, "label", copies_per_task=64)
    plain = oversample(df, "label", copies_per_task=10_000)
    assert chunked.count() == plain.count() == 10_000
    copies = [r["copy"] for r in chunked.filter("label = 1").select("copy").collect()]
    assert sorted(copies) == list(range(1, 5001))
    assert chunked.filter("label = 0").agg(F.max("copy")).first()[0] == 1
    assert sorted(map(tuple, chunked.collect())) == sorted(map(tuple, plain.collect()))
    # the hot row's copies come out of many tasks, not one
    per_task = chunked.filter("label = 1").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(per_task) > 1 and max(r["count"] for r in per_task) < 5000


def test_topk_hot_key_partial_limit_and_salted_form(spark, skewed):
    """The one-window form limits rows per key before the shuffle; the
    salted form (k above the window-limit threshold) gives the same rows."""
    df, _ = skewed
    one = topk_per_key(df, "code", "score", 4, "id")
    one.collect()
    plan = one._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "WindowGroupLimit" in plan and "Partial" in plan
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "2")
    try:
        salted = sorted(map(tuple, topk_per_key(df, "code", "score", 4, "id").collect()))
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert salted == sorted(map(tuple, one.collect()))
