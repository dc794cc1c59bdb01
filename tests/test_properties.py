"""Property tests: operators against direct Python statements of the same
semantics on random small inputs."""

from hypothesis import HealthCheck, example, given, settings
from hypothesis import strategies as st

from tessera.operators import corpus as CO
from tessera.operators.augment import merge_augmentation
from tessera.operators.crosswalk import crosswalk

KEYS = st.sampled_from(["A", "B", "C", "D", "E"])
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(lists=st.lists(st.one_of(st.none(), st.lists(KEYS, max_size=6)), min_size=1, max_size=6),
       dim=st.lists(st.tuples(KEYS, st.text("xyz", min_size=1, max_size=3)), max_size=8))
def test_crosswalk_matches_python(spark, lists, dim):
    df = spark.createDataFrame(list(enumerate(lists)), "id int, l array<string>")
    d = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(dim)] or [("Z", "z", 0)],
                              "k string, v string, o int")
    first = {}
    for k, v in (dim or [("Z", "z")]):
        first.setdefault(k, v)
    got = {r["id"]: r["xw_list"] for r in crosswalk(df, "l", d, "k", "v", "o", key="id").collect()}
    for i, lst in enumerate(lists):
        assert got[i] == [first[x] for x in (lst or []) if x in first]


@SETTINGS
@given(texts=st.lists(st.one_of(st.none(), st.text("ab; ", max_size=8)), min_size=1, max_size=8))
def test_split_rows_matches_python(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = sorted((r["id"], r["t"]) for r in CO.split_rows(df, "t").collect())
    exp = sorted((i, p) for i, t in enumerate(texts) if t is not None for p in t.split("; "))
    assert got == exp


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["t1", "t2", "t3", None]),
                               st.sampled_from(["icpc2_description", "icpc2_short", "icd10_description"])),
                     min_size=1, max_size=10))
def test_drop_shadowed_matches_python(spark, rows):
    df = spark.createDataFrame([(i, t, o) for i, (t, o) in enumerate(rows)], "id int, text string, origin string")
    got = sorted(r["id"] for r in CO.drop_shadowed(df).collect())
    counts = {}
    for t, _ in rows:
        counts[t] = counts.get(t, 0) + 1
    exp = sorted(i for i, (t, o) in enumerate(rows) if not (counts[t] > 1 and o == "icpc2_short"))
    assert got == exp


@SETTINGS
@given(a=st.lists(st.tuples(KEYS, KEYS), max_size=6), b=st.lists(st.tuples(KEYS, KEYS), max_size=6))
def test_merge_augmentation_keep_first_and_idempotent(spark, a, b):
    schema = "code string, text string, pos int"
    ea = spark.createDataFrame([(c, t, i) for i, (c, t) in enumerate(a)] or [("Z", "Z", 0)], schema)
    nb = spark.createDataFrame([(c, t, 100 + i) for i, (c, t) in enumerate(b)] or [("Z", "Z", 100)], schema)
    m1 = merge_augmentation(ea, nb, order="pos")
    seen, exp = set(), []
    for c, t, p in [(c, t, i) for i, (c, t) in enumerate(a or [("Z", "Z")])] + \
                   [(c, t, 100 + i) for i, (c, t) in enumerate(b or [("Z", "Z")])]:
        if (c, t) not in seen:
            seen.add((c, t))
            exp.append((c, t, p))
    assert sorted(tuple(r) for r in m1.collect()) == sorted(exp)
    m2 = merge_augmentation(m1, nb, order="pos")
    assert sorted(tuple(r) for r in m2.collect()) == sorted(exp)


VEC = st.lists(st.integers(-2, 2), min_size=3, max_size=3)


@SETTINGS
@given(vecs=st.lists(VEC, min_size=2, max_size=12), k=st.integers(1, 4), grid=st.booleans())
@example(vecs=[[0, 0, 0], [0, 0, 0], [-1, 2, 2], [-1, 2, 2], [-2, -1, 2]], k=2, grid=False)
def test_vector_topk_matches_brute_force(spark, vecs, k, grid):
    """Exact cosine top-k against a direct statement, through the broadcast
    path and the block grid; integer vectors give exact ties (same vector
    twice) and zero vectors (score 0), ties go to the lowest item id."""
    import numpy as np

    from tessera.operators.vector import vector_topk
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)],
                               "vec_id long, embedding array<float>")
    if grid:
        spark.conf.set("tessera.vector.maxBroadcastQueries", "1")
        spark.conf.set("tessera.vector.blockRows", "3")
    try:
        got = sorted((r["query_id"], r["rank"], r["item_id"]) for r in vector_topk(df, df, k, exclude_self=True).collect())
    finally:
        spark.conf.unset("tessera.vector.maxBroadcastQueries")
        spark.conf.unset("tessera.vector.blockRows")
    m = np.array(vecs, dtype=np.float64)
    n = np.linalg.norm(m, axis=1)
    n[n == 0] = 1.0
    u = m / n[:, None]

    def true(q, i):
        return round(float(u[q] @ u[i]), 9)
    # rank by rank the returned item has the k-th best true score (ties of
    # mathematically equal scores may differ in the last bit, so their order
    # is checked on the score, not the id), each item at most once, no self
    for q in range(len(vecs)):
        best = sorted((true(q, i) for i in range(len(vecs)) if i != q), reverse=True)[:k]
        mine = [i for (qq, _, i) in got if qq == q]
        assert len(mine) == len(best) and len(set(mine)) == len(mine) and q not in mine
        assert [true(q, i) for i in mine] == best
        # identical vectors are exact ties: the lower id comes first
        for a, b in zip(mine, mine[1:]):
            if vecs[a] == vecs[b]:
                assert a < b
