"""Operators 11 to 13: tokenizer alignment, source mixing, filter audit."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import crosstok, filter_audit, mixing, queries
from tessera.llm.vocab import byte_alphabet, vocabulary

from llm_cases import EDGE_TEXTS, SF_SMALL, edge_docs, edge_rows, no_docs, rnd_text  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALPHABET = list("abcdeéèßñÄ 'st!?\n\t0129_-😀 日語ΣσςİÍ<|>▁") + ["'s", "'ll", "<|endoftext|>", "  ", "\n\n", "tion", "the"]

# ----------------------------------------------------------- operator 11 --


@pytest.fixture(scope="module")
def libs():
    a = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))


def brute_align(libs, rows):
    """Contract values per (id, text) row, by offset sets and plain counts."""
    a_lib, b_lib = libs
    value = {c: i for i, c in enumerate(byte_alphabet())}
    prepared, count = [], Counter()
    for doc, text in rows:
        a = a_lib.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_lib.encode(text) if text else []
        ta = [bytes(value[c] for c in a_lib.id_to_token(i)) for i in a]
        tb = [bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode()
              for i, p in ((i, b_lib.id_to_piece(i)) for i in b)]
        raw = (" " + text).encode() if text else b""
        if not text or b"".join(ta) != raw or b"".join(tb) != raw:
            prepared.append((doc, None))
            continue
        ends = [np.cumsum([len(t) for t in x]).tolist() for x in (ta, tb)]
        at_b, groups, i, j = dict(zip(ends[1], range(len(b)))), [], 0, 0
        for k, e in enumerate(ends[0]):
            if e in at_b:
                groups.append((a[i:k + 1], b[j:at_b[e] + 1]))
                i, j = k + 1, at_b[e] + 1
        links = [(x[-1], y[-1]) for x, y in groups]
        count.update(links)
        prepared.append((doc, (len(a), len(b), groups, links)))
    top = defaultdict(int)
    for (_, y), n in count.items():
        top[y] = max(top[y], n)
    out = []
    for doc, p in prepared:
        if p is None:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = p
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc, n_a, n_b, len(groups), len(links), sum(count[e] == top[e[1]] for e in links),
                    sum(count[e] for e in links), hashlib.sha256(text.encode()).hexdigest()))
    return Counter(out)


def test_op11_query_equals_brute_force(spark, libs):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    df = queries.op11_cross_tokenizer(spark, SF_SMALL)
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(tuple(r) for r in df.collect()) == brute_align(libs, rows)


def test_op11_edges(spark, edge_docs, no_docs, libs):
    got = Counter(tuple(r) for r in crosstok.align_documents(edge_docs).collect())
    assert got == brute_align(libs, [(d, t) for d, t, *_ in edge_rows()])
    assert crosstok.align_documents(no_docs).count() == 0


def test_op11_random_texts_over_partitions(spark, libs, monkeypatch):
    rnd = random.Random(11)
    rows = [(i, rnd_text(rnd, rnd.randint(0, 50), ALPHABET)) for i in range(600)]
    monkeypatch.setattr(crosstok, "SLICE", 300)  # slices of a few texts
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert Counter(tuple(r) for r in crosstok.align_documents(df).collect()) == brute_align(libs, rows)


def test_identity_map_and_pairs_cover_what_can_be_linked():
    it = crosstok.aligner(vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
    a, b = it._bytes_a, it._bytes_b
    assert all(a[i] == b[j] for i, j in enumerate(it.same) if j >= 0)
    x, y = np.divmod(it.pairs, it.n_b)
    assert all((a[i].endswith(b[j]) or b[j].endswith(a[i])) and it.same[i] != j for i, j in zip(x, y))
    assert len(it.pairs) < sum(map(len, a)) + 2 * sum(map(len, b))
    link = np.arange(it.n_links)
    link = link[(link >= it.n_a) | (np.r_[it.same, np.zeros(len(it.pairs), int)] >= 0)]
    assert (it.link_of(*it.link_ids(link)) == link).all()


# ----------------------------------------------------------- operator 12 --


def brute_targets(sizes, pattern=(1, 2, 3), limit=3, share=1.0):
    """Water filling, one source at a time; exact fractions."""
    from fractions import Fraction
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: pattern[i % len(pattern)] for i, s in enumerate(order)}
    total, stopped = round(sum(sizes.values()) * share), {}
    while True:
        free = [s for s in order if s not in stopped]
        left = total - sum(stopped.values())
        level = Fraction(left, sum(weight[s] for s in free)) if free else 0
        over = [s for s in free if weight[s] * level > limit * sizes[s]]
        if not over:
            return stopped | {s: weight[s] * level for s in free}
        stopped |= {s: limit * sizes[s] for s in over}


def check_mix(rows, got, limit=3):
    """``rows``: (doc_id, text, source); ``got``: rows of the operator."""
    words = [(d, len(WORD.findall(t or "")), s) for d, t, s in rows]
    sizes = defaultdict(int)
    for _, n, s in words:
        sizes[s] += n
    want = brute_targets(sizes)
    assert Counter((d, n, s) for d, n, s in words) == Counter((r["doc_id"], r["size"], r["source"]) for r in got)
    taken = defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(float(want[r["source"]]), rel=1e-12, abs=1e-12)
        whole = int(want[r["source"]] // sizes[r["source"]]) if sizes[r["source"]] else 0
        assert min(whole, limit) * r["size"] <= r["taken"] <= limit * r["size"]
        taken[r["source"]] += r["taken"]
    for s, n in taken.items():
        assert abs(n - want[s]) <= 0.5, s
        parts = [r for r in got if r["source"] == s and r["size"] and r["taken"] % r["size"]]
        assert len(parts) <= 1  # one document is cut, at most
    return taken


def test_op12_query(spark):
    docs = [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = queries.op12_source_mix(spark, SF_SMALL).collect()
    check_mix(docs, got)
    again = queries.op12_source_mix(spark, SF_SMALL).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_op12_sources_that_stop_and_hot_source(spark):
    rnd = random.Random(12)
    rows = [(i, "w " * rnd.randint(0, 40), rnd.choice(["big", "big", "big", "b", "c", "ä", "", None])) for i in range(900)]
    rows += [(1000 + i, "a b c", f"tiny{i}") for i in range(11)]
    rows += [(2000, "x " * 3000, "one long text"), (2001, None, "no words"), (2002, " \n", "no words")]
    rows += [(None, "same row", "big")] * 300
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    results = []
    for n in (1, 4, 13):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            got = mixing.mix(df.repartition(n)).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 4)
        taken = check_mix(rows, got)
        results.append(Counter(map(tuple, got)))
    assert results[0] == results[1] == results[2]
    assert taken["tiny0"] == 9  # three times its size
    mixed = mixing.mix(df)
    rows_of = mixing.epochs(mixed).collect()
    assert sum(r["words"] for r in rows_of) == mixed.agg(F.sum("taken")).first()[0]
    assert all(r["epoch"] < 3 and r["words"] > 0 for r in rows_of)


def test_op12_shares_and_weights(spark):
    df = spark.createDataFrame([(i, "w " * 10, "ab"[i % 2]) for i in range(20)], "doc_id long, text string, source string")
    got = mixing.mix(df, pattern=(1, 3), share=0.5).collect()
    taken = Counter()
    for r in got:
        taken[r["source"]] += r["taken"]
    assert taken == {"a": 25, "b": 75}
    assert {r["target"] for r in mixing.mix(df, share=100).collect()} == {300.0}  # all stop at their limit


def test_op12_edges(edge_docs, no_docs):
    check_mix([(d, t, s) for d, t, _, s, _ in edge_rows()], mixing.mix(edge_docs).collect())
    assert mixing.mix(no_docs).count() == 0


# ----------------------------------------------------------- operator 13 --


def brute_audit(rows, labels):
    """Contract rows by walking every order over every document."""
    good, toxic = ({d for d, q, x in labels if (q, x)[i] == 1} for i in (0, 1))
    first = {}
    for d, t, _ in rows:
        if d is not None:
            first[t or ""] = min(first.get(t or "", d), d)
    docs = []
    for d, t, part in rows:
        t = t or ""
        w = WORD.findall(t)
        fails = {f for f, x in zip("ABCDE", (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            re.search(r"[#$%&*|]", t), d is not None and first[t] < d)) if x}
        docs.append((part or "", frozenset(fails), d in good, d in toxic))
    cells = Counter(docs)
    out, shapley = {}, Counter()
    for part in {d[0] for d in docs}:
        mine = [(c, n) for c, n in cells.items() if c[0] == part]
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                before = set(order[:k])
                lost = [(c, n) for c, n in mine if f in c[1] and not c[1] & before]
                removed = sum(n for _, n in lost)
                shapley[part, f] += removed
                out[part, "".join(order), k + 1] = [
                    sum(n for c, n in mine if not c[1] & (before | {f})), removed,
                    sum(n for c, n in mine if f in c[1] and c[1] & before), sum(n for c, n in mine if c[1] == {f}),
                    sum(n for c, n in lost if c[2]), sum(n for c, n in lost if c[3])]
    return {(p, o, k, *v, shapley[p, o[k - 1]]) for (p, o, k), v in out.items()}


def docs_of(df):
    return [(r["doc_id"], r["text"], r["lang"]) for r in df.collect()]


def test_op13_query_equals_brute_force(spark):
    docs = docs_of(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    labels = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    df = queries.op13_filter_audit(spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    assert df.columns == ["part", "filter_order", "step", *filter_audit.COUNTS]
    assert len(got) == 600 * len({d[2] or "" for d in docs}) and set(got) == brute_audit(docs, labels)


def test_op13_edges(spark, edge_docs, no_docs):
    labels = [(i, i % 2, i % 3 % 2) for i in range(0, 140)] + [(2, 1, 1), (2, 0, 0), (None, 1, 1), (7, None, None)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("cell", F.lit("clash"))
    got = [tuple(r) for r in filter_audit.audit(edge_docs, marks).collect()]
    known = [(d, q, t) for d, q, t in labels if d is not None]
    assert set(got) == brute_audit([(d, t, s) for d, t, s, *_ in edge_rows()], known) and len(got) == len(set(got))
    assert filter_audit.audit(no_docs, marks).count() == 0
    none = filter_audit.audit(edge_docs, marks.limit(0))
    assert none.agg(F.sum("good_lost") + F.sum("toxic_lost")).first()[0] == 0


def test_op13_random_copies_in_many_parts(spark):
    rnd = random.Random(13)
    texts = [" ".join(rnd.choice(["Aa", "b", "c#", "D", "word", f"u{i}"]) for _ in range(rnd.choice([3, 150, 230]))) for i in range(40)]
    rows = [(rnd.randint(0, 250), texts[0] if rnd.random() < .4 else rnd.choice(texts), rnd.choice(["x", "y", "", None])) for _ in range(500)]
    labels = [(i, rnd.randint(0, 1), rnd.randint(0, 1)) for i in range(0, 250, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert {tuple(r) for r in filter_audit.audit(df, marks).collect()} == brute_audit(rows, labels)


def test_contraction_selects_pass_fail_or_all():
    rng = np.random.default_rng(13)
    t = rng.integers(0, 9, (2, 2, 2, 2, 2, 2))
    P, X, A = filter_audit.PASS, filter_audit.FAIL, filter_audit.ALL
    got = filter_audit.contract(t, [[A] * 5, [P, X, A, A, P], [X] * 5])
    assert got[0].tolist() == t.reshape(2, -1).sum(1).tolist()
    assert got[1].tolist() == t[:, 0, 1, :, :, 0].reshape(2, -1).sum(1).tolist()
    assert got[2].tolist() == t[:, 1, 1, 1, 1, 1].tolist()
