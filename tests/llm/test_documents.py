"""Operators 6, 7, 9 and the pipeline."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import langid, neardup, queries, rules

from llm_cases import DOC_SCHEMA, EDGE_TEXTS, SF_CHECK, SF_SMALL, edge_docs, edge_rows, no_docs, rnd_text  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")

# ------------------------------------------------------------ operator 6 --


def test_op6_held_out_accuracy(spark):
    truth = {r["doc_id"]: (r["lang"], r["text"]) for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()}
    rows = queries.op6_language_id(spark, SF_CHECK).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(truth)
    right = total = 0
    for r in rows:
        lang, text = truth[r["doc_id"]]
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in text))
        if r["held_out"] and r["lang_pred"] != "und":
            right += r["lang_pred"] == lang
            total += 1
    assert total > 150 and right / total >= 0.97


def test_scores_equal_plain_naive_bayes():
    rnd = random.Random(6)
    rng = np.random.default_rng(6)
    model = langid.Model(["aa", "bb", "cc"], np.log(rng.random((langid.BUCKETS, 3)) + 0.1).astype(np.float32))
    for t in EDGE_TEXTS + [rnd_text(rnd, 80, "abc é1!ß ") for _ in range(40)]:
        name, score = (x[0] for x in model.predict([t]))
        codes = langid._codes(t) if t else []
        if not len(codes):
            assert (name, score) == ("und", 0.0)
            continue
        text = "".join(map(chr, codes))
        assert text == " " + " ".join("".join(c if c.isalpha() else " " for c in t.lower()).split()) + " "
        total, n = np.zeros(3), 0
        for g in langid.buckets_of(codes):
            total += model.logp[g]
            n += 1
        assert n == sum(max(0, len(text) - k) for k in range(langid.ORDER))
        z = total * min(n, langid.EVIDENCE) / n
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert name == model.langs[int(z.argmax())] and score == pytest.approx(p.max(), rel=1e-3)


def test_training_equals_plain_counts(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").filter(~langid.held_out())
    model = langid.train(docs)
    count, rows = {}, [(r["lang"], r["text"]) for r in docs.collect()]
    for lang, text in rows:
        if lang is not None and text is not None:
            c = count.setdefault(lang, np.zeros(langid.BUCKETS))
            codes = langid._codes(text)
            np.add.at(c, langid.buckets_of(codes), 1)
    assert model.langs == sorted(count)
    for i, lang in enumerate(model.langs):
        want = np.log((count[lang] + 0.5) / (count[lang].sum() + 0.5 * langid.BUCKETS))
        assert np.allclose(model.logp[:, i], want, atol=1e-4)


def test_many_languages_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(langid, "BLOCK_LANGS", 2)
    monkeypatch.setattr(langid, "SHARED_BLOCKS", 1)
    rnd = random.Random(8)
    words = {f"l{i}": [rnd_text(rnd, 5, "abcdefgh" if i % 2 else "ijklmnop") for _ in range(6)] for i in range(7)}
    rows = [(i, " ".join(rnd.choices(words[lang], k=8)), lang) for i in range(300) for lang in [f"l{i % 7}"]]
    rows += [(900, "...", "zz"), (901, None, "none"), (902, "text", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = langid.train(df)
    assert model.langs == [f"l{i}" for i in range(7)] + ["zz"] and len(model.blocks) == 4
    whole = langid.Model(model.langs, model.logp)
    names, scores = whole.predict([t for _, t, _ in rows])
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(df, model).collect()}
    for (i, *_), name, score in zip(rows, names, scores):
        assert got[i][0] == name and got[i][1] == pytest.approx(score, rel=1e-6)
    assert sum(got[i][0] == lang for i, _, lang in rows[:300]) > 290


def test_long_texts_are_scored_in_chunks(monkeypatch):
    codes = langid._codes("abc défg hijk lmn " * 50)
    whole = np.bincount(langid.buckets_of(codes), minlength=langid.BUCKETS)
    for size in (7, 64, 100, len(codes) - 1, len(codes)):
        monkeypatch.setattr(langid, "CHUNK", size)
        parts = sum(np.bincount(g, minlength=langid.BUCKETS) for g in langid._chunks(codes))
        assert (parts == whole).all()


def test_every_language_is_learned(spark):
    # 300 languages of one letter each, the last ones rarer than the others
    rows = [(10 * i + j, chr(0x4E00 + i) * 5, f"l{i:03d}") for i in range(300) for j in range(2 if i < 280 else 1)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.langs == [f"l{i:03d}" for i in range(300)]
    assert model.predict([chr(0x4E00 + i) * 4 for i in range(300)])[0] == model.langs


def test_op6_edges(spark, edge_docs, no_docs):
    model = langid.train(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    rows = langid.identify(edge_docs, model).collect()
    assert len(rows) == len(edge_rows())
    und = Counter(r["doc_id"] for r in rows if r["lang_pred"] == "und")
    assert und == Counter(d for d, t, *_ in edge_rows() if not any(c.isalpha() for c in t or ""))
    kept = langid.keep_identified(edge_docs, model)
    assert kept.columns == edge_docs.columns and kept.count() == sum(
        r["lang_pred"] != "und" and r["score"] >= 0.5 for r in rows)
    assert langid.identify(no_docs, langid.train(no_docs)).count() == 0
    assert {r["lang_pred"] for r in langid.identify(edge_docs, langid.train(no_docs)).collect()} == {"und"}


# ------------------------------------------------------------ operator 7 --

def plain_counts(text):
    words = WORD.findall(text or "")
    wins = list(zip(words, words[1:], words[2:]))
    many = Counter(wins)
    hit = {i + k for i, w in enumerate(wins) if many[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(hit), len(lines))


def test_counts_equal_brute_force(spark):
    rnd = random.Random(7)
    texts = EDGE_TEXTS + [rnd_text(rnd, rnd.randint(0, 120), list("ab \n\t#|é\x85\xa0\x0b\x1c") + ["x y ", "\n"])
                          for _ in range(1500)]
    texts += [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    for t in texts:
        assert rules.text_counts(t) == plain_counts(t), t


def test_binomial_bound_is_exact():
    for n, p in ((5, 0.3), (40, 0.05), (300, 0.01)):
        for k in range(min(n, 12)):
            want = sum(math.comb(n, i) * Fraction(p) ** i * (1 - Fraction(p)) ** (n - i) for i in range(k + 1))
            assert rules.binomial_tail(k, n, p) == pytest.approx(float(want), rel=1e-9)
    assert rules.certified(0, 300, 0.01, 0.05) and not rules.certified(0, 298, 0.01, 0.05)
    assert not rules.certified(0, 0, 0.5, 0.5)


def plain_cutoffs(rows, label):
    """Brute force over Python rows: (stratum, counts) of documents."""
    risk = rules.MAX_RISK / len(rules.RULES)
    held, junk = defaultdict(list), defaultdict(list)
    for d, s, c in rows:
        f = dict(zip(rules.FEATURES, c))
        if d in label and f["n_words"] >= 50 and 100 * f["n_repeat_words"] <= 50 * f["n_words"]:
            (held if label[d] == 1 else junk)["\0" if s is None else s].append(f)
    least = math.ceil(math.log(rules.ERROR / len(rules.RULES)) / math.log1p(-risk))
    held = {s: h for s, h in held.items() if len(h) >= least}
    out = {}
    for s, h in held.items():
        left, bad = h, junk[s]
        for name, num, den, large, ladder in rules.RULES:
            def hit(f, c):
                return f[den] > 0 and (f[num] > c * f[den] if large else f[num] < c * f[den])
            best = None
            for c in ladder:
                k = sum(hit(f, c) for f in h)
                if not rules.certified(k, len(h), risk, rules.ERROR / (len(held) * len(rules.RULES))):
                    break
                best = c
            if best is not None and (sum(hit(f, best) for f in bad) * len(left)
                                     > sum(hit(f, best) for f in left) * len(bad)):
                out.setdefault(s, {})[name] = best
                left, bad = ([f for f in x if not hit(f, best)] for x in (left, bad))
    return out


@pytest.fixture(scope="module")
def judged_case(spark):
    rnd = random.Random(77)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8))) for _ in range(4000)]
    docs, labels = [], []
    for i in range(3600):
        w = [rnd.choice(words) for _ in range(60)]
        bad = i % 9 == 0
        if bad:
            w = [x + "%%" if rnd.random() < 0.6 else x for x in w]
        if i % 400 == 1:
            w = [x + "#" for x in w[:40]] + w[:20]
        lang = "en" if i % 4 else ("fr" if i % 40 else None)
        docs.append((i, " ".join(w), lang, "s", 0))
        labels.append((i, 0 if bad else 1))
    labels += [(3, 0), (4, None), (None, 1), (5, 1)]
    return docs, labels, spark.createDataFrame(docs, DOC_SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int")


def test_cutoffs_equal_brute_force(judged_case):
    docs, labels, df, lab = judged_case
    worst = {}
    for d, q in labels:
        if d is not None and q is not None:
            worst[d] = min(worst.get(d, 1), q)
    want = plain_cutoffs([(d, l, rules.text_counts(t)) for d, t, l, *_ in docs], worst)
    got = rules.calibrate(rules.features(df), lab)
    assert got == want and "symbols" in got["en"] and "\0" not in got
    assert "dup_lines" not in got["en"]  # no bad document has any: the rule could only cost good ones
    out = {r["doc_id"]: r["kept"] for r in rules.judge(df, lab).collect()}
    good = [d for d, t, l, *_ in docs if worst.get(d) == 1 and l == "en"]
    assert sum(not out[d] for d in good) <= rules.MAX_RISK * len(good)
    bad = [d for d, t, l, *_ in docs if d % 9 == 0 and l == "en"]
    assert sum(out[d] for d in bad) <= 0.1 * len(bad)
    # the pipeline's filter keeps the same rows, with all columns
    kept = rules.keep_good(df, lab)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, k in out.items() if k}


def test_op7_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = queries.op7_quality_rules(spark, SF_SMALL).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        c = plain_counts(docs[r["doc_id"]])
        assert tuple(r[x] for x in rules.COUNTS) == c[:5]
        failed = c[0] < 50 or 100 * c[4] > 50 * c[0]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_op7_edges(spark, edge_docs, no_docs):
    lab = spark.createDataFrame([(0, 1), (None, 0)], "doc_id long, quality int")
    rows = rules.judge(edge_docs, lab).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(d for d, *_ in edge_rows())
    assert all(r["kept"] == (not r["base_failed"]) for r in rows)
    assert rules.judge(no_docs, lab).count() == 0
    assert rules.judge(edge_docs, lab.limit(0)).count() == len(edge_rows())
    assert rules.keep_good(edge_docs, lab).count() == sum(r["kept"] for r in rows)


# ------------------------------------------------------------ operator 9 --

def plain_set(text, k):
    w = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x) for x in WORD.findall(text or "")]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def plain_components(rows, k, percent=80):
    """Brute force: all pairs with a shared shingle, by an inverted index."""
    sets = defaultdict(list)
    for d, t in rows:
        if d is not None:
            sets[d].append(plain_set(t, k))
    flat = [(d, s) for d, ss in sets.items() for s in ss]
    post = defaultdict(list)
    for i, (_, s) in enumerate(flat):
        for x in s:
            post[x].append(i)
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x
    for i, (d, s) in enumerate(flat):
        both = Counter(j for x in s for j in post[x] if j > i)
        for j, n in both.items():
            e, t = flat[j]
            if 100 * n >= percent * (len(s) + len(t) - n):
                a, b = sorted((root(d), root(e)))
                up[b] = a
    return {d: root(d) for d in sets}


def judged(df):
    rows = df.collect()
    for r in rows:
        assert r["kept"] == (r["doc_id"] == r["component_id"] or r["doc_id"] is None)
    return {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"] is not None}, rows


def test_op9_query_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()]
    got, rows = judged(queries.op9_near_duplicates(spark, SF_CHECK))
    assert got == plain_components(docs, 2)
    n = {r["doc_id"]: r["n_shingles"] for r in rows}
    assert all(n[d] == len(plain_set(t, 2)) for d, t in docs)
    assert len(set(got.values())) < len(got)


def edited(rnd, words, share):
    return [f"z{rnd.random()}" if rnd.random() < share else w for w in words]


def test_groups_of_near_copies_keep_every_link(spark, monkeypatch):
    """Copies that are linked with their original alone, with each other
    alone (a ring around no centre), and chains; more of them than a block."""
    rnd = random.Random(9)
    texts = []
    for g in range(3):
        base = [f"w{g}_{i}" for i in range(120)]
        texts += [" ".join(edited(rnd, base, 0.05)) for _ in range(60)]
        texts += [" ".join(edited(rnd, base, 0.02)) for _ in range(10)]
        texts.append(" ".join(base))
        chain = [f"c{g}_{i}" for i in range(400)]
        texts += [" ".join(chain[i * 9:i * 9 + 100]) for i in range(30)]
    texts += ["exact copy " * 30] * 50 + ["two words", "Two  WORDS", "two", "", None]
    rnd.shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_components(rows, 2)
    got, _ = judged(neardup.near_duplicates(df, words=2))
    assert got == want
    monkeypatch.setattr(neardup, "CHUNK", 16)
    assert judged(neardup.near_duplicates(df, words=2))[0] == want


def test_op9_edges(spark, edge_docs, no_docs):
    got, rows = judged(neardup.near_duplicates(edge_docs, words=2))
    assert len(rows) == len(edge_rows())
    assert got == plain_components([(d, t) for d, t, *_ in edge_rows()], 2)
    assert neardup.near_duplicates(no_docs).count() == 0
    # one id with two texts joins their groups
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (2, "p q r s t u v"), (3, "p q r s t u v"), (4, "x y")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert judged(neardup.near_duplicates(df, words=2))[0] == {1: 1, 2: 1, 3: 1, 4: 4}


def test_op9_classes_that_share_their_smallest_id(spark):
    # id 1 is the first of eight unlike classes; each has a near copy of its own
    rnd = random.Random(9)
    rows = []
    for i in range(8):
        words = [f"w{i}x{rnd.randrange(10 ** 6)}" for _ in range(60)]
        rows += [(1, " ".join(words)), (10 + i, " ".join(words + ["tail"]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert judged(neardup.near_duplicates(df, words=2))[0] == plain_components(rows, 2) == {d: 1 for d, _ in rows}


def test_sketch_fills_empty_bins_alike():
    a = np.sort(np.random.default_rng(1).integers(0, 2 ** 64, 40, np.uint64, endpoint=False))
    sk = neardup.sketch(a)
    assert set(sk.tolist()) <= set(a.tolist()) and len(sk) == neardup.BINS
    # agreement of sketches estimates the similarity
    rng = np.random.default_rng(2)
    est = []
    for _ in range(60):
        x = rng.integers(0, 2 ** 64, 50, np.uint64, endpoint=False)
        y = np.r_[x[:45], rng.integers(0, 2 ** 64, 5, np.uint64, endpoint=False)]
        est.append((neardup.sketch(np.sort(x)) == neardup.sketch(np.sort(y))).mean())
    assert abs(np.mean(est) - 45 / 55) < 0.03


# -------------------------------------------------------------- pipeline --

def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "language", "near_duplicates", "packing"]
    good = corpus_pipeline.quality(spark, docs, SF_CHECK)
    assert good.columns == docs.columns
    ids = {r["doc_id"] for r in good.collect()}
    failed = {d for d, t in rows.items() if (c := plain_counts(t))[0] < 50 or 100 * c[4] > 50 * c[0]}
    assert ids == set(rows) - failed  # too few labels here to certify a cutoff
    spoken = corpus_pipeline.language(spark, good, SF_CHECK)
    assert spoken.columns == docs.columns
    single = corpus_pipeline.near_duplicates(spark, spoken, SF_CHECK)
    assert single.columns == docs.columns
    left = [(r["doc_id"], r["text"]) for r in spoken.collect()]
    want = {d for d, c in plain_components(left, 5).items() if d == c}
    assert {r["doc_id"] for r in single.collect()} == want
    out = corpus_pipeline.run(spark, SF_CHECK)
    assert {r["doc_id"] for r in out.select("doc_id").distinct().collect()} == want


def test_pipeline_edges(spark, edge_docs, no_docs):
    docs = edge_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, SF_SMALL).count() == 0
        stage(spark, edge_docs, SF_SMALL).count()
    single = corpus_pipeline.near_duplicates(spark, docs, SF_SMALL)
    ids = Counter(r["doc_id"] for r in single.collect())
    comp = plain_components([(d, t) for d, t, *_ in edge_rows()], 5)
    assert ids == Counter({**{d: 1 for d, c in comp.items() if d == c}, None: 2})


def test_pipeline_judges_texts_that_share_an_id(spark):
    rnd = random.Random(5)
    a, b, c, d = (" ".join(f"t{k}x{rnd.randrange(10 ** 6)}" for _ in range(60)) for k in range(4))
    rows = [(1, a, "s1"), (2, a, "s2"),       # a copy under another id
            (2, b, "s3"), (2, b, "s4"),       # its namesake, twice
            (1, c, "s5"), (3, c + " x", "s6"),  # a near copy of a namesake
            (None, d, "s7"), (None, d, "s8"), (None, None, "s9"), (None, None, "s9"), (4, "", "s"), (4, None, "s")]
    df = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], DOC_SCHEMA)
    got = [corpus_pipeline.near_duplicates(spark, df.repartition(n), SF_SMALL).collect() for n in (1, 5)]
    assert Counter(got[0]) == Counter(got[1])
    assert Counter((r["doc_id"], r["text"]) for r in got[0]) == Counter(
        [(1, a), (2, b), (1, c), (None, d), (None, None), (4, ""), (4, None)])
