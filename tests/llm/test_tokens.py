"""Operators 1, 3, 5 and 10 against the public tokenizer libraries."""

import hashlib
import random
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tessera.llm import packing, piece, queries, repair, token_count, vocab
from tessera.llm.common import new_folder
from tessera.llm.vocab import byte_bpe, vocabulary

from llm_cases import EDGE_TEXTS, SF_SMALL, edge_docs, edge_rows, no_docs, rnd_text  # noqa: F401

ALPHABET = list("abcdeéèßñÄ 'st!?\n\t0129_-😀 日語ΣσςİÍ<|>▁") + ["'s", "'ll", "<|endoftext|>", "  ", "\n\n", "tion", "the"]


def random_texts(n, seed):
    rnd = random.Random(seed)
    return EDGE_TEXTS + [rnd_text(rnd, rnd.randint(0, 60), ALPHABET) for _ in range(n)]


@pytest.fixture(scope="module")
def word_lib():
    return Tokenizer.from_file(vocabulary("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def byte_lib():
    return Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def piece_lib():
    return sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))


def lib_ids(lib, text):
    return lib.encode(text or "", add_special_tokens=False).ids


# ------------------------------------------------------------ operator 1 --

def test_counts_equal_library_on_random_texts(word_lib):
    texts = random_texts(1500, 1)
    got = token_count.counter(vocabulary("word_bpe_49k.json")).counts(texts).tolist()
    assert got == [len(lib_ids(word_lib, t)) for t in texts]


def test_merger_applies_overlapping_pairs_from_the_left():
    vocab = {c: i for i, c in enumerate(token_count.byte_alphabet())}
    vocab |= {"aa": 256, "aaaa": 257, "ab": 258}
    m = token_count.RankMerger(vocab, [("a", "a"), ("aa", "aa"), ("a", "b")], "")
    # aaaaa -> aa aa a -> aaaa a ; aaab -> aa ab
    assert m.counts([b"aaaaa", b"aaab", b"", b"b", b"aaaaaaaa"]).tolist() == [2, 2, 0, 1, 2]


def test_merger_without_birth_order_merges_one_pair_at_a_time():
    vocab = {c: i for i, c in enumerate(token_count.byte_alphabet())}
    vocab |= {"ab": 256, "aba": 257}
    m = token_count.RankMerger(vocab, [("ab", "a"), ("a", "b")], "")
    assert not m.ordered
    # abab: a b | a b -> ab a b -> aba b
    assert m.counts([b"abab"]).tolist() == [2]


def test_op1_query_equals_library(spark, word_lib):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    got = {r["doc_id"]: tuple(r) for r in queries.op1_token_counts(spark, SF_SMALL).collect()}
    for r in docs:
        n = len(lib_ids(word_lib, r["text"]))
        assert got[r["doc_id"]] == (r["doc_id"], len(r["text"].encode()), n, n > 2048)
    assert len(got) == len(docs)


def test_op1_edges(spark, edge_docs, no_docs, word_lib):
    got = Counter(tuple(r) for r in token_count.count_tokens(edge_docs).collect())
    want = Counter((d, len((t or "").encode()), n := len(lib_ids(word_lib, t)), n > 2048)
                   for d, t, *_ in edge_rows())
    assert got == want
    assert token_count.count_tokens(no_docs).count() == 0


def test_every_character_counts_as_in_the_library(word_lib):
    """Also those that Python's Unicode tables see otherwise than the library's."""
    count = token_count.counter(vocabulary("word_bpe_49k.json")).counts
    chars = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) not in ("Cn", "Co")]
    rnd = random.Random(9)
    marks = [c for c in chars if unicodedata.combining(c)]
    apart = [unicodedata.normalize("NFD", c) for c in chars if unicodedata.decomposition(c)[:1] not in ("", "<")]
    texts = ["\ua7cb", "\ua7dc", "x\ua7cby"] + ["".join(chars[i:i + 3]) for i in range(0, len(chars), 3)]
    texts += ["".join(rnd.choice([rnd.choice(chars), rnd.choice(marks), rnd.choice(apart), "A", "Σ"])
                      for _ in range(rnd.randint(2, 6))) for _ in range(6000)]
    texts += ["".join(rnd.choice([chr(rnd.randrange(0x41, 0x370)), rnd.choice(marks[:90])]) for _ in range(5)) for _ in range(3000)]
    want = [len(e.ids) for e in word_lib.encode_batch_fast(texts, add_special_tokens=False)]
    assert count(texts).tolist() == want


def test_long_words_count_as_in_the_library(word_lib):
    import time
    rnd = random.Random(10)
    count = token_count.counter(vocabulary("word_bpe_49k.json")).counts
    words = [rnd_text(rnd, n, "abcdefghijklmnopqrstuvwxyzé") for n in (4096, 5000, 60_000)]
    words += ["ab" * 9000, "aab" * 5001, "the" * 4000, "y" * 9999, "é" * 5000]
    assert count(words).tolist() == [len(lib_ids(word_lib, w)) for w in words]
    start = time.process_time()
    count([rnd_text(rnd, 1_000_000, "abcdefghijklmnopqrstuvwxyz")])
    assert time.process_time() - start < 60


def test_long_merge_equals_the_ragged_one():
    vocab = {c: i for i, c in enumerate(token_count.byte_alphabet())}
    vocab |= {"aa": 256, "aaaa": 257, "ab": 258, "aab": 259}
    m = token_count.RankMerger(vocab, [("a", "a"), ("aa", "aa"), ("a", "b"), ("a", "ab")], "")
    rnd = random.Random(11)
    for _ in range(300):
        w = rnd_text(rnd, rnd.randint(1, 30), "aab").encode()
        assert m._long(w) == m.counts([w])[0]


# ------------------------------------------------------------ operator 3 --

def test_pieces_equal_library_on_random_texts(piece_lib):
    m = piece.piece_model(vocabulary("piece_bpe_32k.model"))
    rnd = random.Random(3)
    texts = random_texts(1500, 2) + [rnd_text(rnd, rnd.randint(0, 150), "aeinrst") for _ in range(200)]
    for t in texts:
        ids = m.encode(t)
        assert ids == piece_lib.encode(t or ""), t
        assert m.decode(ids) == piece_lib.decode(ids), t


def test_pairs_fit_as_merging_them_says():
    m = piece.PieceModel(vocabulary("piece_bpe_32k.model"))
    rnd = random.Random(12)
    ids = list(m.id_of.values())
    for _ in range(20_000):
        a, b = rnd.choice(ids), rnd.choice(ids)
        assert m._fit(a, b) == (m.merged(m._piece[a] + m._piece[b]) == [m._piece[a], m._piece[b]])
    assert all(m._fit(-1, i) == (m.merged(m._piece[i]) == [m._piece[i]]) for i in rnd.sample(ids, 3000))


def test_words_come_back_from_the_old_generation():
    made = []
    cache = vocab.WordCache(lambda w: made.append(w) or w.upper(), size=4)
    for w in ("a", "b", "a", "c", "a", "d", "e", "a", "x" * 100, "x" * 100):
        cache.turn()
        assert cache[w] == w.upper()
        assert len(cache) <= 2
    assert made.count("a") == 1 and made.count("x" * 100) == 2


def test_decode_of_any_ids_equals_library(piece_lib):
    m = piece.piece_model(vocabulary("piece_bpe_32k.model"))
    rnd = random.Random(4)
    for _ in range(2000):
        ids = [rnd.choice([rnd.randint(0, 2), rnd.randint(3, 258), rnd.randint(3, 258), rnd.randint(259, 31_999)])
               for _ in range(rnd.randint(0, 12))]
        assert m.decode(ids) == piece_lib.decode(ids), ids


def test_op3_query_equals_library(spark, piece_lib):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op3_sentencepiece(spark, SF_SMALL).collect()}
    for r in docs:
        ids = piece_lib.encode(r["text"])
        assert got[r["doc_id"]] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                                    hashlib.sha256(piece_lib.decode(ids).encode()).hexdigest())
    assert len(got) == len(docs)


def test_op3_edges(edge_docs, no_docs, piece_lib):
    got = Counter((r["doc_id"], tuple(r["ids"]), r["decoded"])
                  for r in piece.encode_documents(edge_docs, with_text=True).collect())
    want = Counter((d, tuple(piece_lib.encode(t or "")), piece_lib.decode(piece_lib.encode(t or "")))
                   for d, t, *_ in edge_rows())
    assert got == want
    assert piece.encode_documents(no_docs).count() == 0


# ------------------------------------------------------------ operator 5 --

def test_byte_ids_equal_library(byte_lib):
    bpe = byte_bpe(vocabulary("byte_bpe_50k.json"))
    for t in random_texts(1500, 5):
        assert bpe.ids(t).tolist() == lib_ids(byte_lib, t), t


def test_rank_order_equals_the_listed_merges(byte_lib):
    import json
    with open(vocabulary("byte_bpe_50k.json"), encoding="utf-8") as f:
        model = json.load(f)["model"]
    tokenize, alphabet, rnd = byte_lib.model.tokenize, vocab.byte_alphabet(), random.Random(13)
    ranked = vocab.rank_encoder(model, {50_256}, tokenize)
    tokens, value = list(model["vocab"]), {c: i for i, c in enumerate(alphabet)}
    for _ in range(40_000):
        w = "".join(rnd.choice(tokens[:3000] if rnd.random() < .5 else tokens[:-1]) for _ in range(rnd.randint(1, 4)))
        try:
            word = bytes(value[c] for c in w[rnd.randint(0, 2):]).decode()
        except UnicodeDecodeError:
            continue
        want = [t.id for t in tokenize("".join(alphabet[x] for x in word.encode()))]
        assert ranked(word) == want, word
    # merges out of order, or a token that its own text does not merge to
    bad = {"vocab": {c: i for i, c in enumerate(alphabet)} | {"ab": 256, "abc": 257, "bc": 258},
           "merges": [["a", "b"], ["a", "bc"], ["b", "c"]]}
    assert vocab.rank_encoder(bad, set(), tokenize) is None


@pytest.mark.parametrize("base,high", [(50_257, 50_257), (300, 40), (100_000, 100_000)])
def test_grammar_round_trip_and_random_access(base, high):
    rng = np.random.default_rng(6)
    words = [rng.integers(0, high, rng.integers(1, 9)) for _ in range(60)]
    docs = [np.concatenate([words[i] for i in rng.integers(0, 60, n)] or [np.empty(0, int)])
            for n in rng.integers(0, 300, 200)]
    docs += [np.zeros(5000, int), np.array([7, 7, 7, 8, 7, 7] * 900)]
    dtype = np.uint16 if base <= 0xFFFF else np.uint32
    docs = [d.astype(dtype) for d in docs]
    raw = repair.shard_bytes(list(range(len(docs))), np.concatenate(docs), np.cumsum([len(d) for d in docs]), base)
    shard = repair.Shard(raw)
    ids, ends = shard.all_ids()
    assert ids.tolist() == np.concatenate(docs).tolist()
    assert ends.tolist() == np.cumsum([len(d) for d in docs]).tolist()
    for i, d in enumerate(docs):
        assert shard.document(i).tolist() == d.tolist()
    p = shard.part
    assert len(p["left"]) and len(p["symbols"]) < len(ids) / 2  # it does compress
    # stored expansion lengths are those of the rules
    rules = np.arange(base, base + len(p["left"])).astype(p["symbols"].dtype)
    assert p["length"].tolist() == [len(shard.expander.ids(rules[i:i + 1])) for i in range(len(rules))]


def byte_reference(rows, lib, end):
    out, start = {}, 0
    for d, t in sorted(rows):
        ids = lib_ids(lib, t) + [end]
        out[d] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    return out


@pytest.mark.parametrize("base", [300, 0x10000])
def test_grammar_leaves_no_frequent_pair(base):
    rnd = np.random.default_rng(8)
    passage = rnd.integers(0, base, 500)
    docs = [np.concatenate([rnd.integers(0, base, 7), passage]) for _ in range(40)]
    ends = np.cumsum([len(d) for d in docs])
    sym, cut, left, right = repair.compress(np.concatenate(docs), ends, base)
    pairs = Counter()
    for a, e in zip([0, *cut], cut):
        pairs.update(zip(sym[a:e - 1].tolist(), sym[a + 1:e].tolist()))
    assert max(pairs.values()) < repair.MIN_COUNT
    assert repair.rule_lengths(left, right, base).max() > 400  # nearly the whole passage
    raw = repair.shard_bytes(list(range(40)), np.concatenate(docs), ends, base)
    assert all((repair.Shard(raw).document(i) == d).all() for i, d in enumerate(docs))


def test_op5_query_equals_library(spark, byte_lib):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op5_token_files(spark, SF_SMALL).collect()}
    assert got == byte_reference(docs, byte_lib, 0)


def test_op5_many_shards_and_edges(spark, edge_docs, no_docs, byte_lib):
    folder = new_folder(spark, "ids")
    manifest = repair.write_ids(edge_docs, folder, shard_ids=30)
    assert manifest.count() > 5
    got = sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in repair.read_documents(manifest, folder).collect()),
                 key=str)
    want = []
    for d, t, *_ in edge_rows():
        ids = lib_ids(byte_lib, t) + [0]
        want.append((d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert got == sorted(want, key=str)
    rows = repair.read_documents(manifest, folder).collect()
    rows.sort(key=lambda r: r["start"])
    assert [r["start"] for r in rows] == np.r_[0, np.cumsum([r["n_tokens"] for r in rows])][:-1].tolist()
    ids = [r["doc_id"] for r in rows]
    assert ids == sorted(ids, key=lambda d: (d is not None, d))
    assert repair.encode_and_read(no_docs).count() == 0


# ----------------------------------------------------------- operator 10 --

def plain_first_fit(sizes, capacity):
    """Brute force: scan the bins from the first."""
    free, out = [], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        b = next((b for b, f in enumerate(free) if f >= sizes[i]), None)
        if b is None:
            b = len(free)
            free.append(capacity)
        free[b] -= sizes[i]
        out[i] = b
    return out


def test_tournament_tree_is_first_fit():
    rnd = random.Random(10)
    for n in (0, 1, 2, 3, 17, 300):
        for top in (5, 100):
            sizes = [rnd.randint(1, top) for _ in range(n)]
            assert packing.first_fit_decreasing(sizes, 100) == plain_first_fit(sizes, 100)


def check_packing(rows, docs, lib, capacity, end=1):
    ids_of = {d: np.array(lib_ids(lib, t) + [end], "<u4") for d, t in docs}
    pieces, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
        ids = ids_of[r["doc_id"]]
        assert r["doc_tokens"] == len(ids)
        assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes())
    assert set(pieces) == set(ids_of)
    for d, p in pieces.items():
        at = 0
        for s, n in sorted(p):
            assert s == at and n > 0
            at += n
        assert at == len(ids_of[d])
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= capacity
    return len(seqs), sum(len(x) for x in ids_of.values())


def test_op10_query(spark, byte_lib):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    n, total = check_packing(queries.op10_packing(spark, SF_SMALL).collect(), docs, byte_lib, 2048)
    assert n <= total / 2048 * 1.02 + 2


def test_op10_groups_and_edges(spark, edge_docs, no_docs, byte_lib):
    rows = packing.pack(edge_docs, group_docs=8, with_ids=True).collect()
    one = {}
    for d, t, *_ in edge_rows():
        one[d, t] = np.array(lib_ids(byte_lib, t) + [1], "<u4")
    got = Counter()
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"] and zlib.crc32(bytes(r["ids"])) == r["ids_crc32"]
        got[r["doc_id"]] += r["length"]
    want = Counter()
    for d, t, *_ in edge_rows():
        want[d] += len(one[d, t])
    assert got == want
    fill = Counter()
    for r in rows:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= 2048
    spans = defaultdict(list)
    for r in rows:
        spans[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in spans.values():
        s.sort()
        assert [o for o, _ in s] == np.r_[0, np.cumsum([n for _, n in s])][:-1].tolist()
    assert packing.pack(no_docs).count() == 0
