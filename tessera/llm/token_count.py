"""Token counts by rank-synchronous array merging.

The distinct pre-tokens of a batch are held as one ragged numpy array of symbol
ids. Each round looks up the rank of every adjacent pair at once, takes each
sequence's lowest rank, and applies that merge in all sequences together; a
sequence without a mergeable pair leaves the array, and the number of symbols
it has left is its token count. A text's count is the sum over its pre-tokens.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import with_slices
from tessera.llm.vocab import CACHE_WORDS, CACHED_CHARS, WORD_PATTERN, byte_alphabet, splitter, vocabulary

NO_RANK = np.iinfo(np.int64).max
WORDS_AT_ONCE = 65_536
LONG_WORD = 4_096  # bytes from which a sequence is merged by its own bucket queue


class RankMerger:
    """Symbols left of byte sequences after all merges of a BPE file."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        alphabet = byte_alphabet()
        self.plain = np.array([vocab[c] for c in alphabet], np.int64)
        self.last = np.array([vocab[c + suffix] for c in alphabet], np.int64)
        self.base = max(vocab.values()) + 1
        code = np.array([vocab[a] * self.base + vocab[b] for a, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        # later entries of a repeated pair win, as in the library
        order = np.lexsort((-np.arange(len(code)), code))
        first = np.r_[True, np.diff(code[order]) != 0]
        order = order[first]
        self.codes, self.ranks, self.made = code[order], order.astype(np.int64), made
        # A merge whose parts are made by earlier merges can be applied to all
        # its occurrences in a sequence at once; otherwise one at a time.
        born = {}
        for r, (a, b) in enumerate(merges):
            born.setdefault(a + b, r)
        self.ordered = all(born.get(a, -1) < r and born.get(b, -1) < r for r, (a, b) in enumerate(merges))

    def _rank(self, code: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.ranks[at], NO_RANK)

    def _long(self, word: bytes) -> int:
        """Symbols left of one long sequence. The same rounds as in
        :meth:`counts`, but ranks are kept: positions wait in one bucket per
        rank, and a merge looks up the two pairs beside it only. (Merges are in
        order of birth here, so a new pair never ranks below the round's own.)"""
        raw = np.frombuffer(word, np.uint8)
        n = len(raw)
        sym = np.append(self.plain[raw], 0)
        sym[n - 1] = self.last[raw[-1]]
        nxt, prv = np.arange(1, n + 2), np.arange(-1, n)  # n: the place behind the last symbol
        rank = np.full(n + 1, NO_RANK)
        buckets: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def offer(at):
            found = self._rank(sym[at] * self.base + sym[nxt[at]])
            rank[at] = found
            at, found = at[found < NO_RANK], found[found < NO_RANK]
            order = np.argsort(found, kind="stable")
            at, found = at[order], found[order]
            cuts = np.flatnonzero(np.diff(found)) + 1
            for r, part in zip(found[np.r_[0, cuts]].tolist() if len(found) else [], np.split(at, cuts)):
                if r not in buckets:
                    buckets[r] = []
                    heapq.heappush(queue, r)
                buckets[r].append(part)
        offer(np.arange(n - 1))
        left = n
        while queue:
            r = heapq.heappop(queue)
            at = np.unique(np.concatenate(buckets.pop(r)))
            at = at[rank[at] == r]
            if not len(at):
                continue
            # overlapping hits (a a a) count from the left: every second one of a run
            head = np.r_[True, nxt[at[:-1]] != at[1:]]
            lead = np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - lead) % 2 == 0]
            gone = nxt[at]
            sym[at] = self.made[r]
            rank[gone] = NO_RANK
            nxt[at] = nxt[gone]
            prv[nxt[at]] = at
            left -= len(at)
            rank[at] = NO_RANK
            before = prv[at]
            touched = np.unique(np.concatenate([at, before[before >= 0]]))
            offer(touched[nxt[touched] < n])
        return left

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Symbols left of each byte sequence (0 for an empty one)."""
        out = np.zeros(len(words), np.int64)
        size = np.fromiter(map(len, words), np.int64, len(words))
        if self.ordered and (size >= LONG_WORD).any():
            for i in np.flatnonzero(size >= LONG_WORD).tolist():
                out[i] = self._long(words[i])
            short = np.flatnonzero(size < LONG_WORD)
            out[short] = self.counts([words[i] for i in short.tolist()])
            return out
        ids = np.flatnonzero(size)
        if not len(ids):
            return out
        raw = np.frombuffer(b"".join(words), np.uint8)
        sym, size = self.plain[raw], size[ids]
        ends = np.cumsum(size) - 1
        sym[ends] = self.last[raw[ends]]
        while len(ids):
            start = np.cumsum(size) - size
            code = np.append(sym[:-1] * self.base + sym[1:], 0)
            code[start + size - 1] = -1  # no pair across sequences
            rank = self._rank(code)
            best = np.minimum.reduceat(rank, start)
            live = best < NO_RANK
            out[ids[~live]] = size[~live]
            owner = np.repeat(np.arange(len(ids)), size)
            hit = rank == np.where(live, best, -1)[owner]
            at = np.flatnonzero(hit)
            if self.ordered:
                # overlapping hits (a a a) count from the left: every second one of a run
                head = np.r_[True, np.diff(at) != 1] if len(at) else np.empty(0, bool)
                lead = np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - lead) % 2 == 0]
            else:
                at = at[np.r_[True, np.diff(owner[at]) != 0]] if len(at) else at
            sym[at] = self.made[rank[at]]
            keep = live[owner]
            keep[at + 1] = False
            size = (size - np.bincount(owner[at], minlength=len(ids)))[live]
            sym, ids = sym[keep], ids[live]
        return out


FIRST_TABLES = 0x370  # texts of characters below it need no more than the Latin part of the tables


@functools.cache
def _odd_characters(stop: int) -> tuple:
    """What Python's Unicode tables see otherwise than the library's, which may
    be older, in texts of characters below ``stop``: search functions for
    characters that compose or are ordered differently under NFC and for those
    that differ in lower case, and the library's lower case of the latter. All
    code points are compared, by themselves, beside a mark of the lowest and one
    of the highest class, and (composed ones) taken apart."""
    from tokenizers import normalizers
    nfc, lower = normalizers.NFC().normalize_str, normalizers.Lowercase().normalize_str
    chars = [chr(c) for c in range(0x80, stop) if not 0xD800 <= c < 0xE000]
    odd: set[str] = set()

    def compare(strings, owners):
        text = "\n".join(strings)
        for owner, a, b in zip(owners, nfc(text).split("\n"), unicodedata.normalize("NFC", text).split("\n")):
            if a != b:
                odd.update(owner)
    compare(chars, chars)
    marks = [c for c in chars if unicodedata.category(c) != "Co"]
    compare([f"a{c}\u0334" for c in marks], marks)
    compare([f"a\u0345{c}" for c in marks], marks)
    whole = [c for c in map(chr, range(0x80, 0x110000)) if unicodedata.decomposition(c)[:1] not in ("", "<")]
    apart = [unicodedata.normalize("NFD", c) for c in whole]
    made = [(c, a) for c, a in zip(whole, apart) if max(map(ord, a)) < stop]
    compare([a for _, a in made], [c + a[-1] for c, a in made])
    chars = sorted({*chars, *(c for c, _ in made)})
    table = {ord(c): a for c, a in zip(chars, lower("\n".join(chars)).split("\n")) if a != c.lower()}

    def search(found):
        return re.compile("[" + "".join(map(re.escape, sorted(found))) + "]" if found else "(?!)").search
    return search(odd), search(map(chr, table)) if table else search(()), table


class TextCounter:
    """Token counts of whole texts as the ``tokenizers`` library gives them for
    a file with NFC, white-space and lower-case normalisation, a split pattern
    and byte-level BPE with an end-of-word suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [s["type"] for s in spec["normalizer"]["normalizers"]]
        if steps != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"unexpected normaliser {steps}")
        model = spec["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self._merger = RankMerger(model["vocab"], merges, model["end_of_word_suffix"] or "")
        self._split = splitter(WORD_PATTERN)
        self._marks = tuple(t["content"] for t in spec["added_tokens"])
        self._cut = re.compile("|".join(map(re.escape, self._marks))).split
        self._known: dict[str, int] = {}
        self._old: dict[str, int] = {}
        from tokenizers import normalizers
        self._nfc = normalizers.NFC().normalize_str
        self._far = re.compile(f"[{chr(FIRST_TABLES)}-{chr(0x10FFFF)}]").search

    def _pieces(self, text: str) -> list[str]:
        if text.isascii():
            return self._split(text.lower())
        odd, odd_case, lower = _odd_characters(0x110000 if self._far(text) else FIRST_TABLES)
        text = self._nfc(text) if odd(text) else unicodedata.normalize("NFC", text)
        # per character, as the library does: no final-sigma rule
        if odd_case(text):
            text = "".join([lower[ord(c)] if ord(c) in lower else "σ" if c == "Σ" else c.lower() for c in text])
        else:
            text = text.replace("Σ", "σ").lower()
        return self._split(text)

    def counts(self, texts: list[str | None]) -> np.ndarray:
        marks = np.zeros(len(texts), np.int64)
        pieces = []
        for i, t in enumerate(texts):
            if t and any(m in t for m in self._marks):
                parts = self._cut(t)
                marks[i] = len(parts) - 1
                pieces.append(list(chain.from_iterable(map(self._pieces, parts))))
            else:
                pieces.append(self._pieces(t) if t else [])
        if len(self._known) > CACHE_WORDS // 2:  # two generations: words asked for again come back
            self._known, self._old = {}, self._known
        known, old = self._known, self._old
        new = set(chain.from_iterable(pieces)).difference(known)
        known.update([(w, old[w]) for w in new.intersection(old)])
        new = list(new.difference(known))
        long = {}
        for i in range(0, len(new), WORDS_AT_ONCE):
            part = new[i:i + WORDS_AT_ONCE]
            for w, n in zip(part, self._merger.counts([w.encode() for w in part]).tolist()):
                (known if len(w) <= CACHED_CHARS else long)[w] = n
        get = (lambda w: known[w] if w in known else long[w]) if long else known.__getitem__
        return marks + np.fromiter((sum(map(get, p)) for p in pieces), np.int64, len(pieces))


@functools.cache
def counter(path: str) -> TextCounter:
    """One instance per worker and file."""
    return TextCounter(path)


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048,
                 path: str | None = None) -> DataFrame:
    """Rows ``(id, n_bytes, n_tokens, over_limit)``, one per input row.

    Null and empty texts: 0 bytes, 0 tokens, within the limit. Null ids,
    repeated rows and ties stay as they are, one output row each. Other
    columns of ``docs`` are not read, so none can clash; an empty table gives
    an empty result. One pass over the texts, no shuffle.
    """
    path = path or vocabulary("word_bpe_49k.json")
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        count = counter(path).counts
        for b in with_slices(batches):
            texts = b.column(1).to_pylist()
            n = count(texts)
            size = [len(t.encode()) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(size, pa.int64()), pa.array(n), pa.array(n > limit)],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(
        run, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
