"""Pre-tokenisation and word caches for the public vocabulary files.

A text is cut by the vocabulary's own pattern, and each distinct piece is
encoded once per Python worker: pieces never merge across their borders, so the
ids of a text are the ids of its pieces in order. The cache holds at most
``CACHE_WORDS`` pieces in two generations (:class:`WordCache`); that bounds
memory and changes no result.
"""

from __future__ import annotations

import functools
import os
import re
import sys
from array import array
from codecs import charmap_decode

CACHE_WORDS = 600_000
CACHED_CHARS = 64  # longer pieces are encoded anew each time


class WordCache(dict):
    """``word -> make(word)`` with a bounded memory of two generations: when
    the young one holds half of ``size``, it becomes the old one and the old one
    goes (:meth:`turn`, between texts). Words asked for again come back from the
    old one, so frequent words stay. Words of over ``CACHED_CHARS`` characters
    are made anew each time."""

    def __init__(self, make, size: int = CACHE_WORDS):
        super().__init__()
        self._make, self._half, self._old = make, max(1, size // 2), {}

    def __missing__(self, word):
        made = self._old.get(word)
        if made is None:
            made = self._make(word)
        if len(word) <= CACHED_CHARS:
            self[word] = made
        return made

    def turn(self) -> None:
        if len(self) >= self._half:
            self._old = dict(self)
            self.clear()


def vocabulary(name: str) -> str:
    """Path of a vocabulary file of the installed ``public_tokenizers``."""
    import public_tokenizers
    return public_tokenizers.path(name)


@functools.cache
def _ranges(astral: bool) -> dict[str, str]:
    """Bodies of character classes for \\p{L}, \\p{N} and white space, as the
    tokenizers library's own pattern engine sees them (its Unicode tables may
    be older than Python's). ``re`` with such classes is far faster than the
    library's pre-tokeniser. Without ``astral`` only the basic plane is listed."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split
    chars = "".join(chr(c) for c in range(0x110000 if astral else 0x10000) if not 0xD800 <= c < 0xE000)
    out = {}
    for name, prop in (("L", r"\p{L}"), ("N", r"\p{N}"), ("S", r"\s")):
        hits = Split(Regex(prop + "+"), "removed", invert=True).pre_tokenize_str(chars)
        body = []
        for run, _ in hits:
            first, last = ord(run[0]), ord(run[-1])
            if first < 0xD800 <= last:  # the run passes over the surrogates
                body.append(f"\\U{first:08x}-\\U0000d7ff\\U0000e000-\\U{last:08x}")
            else:
                body.append(f"\\U{first:08x}-\\U{last:08x}")
        out[name] = "".join(body)
    return out


# The split patterns of the two vocabulary files.
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""


@functools.cache
def _compiled(pattern: str, astral: bool):
    r = _ranges(astral)
    body = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{r['S']}{r['L']}{r['N']}]")
    for name, prop in (("L", r"\p{L}"), ("N", r"\p{N}")):
        body = body.replace(f"[{prop}]", f"[{r[name]}]").replace(prop, f"[{r[name]}]")
    body = body.replace(r"\S", f"[^{r['S']}]").replace(r"\s", f"[{r['S']}]")
    return re.compile(body).findall


def splitter(pattern: str):
    """``text -> list of pieces`` by ``pattern``."""
    basic = _compiled(pattern, False)

    def split(text: str) -> list[str]:
        if text.isascii() or len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text):
            return basic(text)
        return _compiled(pattern, True)(text)
    return split


@functools.cache
def byte_alphabet() -> str:
    """The character that byte-level vocabularies use for each byte 0..255:
    printable Latin-1 bytes stand for themselves, the others are numbered on
    from U+0100."""
    keep = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return "".join(chr(b) if b in keep else chr(next(rest)) for b in range(256))


def rank_encoder(model: dict, special: set[int], tokenize):
    """``word -> ids`` of a byte-level BPE by merging whichever adjacent pair
    joins to the token of the lowest id (``tiktoken``), or None if that is not
    sure to be what the listed merges do.

    It is if ids ascend in merge order, each merge's parts are made by earlier
    merges, and each token's own text merges to that token alone. For then, if
    x and y stand side by side when all merges before token z = xy are done, they
    do so in the text of z by itself; but there the pair that z is listed with
    stands at that moment, so x, y is that pair."""
    import tiktoken
    vocab, merges = model["vocab"], [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    made = [vocab.get(a + b, -1) for a, b in merges]
    known = {vocab[c] for c in byte_alphabet()}
    for (a, b), z in zip(merges, made):
        if vocab.get(a) not in known or vocab.get(b) not in known or z in known:
            return None
        known.add(z)
    tokens = {t: i for t, i in vocab.items() if i not in special}
    if made != sorted(made) or min(made) < max(vocab[c] for c in byte_alphabet()) or known != set(tokens.values()):
        return None
    if any(len(x := tokenize(t)) != 1 or x[0].id != i for t, i in tokens.items()):
        return None
    value = {c: i for i, c in enumerate(byte_alphabet())}
    ranks = {bytes(value[c] for c in t): i for t, i in tokens.items()}
    return tiktoken.Encoding("own", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class ByteBpe:
    """Ids of whole texts by a byte-level BPE file of the ``tokenizers``
    library, with its default handling of special strings inside texts; with
    ``plain`` these are text like any other."""

    def __init__(self, path: str, plain: bool = False):
        import json

        import numpy as np
        from tokenizers import Tokenizer
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"]
        if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]:
            raise ValueError("a byte-level file without normaliser or prefix space is needed")
        self.size = tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2") if self.size <= 0xFFFF else np.dtype("<u4")
        special = {} if plain else {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = {s: np.array([i], self.dtype).tobytes() for s, i in special.items()}
        self._cut = re.compile("(" + "|".join(re.escape(s) for s in special) + ")").split if special else None
        self._marks = tuple(special)
        self._split = splitter(BYTE_PATTERN)
        if sys.byteorder != "little":
            raise ValueError("ids are held as little-endian numbers")
        alphabet, tokenize = byte_alphabet(), tokenizer.model.tokenize
        kind = "H" if self.dtype.itemsize == 2 else "I"

        def encoded(word):
            return array(kind, [t.id for t in tokenize(charmap_decode(word.encode(), "strict", alphabet)[0])]).tobytes()
        ranked = rank_encoder(spec["model"], {t["id"] for t in spec["added_tokens"]}, tokenize)
        # a short word by rank order, several times as fast; of long ones the library's own queue is faster
        self._words = WordCache(encoded if ranked is None else lambda w: array(kind, ranked(w)).tobytes()
                                if len(w) <= CACHED_CHARS else encoded(w))

    def ids(self, text: str | None):
        """The ids as a numpy array; a null text is empty."""
        import numpy as np
        if not text:
            return np.empty(0, self.dtype)
        self._words.turn()
        get = self._words.__getitem__
        if any(s in text for s in self._marks):
            raw = b"".join(self._special[p] if p in self._special else b"".join(map(get, self._split(p)))
                           for p in self._cut(text) if p)
        else:
            raw = b"".join(map(get, self._split(text)))
        return np.frombuffer(raw, self.dtype)


@functools.cache
def byte_bpe(path: str, plain: bool = False) -> ByteBpe:
    """One instance per worker and file."""
    return ByteBpe(path, plain)
