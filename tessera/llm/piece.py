"""Exact encoding and decoding for merge-type SentencePiece models.

Encoding is by backtracking, not by merging: an Aho-Corasick automaton gives the
longest token at each position; a token is accepted after the previous one only
if the pair is compatible, that is, if re-merging the two tokens' text alone
gives back exactly this pair. On a dead end the last token is taken back and
its position marked as failed in a bit field, so no position fails twice. A
token sequence whose neighbours are all compatible is the merge result (a merge
over a border would also happen in the pair alone), and there is only one.

Texts are cut where no token can span (before a blank that follows another
character, around characters that are in no token); distinct words are encoded
once per worker.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import math
import re
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import with_slices
from tessera.llm.vocab import WordCache, vocabulary

BLANK = "▁"
PAIRS = 1_000_000  # compatibility results held per worker; emptied when full


class PieceModel:
    """Ids of texts, and texts of ids, as the sentencepiece library gives them
    for a BPE model with byte fallback, identity normalisation and escaped
    blanks."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as proto
        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, kinds = model.normalizer_spec, proto.ModelProto.SentencePiece
        if (model.trainer_spec.model_type != proto.TrainerSpec.BPE or not model.trainer_spec.byte_fallback
                or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces):
            raise ValueError("a BPE model with byte fallback and identity normalisation is needed")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
            raise ValueError("user-defined or unused pieces are not supported")
        self.prefix, self.size = norm.add_dummy_prefix, len(model.pieces)
        self.id_of = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        self.score = {p.piece: p.score for p in model.pieces if p.type == kinds.NORMAL}
        self.byte_id = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        self._control = frozenset(i for i, p in enumerate(model.pieces) if p.type == kinds.CONTROL)
        self._byte_value = {i: b for b, i in self.byte_id.items()}
        self._bytes = [b"" if p.type == kinds.CONTROL else " ⁇ ".encode() if p.type == kinds.UNKNOWN
                       else p.piece.replace(BLANK, " ").encode() for p in model.pieces]
        for i, b in self._byte_value.items():
            self._bytes[i] = bytes([b])
        self._text = [b.decode("utf-8", "replace") for b in self._bytes]
        self._blank_first = [p.piece.startswith(BLANK) and p.type == kinds.NORMAL for p in model.pieces]
        if any(BLANK in p.lstrip(BLANK) for p in self.id_of):
            raise ValueError("a token spans a word border")
        self._automaton = ahocorasick.Automaton()
        for p in self.id_of:
            self._automaton.add_word(p, p)
        self._automaton.make_automaton()
        self._n_chars = [len(p.piece) for p in model.pieces]
        self._widest = max(map(len, self.id_of))
        self._chars = frozenset(p for p in self.id_of if len(p) == 1)
        self._piece = [p.piece for p in model.pieces]
        #: the longest token that is a proper prefix of a token, -1 for none
        self._shorter = [next((self.id_of[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in self.id_of), -1)
                         for p in self._piece]
        self._fits: dict[int, bool] = {}
        self._history: dict[str, tuple[list, list] | None] = {}
        self._words = WordCache(self._word)
        self._cut = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+").findall

    # --- merging, for pairs only
    def merged(self, text: str) -> list[str]:
        """Plain merging of ``text``: the best-scored adjacent pair first, the
        leftmost of equals."""
        return self._merge(list(text), None)

    def _merge(self, part: list[str], note) -> list[str]:
        nxt, prv = list(range(1, len(part) + 1)), list(range(-1, len(part) - 1))
        heap = []

        def offer(i):
            j = nxt[i] if i >= 0 else len(part)
            if i >= 0 and j < len(part):
                s = self.score.get(part[i] + part[j])
                if s is not None:
                    heapq.heappush(heap, (-s, i, part[i], part[j]))
        for i in range(len(part) - 1):
            offer(i)
        last = len(part) - 1
        while heap:
            s, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if part[i] != a or j >= len(part) or part[j] != b:
                continue
            part[i], part[j] = a + b, ""
            nxt[i] = nxt[j]
            if nxt[i] < len(part):
                prv[nxt[i]] = i
            if j == last:
                last = i
            if note:
                note(-s, part[0], part[last])
            offer(prv[i])
            offer(i)
        return [p for p in part if p]

    def _steps(self, token: str):
        """How merging builds ``token`` alone: the score of each merge, then
        one that is never reached; and the first and last symbol before each
        merge. None if merging its text does not give the token."""
        if token not in self._history:
            scores, first, last = [], [token[0]], [token[-1]]

            def note(score, left, right):
                scores.append(score)
                first.append(left)
                last.append(right)
            whole = len(self._merge(list(token), note)) == 1
            self._history[token] = (scores + [-math.inf], first, last) if whole else None
        return self._history[token]

    def _fit(self, a: int, b: int) -> bool:
        """Whether tokens ``a`` (-1 for none) and ``b`` may stand side by side:
        merging their joined text gives back exactly the two. Up to the first
        merge over the border both sides merge as they do alone, so their merges
        are replayed by score and only the pair at the border is looked up."""
        if len(self._fits) > PAIRS:
            self._fits.clear()
        ok = self._fits[a * self.size + b] = self._replayed(self._piece[a] if a >= 0 else "", self._piece[b])
        return ok

    def _replayed(self, a: str, b: str) -> bool:
        right = self._steps(b)
        if not a or right is None:
            return right is not None
        left = self._steps(a)
        if left is None:
            return False
        (score_a, _, last), (score_b, first, _), score, i, j = left, right, self.score.get, 0, 0
        while True:
            over, sa, sb = score(last[i] + first[j]), score_a[i], score_b[j]
            if over is not None and over > sa and over >= sb:  # of equal scores the leftmost merges first
                return False
            if sa >= sb:
                if sa == -math.inf:
                    return True
                i += 1
            else:
                j += 1

    def _longest(self, text: str) -> int:
        """The longest token that ``text`` begins with."""
        k = self._automaton.longest_prefix(text)
        while (token := self.id_of.get(text[:k])) is None:
            k -= 1  # what the trie holds need not be a token itself
        return token

    def _tokens(self, text: str) -> list[int]:
        """Backtracking over a text of known characters."""
        fits, shorter, longest, size, widest = self._fits, self._shorter, self._longest, self.size, self._widest
        chars, n = self._n_chars, len(text)
        failed = bytearray(n // 8 + 1)  # bit i: no encoding has a border at i
        out, at, last, token = [], 0, -1, longest(text[:widest])
        while True:
            row = last * size
            while token >= 0:
                end = at + chars[token]
                if not failed[end >> 3] >> (end & 7) & 1:
                    ok = fits.get(row + token)
                    if ok or ok is None and self._fit(last, token):
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                if end == n:
                    return out
                at, last, token = end, token, longest(text[end:end + widest])
            else:
                if not out:
                    raise ValueError(f"no encoding of {text!r}")
                failed[at >> 3] |= 1 << (at & 7)
                at -= chars[out[-1]]
                token = shorter[out.pop()]
                last = out[-1] if out else -1

    def _word(self, word: str) -> tuple[int, ...]:
        chars = self._chars
        if chars.issuperset(word):
            return tuple(self._tokens(word))
        out: list[int] = []
        for inside, run in groupby(word, chars.__contains__):
            run = "".join(run)
            # long runs (nothing to cut at) go through one bit field as well
            out.extend(self._tokens(run) if inside else [self.byte_id[b] for b in run.encode()])
        return tuple(out)

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        text = text.replace(" ", BLANK)
        self._words.turn()
        return list(chain.from_iterable(map(self._words.__getitem__, self._cut(BLANK + text if self.prefix else text))))

    def decode(self, ids: list[int]) -> str:
        """Text of ids: blanks unescaped, one leading blank dropped, byte
        tokens joined to characters (a byte that is in no whole character
        becomes U+FFFD)."""
        try:
            if not self._control.isdisjoint(ids):  # a control id ends a run of byte tokens
                text = self._decode_bytes(ids)
            else:
                text = b"".join(map(self._bytes.__getitem__, ids)).decode()
        except UnicodeDecodeError:
            text = self._decode_bytes(ids)
        first = next((i for i in ids if self._bytes[i]), None)
        return text[1:] if self.prefix and first is not None and self._blank_first[first] else text

    def _decode_bytes(self, ids: list[int]) -> str:
        out, held = [], bytearray()

        def flush():
            i = 0
            while i < len(held):
                for n in (1, 2, 3, 4):
                    try:
                        out.append(held[i:i + n].decode())
                        i += n
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    i += 1
            held.clear()
        for i in ids:
            if i in self._byte_value:
                held.append(self._byte_value[i])
            else:
                flush()
                out.append(self._text[i])
        flush()
        return "".join(out)


@functools.cache
def piece_model(path: str) -> PieceModel:
    """One instance per worker and file."""
    return PieceModel(path)


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                     with_text: bool = False) -> DataFrame:
    """Encode every whole text, then decode the ids: id, ``n_tokens``,
    ``ids_sha256``, ``decoded_sha256`` (and ``ids``, ``decoded``).

    Null and empty texts: no ids, empty text. Repeated rows and null ids give
    one output row each; only id and text are read, so other columns can't
    clash; an empty table gives no row. One pass, no shuffle.
    """
    path = path or vocabulary("piece_bpe_32k.model")
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * with_text

    def run(batches):
        m = piece_model(path)
        sha, decimal = hashlib.sha256, [str(i) for i in range(m.size)]
        for b in with_slices(batches, 256):
            n, h, d, ids_out, text_out = [], [], [], [], []
            for text in b.column(1).to_pylist():
                ids = m.encode(text)
                back = m.decode(ids)
                n.append(len(ids))
                h.append(sha(",".join([decimal[i] for i in ids]).encode()).hexdigest())
                d.append(sha(back.encode()).hexdigest())
                if with_text:
                    ids_out.append(ids)
                    text_out.append(back)
            arrays = [b.column(0), pa.array(n, pa.int64()), pa.array(h, pa.string()), pa.array(d, pa.string())]
            if with_text:
                arrays += [pa.array(ids_out, pa.list_(pa.int32())), pa.array(text_out, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(
        run, schema + ", ids array<int>, decoded string" * with_text)
