"""SentencePiece encoding and decoding over a trie of words.

The distinct marked words of many texts (each a run of blanks with what follows it) are sorted, so
that equal beginnings stand together: a trie, walked depth first. Each letter on the way extends
the walks through the trie of pieces that are still open and gives one forward state; a word shares
the states of the letters it has in common with the word before it.

What a forward state is depends on the kind of model. For a unigram model it is the best score up
to there and the piece that ends there (Viterbi). A BPE model's scores are merge ranks, whose sums
mean nothing, so Viterbi over scores would not give its encodings. There the state is the last
piece of the encoding of the letters so far. It is the one piece for which the state it starts from
and itself stay apart when merged alone: an encoding is right exactly if each two neighbours are.
Both equal the encodings of the public library.

Defined results: a null text has null ids, an empty one none. Letters without a piece are spelled
in bytes where the model has byte pieces, else a run of them is one unknown piece. User-defined
pieces are not supported. Repeated rows are encoded alike.
"""

from __future__ import annotations

import codecs
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Letters of text handled together, and distinct words whose encoding a task remembers.
GROUP_CHARS = 1 << 21
MEMORY = 400_000
PAIRS = 400_000

# Kinds of model in the serialised form.
UNIGRAM, BPE = 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a serialised message."""
    def varint(at: int) -> tuple[int, int]:
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out, at
    at = 0
    while at < len(data):
        tag, at = varint(at)
        if tag & 7 == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if tag & 7 == 2 else ({1: 8, 5: 4}[tag & 7], at)
            value = data[at:at + size]
            at += size
        yield tag >> 3, value


def kind_of(model: bytes) -> int:
    kind = UNIGRAM
    for number, value in _fields(model):
        if number == 2:
            kind = next((v for n, v in _fields(value) if n == 3), kind)
    return kind


class Pieces:
    """A model's pieces, its trie, and the encoding of sorted words."""

    def __init__(self, model: bytes, splits: dict[int, tuple[int, int]] | None = None):
        self.library = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        self.kind = kind_of(model)
        self.unknown = sp.unk_id()
        self.text = [sp.id_to_piece(i) for i in range(n)]
        self.score = [sp.get_score(i) for i in range(n)]
        self.byte = {int(self.text[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        special = {i for i in range(n) if sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)}
        self.id = {self.text[i]: i for i in range(n) if i not in special}
        self.least = min((self.score[i] for i in self.id.values()), default=0.0) - 10.0
        self.pair: dict[int, bool] = {}
        #: by piece: the two pieces of its last merge. A piece of several letters without an entry
        #: is never reached by merging.
        self.splits = (self._splits() if self.kind == BPE else {}) if splits is None else splits
        self.rank = [-self.score[i] if i in self.splits else -1.0 for i in range(n)]
        root: dict = {}
        for text, i in self.id.items():
            if self.kind != BPE or len(text) == 1 or i in self.splits:
                node = root
                for c in text:
                    node = node.setdefault(c, {})
                node[""] = i

        def sealed(node: dict) -> tuple[dict, int]:
            return {c: sealed(below) for c, below in node.items() if c}, node.get("", -1)
        #: by letter: the trie below it and the piece that ends with it, or -1
        self.root = sealed(root)[0]
        # no piece reaches over the end of a word, else a text is one word
        apart = not any(re.search(f"[^{MARK}]{MARK}", t) for t in self.id)
        self.words = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+" if apart else "(?s).+").findall
        self.seen: dict[str, tuple[bytes, bytes]] = {}
        self.raw = [bytes([int(t[3:5], 16)]) if i in set(self.byte.values()) else b"" if sp.is_control(i) else
                    " ⁇ ".encode() if sp.is_unknown(i) else t.replace(MARK, " ").encode() for i, t in enumerate(self.text)]

    def merged(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """Byte-pair merges of a short text, the best-ranked pair first, of equal ones the leftmost;
        and the last pair merged."""
        parts = list(text)
        last = None
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                j = self.id.get(parts[i] + parts[i + 1])
                if j is not None and (best is None or self.score[j] > best):
                    best, at = self.score[j], i
            if at < 0:
                break
            last = parts[at], parts[at + 1]
            parts[at:at + 2] = ["".join(last)]
        return parts, last

    def _splits(self) -> dict[int, tuple[int, int]]:
        out = {}
        for text, i in self.id.items():
            if len(text) > 1:
                parts, last = self.merged(text)
                if parts == [text]:
                    out[i] = self.id[last[0]], self.id[last[1]]
        return out

    def stays(self, a: int, b: int) -> bool:
        """Whether the pieces a and b next to one another are as merging leaves them: taking their
        merges back from the last on, no pair across the border may have come before."""
        key = a * len(self.text) + b
        out = self.pair.get(key)
        if out is None:
            if len(self.pair) >= PAIRS:
                self.pair.clear()
            out = self.pair[key] = self._stays(a, b)
        return out

    def _stays(self, a: int, b: int) -> bool:
        text, rank, splits = self.text, self.rank, self.splits
        before = float("inf")
        while True:
            across = self.id.get(text[a] + text[b])
            if across is not None and -self.score[across] < before:
                return False
            if rank[a] > rank[b]:
                before = rank[a]
                a = splits[a][1]
            elif b in splits:
                before = rank[b] + 0.5  # of two equal merges the left one comes first
                b = splits[b][0]
            else:
                return True

    def encode_sorted(self, words: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
        """Ids of each word; ``words`` are sorted and distinct."""
        grow = self._grow_bpe if self.kind == BPE else self._grow_unigram
        before = ""
        # by number of letters: the open walks (trie below, start), and the state: what the next
        # step needs (last piece or score), the piece that ends there and where it starts
        walks: list[list] = [[]]
        heads: list = [-1 if self.kind == BPE else 0.0]
        picks: list[tuple[int, int]] = [(-1, 0)]
        for word in words:
            same = 0
            for x, y in zip(before, word):
                if x != y:
                    break
                same += 1
            del walks[same + 1:], heads[same + 1:], picks[same + 1:]
            before = word
            grow(word, same, walks, heads, picks)
            yield word, self._back(word, picks)

    def _grow_bpe(self, word: str, same: int, walks: list, heads: list, picks: list) -> None:
        first, pair, n = self.root, self.pair, len(self.text)
        for d in range(same, len(word)):
            c = word[d]
            going = []
            piece, begin = -1, d
            for trie, start in walks[d]:
                step = trie.get(c)
                if step is not None:
                    going.append((step[0], start))
                    if piece < 0 and step[1] >= 0:
                        last, end = heads[start], step[1]
                        stays = True if last < 0 else pair.get(last * n + end)
                        if stays is None:
                            stays = self.stays(last, end)
                        if stays:
                            piece, begin = end, start
            step = first.get(c)
            if step is not None:
                going.append((step[0], d))
                if piece < 0 and step[1] >= 0:
                    last, end = heads[d], step[1]
                    if last < 0 or self.stays(last, end):
                        piece = end
            walks.append(going)
            heads.append(piece)
            picks.append((self.unknown if piece < 0 else piece, begin))

    def _grow_unigram(self, word: str, same: int, walks: list, heads: list, picks: list) -> None:
        first, score = self.root, self.score
        for d in range(same, len(word)):
            c = word[d]
            going = []
            best, piece, begin = None, self.unknown, d
            for trie, start in (*walks[d], (first, d)):
                step = trie.get(c)
                if step is not None:
                    going.append((step[0], start))
                    if step[1] >= 0:
                        s = heads[start] + score[step[1]]
                        if best is None or s > best:
                            best, piece, begin = s, step[1], start
            own = first.get(c)
            if own is None or own[1] < 0:
                # a letter without a piece of its own can always be unknown
                s = heads[d] + self.least
                if best is None or s > best:
                    best, piece, begin = s, self.unknown, d
            walks.append(going)
            heads.append(best)
            picks.append((piece, begin))

    def _back(self, word: str, picks: list[tuple[int, int]]) -> list[int]:
        out: list[int] = []
        end = len(word)
        while end:
            piece, start = picks[end]
            if piece != self.unknown:
                out.append(piece)
            elif self.byte:
                out.extend(self.byte[b] for b in reversed(word[start:end].encode()))
            elif not out or out[-1] != self.unknown:
                out.append(piece)
            end = start
        out.reverse()
        return out

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, bytes]]:
        """Ids of each text, and the bytes that they stand for."""
        split = [self.words(t) for t in self.library.normalize(texts)] if texts else []
        seen, raw = self.seen, self.raw
        new = sorted({w for ws in split for w in ws if w not in seen})
        # too many to remember are kept for this group only
        found = seen if len(seen) + len(new) <= MEMORY else {}
        for word, ids in self.encode_sorted(new):
            found[word] = array("i", ids).tobytes(), b"".join([raw[i] for i in ids])
        out = []
        for ws in split:
            parts = [seen.get(w) or found[w] for w in ws]
            out.append((np.frombuffer(b"".join([i for i, _ in parts]), np.int32), b"".join([r for _, r in parts])))
        return out

    @staticmethod
    def text_of(raw: bytes) -> str:
        out = raw.decode("utf-8", "each byte")
        return out[1:] if out.startswith(" ") else out

    def decode(self, ids: Iterable[int]) -> str:
        raw = self.raw
        return self.text_of(b"".join([raw[i] for i in ids]))


def _each_byte(e: UnicodeError) -> tuple[str, int]:
    return "�" * (e.end - e.start), e.end


def shared_pieces(docs: DataFrame, model: bytes):
    """Gives a task the model's pieces. They are kept with the broadcast value, so a worker builds
    them once and goes on with what it remembers."""
    shared = docs.sparkSession.sparkContext.broadcast({"model": model, "splits": Pieces(model).splits})

    def get() -> Pieces:
        codecs.register_error("each byte", _each_byte)
        state = shared.value
        if "pieces" not in state:
            state["pieces"] = Pieces(state["model"], state["splits"])
        return state["pieces"]

    return get


def encode(docs: DataFrame, model: bytes, text: str = "text") -> Column:
    """Struct (ids, lossless): the piece ids of ``text``, and whether decoding them gives it back."""
    get = shared_pieces(docs, model)

    @F.pandas_udf("ids array<int>, lossless boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        pieces = get()
        for batch in batches:
            at = 0
            while at < len(batch):
                stop, size = at, 0
                while stop < len(batch) and (stop == at or size < GROUP_CHARS):
                    size += len(batch.iloc[stop] or "")
                    stop += 1
                texts = [t if isinstance(t, str) else None for t in batch.iloc[at:stop]]
                coded = pieces.encode([t or "" for t in texts])
                # a group leaves the task before the next is encoded
                yield pd.DataFrame({
                    "ids": [None if t is None else i for t, (i, _) in zip(texts, coded)],
                    "lossless": pd.array([None if t is None else pieces.text_of(raw) == t for t, (_, raw) in zip(texts, coded)], "boolean")})
                at = stop

    return run(F.col(text))


def decode(docs: DataFrame, model: bytes, ids: str = "ids") -> Column:
    """The text of piece ids; null for null."""
    get = shared_pieces(docs, model)

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pieces = get()
        for batch in batches:
            yield pd.Series([None if i is None else pieces.decode(i) for i in batch], dtype=object)

    return run(F.col(ids))
