"""Language identification with spans for mixed-language texts.

Every word gets a score for each learned language from hashed character n-grams. The
script of the word narrows the candidates first: a language that never used the script
in training is ruled out. A Viterbi pass over the words of a text, with a penalty for
each change of language, gives the labelling; runs of equal labels are the spans, and
the language with the most letters is that of the text.

Defined results: null text, empty text or a text without a letter gives ``und`` with
score 0 and no spans. Ties go to the language that is more frequent in training, then
to the smaller name. Nothing learned (empty or unlabelled table): every text is ``und``.
Repeated rows are labelled alike; other columns pass through untouched.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeflow.llm.common import BLOCK_CHARS, below, codepoints, restored, text_groups

UNKNOWN = "und"
#: N-gram orders and the number of hash buckets they share.
ORDERS = (1, 2, 3, 4)
BUCKETS = 1 << 17
#: Training documents taken per language (a bounded, hash-chosen sample).
DOCS_PER_LANG = 3000
#: Cost of a change of language between two words, in nats.
SWITCH_PENALTY = 12.0
#: A language may use a script that has this share of its training letters.
SCRIPT_SHARE = 0.001
GROUP_CHARS = 6 * BLOCK_CHARS

# Unicode script ranges (first and last code point).
SCRIPT_RANGES = [
    ("latin", 0x0041, 0x024F),
    ("ipa", 0x0250, 0x02FF),
    ("greek", 0x0370, 0x03FF),
    ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x077F),
    ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF),
    ("gurmukhi", 0x0A00, 0x0A7F),
    ("gujarati", 0x0A80, 0x0AFF),
    ("tamil", 0x0B80, 0x0BFF),
    ("telugu", 0x0C00, 0x0C7F),
    ("kannada", 0x0C80, 0x0CFF),
    ("malayalam", 0x0D00, 0x0D7F),
    ("thai", 0x0E00, 0x0E7F),
    ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF),
    ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x1F00, 0x1FFF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x4DBF),
    ("han", 0x4E00, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
    ("han", 0x20000, 0x323AF),
]
SCRIPTS = ["other", *dict.fromkeys(name for name, _, _ in SCRIPT_RANGES)]

_BOUNDARY = 1
#: Code points from here on are told by category: a letter is this entry (Han), a mark the next, all else the third.
_TABLE = 0x20000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0x100000001B3)


class Chars:
    """By code point: whether it is a letter or part of a word, its lower case, its script."""

    def __init__(self):
        n = _TABLE + 3
        self.letter = np.zeros(n, bool)
        self.word = np.zeros(n, bool)
        self.lower = np.arange(n, dtype=np.uint32)
        self.script = np.zeros(n, np.uint8)
        for c in range(_TABLE):
            ch = chr(c)
            if ch.isalpha():
                self.letter[c] = self.word[c] = True
                if len(low := ch.lower()) == 1 and ord(low) < _TABLE:
                    self.lower[c] = ord(low)
            elif unicodedata.category(ch)[0] == "M":
                self.word[c] = True
        self.letter[_TABLE] = self.word[_TABLE] = self.word[_TABLE + 1] = True
        for name, first, last in SCRIPT_RANGES:
            self.script[first:last + 1] = SCRIPTS.index(name)

    @staticmethod
    def points(text: str) -> np.ndarray:
        points = codepoints(text)
        above = points >= _TABLE
        if above.any():
            points = points.copy()
            found, at = np.unique(points[above], return_inverse=True)
            kinds = [unicodedata.category(chr(c))[0] for c in found.tolist()]
            points[above] = np.array([_TABLE + {"L": 0, "M": 1}.get(k, 2) for k in kinds], np.uint32)[at]
        return points

    def words(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end positions of the runs of word characters that hold a letter."""
        inside = np.zeros(len(points) + 2, np.int8)
        inside[1:-1] = self.word[points]
        edge = np.diff(inside)
        first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if len(first):
            seen = np.concatenate([[0], np.cumsum(self.letter[points])])
            keep = seen[end] > seen[first]
            first, end = first[keep], end[keep]
        return first, end

    def folded(self, points: np.ndarray) -> np.ndarray:
        """Lower case with one boundary code for all that is not part of a word, and one more
        boundary at either end."""
        out = np.full(len(points) + 2, _BOUNDARY, np.uint32)
        out[1:-1] = np.where(self.word[points], self.lower[points], _BOUNDARY)
        return out

    def blocks(self, points: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
        """Ranges of at most about ``most`` positions that end outside words, if there is such a
        place within the next ``most`` positions."""
        at = 0
        while at < len(points):
            end = min(len(points), at + most)
            if end < len(points):
                gap = np.flatnonzero(~self.word[points[end:end + most]])
                end += int(gap[0]) + 1 if len(gap) else 0
            yield at, end
            at = end


def _buckets(a: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the gram of ``order`` that ends at each position of ``a`` and whether it is
    one: boundaries may stand at its ends only, and a letter has to be in it."""
    n = len(a)
    h = np.zeros(n, np.uint64)
    ok = np.ones(n, bool)
    some = np.zeros(n, bool)
    for back in range(order - 1, -1, -1):
        part = a[:n - back] if back else a
        h[back:] = (h[back:] + part.astype(np.uint64)) * _STEP
        is_letter = part != _BOUNDARY
        if 0 < back < order - 1:
            ok[back:] &= is_letter
        some[back:] |= is_letter
    ok[:order - 1] = False
    h += np.uint64(order)
    return ((h * _MIX) >> np.uint64(64 - 17)).astype(np.int64), ok & some


class LanguageModel:
    """Log-odds of hashed n-grams per language, script sets and the prior."""

    def __init__(self, langs: list[str], counts: np.ndarray, scripts: np.ndarray, docs: np.ndarray):
        self.langs = langs
        self.chars = vars(Chars())
        smooth = 0.5
        p = (counts + smooth) / (counts.sum(0, keepdims=True) + smooth * len(counts))
        logs = np.log(p)
        self.table = (logs - logs.mean(1, keepdims=True)).astype(np.float32)
        share = scripts / np.maximum(1, scripts.sum(0, keepdims=True))
        self.allowed = share >= SCRIPT_SHARE
        self.known = self.allowed.any(1)
        self.prior = np.log((docs + 1) / (docs.sum() + len(docs))).astype(np.float32)

    def word_scores(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and end position and the scores by language of every word."""
        chars = restored(Chars, self.chars)
        starts, ends, scores = [], [], []
        for at, stop in chars.blocks(points, max(4096, 4 * BLOCK_CHARS // max(4, len(self.langs)))):
            part = points[at:stop]
            first, end = chars.words(part)
            if not len(first):
                continue
            a = chars.folded(part)
            total = np.zeros((len(a), len(self.langs)), np.float32)
            for order in ORDERS:
                bucket, ok = _buckets(a, order)
                where = np.flatnonzero(ok)
                total[where] += self.table[bucket[where]]
            # positions of ``a`` are one further; a word's sum includes the boundary after it
            cuts = np.stack([first + 1, end + 2], 1).ravel()
            cuts = cuts[:-1] if cuts[-1] >= len(total) else cuts
            s = np.add.reduceat(total, cuts, axis=0)[::2]
            kind = chars.script[part[first]]
            s[~self.known[kind]] = 0
            narrowed = self.known[kind][:, None] & ~self.allowed[kind]
            s[narrowed] -= 1e4
            starts.append(first + at)
            ends.append(end + at)
            scores.append(s)
        if not starts:
            none = np.zeros(0, np.int64)
            return none, none, np.zeros((0, len(self.langs)), np.float32)
        return np.concatenate(starts), np.concatenate(ends), np.concatenate(scores)

    def viterbi(self, scores: np.ndarray, begins: np.ndarray, counts: np.ndarray, penalty: float) -> np.ndarray:
        """Label of every word. Text d has the ``counts[d]`` words from ``begins[d]``; all texts
        take a step together, the longest first, so that the texts still running are a prefix."""
        order = np.argsort(-counts, kind="stable")
        begins, counts = begins[order], counts[order]
        labels = np.zeros(len(scores), np.int16)
        steps = int(counts[0]) if len(counts) else 0
        if not steps:
            return labels
        running = np.searchsorted(-counts, -np.arange(steps), side="left")  # texts with more than t words
        v = self.prior + scores[begins[:running[0]]]
        stay = np.ones(scores.shape, bool)
        came = np.zeros(len(scores), np.int16)
        final = np.zeros(len(counts), np.int16)
        for t in range(1, steps + 1):
            n = running[t] if t < steps else 0
            if n < len(v):
                final[n:len(v)] = v[n:].argmax(1)
                v = v[:n]
            if not n:
                break
            at = begins[:n] + t
            best = v.argmax(1)
            jump = v[np.arange(n), best] - penalty
            keeps = v >= jump[:, None]
            stay[at] = keeps
            came[at] = best
            v = np.where(keeps, v, jump[:, None]) + scores[at]
        now = final
        for t in range(steps - 1, -1, -1):
            n = running[t]
            at = begins[:n] + t
            cur = now[:n]
            labels[at] = cur
            now[:n] = np.where(stay[at, cur], cur, came[at])
        return labels

    def label(self, texts: list[str], penalty: float = SWITCH_PENALTY, spans: bool = False) -> pd.DataFrame:
        """Language, score and number of spans of each text, and the spans if asked for."""
        rows: list[tuple] = []
        for begin, stop in text_groups(texts, GROUP_CHARS):
            group = texts[begin:stop]
            points = Chars.points("\n".join(group) + "\n")
            sizes = np.array([len(t) for t in group]) + 1
            offset = np.concatenate([[0], np.cumsum(sizes)])
            first, end, scores = self.word_scores(points)
            begins = np.searchsorted(first, offset[:-1])
            counts = np.searchsorted(first, offset[1:]) - begins
            labels = self.viterbi(scores, begins, counts, penalty)
            doc = np.repeat(np.arange(len(group)), counts)
            letters = np.zeros((len(group), len(self.langs)))
            np.add.at(letters, (doc, labels), end - first)
            best = (letters + self.prior * 1e-9).argmax(1)
            total = letters.sum(1)
            share = letters[np.arange(len(group)), best] / np.maximum(total, 1)
            new = np.ones(len(labels), bool)
            new[1:] = (labels[1:] != labels[:-1]) | (doc[1:] != doc[:-1])
            n_spans = np.bincount(doc[new], minlength=len(group))
            for d in range(len(group)):
                found = None
                if spans:
                    w = slice(begins[d], begins[d] + counts[d])
                    head = np.flatnonzero(new[w])
                    tail = np.append(head[1:], counts[d]) - 1
                    found = [
                        {"start": int(first[w][i] - offset[d]), "end": int(end[w][j] - offset[d]), "lang": self.langs[labels[w][i]]}
                        for i, j in zip(head, tail)
                    ]
                if total[d]:
                    rows.append((self.langs[best[d]], float(share[d]), int(n_spans[d]), found))
                else:
                    rows.append((UNKNOWN, 0.0, 0, found))
        return pd.DataFrame(rows, columns=["lang_pred", "score", "n_spans", "spans"])


def train(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
          docs_per_lang: int = DOCS_PER_LANG) -> LanguageModel | None:
    """Fit on at most about ``docs_per_lang`` documents of each language, chosen by a hash of the
    key. The driver gets the bucket counts only, whose number is fixed by ``BUCKETS``."""
    labelled = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).alias("l")).filter(
        F.col("l").isNotNull() & F.col("t").isNotNull())
    sizes = {r["l"]: r["n"] for r in labelled.groupBy("l").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    chosen = None
    for name, n in sorted(sizes.items()):
        cond = (F.col("l") == name) & below(F.col("k"), docs_per_lang / n)
        chosen = cond if chosen is None else chosen | cond
    langs = sorted(sizes)
    number = {name: i for i, name in enumerate(langs)}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chars = Chars()
        grams: dict[int, np.ndarray] = {}
        scripts: dict[int, np.ndarray] = {}
        for batch in batches:
            for name, group in batch.groupby("l"):
                i = number[name]
                g = grams.setdefault(i, np.zeros(BUCKETS, np.int64))
                s = scripts.setdefault(i, np.zeros(len(SCRIPTS), np.int64))
                texts = group["t"].tolist()
                for begin, stop in text_groups(texts, BLOCK_CHARS):
                    points = Chars.points("\n".join(texts[begin:stop]))
                    for at, end in chars.blocks(points, BLOCK_CHARS):
                        a = chars.folded(points[at:end])
                        for order in ORDERS:
                            bucket, ok = _buckets(a, order)
                            g += np.bincount(bucket[ok], minlength=BUCKETS)
                        part = points[at:end]
                        s += np.bincount(chars.script[part[chars.letter[part]]], minlength=len(SCRIPTS))
        for i, g in grams.items():
            at = np.flatnonzero(g)
            yield pd.DataFrame({"lang": i, "bucket": at, "n": g[at]})
            s = scripts[i]
            yield pd.DataFrame({"lang": i, "bucket": -1 - np.arange(len(s)), "n": s})

    found = (labelled.filter(chosen).select("t", "l").mapInPandas(count, "lang int, bucket int, n long")
             .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    counts = np.zeros((BUCKETS, len(langs)))
    scripts = np.zeros((len(SCRIPTS), len(langs)))
    b = found["bucket"].to_numpy()
    l, n = found["lang"].to_numpy(), found["n"].to_numpy()
    counts[b[b >= 0], l[b >= 0]] = n[b >= 0]
    scripts[-1 - b[b < 0], l[b < 0]] = n[b < 0]
    return LanguageModel(langs, counts, scripts, np.array([sizes[x] for x in langs], float))


def label(docs: DataFrame, model: LanguageModel | None, text: str = "text",
          penalty: float = SWITCH_PENALTY, spans: bool = False) -> Column:
    """A struct column (lang_pred, score, n_spans, and spans if asked for) for ``docs``."""
    kind = "lang_pred string, score double, n_spans int" + ", spans array<struct<start:int,end:int,lang:string>>" * spans
    shared = docs.sparkSession.sparkContext.broadcast(None if model is None else vars(model))

    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = None if shared.value is None else restored(LanguageModel, shared.value)
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch]
            if m is None:
                out = pd.DataFrame({"lang_pred": [UNKNOWN] * len(texts), "score": 0.0, "n_spans": 0, "spans": [[]] * len(texts)})
            else:
                out = m.label(texts, penalty, spans)
            yield out if spans else out.drop(columns="spans")

    return run(F.col(text))
