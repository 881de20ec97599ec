"""Toxicity by compression distance.

Two zstandard dictionaries are trained. That of ordinary text is trained by zstandard itself. That
of toxic text is the same with segments of toxic text in front, chosen as a cover: the character
n-grams that stand in far more toxic than ordinary documents, each grown to the segment that its
words share, taken by how many toxic occurrences they cover that no earlier one does. As the rest
is equal byte for byte, a window that compresses better with the toxic dictionary does so because
of such a segment and not by chance.

Windows are the words of a text, each between two marks that both dictionaries hold, so that the
cost of a first match is paid and a match of four letters shows. The lengths saved in a document's
best windows and its size go through a logistic curve that is fitted on labelled documents held
back from the dictionaries; its threshold is set there too.

Defined results: null and empty texts and texts without a letter score as a text whose windows
save nothing. With no toxic or no ordinary label to learn from, every score is 0. Repeated rows
score alike; a key with several labels counts as toxic if one of them says so; null labels and
null keys teach nothing. Only the named columns are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeflow.llm.common import below, written

#: Labelled documents to learn from at most (chosen by a hash of the key), and the share of them
#: that is held back for the curve.
TOXIC_DOCS = 3000
ORDINARY_DOCS = 6000
#: Of the ordinary ones, as many train the ordinary dictionary at most.
DICTIONARY_DOCS = 2000
HELD_SHARE = 0.4
#: N-gram sizes; fewest toxic documents, least lift and least z of one that tells the classes apart.
GRAMS = (4, 5, 6, 8)
MIN_DOCS = 4
MIN_LIFT = 8.0
MIN_Z = 3.0
#: Largest sizes of the two parts of the dictionaries, and the zstandard level.
SEGMENTS = 400
ORDINARY_BYTES = 4096
LEVEL = 6
#: Least precision of the threshold on held documents.
MIN_PRECISION = 0.6
#: Distinct words whose result a task remembers.
MEMORY = 200_000

_MARK = b"\x01#mark>"
_TAIL = b"<tail#mark\x01"


def words_of(text) -> list[str]:
    return re.findall(r"[^\W\d_]+", text.lower()) if isinstance(text, str) else []


def grams_of(word: str) -> set[str]:
    w = f" {word} "
    return {w[i:i + n] for n in GRAMS for i in range(len(w) - n + 1)}


def cover(words: dict[str, int], grams: set[str]) -> list[str]:
    """Segments that cover the toxic words, the most telling first. ``words``: toxic documents
    that hold each word."""
    holds: dict[str, list[str]] = {}
    for w in words:
        for g in grams_of(w) & grams:
            holds.setdefault(g, []).append(w)
    left = dict(words)
    gain = {g: sum(words[w] for w in ws) for g, ws in holds.items()}
    out: list[str] = []
    while gain and len(out) < SEGMENTS:
        g = max(gain, key=lambda x: (gain[x], len(x), x))
        if gain[g] < MIN_DOCS:
            break
        own = [w for w in holds[g] if w in left]
        out.append(grown(g, {f" {w} ": left[w] for w in own}))
        for w in own:
            n = left.pop(w)
            for h in grams_of(w) & grams:
                gain[h] -= n
        gain.pop(g)
    return out


def grown(gram: str, words: dict[str, int]) -> str:
    """The gram with the letters on either side that most of its words share."""
    for side in (-1, 1):
        while True:
            nexts: Counter[str] = Counter()
            for w, n in words.items():
                at = w.find(gram)
                at = at - 1 if side < 0 else at + len(gram)
                nexts[w[at] if 0 <= at < len(w) else ""] += n
            letter, n = nexts.most_common(1)[0]
            if not letter or n < 0.8 * sum(nexts.values()):
                break
            gram = letter + gram if side < 0 else gram + letter
            words = {w: n for w, n in words.items() if gram in w}
    return gram


def dictionaries(segments: list[str], ordinary: list[bytes]) -> tuple[bytes, bytes]:
    """Contents of the toxic and the ordinary dictionary, of equal length."""
    try:
        base = zstandard.train_dictionary(ORDINARY_BYTES, ordinary, k=48, d=6).as_bytes()[-ORDINARY_BYTES * 3 // 4:]
    except zstandard.ZstdError:  # too few samples to train on
        base = b" ".join(ordinary)[-ORDINARY_BYTES * 3 // 4:]
    told = "\n".join(reversed(segments)).encode() + b"\n"
    end = base + _MARK + _TAIL
    return told + end, bytes(len(told)) + end


class Windows:
    """Bytes that the toxic dictionary saves on a window against the ordinary one."""

    def __init__(self, toxic: bytes, ordinary: bytes, told: int):
        def compressor(content: bytes) -> zstandard.ZstdCompressor:
            # matches have four bytes at least, see ``saved``
            p = zstandard.ZstdCompressionParameters.from_level(
                LEVEL, min_match=4, source_size=64, dict_size=len(content), write_checksum=False, write_content_size=False, write_dict_id=False)
            return zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=p)
        self.toxic, self.ordinary = compressor(toxic), compressor(ordinary)
        self.shared = {toxic[i:i + 4] for i in range(told - 3)}
        self.seen: dict[str, int] = {}

    def saved(self, word: str) -> int:
        out = self.seen.get(word)
        if out is None:
            b = b" " + word.encode() + b" "
            out = 0
            # without four bytes in common with the segments, both find the same matches
            if any(b[i:i + 4] in self.shared for i in range(len(b) - 3)):
                b = _MARK + b + _TAIL
                out = len(self.ordinary.compress(b)) - len(self.toxic.compress(b))
            if len(self.seen) >= MEMORY:
                self.seen.clear()
            self.seen[word] = out
        return out

    def features(self, text) -> tuple[float, float, float, float]:
        """Savings of the three best windows, and the logarithm of the number of words."""
        words = words_of(text)
        best = sorted((s for w in set(words) if (s := self.saved(w)) > 0), reverse=True)[:3]
        best += [0] * (3 - len(best))
        return best[0], best[1], best[2], float(np.log1p(len(words)))


def fitted(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centre, scale and weights of a logistic curve, the constant first, shifted so that 0.5 is
    the threshold with the best F1 of those with a precision of ``MIN_PRECISION`` or more."""
    centre, scale = x.mean(0), x.std(0) + 1e-9
    a = np.column_stack([np.ones(len(x)), (x - centre) / scale])
    w = np.zeros(a.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (y - p) - 0.1 * w
        h = (a * (p * (1 - p))[:, None]).T @ a + 0.1 * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    z = a @ w
    order = np.argsort(-z, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    last = np.append(z[order][1:] != z[order][:-1], True)  # a threshold falls between different values
    sure = last & (hits >= MIN_PRECISION * np.arange(1, len(y) + 1))
    if not sure.any():  # nothing tells the classes apart: no document is called toxic
        w[0] -= z.max() + 1
        return centre, scale, w
    k = int(np.argmax(np.where(sure, f1, -1)))
    lower = z[order][k + 1] if k + 1 < len(z) else z[order][k] - 1
    w[0] -= (z[order][k] + lower) / 2
    return centre, scale, w


def _gram_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    toxic: Counter[str] = Counter()
    ordinary: Counter[str] = Counter()

    def flush() -> pd.DataFrame:
        keys = [*toxic, *(g for g in ordinary if g not in toxic)]
        out = pd.DataFrame({"gram": pd.Series(keys, dtype=object), "toxic": pd.Series([toxic[g] for g in keys], dtype="int64"),
                            "ordinary": pd.Series([ordinary[g] for g in keys], dtype="int64")})
        toxic.clear()
        ordinary.clear()
        return out

    for batch in batches:
        for text, label in zip(batch["text"], batch["toxic"]):
            (toxic if label else ordinary).update(set().union(*map(grams_of, set(words_of(text)))))
            if len(toxic) + len(ordinary) > 500_000:
                yield flush()
    yield flush()


def confirmed(held: DataFrame, segments: list[str]) -> list[str]:
    """The segments that tell the classes apart on documents they weren't chosen from, too."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = np.zeros((len(segments) + 1, 2), np.int64)
        for batch in batches:
            for text, label in zip(batch["text"], batch["toxic"]):
                line = f" {'  '.join(words_of(text))} "
                found[:-1, label] += np.array([x in line for x in segments], np.int64)
                found[-1, label] += 1
        yield pd.DataFrame({"i": range(len(found)), "o": found[:, 0], "t": found[:, 1]})

    rows = held.select("text", "toxic").mapInPandas(count, "i int, o long, t long").groupBy("i").agg(F.sum("o").alias("o"), F.sum("t").alias("t")).collect()
    by = {r["i"]: (r["o"], r["t"]) for r in rows}
    n_o, n_t = by.get(len(segments), (0, 0))
    lift = {i: (t + 0.5) / (n_t + 1) / ((o + 0.5) / (n_o + 1)) for i, (o, t) in by.items()}
    return [x for i, x in enumerate(segments) if by[i][1] >= 2 and lift[i] >= MIN_LIFT / 2]


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          toxic_docs: int = TOXIC_DOCS, ordinary_docs: int = ORDINARY_DOCS) -> dict | None:
    """Dictionaries and curve as plain data, from a bounded sample of the labelled rows."""
    known = (labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
             .groupBy(F.col(key).alias("key")).agg(F.max(F.col(label).cast("int")).alias("toxic")))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return None
    wanted = F.when(F.col("toxic") == 1, below(F.col("key"), toxic_docs / sizes[1])).otherwise(below(F.col("key"), ordinary_docs / sizes[0]))
    # at most about toxic_docs + ordinary_docs rows of two numbers
    chosen = F.broadcast(known.filter(wanted))
    sample = (docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(chosen, "key").filter(F.col("text").isNotNull())
              .groupBy(F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic"))
              .withColumn("held", F.pmod(F.xxhash64("h", F.lit(3)), F.lit(1000)) < int(1000 * HELD_SHARE)))
    sample = written(sample.select("text", "toxic", "held"), "toxic-sample")
    teach = sample.filter(~F.col("held"))
    n = {r["toxic"]: r["n"] for r in teach.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return None
    counts = teach.select("text", "toxic").mapInPandas(_gram_counts, "gram string, toxic long, ordinary long").groupBy("gram").agg(
        F.sum("toxic").alias("t"), F.sum("ordinary").alias("o")).filter(F.col("t") >= MIN_DOCS)
    t, o = F.col("t") + 0.5, F.col("o") + 0.5
    lift = (t / (n[1] + 1)) / (o / (n[0] + 1))
    z = (F.log(t / (n[1] + 1 - t)) - F.log(o / (n[0] + 1 - o))) / F.sqrt(1 / t + 1 / o)
    grams = {r["gram"] for r in counts.filter((lift >= MIN_LIFT) & (z >= MIN_Z)).select("gram").collect()}

    def telling(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: Counter[str] = Counter()
        for batch in batches:
            for x in batch["text"]:
                found.update(w for w in set(words_of(x)) if not grams.isdisjoint(grams_of(w)))
        yield pd.DataFrame({"word": pd.Series(list(found), dtype=object), "n": pd.Series(list(found.values()), dtype="int64")})

    rows = teach.filter("toxic = 1").select("text").mapInPandas(telling, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    segments = confirmed(sample.filter("held"), cover({r["word"]: r["n"] for r in rows}, grams))
    plain = teach.filter("toxic = 0").select(F.lower("text").alias("t")).limit(DICTIONARY_DOCS).collect()
    toxic, ordinary = dictionaries(segments, [r["t"].encode() for r in plain])
    model = {"toxic": toxic, "ordinary": ordinary, "told": len("\n".join(segments).encode()), "segments": segments}
    held = sample.filter("held").select("toxic", features(sample.filter("held"), model, "text").alias("f")).select("toxic", "f.*").toPandas()
    y = held["toxic"].to_numpy(float)
    if not 0 < y.sum() < len(y):
        return None
    model["curve"] = fitted(held[["a", "b", "c", "size"]].to_numpy(float), y)
    return model


def features(docs: DataFrame, model: dict, text: str) -> Column:
    shared = docs.sparkSession.sparkContext.broadcast((model["toxic"], model["ordinary"], model["told"]))

    @F.pandas_udf("a double, b double, c double, size double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        windows = Windows(*shared.value)
        for batch in batches:
            yield pd.DataFrame([windows.features(t) for t in batch], columns=["a", "b", "c", "size"], dtype=float)

    return run(F.col(text))


def score(docs: DataFrame, model: dict | None, text: str = "text") -> Column:
    """Score from 0 to 1; 0.5 is the calibrated threshold."""
    if model is None:
        return F.lit(0.0)
    centre, scale, w = model["curve"]
    f = features(docs, model, text)
    z = F.lit(float(w[0]))
    for name, c, s, k in zip(("a", "b", "c", "size"), centre, scale, w[1:]):
        z = z + (f[name] - float(c)) * float(k / s)
    return 1 / (1 + F.exp(-z))
