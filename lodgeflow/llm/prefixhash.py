"""Document fingerprints from prefix polynomial hashes.

``Prefixes`` holds a text's modular prefix arrays: ``P[i] = sum of (c[j] + 1) * B**j, j < i`` modulo
the prime 2**31 - 1, for two bases. Any span's hash follows from two entries, so spans of any texts
are compared without reading them (``hashes``, ``equal``), the longest common extension of two places
is found by binary search (``common``), and the hash of texts joined together follows from theirs
(``joined``). Two spans of n characters that differ hash alike with probability (n / 2**31)**2 at most.

A fingerprint is the hash of the whole text (16 hexadecimal digits) and a sketch of its spans of
``SPAN`` code points: they are dealt by hash to ``BUCKETS`` buckets, of which each shows the low
16 bits of its smallest hash (4 digits; dashes where it has none). Equal buckets estimate the share
s of common spans, of all that either text has; ``likeness`` is ``2 s / (1 + s)``, the share of common
spans in a text if both have as many. Equal texts have equal fingerprints and likeness 1.

``fingerprints`` reads every text with the next in descending order of the key. Texts are sorted by
range, once; a task reads its range in order and holds two texts at a time. Each range's last text
meets the next range's first one in a second pass over these few rows. The edited text, the own first
half and the beginning of the next, gets its fingerprint from the arrays of the two, not from its
characters.

Defined results: a null text is an empty one, whose sketch is dashes; texts of fewer than ``SPAN``
characters are one span. Null keys come last. Rows with one key are ordered by the hash of their text,
then their place in the input; a table of one row has itself as the next. Bytes that aren't UTF-8 count
as U+FFFD. Other columns are not read. An empty table has no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeflow.llm.common import codepoints, written

#: Code points of a span; buckets of a sketch.
SPAN = 16
BUCKETS = 64
PRIME = (1 << 31) - 1
#: Two bases, drawn at random once and fixed since, so that fingerprints can be kept.
BASES = (1_284_073_551, 722_519_803)
#: Entries of the tables of powers; longer texts take them block by block.
_BLOCK = 1 << 16
_NONE = -1


def _mod(x: np.ndarray) -> np.ndarray:
    """``x`` modulo ``PRIME``, for x under 2**62."""
    x = (x & PRIME) + (x >> 31)
    x = (x & PRIME) + (x >> 31)
    return np.where(x >= PRIME, x - PRIME, x)


def _powers(base: int) -> np.ndarray:
    out = np.ones(1, np.int64)
    while len(out) < _BLOCK:
        out = np.concatenate([out, _mod(out * pow(base, len(out), PRIME))])
    return out


_TABLES: dict[int, np.ndarray] = {}


def _scaled(values: np.ndarray, base: int, begin: int = 0) -> np.ndarray:
    """``values[j] * base**(begin + j)`` modulo ``PRIME``."""
    if base not in _TABLES:
        _TABLES[base] = _powers(base)
    out = np.empty(len(values), np.int64)
    for i in range(0, len(values), _BLOCK):
        part = values[i:i + _BLOCK]
        part = _mod(part * _TABLES[base][:len(part)])
        shift = pow(base, begin + i, PRIME)
        out[i:i + _BLOCK] = part if shift == 1 else _mod(part * shift)
    return out


_INVERSE = tuple(pow(b, -1, PRIME) for b in BASES)


class Prefixes:
    """The prefix arrays of one text, given as code points."""

    def __init__(self, codes: np.ndarray):
        self.size = len(codes)
        values = codes.astype(np.int64) + 1
        self.sums = [np.concatenate([[0], _mod(np.cumsum(_scaled(values, b)))]) for b in BASES]

    def hash(self, begin: int, size: int) -> tuple[int, int]:
        """The hash of one span, as if it stood at the beginning of a text."""
        return tuple((int(p[begin + size]) - int(p[begin])) * pow(inv, begin, PRIME) % PRIME for p, inv in zip(self.sums, _INVERSE))

    def hashes(self, size: int) -> np.ndarray:
        """The hashes of all spans of ``size``, by their begin."""
        high, low = (_scaled(_mod(p[size:] - p[:len(p) - size] + PRIME), inv) for p, inv in zip(self.sums, _INVERSE))
        return (high << 31) | low

    def equal(self, begin: int, other: Prefixes, at: int, size: int) -> bool:
        """Whether the two spans of ``size`` are equal."""
        return begin + size <= self.size and at + size <= other.size and self.hash(begin, size) == other.hash(at, size)

    def common(self, begin: int, other: Prefixes, at: int) -> int:
        """The length of the longest common extension of the two places, by binary search."""
        low, high = 0, min(self.size - begin, other.size - at)
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if self.equal(begin, other, at, middle) else (low, middle - 1)
        return low


def joined(a: tuple[int, int], size: int, b: tuple[int, int]) -> tuple[int, int]:
    """The hash of a text of ``size`` code points with hash ``a``, followed by one with hash ``b``."""
    return tuple((x + y * pow(base, size, PRIME)) % PRIME for x, y, base in zip(a, b, BASES))


def _sketch(spans: np.ndarray) -> np.ndarray:
    """The low bits of each bucket's smallest hash; ``_NONE`` for a bucket without one."""
    smallest = np.full(BUCKETS, np.iinfo(np.int64).max)
    few = spans
    if len(spans) > 64 * BUCKETS:
        # the small hashes alone have all minima unless a bucket has none of them
        few = spans[(spans // BUCKETS) < (1 << 62) // len(spans) * 16]
    np.minimum.at(smallest, few % BUCKETS, few // BUCKETS)
    if few is not spans and (smallest == np.iinfo(np.int64).max).any():
        np.minimum.at(smallest, spans % BUCKETS, spans // BUCKETS)
    return np.where(smallest == np.iinfo(np.int64).max, _NONE, smallest & 0xFFFF)


def _shown(whole: tuple[int, int], sketch: np.ndarray) -> str:
    return f"{whole[0] << 31 | whole[1]:016x}" + "".join("----" if x < 0 else f"{x:04x}" for x in sketch.tolist())


def likeness(a: str, b: str) -> float:
    """Likeness of two fingerprints, 0 to 1; 1 for equal texts only."""
    if a[:16] == b[:16]:
        return 1.0
    x, y = ([f[i:i + 4] for i in range(16, len(f), 4)] for f in (a, b))
    used = sum(1 for p, q in zip(x, y) if p != "----" or q != "----")
    same = sum(1 for p, q in zip(x, y) if p == q != "----")
    if not used or not same:
        return 0.0
    share = min(same, used - 0.5) / used
    return 2 * share / (1 + share)


class Text:
    """A text with its arrays and fingerprint."""

    def __init__(self, text: str):
        self.text = text
        self.codes = codepoints(text)
        self.prefixes = Prefixes(self.codes)
        n = self.prefixes.size
        self.spans = self.prefixes.hashes(min(SPAN, n)) if n else np.zeros(0, np.int64)
        self.whole = self.prefixes.hash(0, n)
        self.fingerprint = _shown(self.whole, _sketch(self.spans))

    def edited(self, other: Text) -> dict:
        """The text with its last ``floor(n / 2)`` code points replaced by the first as many of ``other``."""
        n = self.prefixes.size
        head = n - n // 2
        tail = min(n // 2, other.prefixes.size)
        text = self.text[:head] + other.text[:tail]
        whole = joined(self.prefixes.hash(0, head), head, other.prefixes.hash(0, tail))
        size = head + tail
        if size < SPAN or min(n, other.prefixes.size) < SPAN:
            # a text without full spans: its spans are no spans of the result
            codes = Prefixes(np.concatenate([self.codes[:head], other.codes[:tail]]))
            spans = codes.hashes(min(SPAN, size)) if size else np.zeros(0, np.int64)
        else:
            seam = np.concatenate([self.codes[max(0, head - SPAN + 1):head], other.codes[:min(tail, SPAN - 1)]])
            across = Prefixes(seam).hashes(SPAN) if len(seam) >= SPAN else np.zeros(0, np.int64)
            spans = np.concatenate([self.spans[:max(0, head - SPAN + 1)], across, other.spans[:max(0, tail - SPAN + 1)]])
        shown = _shown(whole, _sketch(spans))
        # behind its own half the edited text goes on as the other begins
        shared = head + min(tail, self.prefixes.common(head, other.prefixes, 0))
        return {"n_chars": n, "edited_sha256": hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(),
                "fingerprint": self.fingerprint, "edited_fingerprint": shown, "near_edited": likeness(self.fingerprint, shown),
                "near_next": likeness(self.fingerprint, other.fingerprint), "common_edited": shared,
                "common_next": self.prefixes.common(0, other.prefixes, 0)}


_FIELDS = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, "
           "common_edited long, common_next long")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    common_edited, common_next): every text's fingerprint and that of its edited text, its likeness to
    the edited and to the next text, and how many code points each has in common with it from the
    beginning."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t"), F.xxhash64(text).alias("h"),
                       F.monotonically_increasing_id().alias("u"))
    order = [F.col("k").desc_nulls_last(), F.col("h"), F.col("u")]
    # the tasks are heavy for their bytes, so their number isn't left to these
    dealt = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order).select("k", "t")
    k_type = rows.schema["k"].dataType.simpleString()
    arrow_k = rows.select("k").limit(0).toArrow().schema[0].type
    out = pa.schema([("k", arrow_k), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                     ("near_edited", pa.float64()), ("near_next", pa.float64()), ("common_edited", pa.int64()), ("common_next", pa.int64()),
                     ("part", pa.int32()), ("first", pa.binary()), ("last", pa.binary())])

    def read(value) -> Text:
        return Text(value.as_py().decode("utf-8", "replace"))

    def in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), None
        for batch in batches:
            done = []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                now = read(t)
                if before is None:
                    done.append({"part": part, "first": t.as_py()})
                else:
                    done.append({"k": before[0]} | before[1].edited(now))
                before = k, now, t
            yield pa.RecordBatch.from_pylist(done, out)
        if before is not None:
            yield pa.RecordBatch.from_pylist([{"k": before[0], "part": part, "last": before[2].as_py()}], out)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2))
            yield pa.RecordBatch.from_pylist([{"k": k} | read(t).edited(read(u)) for k, t, u in rows], pa.schema(list(out)[:9]))

    found = written(dealt.mapInArrow(in_order, f"k {k_type}, {_FIELDS}, part int, first binary, last binary"), "fingerprints")
    # one number per range: as many as there are partitions
    parts = sorted(r["part"] for r in found.filter(F.col("first").isNotNull()).select("part").collect())
    after = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next int")
    firsts = found.filter(F.col("first").isNotNull()).select(F.col("part").alias("next"), F.col("first").alias("u"))
    edges = found.filter(F.col("last").isNotNull()).select("part", "k", "last").join(after, "part").join(firsts, "next").select("k", "last", "u")
    fields = [c.split()[0] for c in _FIELDS.split(", ")]
    inner = found.filter(F.col("part").isNull()).select("k", *fields)
    return inner.unionByName(edges.mapInArrow(pairs, f"k {k_type}, {_FIELDS}")).withColumnRenamed("k", key)


def span_equal(a: Column, begin: Column, b: Column, at: Column, size: Column) -> Column:
    """Whether the spans of ``size`` code points at ``begin`` of text ``a`` and at ``at`` of ``b`` are
    equal; false where one leaves its text, null where an argument is."""
    @F.pandas_udf("boolean")
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([None if any(map(pd.isna, row)) else min(row[1], row[3], row[4]) >= 0 and Prefixes(codepoints(row[0])).equal(
                int(row[1]), Prefixes(codepoints(row[2])), int(row[3]), int(row[4])) for row in zip(*batch)], dtype="object")

    return run(a, begin, b, at, size)


def common_extension(a: Column, begin: Column, b: Column, at: Column) -> Column:
    """How many code points text ``a`` from ``begin`` on and ``b`` from ``at`` on have in common; null
    where an argument is, or a place is outside its text."""
    @F.pandas_udf("long")
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for batch in batches:
            found = []
            for row in zip(*batch):
                if any(map(pd.isna, row)) or not (0 <= row[1] <= len(row[0]) and 0 <= row[3] <= len(row[2])):
                    found.append(None)
                else:
                    found.append(Prefixes(codepoints(row[0])).common(int(row[1]), Prefixes(codepoints(row[2])), int(row[3])))
            yield pd.Series(found, dtype="Int64")

    return run(a, begin, b, at)
