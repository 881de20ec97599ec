"""SimHash near-duplicates: fingerprints of word shingles, linked at few differing bits.

Fingerprints are joined by a hierarchical index in Gray order. Two fingerprints with at
most k differing bits agree in one of k + 1 blocks of bits, so each distinct fingerprint
is dealt to k + 1 top nodes (block, value of the block). Inside a top node the fingerprints
are sorted by Gray rank, which puts close bit patterns side by side; runs of them form the
leaves and runs of leaves the upper nodes, each keeping the bits that all below it share.
Two nodes are compared on the bits shared in both, and the whole pair of groups is dropped
when these already differ too often. A top node with more than ``GROUP_ROWS`` fingerprints
is cut in segments that are paired in tasks of their own, so no task holds an unbounded
group, and each task passes on a spanning forest of its links, not all pairs.

Defined results: null, empty and blank texts have fingerprint zero and are linked like any
other; fewer words than a shingle are one shingle; repeated rows share a fingerprint. A null
id never names a component unless all its members have null ids, and an empty table gives an
empty result. Only the key and the text are read, so further columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeflow.llm.common import written
from lodgeflow.llm.components import Union, connected_components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
#: Fingerprints of one top node handled in one task (two such segments meet at most).
GROUP_ROWS = 4096
_LEAF = 32
_FAN = 8
_HASHES = 1 << 16


def fingerprint_of(text: str, shingle: int, seed: int) -> int:
    """The 64-bit fingerprint of one text; bits set in over half of the shingles' hashes."""
    words = text.encode().lower().split()
    if not words:
        return 0
    hashed = partial(xxhash.xxh64_intdigest, seed=seed)
    if len(words) < shingle:
        return hashed(b" ".join(words))
    ones = np.zeros(64, np.int64)
    n = len(words) - shingle + 1
    for at in range(0, n, _HASHES):
        part = words[at:at + _HASHES + shingle - 1]
        runs = zip(*(part[i:] for i in range(shingle)))
        h = np.fromiter(map(hashed, map(b" ".join, runs)), np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprint(text: Column, shingle: int = SHINGLE_WORDS, seed: int = SEED) -> Column:
    """Fingerprint as a signed long (the bits of the unsigned one)."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            prints = [fingerprint_of(t, shingle, seed) if isinstance(t, str) else 0 for t in batch]
            yield pd.Series(np.array(prints, np.uint64).view(np.int64))

    return run(text)


def gray_rank(bits: Column) -> Column:
    """Position of a bit pattern in the reflected Gray code, shifted so that signed order is it."""
    for s in (1, 2, 4, 8, 16, 32):
        bits = bits.bitwiseXOR(F.shiftrightunsigned(bits, s))
    return bits.bitwiseXOR(F.lit(-(1 << 63)))


def _near(a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= most


def _tree(f: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels from the leaves up: the shared bits (mask) of each node and their values."""
    levels = []
    low, high = f, f  # AND and OR of all fingerprints below a node
    size = _LEAF
    while True:
        cuts = np.arange(0, len(low), size)
        low, high = np.bitwise_and.reduceat(low, cuts), np.bitwise_or.reduceat(high, cuts)
        levels.append((~(low ^ high), low))
        if len(low) <= _FAN:
            return levels
        size = _FAN


def link(f: np.ndarray, most: int, union: Union, at: int = 0) -> None:
    """Union the fingerprints ``f``, in Gray order and at ``at`` in the numbering of ``union``,
    that differ in ``most`` bits at most."""
    levels = _tree(f)
    n = len(levels[-1][0])
    a, b = np.triu_indices(n)
    for depth in range(len(levels) - 1, -1, -1):
        mask, value = levels[depth]
        if depth < len(levels) - 1:
            # children of the surviving pairs; a pair of one node with itself counts once
            steps = np.arange(_FAN)
            a = (a[:, None, None] * _FAN + steps[:, None] + 0 * steps).ravel()
            b = (b[:, None, None] * _FAN + 0 * steps[:, None] + steps).ravel()
            keep = (a < len(mask)) & (b < len(mask)) & (a <= b)
            a, b = a[keep], b[keep]
        keep = np.bitwise_count((value[a] ^ value[b]) & mask[a] & mask[b]) <= most
        a, b = a[keep], b[keep]
    steps = np.arange(_LEAF)
    for i in range(0, len(a), 1024):
        x = (a[i:i + 1024, None, None] * _LEAF + steps[:, None] + 0 * steps).ravel()
        y = (b[i:i + 1024, None, None] * _LEAF + 0 * steps[:, None] + steps).ravel()
        keep = (x < y) & (y < len(f))
        x, y = x[keep], y[keep]
        keep = _near(f[x], f[y], most)
        union.add(x[keep] + at, y[keep] + at)


def _forest(batches: Iterator[pd.DataFrame], most: int) -> Iterator[pd.DataFrame]:
    """Spanning links of every group; rows come sorted by group and Gray rank, and a group's
    rows may be cut over batches."""

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        f = rows["fp"].to_numpy().view(np.uint64)
        key = rows[["block", "value", "i", "j"]].to_numpy()
        head = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(1)))
        size = np.diff(np.append(head, len(f)))
        group = np.repeat(np.arange(len(head)), size)
        union = Union(len(f))
        small = size <= 2 * _LEAF
        reach = int(size[small].max(initial=1))
        for d in range(1, reach):
            x = np.flatnonzero((group[d:] == group[:-d]) & small[group[d:]])
            x = x[_near(f[x], f[x + d], most)]
            union.add(x, x + d)
        for g in np.flatnonzero(~small):
            link(f[head[g]:head[g] + size[g]], most, union, head[g])
        root = union.roots()
        at = np.flatnonzero(root != np.arange(len(f)))
        signed = f.view(np.int64)
        return pd.DataFrame({"a": signed[at], "b": signed[root[at]]})

    held: list[pd.DataFrame] = []
    last = None
    for batch in batches:
        if not len(batch):
            continue
        key = batch[["block", "value", "i", "j"]].to_numpy()
        tail = key[-1]
        same = (key == tail).all(1)
        begin = len(batch) - int(np.argmin(same[::-1])) if not same.all() else 0
        if held and (begin or (key[0] != last).any()):
            held.append(batch[:begin])
            yield work(pd.concat(held))
            held = []
        elif begin:
            yield work(batch[:begin])
        held.append(batch[begin:])
        last = tail
    if held:
        yield work(pd.concat(held))


def links(prints: DataFrame, most: int = MAX_BITS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Spanning links (a, b) between the distinct fingerprints ``prints.fp`` that differ in at most
    ``most`` bits: the components are those of all such pairs."""
    blocks = most + 1
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(F.shiftleft("fp", 64 - edges[i + 1]), 64 - edges[i + 1] + edges[i]).alias("value"))
             for i in range(blocks)]
    dealt = prints.select("fp", F.explode(F.array(*parts)).alias("x")).select("fp", "x.block", "x.value")
    sizes = dealt.groupBy("block", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    segments = F.ceil(F.col("n") / group_rows).cast("int")
    own = F.pmod(F.xxhash64("fp"), segments.cast("long")).cast("int")
    dealt = dealt.join(sizes, ["block", "value"]).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), segments - 1)))
    # a segment meets itself in the pairs with all others, so (i, i) is needed for a lone one only
    dealt = dealt.filter((F.col("n") <= group_rows) | (F.col("own") != F.col("other"))).select(
        "fp", "block", "value", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), gray_rank(F.col("fp")).alias("rank"))
    keys = ["block", "value", "i", "j"]
    return (dealt.repartition(*keys).sortWithinPartitions(*keys, "rank").drop("rank")
            .mapInPandas(lambda batches: _forest(batches, most), "a long, b long"))


def classes_of(own: DataFrame, most: int = MAX_BITS) -> DataFrame:
    """(fp, label, component_id) for the fingerprints of ``own`` (key, fp): label is the smallest
    fingerprint of the component, component_id its smallest key. Written, so that a join with
    documents stands alone in its stage and a hot fingerprint's rows can be split."""
    classes = written(own.groupBy("fp").agg(F.min("key").alias("least")), "simhash-classes")
    members = connected_components(links(classes.select("fp"), most))
    linked = classes.join(members.withColumnRenamed("node", "fp"), "fp")
    least = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    named = members.join(least, "component").select(F.col("node").alias("fp"), F.col("component").alias("label"), "component_id")
    return written(classes.join(named, "fp", "left").select(
        "fp", F.coalesce("label", "fp").alias("label"), F.coalesce("component_id", "least").alias("component_id")), "simhash-components")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE_WORDS,
                    seed: int = SEED, most: int = MAX_BITS) -> DataFrame:
    """(key, fp, component_id): component_id is the smallest key reachable over links."""
    own = written(docs.select(F.col(key).alias("key"), fingerprint(F.col(text), shingle, seed).alias("fp")), "simhash")
    return own.join(classes_of(own, most), "fp").select(F.col("key").alias(key), "fp", "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE_WORDS,
             seed: int = SEED, most: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` for each component: that with the smallest key, null keys last, and of
    repeated rows any one."""
    own = written(docs.select(F.col(key).alias("key"), fingerprint(F.col(text), shingle, seed).alias("fp"), F.xxhash64(text).alias("th")), "simhash")
    place = F.struct(F.col("key").isNull().alias("none"), F.col("key"), F.col("th"))
    seen = own.join(classes_of(own, most).select("fp", "label"), "fp").groupBy("label", "key", "th").agg(F.count(F.lit(1)).alias("n"))
    chosen = (seen.groupBy("label").agg(F.min(place).alias("at"), F.min_by("n", place).alias("__rows"))
              .select(F.col("at.key").alias("__key"), F.col("at.th").alias("__th"), "__rows"))
    kept = docs.join(chosen, F.col(key).eqNullSafe(F.col("__key")) & (F.xxhash64(text) == F.col("__th")))
    # of rows with equal key and text one stays; the others need no comparison
    single = kept.filter("__rows = 1")
    return single.unionByName(kept.filter("__rows > 1").dropDuplicates(["__key", "__th"])).drop("__key", "__th", "__rows")
