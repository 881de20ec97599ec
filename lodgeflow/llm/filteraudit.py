"""What each filter of a chain removes, in every order: an audit over sorted posting lists.

Every row has an id. Within a part and a range of ids, each filter has the sorted list of the ids
that fail it, and each mark (a good or a toxic document, say) the list of those that bear it. For
every filter and every set of filters before it, the ids it removes are its list without the lists
of the set, found by galloping: the list goes through each list of the set in turn, leaps ahead by
doubling steps to the stretch that can hold its next ids and searches there; sets that begin alike
share the work. The sizes are summed over the ranges. Whatever the number of orders, a filter has one
result per set of filters before it, and a report row reads the one of its set.

A list holds the ids of one range, ``2**RANGE_BITS`` of them at most, whatever share of the rows one
part has. Copies are found by the SHA-256 of their text; those of a text that is shared by over a
thousandth of the rows, a thousand texts at most, are told by a broadcast, the rest by a join, and
keys of the labels likewise, so that no task holds a hot text or key.

Defined results: null texts are empty ones, and empty texts are equal to each other; a null part is
the empty string; a null key is neither smaller than another nor has labels; rows with equal keys are
rows of their own, and none is the other's copy; of several label rows with one key any that says 1
counts. Other columns are not read. An empty table has no parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeflow.llm.common import written

#: Ids of a range, as a power of two; a key of over one in so many rows is hot.
RANGE_BITS = 16
HOT = 1000
#: Ids that leap together.
_STRIDE = 256


# Bytes to leave out when counting those of a kind; ``_TAIL`` are those that begin no character.
_CAPITALS = bytes(range(65, 91))
_SIGNS = b"#$%&*|"
_NOT_CAPITALS, _NOT_SIGNS = (bytes(b for b in range(256) if b not in kind) for kind in (_CAPITALS, _SIGNS))
_TAIL = bytes(range(0x80, 0xC0))


def measured(rows: DataFrame) -> DataFrame:
    """``rows`` (.., text as binary) with the SHA-256, code points, A-Z letters, words and distinct words
    of the text, and whether it holds one of ``#$%&*|``, in its place. Words are separated by ASCII
    white space. A task holds the measures of a batch, and the words of one text."""
    fields = [pa.field("digest", pa.binary()), *(pa.field(c, pa.int64()) for c in ("chars", "capitals", "words", "distinct")), pa.field("signs", pa.bool_())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def one(t: bytes):
            words = t.split()
            return (hashlib.sha256(t).digest(), len(t.translate(None, _TAIL)), len(t.translate(None, _NOT_CAPITALS)), len(words), len(set(words)),
                    bool(t.translate(None, _NOT_SIGNS)))
        for batch in batches:
            found = zip(*(one(t.as_py()) for t in batch.columns[-1])) if batch.num_rows else [()] * len(fields)
            kept = list(zip(batch.schema, batch.columns))[:-1]
            yield pa.RecordBatch.from_arrays([c for _, c in kept] + [pa.array(c, f.type) for f, c in zip(fields, found)],
                                             schema=pa.schema([f for f, _ in kept] + fields))

    passed = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{passed}, digest binary, chars long, capitals long, words long, distinct long, signs boolean")


def join_unique(rows: DataFrame, facts: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` with the columns of ``facts``, which has one row per ``key`` at most. The rows of a hot
    key, of which there are under ``HOT``, don't travel."""
    hot = rows.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).filter((F.col("__n") * HOT > total) & F.col(key).isNotNull()).select(key)
    hot = written(hot.join(facts, key, "left"), "audit-hot")
    near = rows.join(F.broadcast(hot), key)
    far = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(facts, key, "left")
    return near.unionByName(far)


def gallop(ids: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which of the sorted ``ids`` are in the sorted list ``among``."""
    found = np.zeros(len(ids), bool)
    at = 0
    for i in range(0, len(ids), _STRIDE):
        some = ids[i:i + _STRIDE]
        step = 1
        while at + step < len(among) and among[at + step] < some[0]:
            at += step
            step *= 2
        if at >= len(among):
            break
        end, step = at, _STRIDE
        while end < len(among) and among[end] <= some[-1]:
            end += step
            step *= 2
        stretch = among[at:end + 1]
        place = np.searchsorted(stretch, some)
        inside = place < len(stretch)
        found[i:i + _STRIDE][inside] = stretch[place[inside]] == some[inside]
        at += int(np.searchsorted(stretch, some[-1]))
    return found


def cells(lists: Sequence[np.ndarray], marks: Sequence[np.ndarray], size: int) -> list[tuple[int, ...]]:
    """For each filter and set of others before it (as bits): (filter, set, docs, fails, removed,
    removed or failing the filter, and removed with each mark) in one range of ``size`` ids."""
    empty = np.zeros(0, np.int64)
    gone = {0: 0}
    for s in range(1, 1 << len(lists)):
        # the set's last list adds what the others have not
        last = s.bit_length() - 1
        rest = lists[last]
        for g in range(last):
            if s >> g & 1:
                rest = rest[~gallop(rest, lists[g])]
        gone[s] = gone[s ^ (1 << last)] + len(rest)
    out = []
    for f, own in enumerate(lists):
        left = {0: own}
        for s in range(1 << len(lists)):
            if s >> f & 1:
                continue
            if s:
                last = s.bit_length() - 1
                rest = left[s ^ (1 << last)]
                left[s] = rest[~gallop(rest, lists[last])] if len(rest) else empty
            removed = left[s]
            out.append((f, s, size, len(own), len(removed), gone[s | 1 << f], *(int(gallop(removed, m).sum()) for m in marks)))
    return out


def postings(rows: DataFrame, part: Column, number: Column, fails: Sequence[Column], marks: Sequence[Column]) -> DataFrame:
    """(part, range, size, f0.., m0..): for each part and range of ids the sorted lists of those that fail
    each filter and of those with each mark."""
    flags = {**{f"f{i}": c for i, c in enumerate(fails)}, **{f"m{i}": c for i, c in enumerate(marks)}}
    lists = [F.sort_array(F.collect_list(F.when(F.col(name), F.col("id")))).alias(name) for name in flags]
    return (rows.select(part.alias("part"), number.alias("id"), *(c.alias(name) for name, c in flags.items()))
            .groupBy("part", F.shiftright("id", RANGE_BITS).alias("range")).agg(F.count(F.lit(1)).alias("size"), *lists))


def report(lists: DataFrame, names: str, marks: Sequence[str]) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, shapley and ``<mark>_lost``) of
    every part, order of the filters and step. ``names`` has a letter per filter; the report's orders are
    as many as these can be put in, so it is for a few filters."""
    k = len(names)
    sums = ["docs", "fails", "removed", "together", *(f"{m}_lost" for m in marks)]
    schema = "part string, filter int, earlier int, " + ", ".join(f"{c} long" for c in sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                column = {c: batch.column(j)[i] for j, c in enumerate(batch.schema.names)}
                fail, mark = ([column[f"{p}{x}"].values.to_numpy() for x in range(n)] for p, n in (("f", k), ("m", len(marks))))
                out += [(column["part"].as_py(), *cell) for cell in cells(fail, mark, column["size"].as_py())]
            names_ = ["part", "filter", "earlier", *sums]
            kinds = [pa.string(), pa.int32(), pa.int32(), *[pa.int64()] * len(sums)]
            columns = list(zip(*out)) if out else [()] * len(names_)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names_)

    total = lists.mapInArrow(run, schema).groupBy("part", "filter", "earlier").agg(*(F.sum(c).alias(c) for c in sums))
    total = written(total, "audit-cells")
    before = F.bit_count(F.col("earlier"))
    orders = F.lit(0)
    for i in range(k):
        orders = F.when(before == i, factorial(i) * factorial(k - 1 - i)).otherwise(orders)
    own = total.groupBy("part", "filter").agg(
        F.sum(F.when(before == k - 1, F.col("removed")).otherwise(0)).alias("unique_fails"),
        F.sum(F.col("removed") * orders).alias("shapley"))
    steps = []
    for order in permutations(range(k)):
        earlier = 0
        for step, f in enumerate(order):
            steps.append(("".join(names[x] for x in order), step + 1, f, earlier))
            earlier |= 1 << f
    steps = lists.sparkSession.createDataFrame(steps, "filter_order string, step int, filter int, earlier int")
    # one row per order and step of the named filters, whatever the data
    return (total.join(own, ["part", "filter"]).join(F.broadcast(steps), ["filter", "earlier"])
            .select("part", "filter_order", "step", (F.col("docs") - F.col("together")).alias("kept"), "removed",
                    (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails", *(f"{m}_lost" for m in marks), "shapley"))


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """The report of five filters over ``docs``. A document fails A with under 50 words, B with under
    65 distinct words in 100, C with over 5 capitals A-Z in 100 code points, D with one of ``#$%&*|``,
    E if a smaller key has the same text. ``labels`` (key, quality, toxic) marks good and toxic ones."""
    base = written(measured(docs.select(
        F.monotonically_increasing_id().alias("id"), F.col(key).alias("key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text")))
        .select("id", "key", "part", "digest", (F.col("words") < 50).alias("a"), (100 * F.col("distinct") < 65 * F.col("words")).alias("b"),
                (100 * F.col("capitals") > 5 * F.col("chars")).alias("c"), F.col("signs").alias("d")), "audit-rows")
    total = base.count()
    firsts = base.groupBy("digest").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("__copies")).filter("__copies > 1").drop("__copies")
    marks = labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = written(join_unique(base, firsts, "digest", total).select("id", "key", "part", "a", "b", "c", "d", F.coalesce(F.col("first") < F.col("key"), F.lit(False)).alias("e")), "audit-copies")
    rows = join_unique(rows, marks, "key", total)
    lists = written(postings(rows, F.col("part"), F.col("id"), [F.col(c) for c in "abcde"], [F.col("good") == 1, F.col("toxic") == 1]), "audit-lists")
    return report(lists, "ABCDE", ["good", "toxic"])
