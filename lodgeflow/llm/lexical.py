"""Ranked lexical search: Block-Max MaxScore over the shards of an inverted index.

**Index.** Every task turns the texts it reads into shards of about ``SHARD_TERMS`` term occurrences;
texts are not shuffled, and a shard is added without touching the others. A shard's documents are
numbered by key. A posting list is blocks of ``BLOCK`` documents: gaps and frequencies as
variable-length bytes, and beside them, not compressed, each block's last document, first byte and
the pairs (frequency, length of the document) that no other pair of the block beats. So block maxima
are exact under whatever collection statistics hold when the index is searched.

**Search.** A term's score in a document is ``w * ((10**9 * tf) div (1000 * tf + 8 * m))`` with
``m = 10 + (90 * n * N) div L``: n the document's terms, N the documents that have any, L the terms of
all. ``w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))``. In a shard, a query's lists are ordered by
their largest score. Those whose sum can't beat the k-th best so far are not essential: documents
come from the other lists alone, and each is dropped as soon as its score, the maximum of its block
in the next non-essential list, and the largest scores of the rest can't beat the k-th best. Blocks
without a document left are never decompressed. Documents are taken in order of their key, so one
that only equals the k-th best is no better. The k best of every shard are merged.

Queries come in blocks of ``2**QUERY_BITS``; a task holds one shard's lists of one block of queries. An
item's terms meet the lists by an equality join on the term, which Spark broadcasts or shuffles by
size; a frequent term has one row per shard, so no key gathers postings.

Defined results: null texts and texts without a term are no documents; a null key is ranked after
equal scores; repeated rows are documents of their own and repeated queries are answered each; a
query without a known term has no rows. Other columns are not read. An empty table finds nothing.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgeflow.llm.common import written

#: Term occurrences and documents at which a shard is closed; postings of a block.
SHARD_TERMS = 1 << 22
SHARD_DOCS = 1 << 16
BLOCK = 128
#: Queries searched together, as a power of two; documents of the first window of a search, and of the largest.
QUERY_BITS = 10
WINDOWS = (256, 4096)
#: The list of a shard's documents stands under this term, which no text has.
HEADER = b""

# A-Z in lower case; ASCII bytes but letters and digits separate terms; the bytes of all other
# characters belong to terms.
_FOLD = bytes((b + 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text, given in UTF-8."""
    return text.translate(_FOLD).split()


def _lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(values, kind))


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``values`` as variable-length bytes (seven bits a byte, the last below 128), and where each begins."""
    size = np.ones(len(values), np.int64)
    for bits in (7, 14, 21, 28):
        size += values >= (1 << bits)
    begin = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(begin[-1], np.uint8)
    for k in range(5):
        has = np.flatnonzero(size > k)
        if len(has):
            out[begin[has] + k] = ((values[has] >> (7 * k)) & 127) | np.where(size[has] > k + 1, 128, 0)
    return out, begin


def unpacked(data: np.ndarray) -> np.ndarray:
    """The values of ``packed`` bytes."""
    ends = np.flatnonzero(data < 128)
    begin = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(len(data)) - np.repeat(begin, ends - begin + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * place), begin)


class _Shard:
    """The texts of one shard while they are read."""

    def __init__(self, number: int):
        self.number = number
        self.keys: list = []
        self.sizes: list[int] = []
        self.parts: list[np.ndarray] = []
        self.vocabulary: dict[bytes, int] = defaultdict(count().__next__)
        self.size = 0

    def add(self, key, text: bytes) -> None:
        found = terms(text)
        if found:
            self.keys.append(key)
            self.sizes.append(len(found))
            self.parts.append(np.fromiter(map(self.vocabulary.__getitem__, found), np.uint32, len(found)))
            self.size += len(found)

    @property
    def full(self) -> bool:
        return self.size >= SHARD_TERMS or len(self.keys) >= SHARD_DOCS

    def rows(self, schema: pa.Schema) -> pa.RecordBatch:
        order = sorted(range(len(self.keys)), key=lambda i: (self.keys[i] is None, self.keys[i] if self.keys[i] is not None else 0, i))
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        sizes = np.array(self.sizes, np.int64)
        lens = sizes[order]
        names = sorted(self.vocabulary)
        rank = np.empty(len(names), np.int64)
        rank[[self.vocabulary[t] for t in names]] = np.arange(len(names))
        where = rank[np.concatenate(self.parts)]
        self.parts.clear()
        where = (where << 32) | np.repeat(number, sizes)
        where.sort()
        first = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]]))
        tf = np.diff(np.append(first, len(where)))
        where = where[first]
        doc = where & 0xFFFFFFFF
        begin = np.flatnonzero(np.concatenate([[True], (where[1:] >> 32) != (where[:-1] >> 32)]))
        df = np.diff(np.append(begin, len(where)))
        new_block = (np.arange(len(where)) - np.repeat(begin, df)) % BLOCK == 0
        blocks = np.flatnonzero(new_block)
        per_term = -(-df // BLOCK)
        # the first document of a block stands by itself, so that each block is read alone
        gap = np.where(new_block, doc, doc - np.concatenate([[0], doc[:-1]]))
        data, at = packed(np.stack([gap, tf - 1], 1).reshape(-1))
        at = at[::2]
        ends_of_blocks = np.append(blocks[1:], len(where))
        # pairs by length within a block; one counts if its frequency is over those of all shorter ones
        block = np.cumsum(new_block) - 1
        by_length = np.argsort((block << 32) | lens[doc], kind="stable")
        block = block[by_length]
        height = (block << 32) | tf[by_length]
        best = np.maximum.accumulate(height)
        kept = np.flatnonzero(np.concatenate([[True], height[1:] > best[:-1]]))
        pairs = np.bincount(block[kept], minlength=len(blocks))
        kept = by_length[kept]
        by_term = np.cumsum(per_term)
        pair_ends = np.cumsum(pairs)[by_term - 1]
        body = pa.RecordBatch.from_arrays([
            pa.array(np.full(len(names), self.number)),
            pa.array(names, pa.binary()),
            pa.array(df, pa.int32()),
            _lists(doc[ends_of_blocks - 1], by_term, pa.int32()),
            _lists(at[blocks] - np.repeat(at[begin], per_term), by_term, pa.int32()),
            _lists(pairs, by_term, pa.int32()),
            _lists(tf[kept], pair_ends, pa.int32()),
            _lists(lens[doc[kept]], pair_ends, pa.int32()),
            pa.Array.from_buffers(pa.binary(), len(names), [None, pa.py_buffer(at[np.append(begin, len(where))].astype(np.int32)), pa.py_buffer(data)]),
            pa.nulls(len(names), schema.field("keys").type),
            pa.nulls(len(names), schema.field("lens").type),
        ], schema=schema)
        head = {f.name: None for f in schema} | {
            "shard": self.number, "term": HEADER, "df": 0, "keys": [self.keys[i] for i in order], "lens": lens.tolist()}
        return pa.Table.from_batches([pa.RecordBatch.from_pylist([head], schema), body]).combine_chunks().to_batches()[0]


def build(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The index of ``docs``, as a table in the shared scratch folder."""
    keys = f"array<{docs.select(F.col(key)).schema[0].dataType.simpleString()}>"
    schema = (f"shard long, term binary, df int, lasts array<int>, starts array<int>, pairs array<int>, tfs array<int>, "
              f"lengths array<int>, data binary, keys {keys}, lens array<int>")
    arrow_keys = docs.select(F.col(key)).limit(0).toArrow().schema[0].type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ints():
            return pa.list_(pa.int32())
        out = pa.schema([("shard", pa.int64()), ("term", pa.binary()), ("df", pa.int32()), ("lasts", ints()), ("starts", ints()), ("pairs", ints()),
                         ("tfs", ints()), ("lengths", ints()), ("data", pa.binary()), ("keys", pa.list_(arrow_keys)), ("lens", ints())])
        numbers = (TaskContext.get().partitionId() << 32 | i for i in count())
        shard = _Shard(next(numbers))
        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                if t.is_valid:
                    shard.add(k, t.as_py())
                if shard.full:
                    yield shard.rows(out)
                    shard = _Shard(next(numbers))
        if shard.keys:
            yield shard.rows(out)

    return written(docs.select(F.col(key), F.col(text).cast("binary")).mapInArrow(run, schema), "lexical-index")


class _List:
    """A term's postings in one shard; blocks are decompressed when asked for."""

    def __init__(self, row: dict, w: int, stats: tuple[int, int], m: np.ndarray):
        self.lasts, self.starts, self.data = row["lasts"], np.append(row["starts"], len(row["data"])), row["data"]
        self.w, self.m = w, m
        pairs = np.asarray(row["pairs"])
        best = term_score(np.asarray(row["tfs"], np.int64), length_norm(np.asarray(row["lengths"], np.int64), stats))
        self.maxima = w * np.maximum.reduceat(best, np.concatenate([[0], np.cumsum(pairs)[:-1]]))
        self.bound = int(self.maxima.max())
        self.read: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of a block and their scores."""
        if b not in self.read:
            values = unpacked(np.frombuffer(self.data, np.uint8, self.starts[b + 1] - self.starts[b], self.starts[b])).reshape(-1, 2)
            docs = np.cumsum(values[:, 0])
            self.read[b] = docs, self.w * term_score(values[:, 1] + 1, self.m[docs])
        return self.read[b]


def length_norm(n: np.ndarray, stats: tuple[int, int]) -> np.ndarray:
    return 10 + (90 * n * stats[0]) // stats[1]


def term_score(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def best_of_shard(lists: Sequence[_List], size: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best documents of a shard of ``size`` and their scores, by Block-Max MaxScore."""
    lists = sorted(lists, key=lambda x: x.bound)
    sums = np.concatenate([[0], np.cumsum([x.bound for x in lists])])  # sums[i]: the first i lists at most
    docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    least = begin = 0
    width = WINDOWS[0]
    while begin < size:
        essential = int(np.searchsorted(sums, least, "right")) - 1
        if essential == len(lists):
            break
        end = min(size, begin + width)
        width = min(2 * width, WINDOWS[1])
        total = np.zeros(end - begin, np.int64)
        for x in lists[essential:]:
            for b in range(int(np.searchsorted(x.lasts, begin)), len(x.lasts)):
                d, s = x.block(b)
                lo, hi = np.searchsorted(d, (begin, end))
                total[d[lo:hi] - begin] += s[lo:hi]
                if x.lasts[b] >= end - 1:
                    break
        left = np.flatnonzero(total)
        for i in range(essential - 1, -1, -1):
            x = lists[i]
            left = left[total[left] + sums[i + 1] > least]
            at = np.searchsorted(x.lasts, left + begin)
            there = at < len(x.lasts)
            most = np.where(there, x.maxima[np.minimum(at, len(x.lasts) - 1)], 0)
            may = total[left] + most + sums[i] > least
            left, at, there = left[may], at[may], there[may]
            for b in np.unique(at[there]):
                d, s = x.block(int(b))
                mine = left[at == b]
                place = np.minimum(np.searchsorted(d, mine + begin), len(d) - 1)
                total[mine] += np.where(d[place] == mine + begin, s[place], 0)
        left = left[total[left] > least]
        docs, scores = np.concatenate([docs, left + begin]), np.concatenate([scores, total[left]])
        top = np.lexsort((docs, -scores))[:k]
        docs, scores = docs[top], scores[top]
        if len(docs) == k:
            least = int(scores[-1])
        begin = end
    return docs, scores


def weight(df: Column, n: int) -> Column:
    return F.floor(1000 * F.log(F.lit(2 * n + 2).cast("double") / (2 * df + 1))).cast("long")


def search(index: DataFrame, queries: DataFrame, key: str = "item_id", text: str = "text", k: int = 10) -> DataFrame:
    """(``key``, rank, doc, score) of the ``k`` best documents of every query. Ranks begin at 1;
    equal scores are ranked by the documents' key."""
    spark = index.sparkSession
    heads = index.filter(F.col("term") == F.lit(HEADER))
    n, total, shards = heads.agg(F.sum(F.size("lens")), F.sum(F.aggregate("lens", F.lit(0).cast("long"), lambda a, x: a + x)), F.count(F.lit(1))).first()
    doc_type = index.schema["keys"].dataType.elementType.simpleString()
    stats = (int(n or 0), int(total or 1))

    @F.udf("array<binary>", useArrow=True)
    def terms_of(t):
        return sorted(set(terms(bytes(t)))) if t is not None else []

    items = written(queries.select(F.col(key).alias("item"), F.monotonically_increasing_id().alias("q"), F.col(text).cast("binary").alias("t"))
                    .select("item", "q", F.shiftright("q", QUERY_BITS).alias("block"), terms_of("t").alias("terms")), "lexical-queries")
    asked = items.select("q", "block", F.explode("terms").alias("term"))
    known = (index.select("term", "df").join(asked.select("term").distinct(), "term").groupBy("term").agg(weight(F.sum("df"), stats[0]).alias("w")))
    wanted = (asked.join(known, "term").groupBy("block", "term").agg(F.first("w").alias("w"), F.collect_list("q").alias("qs"))
              .unionByName(items.select("block").distinct().withColumns({"term": F.lit(HEADER), "w": F.lit(0).cast("long"), "qs": F.array().cast("array<long>")})))
    wanted = written(wanted, "lexical-terms")
    # the tasks are heavy for their bytes, so their number isn't left to these
    blocks = wanted.filter(F.col("term") == F.lit(HEADER)).count()
    tasks = max(1, min(blocks * (shards or 0), max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)))

    def run(table: pa.Table) -> pa.Table:
        rows = table.select(["term", "w", "qs", "lasts", "starts", "pairs", "tfs", "lengths", "data"]).to_pylist()
        at = next(i for i, r in enumerate(rows) if r["term"] == HEADER)
        names = table.column("keys")[at].values
        m = length_norm(table.column("lens")[at].values.to_numpy().astype(np.int64), stats)
        lists = defaultdict(list)
        for i, r in enumerate(rows):
            if i != at:
                x = _List(r, r["w"], stats, m)
                for q in r["qs"]:
                    lists[q].append(x)
        qs, docs, scores = [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for q, own in lists.items():
            d, s = best_of_shard(own, len(m), k)
            qs += [q] * len(d)
            docs.append(d)
            scores.append(s)
        return pa.table({"q": pa.array(qs, pa.int64()), "doc": names.take(pa.array(np.concatenate(docs))), "score": pa.array(np.concatenate(scores))})

    found = index.join(wanted, "term").repartition(tasks, "shard", "block").groupBy("shard", "block").applyInArrow(run, f"q long, doc {doc_type}, score long")
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.join(items.select("q", "item"), "q").select(F.col("item").alias(key), "rank", "doc", "score")
