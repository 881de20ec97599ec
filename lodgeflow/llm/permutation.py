"""Nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order of distance. Each shard of the table holds
inverted files: for each pivot and place, the vectors that have the pivot at that place. A query
walks the files of its own pivots; a shared pivot at places a and b takes 2 (m - max(a, b)) off the
footrule distance of two lists of m pivots, a pivot missing from a list counting as at place m. The
best vectors by footrule distance are compared exactly, in double precision, and the best of all
shards are the result.

The pivots are a bounded sample, every vector is indexed. Equal vectors are one node with its
smallest ids, one more than asked for, as one may be the query's own; shards, and what a query
compares, are counted in nodes, and all nodes at the last footrule distance are compared. Queries
visit shards in blocks, by a product of shards and blocks that broadcasts neither: the driver holds
no vectors but the pivots. A task keeps the bytes of a bounded group of blocks and works on one shard
and one block at a time.

Defined results: vectors that are null, empty, zero, not finite or not of the most frequent size,
and those without an id take no part. An id counts once in a result, with its nearest vector,
and is never found by its own query. Ties go to the smaller id. Fewer candidates than asked for
are all returned; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgeflow.llm.common import written
from lodgeflow.llm.vectors import dimension, packed, usable

#: Pivots, and how many of them represent a vector.
PIVOTS = 128
PREFIX = 64
#: Vectors of a shard, queries of a block.
SHARD_ROWS = 8192
BLOCK_ROWS = 1024
#: Bytes of query vectors that a task keeps.
GROUP_BYTES = 1 << 25
#: Share of a shard that is compared exactly for each query, and the least number.
SHARE = 0.08
LEAST = 512


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The ``prefix`` nearest pivots of each vector, the nearest first, ties to the smaller number."""
    d = (pivots * pivots).sum(1)[None] - 2 * (x @ pivots.T)
    return np.argsort(d, 1, kind="stable")[:, :prefix].astype(np.int32)


def inverted(lists: np.ndarray, n_pivots: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors by (pivot, place), and where each such file begins."""
    n, m = lists.shape
    file = lists.astype(np.int64) * m + np.arange(m)
    order = np.argsort(file.ravel(), kind="stable")
    begins = np.searchsorted(file.ravel()[order], np.arange(n_pivots * m + 1))
    return (order // m).astype(np.int32), begins.astype(np.int32)


def weights(posts: np.ndarray, begins: np.ndarray, n: int, m: int) -> np.ndarray:
    """The inverted files with a row for each pivot: what every vector's place leaves of ``m``, 0 for
    vectors without the pivot."""
    out = np.zeros(((len(begins) - 1) // m, n), np.int16 if m < 256 else np.int32)
    file = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    out[file // m, posts] = m - file % m
    return out


def savings(own: np.ndarray, posts: np.ndarray, begins: np.ndarray, n: int) -> np.ndarray:
    """Half of what each vector's footrule distance from the list ``own`` falls short of that of
    lists without a pivot in common."""
    return saved(own, weights(posts, begins, n, len(own)))


def saved(own: np.ndarray, files: np.ndarray) -> np.ndarray:
    """``savings`` by the files that ``weights`` gives: many queries walk the same."""
    out = np.zeros(files.shape[1], files.dtype)  # at most m (m + 1) / 2
    for a, pivot in enumerate(own.tolist()):
        out += np.minimum(files[pivot], files.dtype.type(len(own) - a))
    return out


def search(vectors: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding",
           n_pivots: int = PIVOTS, prefix: int = PREFIX, shard_rows: int = SHARD_ROWS, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of ``vectors`` that ``is_query`` holds for."""
    schema = "query_id long, rank int, vec_id long, score double"
    spark = vectors.sparkSession
    valid = vectors.filter(usable(F.col(vector)) & F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("id"), F.col(vector).alias("v"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    size = dimension(valid, "v")
    if size is None:
        return spark.createDataFrame([], schema)
    valid = valid.filter(F.size("v") == size)
    # only the k + 1 smallest ids of a node leave a task
    least_ids = Window.partitionBy("v").orderBy("id")
    nodes = written(valid.select("id", "v").distinct().withColumn("no", F.row_number().over(least_ids)).filter(F.col("no") <= k + 1)
                    .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")), "permutation-nodes")
    # pivots: the nodes with the smallest hashes
    rows = nodes.orderBy(F.xxhash64(F.col("ids")[0]), F.col("ids")[0], "v").limit(n_pivots).select("v").collect()
    pivots = np.array([tuple(r["v"]) for r in rows], np.float64)
    m = min(prefix, len(pivots))
    asked = valid.agg(F.sum(F.col("is_query").cast("long"))).first()[0]
    shards, blocks = -(-nodes.count() // shard_rows), max(1, -(-asked // BLOCK_ROWS))
    shared = spark.sparkContext.broadcast(pivots)

    def index(group: pd.DataFrame) -> pd.DataFrame:
        x = np.array(group["v"].tolist(), np.float64)
        posts, begins = inverted(nearest_pivots(x, shared.value, m), len(shared.value))
        sizes = np.array([len(i) for i in group["ids"]], np.int64)
        return pd.DataFrame({"shard": [int(group["shard"].iloc[0])], "ids": [np.concatenate(group["ids"].to_list()).astype(np.int64).tobytes()],
                             "sizes": [sizes.tobytes()], "x": [x.tobytes()], "posts": [posts.tobytes()], "begins": [begins.tobytes()]})

    # any row number will do to spread nodes: their smallest ids may be one
    dealt = nodes.select("ids", "v", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).cast("int").alias("shard"))
    # a file for each shard, so that reading can be cut between any two
    indexed = written(dealt.groupBy("shard").applyInPandas(index, "shard int, ids binary, sizes binary, x binary, posts binary, begins binary"), "permutation-index", file_rows=1)

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"q_ids": [group["id"].to_numpy(np.int64).tobytes()], "q": [packed(group["v"])]})

    queries = written(valid.filter("is_query").select("id", "v").distinct()
                      .withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int"))
                      .groupBy("block").applyInPandas(pack, "q_ids binary, q binary"), "permutation-queries")
    groups = min(blocks, -(-blocks * BLOCK_ROWS * size * 8 // GROUP_BYTES))
    # the hint rules a broadcast out: statistics don't tell how large the rows of either side are
    visits = indexed.crossJoin(queries.repartition(groups).hint("shuffle_replicate_nl"))

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                ids, sizes, q_ids = np.frombuffer(r.ids, np.int64), np.frombuffer(r.sizes, np.int64), np.frombuffer(r.q_ids, np.int64)
                x, q = np.frombuffer(r.x).reshape(-1, size), np.frombuffer(r.q).reshape(-1, size)
                posts, begins = np.frombuffer(r.posts, np.int32), np.frombuffer(r.begins, np.int32)
                n, ends = len(sizes), np.cumsum(sizes)
                node_of = np.repeat(np.arange(n), sizes)
                files = weights(posts, begins, n, m)
                most = min(n, max(least, 4 * k, int(share * n)))
                out = [], [], []
                for own, point, q_id in zip(nearest_pivots(q, shared.value, m), q, q_ids):
                    near = saved(own, files)
                    mine = node_of[ids == q_id]
                    near[mine[sizes[mine] == 1]] = -1  # nodes of its own id only
                    c = np.flatnonzero(near >= max(0, np.partition(near, n - most)[n - most]))
                    d = np.sqrt(((x[c] - point) ** 2).sum(1))
                    order = np.argsort(d, kind="stable")
                    c, d = c[order], d[order]
                    # nodes by distance, with all at the last one, until there are k ids
                    take = 4 * k
                    while True:
                        some = c[:np.searchsorted(d, d[min(take, len(d)) - 1], "right")] if len(d) else c
                        found_ids = np.concatenate([ids[ends[i] - sizes[i]:ends[i]] for i in some]) if len(some) else ids[:0]
                        scores = np.repeat(d[:len(some)], sizes[some])
                        other = found_ids != q_id
                        found_ids, scores = found_ids[other], scores[other]
                        best = np.lexsort((found_ids, scores))
                        # an id may have several vectors: its nearest counts
                        _, once = np.unique(found_ids[best], return_index=True)
                        if len(once) >= k or len(some) == len(c):
                            break
                        take *= 4
                    best = best[np.sort(once)][:k]
                    for column, v in zip(out, (np.full(len(best), q_id), found_ids[best], scores[best])):
                        column.append(v)
                if len(q_ids):
                    yield pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, out))))

    found = visits.mapInPandas(visit, "query_id long, vec_id long, score double").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
