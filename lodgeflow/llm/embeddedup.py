"""Near-duplicate vectors by cosine, found in small-world graphs.

Equal vectors are one node with a weight. Nodes are dealt at random to shards, each shard builds a
hierarchical navigable small-world graph, and every node is searched for in every shard. All links
found are verified in double precision. A beam is too narrow for a query whose whole beam are links;
such queries go on with wider beams and, where a large part of a shard is linked, are compared with
all of it. For every pair of shards a sample of the other queries is compared with the whole shard,
too, and while it shows a missed link, the beam is widened and the search repeated.

A task passes on how many vectors each node is linked with and a spanning forest of its links, so
its output is in proportion to its nodes however many pairs there are.

Defined results: vectors that are null, empty, zero, not finite or not of the most frequent size
link with nothing and are components of their own. Equal vectors are linked. A null id counts in
its neighbours' links, and names a component only if all its members have null ids. Repeated rows
are rows of their own. Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeflow.llm import hnsw
from lodgeflow.llm.common import written
from lodgeflow.llm.components import Union, connected_components
from lodgeflow.llm.vectors import dimension, usable

THRESHOLD = 0.95
SHARD_ROWS = 8192
#: First beam, queries audited for each pair of shards, queries compared with a whole shard at once.
BEAM = 24
AUDITED = 256
_CHUNK = 128
_SLACK = 1e-4  # single precision decides outside of this


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def linked(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray, levels: list[np.ndarray], threshold: float,
           same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For unit vectors ``a`` searched in the graph of ``b``: the weights linked with each row of a
    and of b, and the root of each row of b and then (unless ``same``) of a in the forest."""
    b32, a32 = b.astype(np.float32), a.astype(np.float32)
    n, shift = len(b), 0 if same else len(b)
    union = Union(n + (0 if same else len(a)))
    deg_a, deg_b = np.zeros(len(a), np.int64), np.zeros(n, np.int64)
    pending = np.arange(len(a))
    beam = BEAM
    pairs = []
    while len(pending) and beam < n // 4:
        ids, sims = hnsw.search(b32, levels, a32[pending], beam)
        full = sims[:, -1] >= threshold - _SLACK
        at, k = np.nonzero((sims >= threshold - _SLACK) & ~full[:, None])
        q, v = pending[at], ids[at, k]
        true = np.einsum("ij,ij->i", a[q], b[v]) >= threshold
        q, v = q[true], v[true]
        settled = pending[~full]
        audit = settled[::max(1, len(settled) // AUDITED)]
        if len(audit):
            want = int((a[audit] @ b.T >= threshold).sum())
            if want > int(np.isin(q, audit).sum()):
                beam *= 2
                continue
        pairs.append((q, v))
        pending = pending[full]
        beam *= 4
    q = np.concatenate([p[0] for p in pairs]) if pairs else np.zeros(0, np.int64)
    v = np.concatenate([p[1] for p in pairs]) if pairs else np.zeros(0, np.int64)
    whole = np.zeros(len(a), bool)
    whole[pending] = True
    if same:
        # a pair counts once, whichever of both found it; rows compared as a whole count their own
        keep = (q != v) & ~whole[v]
        code = np.unique(np.minimum(q[keep], v[keep]) * n + np.maximum(q[keep], v[keep]))
        q, v = code // n, code % n
        np.add.at(deg_a, q, wb[v])
        np.add.at(deg_a, v, wb[q])
    else:
        np.add.at(deg_a, q, wb[v])
        np.add.at(deg_b, v, wa[q])
    union.add(q + shift, v)
    for at in range(0, len(pending), _CHUNK):
        rows = pending[at:at + _CHUNK]
        hit = a[rows] @ b.T >= threshold
        if same:
            hit[np.arange(len(rows)), rows] = False
        deg_a[rows] += hit @ wb
        back = wa[rows] @ hit
        if same:
            deg_a += np.where(whole, 0, back)
        else:
            deg_b += back
        i, j = np.nonzero(hit)
        union.add(rows[i] + shift, j)
    return deg_a, deg_b, union.roots()


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD,
                    shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per vector: key, n_links, component_id and kept."""
    rows = vectors.select(F.col(key).alias("key"), F.col(vector).alias("v"))
    size = dimension(rows.filter(usable(F.col("v"))), "v")
    ok = usable(F.col("v")) & (F.size("v") == F.lit(size or 0))
    nodes = written(rows.filter(ok).groupBy("v").agg(F.min("key").alias("least"), F.count(F.lit(1)).alias("weight"))
                    .withColumn("node", F.monotonically_increasing_id()), "vector-nodes")
    shards = max(1, -(-nodes.count() // shard_rows))
    single = vectors.schema[vector].dataType.simpleString() == "array<float>"
    kind = np.float32 if single else np.float64

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node")
        x = np.array(group["v"].tolist(), kind)
        # the hash that dealt the nodes also mixes them: the upper levels are random samples
        order = np.argsort(group["node"].to_numpy(np.uint64) * np.uint64(0x9E3779B97F4A7C15), kind="stable")
        x = x[order]
        levels = hnsw.build(unit(x).astype(np.float32))
        return pd.DataFrame({"shard": [int(group["shard"].iloc[0])], "nodes": [group["node"].to_numpy(np.int64)[order].tobytes()],
                             "weights": [group["weight"].to_numpy(np.int64)[order].tobytes()], "x": [x.tobytes()],
                             "levels": [[level.tobytes() for level in levels]]})

    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int")).select("shard", "node", "v", "weight")
    graphs = written(dealt.groupBy("shard").applyInPandas(grow, "shard int, nodes binary, weights binary, x binary, levels array<binary>"), "vector-graphs")

    # every two shards meet once; which of them has the graph goes by parity, so each has its share
    graph = F.col("graph")
    turn = (F.col("shard") + graph) % 2
    meets = (graph == F.col("shard")) | F.when(F.col("shard") < graph, turn == 0).otherwise(turn == 1)
    queries = graphs.select("shard", F.col("nodes").alias("q_nodes"), F.col("weights").alias("q_weights"), F.col("x").alias("q"))
    visits = (queries.withColumn("graph", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).filter(meets)
              .join(graphs.withColumnRenamed("shard", "graph"), "graph"))

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                same = r.shard == r.graph
                own, other = np.frombuffer(r.q_nodes, np.int64), np.frombuffer(r.nodes, np.int64)
                a, b = (unit(np.frombuffer(x, kind).reshape(-1, size)) for x in (r.q, r.x))
                levels = [np.frombuffer(level, np.int32).reshape(-1, hnsw.DEGREE) for level in r.levels]
                deg_a, deg_b, roots = linked(a, np.frombuffer(r.q_weights, np.int64), b, np.frombuffer(r.weights, np.int64), levels, threshold, same)
                names = other if same else np.concatenate([other, own])
                counts = deg_a if same else np.concatenate([deg_b, deg_a])
                at = np.flatnonzero(counts)
                yield pd.DataFrame({"node": names[at], "root": names[roots[at]], "n": counts[at]})

    found = written(visits.mapInPandas(visit, "node long, root long, n long"), "vector-links")
    members = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    named = nodes.select("node", "least", "weight").join(members, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    result = written(nodes.select("node", "v").join(
        named.join(least, "component").join(counts, "node", "left").select(
            "node", "component_id", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links")), "node"), "vector-components")
    # the join with all rows stands alone in its stage, so that a hot vector's rows can be split
    out = rows.withColumn("v", F.when(ok, F.col("v"))).join(result.select("v", "component_id", "n_links"), "v", "left")
    ident = F.when(F.col("n_links").isNull(), F.col("key")).otherwise(F.col("component_id"))
    return out.select(F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), ident.alias("component_id"),
                      F.col("key").eqNullSafe(ident).alias("kept"))
