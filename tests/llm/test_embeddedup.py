import numpy as np
import pytest

from lodgeflow.llm import embeddedup as E
from lodgeflow.llm import hnsw


def plain(ids, x, threshold=0.95):
    u = E.unit(x)
    hit = u @ u.T >= threshold
    np.fill_diagonal(hit, False)
    label = np.arange(len(ids))
    while True:
        new = np.array([min(label[i], label[hit[i]].min(initial=len(ids))) for i in range(len(ids))])
        if (new == label).all():
            break
        label = new
    least = {c: min(ids[i] for i in np.flatnonzero(label == c)) for c in set(label)}
    return {int(i): (int(n), int(least[c])) for i, n, c in zip(ids, hit.sum(1), label)}


def clustered(rng, n, sizes, d=16):
    parts = [rng.normal(size=(n, d))]
    for size in sizes:
        parts.append(rng.normal(size=d) + 0.05 * rng.normal(size=(size, d)))
    x = np.concatenate(parts)
    return x[rng.permutation(len(x))]


def test_graph_search_finds_neighbours():
    rng = np.random.default_rng(1)
    x = E.unit(clustered(rng, 3000, [5, 40, 300])).astype(np.float32)
    levels = hnsw.build(x)
    assert len(levels) > 1 and len(levels[0]) == len(x)
    ids, sims = hnsw.search(x, levels, x[:400], 32)
    exact = x[:400] @ x.T
    want = np.argsort(-exact, 1)[:, :10]
    recall = np.mean([len(set(want[i]) & set(ids[i, :10])) / 10 for i in range(400)])
    assert recall > 0.9 and (np.diff(sims, axis=1) <= 0).all()


@pytest.mark.parametrize("shard_rows", [100000, 700])
def test_links_equal_all_pairs(spark, shard_rows):
    rng = np.random.default_rng(2)
    x = clustered(rng, 1200, [2, 3, 10, 60, 500]).astype(np.float32)
    ids = rng.permutation(5 * len(x))[:len(x)]
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<float>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in E.near_duplicates(df, shard_rows=shard_rows).collect()}
    assert got == plain(ids, x)


def test_odd_rows(spark):
    same = [1.0, 2.0, 3.0]
    rows = [(i, same) for i in (9, 3, 7)] + [(20, [2.0, 4.0, 6.0]), (None, same), (3, same), (30, [-1.0, 0.0, 0.0]), (31, [-1.0, -0.0, 0.0])]
    rows += [(100, None), (101, []), (102, [0.0, 0.0, 0.0]), (103, [1.0, None, 2.0]), (104, [float("nan"), 1.0, 1.0]), (105, [float("inf"), 0.0, 0.0]),
             (106, [1.0, 2.0]), (None, None)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, kept string")
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in E.near_duplicates(df).collect()), key=str)
    want = [(i, 5, 3, i == 3) for i in (9, 3, 7, 20, 3)] + [(None, 5, 3, False), (30, 1, 30, True), (31, 1, 30, False)]
    want += [(i, 0, i, True) for i in range(100, 107)] + [(None, 0, None, True)]
    assert got == sorted(want, key=str)
    assert E.near_duplicates(df.limit(0)).count() == 0


def test_query(spark):
    from lodgeflow.llm import queries as Q
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    want = plain(rows["vec_id"].to_numpy(), np.array(rows["embedding"].tolist()))
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in Q.op10_embedding_dedup(spark, sf).collect()}
    assert got == want
