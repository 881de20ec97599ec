import numpy as np
import pytest
from pyspark.sql import functions as F

from lodgeflow.llm import permutation as P
from lodgeflow.llm import queries as Q


def brute(ids, x, query_ids, k):
    out = {}
    for q in query_ids:
        at = np.flatnonzero(ids == q)[0]
        d = np.sqrt(((x - x[at]) ** 2).sum(1))
        order = [i for i in np.lexsort((ids, d)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(d[i])) for i in order]
    return out


def test_savings_is_the_footrule_distance():
    rng = np.random.default_rng(1)
    lists = np.array([rng.permutation(12)[:5] for _ in range(50)], np.int32)
    posts, begins = P.inverted(lists, 12)
    own = lists[7]

    def footrule(a, b):
        place = lambda x, p: list(x).index(p) if p in x else len(x)
        return sum(abs(place(a, p) - place(b, p)) for p in set(a) | set(b))
    got = P.savings(own, posts, begins, 50)
    none = 5 * 6  # two lists of five without a common pivot
    assert [none - 2 * int(s) for s in got] == [footrule(list(own), list(v)) for v in lists]


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall(spark, sf):
    path = f"/root/testdata/{sf}"
    rows = spark.read.parquet(f"{path}/embeddings.parquet").toPandas()
    ids, x = rows["vec_id"].to_numpy(), np.array(rows["embedding"].tolist(), np.float64)
    want = brute(ids, x, [i for i in ids if i % 100 == 0], 10)
    got = {}
    for r in Q.op4_nearest(spark, path).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    hits = sum(len({a for a, _ in got[q]} & {a for a, _ in want[q]}) for q in want)
    assert hits / (10 * len(want)) >= 0.95
    for q in want:
        exact = dict(zip(ids.tolist(), np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))))
        assert all(abs(exact[a] - s) < 1e-12 for a, s in got[q])


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    same = [1.0, 2.0, 3.0]
    rows = [(i, same) for i in range(40)] + [(100 + i, rng.normal(size=3).tolist()) for i in range(60)]
    rows += [(200, None), (300, []), (400, [0.0, 0.0, 0.0]), (500, [1.0, None, 2.0]), (600, [float("nan"), 1.0, 1.0]), (700, [float("inf"), 0.0, 0.0]),
             (800, [1.0, 2.0]), (None, same), (5, same), (10, rng.normal(size=3).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("query_id", F.lit("clash"))
    got = P.search(df, F.col("vec_id") % 20 == 0, shard_rows=16, least=16).orderBy("query_id", "rank").collect()
    of = {}
    for r in got:
        of.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(of) == {0, 20, 100, 120, 140}
    assert of[0] == [(k, k, 0.0) for k in range(1, 11)]
    assert of[20] == [(k + 1, k, 0.0) for k in range(10)]
    few = spark.createDataFrame(rows[40:43], "vec_id long, embedding array<double>")
    assert [r["vec_id"] for r in P.search(few, F.col("vec_id") == 100).collect()] != [] and P.search(few, F.col("vec_id") == 100).count() == 2
    assert P.search(df.limit(0), F.lit(True)).count() == 0


def test_copies_and_a_hot_id_take_no_places(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 16))
    centre = rng.normal(size=16)
    queries = np.argsort(((x - centre) ** 2).sum(1))[:20].tolist()
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    copies = [(10000 + i, centre.tolist()) for i in range(1500)]
    ids, all_x = np.array([i for i, _ in rows + copies]), np.array([v for _, v in rows + copies])
    want = brute(ids, all_x, queries, 30)
    got = {}
    df = spark.createDataFrame(rows + copies, "vec_id long, embedding array<double>")
    for r in P.search(df, F.col("vec_id").isin(queries), k=30, least=240).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert sum(len(got[q] & {i for i, _ in want[q]}) for q in queries) / (30 * len(queries)) >= 0.95
    near = x[0] + rng.normal(size=(200, 16)) * 1e-3
    hot = [(9999, v.tolist()) for v in near]  # one id, 200 vectors nearer than any other
    found = P.search(spark.createDataFrame(rows + hot, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, least=800).orderBy("rank").collect()
    want = [9999] + [i for i, _ in brute(ids[:600], x, [0], 9)[0]]
    assert [r["vec_id"] for r in found] == want


def test_every_shard_meets_every_block_without_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK_ROWS", 16)
    monkeypatch.setattr(P, "GROUP_BYTES", 4096, raising=False)
    rng = np.random.default_rng(4)
    x, ids = rng.normal(size=(400, 8)), np.arange(400)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    found = P.search(df, F.col("vec_id") % 4 == 0, shard_rows=64, least=400)
    got = {}
    for r in found.collect():  # 7 shards, 7 blocks in two groups
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = brute(ids, x, range(0, 400, 4), 10)
    assert {q: [i for _, i, _ in sorted(v)] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    plan = found._jdf.queryExecution().executedPlan().toString()
    # the driver would get a copy of every block for each shard
    assert "isFinalPlan=true" in plan and "Broadcast" not in plan
    assert P.search(df, F.col("vec_id") < 0).count() == 0


@pytest.mark.parametrize("m", [1, 64, 255, 256])
def test_files_hold_any_length_of_list(m):
    rng = np.random.default_rng(m)
    lists = np.array([rng.permutation(300)[:m] for _ in range(20)], np.int32)
    posts, begins = P.inverted(lists, 300)
    got = P.savings(lists[3], posts, begins, 20).tolist()
    place = [{p: i for i, p in enumerate(v)} for v in lists.tolist()]
    assert got == [sum(m - max(a, v[p]) for p, a in place[3].items() if p in v) for v in place]
    assert got[3] == m * (m + 1) // 2
