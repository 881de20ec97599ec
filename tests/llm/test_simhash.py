import random

import numpy as np
import pytest
import xxhash

from lodgeflow.llm import simhash
from lodgeflow.llm.components import connected_components


def plain_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [words[i:i + 3] for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(b" ".join(r), seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(values, most):
    parent = list(range(len(values)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= most:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("group_rows", [4096, 40])
def test_links_equal_all_pairs(spark, group_rows):
    rng = random.Random(group_rows)
    values = {0}
    for _ in range(12):
        base = rng.getrandbits(64)
        values |= {base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(30)}
    values |= {rng.getrandbits(64) for _ in range(200)}
    values = sorted(values)
    links = simhash.links(spark.createDataFrame([(signed(v),) for v in values], "fp long"), 2, group_rows)
    got = {r["node"]: r["component"] for r in connected_components(links).collect()}
    want = plain_components(values, 2)
    groups = {}
    for v, c in zip(values, want):
        groups.setdefault(c, set()).add(signed(v))
    seen = {}
    for v in values:
        seen.setdefault(got.get(signed(v), signed(v)), set()).add(signed(v))
    assert {frozenset(g) for g in groups.values()} == {frozenset(g) for g in seen.values()}


def test_large_group_tree():
    rng = np.random.default_rng(3)
    f = np.unique((rng.integers(0, 1 << 14, 900, dtype=np.uint64) << np.uint64(40)) | np.uint64(7))
    order = np.argsort(f ^ (f >> np.uint64(1)))
    f = f[order]
    union = simhash.Union(len(f))
    simhash.link(f, 2, union)
    want = plain_components([int(x) for x in f], 2)
    assert union.roots().tolist() == want


def test_documents(spark, documents):
    long = " ".join(f"w{i}" for i in range(300))
    rows = [(5, long, "en"), (2, long.upper(), "en"), (9, long + " tail", "en"), (1, None, None), (7, "", "en"),
            (3, " \t\n", "en"), (4, "one two", "en"), (4, "one two", "en"), (None, "other words here", "en"), (8, "é Ü ẞ", "de")]
    got = [(r["doc_id"], r["fp"], r["component_id"]) for r in simhash.near_duplicates(documents(rows)).collect()]
    assert len(got) == len(rows)
    prints = {r[0]: signed(plain_print(r[1])) for r in rows}
    assert all(fp == prints[i] for i, fp, _ in got)
    comp = {i: c for i, _, c in got}
    want = plain_components([plain_print(r[1]) for r in rows], 2)
    for (i, _, _), c in zip(rows, want):
        members = [rows[k][0] for k in range(len(rows)) if want[k] == c and rows[k][0] is not None]
        assert comp[i] == min(members, default=None)
    assert simhash.near_duplicates(documents(rows).filter("doc_id = 77")).count() == 0
