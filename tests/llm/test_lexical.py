import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from lodgeflow.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, items, k=10):
    """Every document scored for every item."""
    docs = [(key, Counter(TERM.findall((t or "").translate(LOWER)))) for key, t in rows]
    docs = [(key, c) for key, c in docs if c]
    n, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        found = []
        for key, c in docs:
            m = 10 + (90 * sum(c.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in set(TERM.findall((text or "").translate(LOWER))) if c[t])
            if score > 0:
                found.append((-score, key is None, key if key is not None else 0))
        for rank, (s, none, key) in enumerate(sorted(found)[:k], 1):
            out.append((item, rank, None if none else key, -s))
    return sorted(out, key=str)


def searched(docs, queries, **kw):
    return sorted(map(tuple, lexical.search(lexical.build(docs), queries, **kw).collect()), key=str)


def test_packed_round_trip():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2**21 - 1, 2**21, 2**28, 2**31 - 1] + list(range(300)), np.int64)
    data, begin = lexical.packed(values)
    assert (lexical.unpacked(data) == values).all()
    assert (lexical.unpacked(data[begin[3]:begin[7]]) == values[3:7]).all()


@pytest.mark.parametrize("shard, block", [(1 << 22, 128), (900, 4)])
def test_all_documents_scored(spark, documents, monkeypatch, shard, block):
    """Equal to scoring everything, in one shard and in many with small blocks."""
    monkeypatch.setattr(lexical, "SHARD_TERMS", shard)
    monkeypatch.setattr(lexical, "BLOCK", block)
    monkeypatch.setattr(lexical, "WINDOWS", (8, 32))
    rng = random.Random(3)
    words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(4000)] + ["École", "größe", "中文", "A1"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 60)))) for i in range(400)]
    rows += [(1000 + i, "same text Twice, w1 w2") for i in range(30)] + [(500, None), (501, ""), (502, "-- ,;"), (None, "w1 same"), (None, "w1 same"),
                                                                    (503, "w1 " * 20000), (7, "w2 same"), (7, "w2 same")]
    items = [(i, " ".join(rng.choices(words, k=12))) for i in range(40)] + [(90, None), (91, "unknownterm"), (92, ""), (93, "W1, w1! same"), (94, "ÉCOLE école 中文")]
    queries = spark.createDataFrame(items, "item_id long, text string")
    assert searched(documents([(k, t, "en") for k, t in rows]), queries) == plain(rows, items)


def test_empty_and_clashing_names(spark, documents):
    queries = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert searched(documents([(1, "a", "en")]).limit(0), queries) == []
    assert searched(documents([(1, "a", "en")]), queries.limit(0)) == []
    docs = spark.createDataFrame([("x", "a c", 1, "t"), ("y", "c c", 2, "u")], "name string, body string, shard int, term string")
    found = lexical.search(lexical.build(docs, "name", "body"), queries.withColumnRenamed("item_id", "block"), key="block")
    assert [(r["block"], r["rank"], r["doc"]) for r in found.collect()] == [(1, 1, "x")]


def test_rejected_blocks_stay_packed():
    """Where a rare term decides, most blocks of the frequent one are never decompressed."""
    class Counted(lexical._List):
        pass
    n = 20000
    stats = (n, n * 10)
    m = lexical.length_norm(np.full(n, 10), stats)

    def made(docs, w):
        docs = np.array(docs)
        blocks = [docs[i:i + 128] for i in range(0, len(docs), 128)]
        values = [lexical.packed(np.stack([np.diff(b, prepend=0), np.zeros(len(b), int)], 1).reshape(-1))[0] for b in blocks]
        row = {"lasts": np.array([b[-1] for b in blocks]), "starts": np.cumsum([0] + [len(v) for v in values[:-1]]), "pairs": [1] * len(blocks),
               "tfs": [1] * len(blocks), "lengths": [10] * len(blocks), "data": np.concatenate(values).tobytes()}
        return lexical._List(row, w, stats, m)

    common, rare = made(range(n), 1), made(range(0, n, 500), 9000)
    docs, scores = lexical.best_of_shard([common, rare], n, 5)
    assert docs.tolist() == [0, 500, 1000, 1500, 2000] and len(set(scores.tolist())) == 1
    assert len(common.read) < 40 < len(common.lasts)
