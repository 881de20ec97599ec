import random
from itertools import permutations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lodgeflow.llm import filteraudit


def plain(rows, labels):
    """Every order applied to every document, one after the other."""
    good, toxic = ({k for k, q, t in labels if (q, t)[i] == 1 and k is not None} for i in (0, 1))
    docs = []
    for key, text, part in rows:
        t = text or ""
        w = [x for x in t.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\v", " ").replace("\f", " ").split(" ") if x]
        fails = set()
        if len(w) < 50:
            fails.add("A")
        if 100 * len(set(w)) < 65 * len(w):
            fails.add("B")
        if 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t):
            fails.add("C")
        if any(c in t for c in "#$%&*|"):
            fails.add("D")
        if key is not None and any(k is not None and k < key and (u or "") == t for k, u, _ in rows):
            fails.add("E")
        docs.append((part or "", fails, key in good, key in toxic))
    out = {}
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        lines = []
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(gone)
                lines.append((f, "".join(order), step, len(left), len(gone), sum(f in d[1] for d in own) - len(gone), sum(d[1] == {f} for d in own),
                              sum(d[2] for d in gone), sum(d[3] for d in gone)))
        out |= {(part, *x[1:3]): (*x[3:], shapley[x[0]]) for x in lines}
    return out


@settings(max_examples=80, deadline=None)
@given(st.sets(st.integers(0, 3000)), st.sets(st.integers(0, 3000)))
def test_gallop(a, b):
    x, y = (np.array(sorted(s), np.int64) for s in (a, b))
    assert (filteraudit.gallop(x, y) == np.isin(x, y)).all()


def test_gallop_far_apart():
    rng = np.random.default_rng(1)
    for n, m in ((5, 100_000), (100_000, 5), (40_000, 50_000)):
        x, y = (np.unique(rng.integers(0, 1 << 40, k)) for k in (n, m))
        y = np.unique(np.concatenate([y, x[::3]]))
        assert (filteraudit.gallop(x, y) == np.isin(x, y)).all()


def test_every_order(spark, monkeypatch):
    monkeypatch.setattr(filteraudit, "RANGE_BITS", 4)
    monkeypatch.setattr(filteraudit, "HOT", 20)
    rng = random.Random(8)
    words = [f"Word{i}" if i % 9 == 0 else f"w{i}" for i in range(80)] + ["a#b", " x", "Éa"]

    def text():
        k = rng.choice((3, 49, 50, 51, 90, 200))
        return rng.choice((" ", "\t", "\n", "\v ", "\x1c")).join(rng.choices(words[:rng.choice((20, 60, len(words)))], k=k))

    rows = [(i, text(), rng.choice(("s0", "s0", "s0", "s1", "s2", None, ""))) for i in range(150)]
    rows += [(200 + i, rows[3][1], "s0") for i in range(60)] + [(300, None, "s1"), (301, "", "s1"), (302, "", None), (None, rows[3][1], "s0"), (None, None, None),
                                                              (5, rows[5][1], "s1"), (5, "again", "s1"), (303, "x " * 40000, "s2")]
    labels = [(i, rng.choice((0, 1, None)), rng.choice((0, 1, None))) for i in range(260)] + [(None, 1, 1), (7, 1, 1), (7, 0, 0)]
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, source string, part int, id string").repartition(3)
    got = filteraudit.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int").repartition(2))
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows_got = [tuple(r) for r in got.collect()]
    assert {r[:3]: r[3:] for r in rows_got} == plain(rows, labels)
    assert len(rows_got) == 600 * 4


def test_empty_tables(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filteraudit.audit(documents([(1, "a", "en")]).limit(0), labels).count() == 0
    assert filteraudit.audit(documents([(1, "a", "en")]), labels).count() == 600
