import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lodgeflow.llm import prefixhash
from lodgeflow.llm.common import codepoints
from pyspark.sql import functions as F

texts = st.text("abé中\U0001F600", max_size=60)


def plain_hash(text):
    return tuple(sum((ord(c) + 1) * pow(b, j, prefixhash.PRIME) for j, c in enumerate(text)) % prefixhash.PRIME for b in prefixhash.BASES)


def plain_fingerprint(text):
    n = len(text)
    size = min(prefixhash.SPAN, n)
    buckets = {}
    for i in range(n - size + 1 if n else 0):
        high, low = plain_hash(text[i:i + size])
        h = high << 31 | low
        buckets.setdefault(h % prefixhash.BUCKETS, []).append(h // prefixhash.BUCKETS)
    whole = plain_hash(text)
    return f"{whole[0] << 31 | whole[1]:016x}" + "".join(f"{min(buckets[b]) & 0xFFFF:04x}" if b in buckets else "----" for b in range(prefixhash.BUCKETS))


@settings(max_examples=60, deadline=None)
@given(texts, texts, st.data())
def test_spans_and_extensions(a, b, data):
    x, y = (prefixhash.Prefixes(codepoints(t)) for t in (a, b))
    i, j = (data.draw(st.integers(0, len(t))) for t in (a, b))
    size = data.draw(st.integers(0, 20))
    assert x.equal(i, y, j, size) == (i + size <= len(a) and j + size <= len(b) and a[i:i + size] == b[j:j + size])
    common = next((k for k, (p, q) in enumerate(zip(a[i:], b[j:])) if p != q), min(len(a) - i, len(b) - j))
    assert x.common(i, y, j) == common
    assert x.hash(i, len(a) - i) == plain_hash(a[i:])
    assert prefixhash.joined(plain_hash(a), len(a), plain_hash(b)) == plain_hash(a + b)


def test_long_texts_cross_blocks():
    rng = np.random.default_rng(5)
    codes = rng.integers(32, 0x10FFFF, 200_000).astype(np.uint32)
    x, y = prefixhash.Prefixes(codes), prefixhash.Prefixes(codes[70_001:])
    assert x.common(70_001, y, 0) == len(codes) - 70_001
    assert (x.hashes(16)[70_001:] == y.hashes(16)).all()
    other = codes.copy()
    other[150_000] ^= 1
    assert x.common(0, prefixhash.Prefixes(other), 0) == 150_000


def rows_of_test():
    rng = random.Random(6)
    words = ["alpha", "beta", "gämma", "中文字", "delta", "eps", "\U0001F600"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 200)))) for i in range(120)]
    return rows + [(200, None), (201, ""), (202, "x"), (203, "short"), (204, "same text, long enough for spans"), (205, "same text, long enough for spans"),
                   (206, "ab " * 30000), (207, "exactly sixteen!"), (208, "fifteen letters")]


def test_fingerprints(spark, documents):
    rows = rows_of_test()
    got = {r["doc_id"]: r for r in prefixhash.fingerprints(documents([(k, t, "en") for k, t in rows], 5)).collect()}
    ordered = sorted(((k, t or "") for k, t in rows), reverse=True)
    for i, (k, t) in enumerate(ordered):
        other = ordered[(i + 1) % len(ordered)][1]
        n = len(t) // 2
        edited = t[:len(t) - n] + other[:n]
        r = got[k]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r["edited_fingerprint"] == prefixhash.Text(edited).fingerprint
        assert r["common_edited"] == next((j for j, (p, q) in enumerate(zip(t, edited)) if p != q), min(len(t), len(edited)))
        assert r["common_next"] == next((j for j, (p, q) in enumerate(zip(t, other)) if p != q), min(len(t), len(other)))
        assert 0 <= r["near_edited"] <= 1 and (r["near_next"] == 1) == (t == other)
        if len(t) < 300:
            assert r["fingerprint"] == plain_fingerprint(t)
    assert len(got) == len(rows)
    assert got[204]["fingerprint"] == got[205]["fingerprint"]


def test_likeness_estimates_common_spans():
    rng = random.Random(7)
    letters = "abcdefghijklmnopqrstuvwxyz "
    a = "".join(rng.choices(letters, k=6000))
    for share in (0.0, 0.25, 0.5, 0.9, 1.0):
        cut = int(6000 * share)
        b = "".join(rng.choices(letters, k=50)) + a[:cut] + "".join(rng.choices(letters, k=6000 - cut))
        assert abs(prefixhash.likeness(prefixhash.Text(a).fingerprint, prefixhash.Text(b).fingerprint) - share) < 0.15


def test_odd_tables(spark, documents):
    def run(rows, parts=3):
        return sorted((tuple(r) for r in prefixhash.fingerprints(documents(rows, parts)).collect()), key=str)
    assert prefixhash.fingerprints(documents([(1, "a", "en")]).limit(0)).count() == 0
    alone = run([(1, "abcd", "en")])
    assert len(alone) == 1 and alone[0][2] == hashlib.sha256(b"abab").hexdigest() and alone[0][6] == 1.0
    rows = [(1, "one text " * 5, "en")] * 3 + [(None, "null key " * 5, "en"), (2, "two texts " * 5, "en"), (1, "another text " * 5, "en")]
    assert run(rows, 1) == run(rows, 4) and len(run(rows)) == len(rows)
    clash = spark.createDataFrame([(3, "t one", 1, "z"), (2, "t two", 2, "z")], "k int, t string, u int, h string")
    assert prefixhash.fingerprints(clash, "k", "t").columns[:2] == ["k", "n_chars"]


def test_columns(spark):
    rows = [("hello world", 6, "my world", 3, 5), ("hello", 3, "help", 3, 1), ("a", 0, "a", 0, 9), (None, 0, "a", 0, 1), ("中文a", 1, "文b", 0, 1), ("a", -1, "a", 0, 1)]
    df = spark.createDataFrame(rows, "a string, i int, b string, j int, n int")
    got = df.select(prefixhash.span_equal(*map(F.col, "aibjn")).alias("e"), prefixhash.common_extension(*map(F.col, "aibj")).alias("c")).collect()
    assert [r["e"] for r in got] == [True, False, False, None, True, False]
    assert [r["c"] for r in got] == [5, 0, 1, None, 1, None]
