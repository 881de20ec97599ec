import hashlib
import math
import random
import re
import time

from pyspark.sql import functions as F

from lodgeflow.llm import pii
from lodgeflow.llm import queries as Q

# The contract's patterns.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += (d * 2 - 9 if d > 4 else d * 2) if i % 2 else d
    return total % 10 == 0


def plain(text):
    out = []
    for no, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                  "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), no, m.end(), kind))
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))


def base_of(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = pii.with_base_spans(docs, "text", "base").select("doc_id", pii.digest(F.col("base")).alias("d")).collect()
    return {r["doc_id"]: r["d"] for r in rows}


def test_base_spans_equal_the_patterns(spark):
    texts = [
        None, "", "no data", "a@b.c", "x@a.b_c@d.e z", "..a%+-@b-.c.d. e@f", "a@b@c.d", "é😀 me@x.org 😀1.2.3.4",
        "1.2.3.4.5.6.7.8", "256.1.1.1 255.255.255.255 001.02.3.0004", "1.2.3 4.5.6.7", "4111 1111 1111 1111", "4111-1111-1111-1112",
        "4602651151338161", "00000000000000", "1  2", "+1 (815) 555-2757 x", "+1 (815) 555-27", "+12345678901234567", "+1 ().-", "++15551234567",
        "4111 1111 1111 1111 4111 1111 1111 1111", "9" * 5000, "1 " * 5000, "a." * 6000 + "@x.y", "a" * 30000, "m@" + "a.b" * 4000, "+1" + " (" * 3000,
        "١٢٣.1.2.3.4", "a@b.c,d@e.f;g@h.i",
    ]
    rng = random.Random(4)
    texts += ["".join(rng.choice("a1.@+- 4(9%_😀é") for _ in range(120)) for _ in range(400)]
    got = base_of(spark, texts)
    for i, t in enumerate(texts):
        assert got[i] == plain(t), t


def test_terms_that_disclose(spark):
    rows = []
    for i in range(4):  # "Xantippe" stands next to one address and nowhere else; "hello" everywhere
        rows.append((i, f"number {i * 7919} hello Xantippe, x.a@mail.org thanks variant{i}"))
    rows += [(10 + i, f"hello all of you thanks number {i}") for i in range(60)]
    rows += [(100, "hello Xavier y.b@mail.org once"), (101, None), (None, "hello Xantippe, x.a@mail.org"), (102, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.find(docs, keep_text=True).withColumn("d", pii.digest(F.array_sort(F.concat("base", "terms")))).collect()}
    n, n_e, n_et, n_t = len(rows), 5, 5, 5
    assert math.isclose(math.log(n_et * n / n_t / n_e) / math.log(n / n_e), 1)
    text = rows[0][1]
    at = text.index("Xantippe")
    assert f"term:{at}:{at + 8}" in got[0]["d"] and "term" not in got[100]["d"] and "term" not in got[10]["d"]
    assert f"term:{text.index('hello')}" not in got[0]["d"]
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert clean[0] == "number 0 hello , <EMAIL> thanks variant0"
    assert clean[100] == "hello Xavier <EMAIL> once" and clean[101] is None and clean[102] == "" and clean[10] == rows[4][1]
    assert pii.find(docs.limit(0)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in Q.op7_pii(spark, sf).collect():
        want = plain(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        kinds = [x.split(":")[0] for x in want.split(",")]
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [kinds.count(k) for k in PATTERNS]
        assert set(want.split(",")) - {""} <= set(r["spans"].split(","))


def test_terms_of_a_rare_entity_are_marked_in_all_texts(spark):
    far = "and so on and on " * 30
    rows = [(i, f"Zuleika {i}. {far} write to z@mail.org or {i}") for i in range(2)]  # two texts, and 100 words off
    rows += [(2, "Then zuleika's friend met Zuleika (Zuleika) here"), (3, "Zuleikas variant")]
    rows += [(10 + i, f"hello all of you {i} {far}") for i in range(400)]
    rows += [(500 + i, f"lone{i} once{i} hello u{i}@mail.org") for i in range(20)] + [(600, "hapaxword hello u600@mail.org")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    texts = dict(rows)
    for i in range(2):
        assert "Zuleika" not in clean[i] and "and so on" in clean[i] and "write" not in clean[i]
    assert clean[2] == "Then <TERM>'s friend met <TERM> (<TERM>) here"  # no base span in this text
    assert clean[3] == texts[3] and clean[10] == texts[10]
    assert clean[600] == "hapaxword hello <EMAIL>"  # one text is no evidence, however rare the word
    few = spark.createDataFrame(rows[2:50] + rows[-1:], "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in pii.sanitise(few).collect()}[600] == "hapaxword hello <EMAIL>"


def plain_disclosing(rows):
    """Terms at or over the threshold, counted pair by pair."""
    texts, n = {}, len(rows)
    for _, t in rows:
        texts[t] = texts.get(t, 0) + 1
    kinds = list(PATTERNS)
    words, entities = {}, {}
    for t in texts:
        spans = [x.split(":") for x in plain(t).split(",") if x]
        entities[t] = {(kinds.index(k), t[int(a):int(b)].lower()) for k, a, b in spans}
        bare, at = "", 0
        for _, a, b in spans:
            bare, at = bare + t[at:max(at, int(a))] + " ", max(at, int(b))
        words[t] = {w.lower() for w in re.findall(r"(?<![^\W_])[^\W\d_]{3,}(?![^\W_])", bare + t[at:])}
    with_e, with_t = {}, {}
    for t in texts:
        for e in entities[t]:
            with_e.setdefault(e, set()).add(t)
        for w in words[t]:
            with_t.setdefault(w, set()).add(t)

    def n_of(found):
        return sum(texts[t] for t in found)

    pairs = []
    for e, es in with_e.items():
        if len(es) < 2 or n_of(es) >= n:
            continue
        for w in set().union(*(words[t] for t in es)):
            both = es & with_t[w]
            if len(both) >= 2 and n_of(with_t[w]) <= n_of(es) * (n / n_of(es)) ** 0.1 * (1 + 1e-6):
                pairs.append((e, w, both))
    out = set()
    for e, w, both in pairs:
        n_e, n_t, n_et, k, es = n_of(with_e[e]), n_of(with_t[w]), n_of(both), len(both), len(with_e[e])
        share, seen = min(1, (k + n_t - n_et) / len(texts)), k / es
        if seen <= share or math.log(n_et * n / (n_t * n_e)) / math.log(n / n_e) < 0.9 - 1e-9:
            continue
        rest = (es - k) * math.log((1 - seen) / (1 - share)) if k < es else 0
        if -(k * math.log(seen / share) + rest) <= math.log(0.01 / len(pairs)) + 1e-9:
            out.add(w)
    return out


def test_planted_names_go_and_clean_texts_stay(spark):
    """Against counting every pair; of names planted beside one address in several texts nearly all are
    found, and texts without personal data or such a name stay as they are."""
    rng = random.Random(9)
    letters = "abcdefghijklmnoprstuvwz"
    words = ["".join(rng.choices(letters, k=6)) for _ in range(4000)]
    rows, names = [], ["Q" + "".join(rng.choices(letters, k=7)) for _ in range(40)]
    for i, name in enumerate(names):
        for _ in range(rng.randrange(3, 6)):
            body = rng.choices(words, k=30)
            body[4], body[20] = name, f"{name.lower()}{i}@mail.org"
            rows.append(" ".join(body))
    rows += [" ".join(rng.choices(words, k=29)) + f" u{i}@mail.org" for i in range(150)]  # entities of one text
    clean = [" ".join(rng.choices(words, k=40)) for _ in range(1200)]
    rows = list(enumerate(rows + [rows[0], rows[0]] + clean))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    based = pii.with_base_spans(docs, "text", "base")
    holders = based.filter(F.size("base") > 0).withColumns({"row": F.col("doc_id"), "th": F.xxhash64("text")})
    got = {r["h"] for r in pii.disclosing_terms(holders, docs, "text").collect()}
    want = plain_disclosing(rows)
    forms = spark.createDataFrame([(w,) for w in want], "w string").select(F.xxhash64("w").alias("h"))
    assert got == {r["h"] for r in forms.collect()}
    assert len({x.lower() for x in names} & want) >= 0.9 * len(names)
    kept = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    untouched = sum(kept[i] == t for i, t in rows[-len(clean):])
    assert untouched >= 0.95 * len(clean)


def test_copies_are_no_evidence(spark):
    """A text with an address, copied many times with a word or two changed, discloses nothing."""
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefghijklmnoprstuvwz", k=6)) for _ in range(3000)]
    body = rng.choices(words, k=120)
    rows = []
    for _ in range(12):
        copy = list(body)
        copy[rng.randrange(120)] = rng.choice(words)
        rows.append(" ".join(copy) + " someone@mail.org")
    rows = list(enumerate(rows + [" ".join(rng.choices(words, k=60)) for _ in range(600)]))
    kept = {r["doc_id"]: r["text"] for r in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(kept[i] == t.replace("someone@mail.org", "<EMAIL>") for i, t in rows)


def test_long_texts(spark):
    """The work on one text grows with its length: spans and words by the ten thousands."""
    text = " ".join(f"word{chr(97 + i % 26)} u{i}@mail.org" for i in range(20_000))
    docs = spark.createDataFrame([(1, text), (2, "é " + text), (3, "x 1.2.3.4 +1 (815) 555-2757")], "doc_id long, text string")
    start = time.time()
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert time.time() - start < 60
    assert clean[1].count("<EMAIL>") == 20_000 and "@" not in clean[2] and clean[2].startswith("é ") and clean[3] == "x <IP> <PHONE>"
    assert base_of(spark, [text])[0] == plain(text)


def test_overlapping_spans_across_chunks(spark, monkeypatch):
    monkeypatch.setattr(pii, "CHUNK", 3)
    rng = random.Random(10)
    rows = []
    for i in range(60):
        t = "".join(rng.choice("abcdé ") for _ in range(80))
        spans = sorted((a, rng.randrange(4), min(80, a + rng.randrange(1, 9)), "v") for a in rng.sample(range(79), rng.randrange(0, 20)))
        rows.append((i, t, spans))
    df = spark.createDataFrame(rows, "i int, t string, s array<struct<start:int,no:int,end:int,value:string>>")
    got = df.select("i", pii.redacted(F.col("t"), F.col("s")).alias("r"), pii._blanked(F.col("t"), F.col("s")).alias("b")).collect()
    for (_, t, spans), g in zip(rows, sorted(got)):
        first = merged = ""
        at = to = 0
        for a, no, b, _ in spans:
            if a >= at:
                first, at = first + t[at:a] + f"<{pii.KINDS[no].upper()}>", b
            merged, to = merged + t[to:max(to, a)] + " ", max(to, b)
        assert (g["r"], g["b"]) == (first + t[at:], merged + t[to:])
