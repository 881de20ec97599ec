import random

from lodgeflow.llm import language
from lodgeflow.llm import queries as Q

EN = "the quick brown fox jumps over the lazy dog while many other animals watch from their houses and think about dinner".split()
DE = "der schnelle braune fuchs springt über den faulen hund während viele andere tiere aus ihren häusern zusehen und an essen denken".split()
RU = "быстрая коричневая лиса прыгает через ленивую собаку пока другие звери смотрят из домов и думают про ужин".split()


def some(rng, words, n=30):
    return " ".join(rng.choice(words) for _ in range(n))


def model(spark, documents):
    rng = random.Random(1)
    rows = [(i, some(rng, w), lang) for i, (w, lang) in enumerate([(EN, "en"), (DE, "de"), (RU, "ru")] * 30)]
    docs = documents(rows + [(1000, None, "en"), (1001, "text", None)])
    return docs, language.train(docs)


def test_spans_of_a_mixed_text(spark, documents):
    docs, m = model(spark, documents)
    rng = random.Random(2)
    parts = [some(rng, EN), some(rng, DE), some(rng, RU)]
    text = ", ".join(parts)
    r = m.label([text], spans=True).iloc[0]
    assert [s["lang"] for s in r["spans"]] == ["en", "de", "ru"]
    for s, part in zip(r["spans"], parts):
        assert abs(s["start"] - text.index(part)) < 20 and abs(s["end"] - text.index(part) - len(part)) < 20


def test_viterbi_equals_plain(spark, documents):
    _, m = model(spark, documents)
    rng = random.Random(3)
    texts = [" ".join(rng.choice(EN + DE + RU) for _ in range(rng.randint(0, 60))) for _ in range(40)]
    for text in texts:
        points = language.Chars.points(text + "\n")
        _, _, scores = m.word_scores(points)
        best = [list(m.prior + scores[0])] if len(scores) else []
        back = []
        for s in scores[1:]:
            top = max(range(len(s)), key=lambda k: best[-1][k])
            back.append([k if best[-1][k] >= best[-1][top] - 12 else top for k in range(len(s))])
            best.append([best[-1][b] - (0 if b == k else 12) + s[k] for k, b in enumerate(back[-1])])
        if not best:
            continue
        path = [max(range(len(m.langs)), key=lambda k: best[-1][k])]
        for b in reversed(back):
            path.append(b[path[-1]])
        import numpy as np
        assert m.viterbi(scores, np.array([0]), np.array([len(scores)]), 12).tolist() == path[::-1]


def test_odd_rows(spark, documents):
    docs, m = model(spark, documents)
    rows = [(1, None, None), (2, "", "en"), (3, "123 !? 😀", "en"), (4, "ΩΨ", "en"), (5, "fox " * 50000, "en"), (6, "ü" * 200000, None), (6, "ü" * 200000, None)]
    odd = documents(rows)
    got = odd.select("doc_id", language.label(odd, m, spans=True).alias("r")).select("doc_id", "r.*").collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == 7 and [by[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3
    assert by[4]["lang_pred"] in ("en", "de", "ru") and by[5]["lang_pred"] == "en" and by[6]["lang_pred"] == "de"
    assert all(0 <= r["score"] <= 1 for r in got) and by[1]["spans"] == []
    assert language.train(odd.limit(0)) is None
    assert {r[0] for r in odd.select(language.label(odd, None).alias("r")).select("r.lang_pred").collect()} == {"und"}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = Q.op1_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (got.lang_pred == got.lang).mean() > 0.97


def test_letters_of_all_planes(spark, documents):
    _, m = model(spark, documents)
    every = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    chars = language.Chars()
    letter = chars.letter[language.Chars.points("".join(map(chr, every)))]
    assert (letter == [chr(c).isalpha() for c in every]).all()
    none = ["\U000F0000\U000F0001", "\U000E0101", "\U000E0041\U000E0042", "\U0001F600", "12 \U00100000 !"]
    got = m.label(none)
    assert got["lang_pred"].tolist() == [language.UNKNOWN] * len(none) and (got["score"] == 0).all()
    assert m.label(["\U00020000\U00020001"])["lang_pred"][0] != language.UNKNOWN
