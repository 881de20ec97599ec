import random

from pyspark.sql import functions as F

from lodgeflow.llm import queries as Q
from lodgeflow.llm import toxicity


def test_cover_takes_shared_segments():
    words = {"grumblewort": 9, "grumblefax": 8, "snark": 12}
    grams = set().union(*(toxicity.grams_of(w) for w in words))
    found = toxicity.cover(words, grams)
    assert " grumble" in found and " snark " in found


def test_shared_bytes_shortcut_is_exact():
    rng = random.Random(3)
    plain = [" ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8))) for _ in range(60)).encode() for _ in range(50)]
    told = [" grumble", " snark "]
    toxic, ordinary = toxicity.dictionaries(told, plain)
    w = toxicity.Windows(toxic, ordinary, len("\n".join(told).encode()))
    assert w.saved("snark") >= 2 and w.saved("grumbling") >= 2
    for _ in range(2000):
        word = "".join(rng.choice("abcdefghgrumblesnk") for _ in range(rng.randint(1, 12)))
        b = toxicity._MARK + b" " + word.encode() + b" " + toxicity._TAIL
        full = len(w.ordinary.compress(b)) - len(w.toxic.compress(b))
        assert w.saved(word) == full or (w.saved(word) == 0 and abs(full) <= 1)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = Q.op9_toxicity(spark, sf)
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{sf}/labels.parquet").filter("toxic is not null")
    held = got.filter("held_out").join(labels, "doc_id").toPandas()
    hit = ((held.predicted == 1) & (held.toxic == 1)).sum()
    assert hit / (held.predicted == 1).sum() >= 0.9
    assert hit / (held.toxic == 1).sum() >= 0.75


def test_nothing_tells_the_classes_apart(spark):
    docs = spark.createDataFrame([(i, f"same words here {i // 2}") for i in range(80)] + [(99, "12 34")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(99, 1)], "doc_id long, toxic int")
    got = docs.select(toxicity.score(docs, toxicity.train(docs, labels)).alias("s")).collect()
    assert len(got) == 81 and all(0 <= r["s"] <= 1 for r in got)


def test_odd_rows(spark):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(300)]

    def text(*extra):
        return " ".join(rng.sample(words, 40) + list(extra))
    rows = [(i, text(*["snarkle", "grumblo"][:i % 3 == 0 and 2]), int(i % 3 == 0)) for i in range(300)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(900, None), (901, ""), (902, "123 !!"), (None, text("snarkle")), (903, "x" * 300000), (0, rows[0][1])], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(0, 1), (5, None), (None, 1)], "doc_id long, toxic int")
    got = docs.select("doc_id", toxicity.score(docs, toxicity.train(docs, labels)).alias("score")).collect()
    assert len(got) == 306 and all(0 <= r["score"] <= 1 for r in got)
    right = sum((r["score"] >= 0.5) == (r["doc_id"] % 3 == 0) for r in got if r["doc_id"] is not None and r["doc_id"] < 300)
    assert right >= 295
    assert all(r["score"] < 0.5 for r in got if r["doc_id"] in (900, 901, 902, 903))
    assert toxicity.train(docs, labels.filter("toxic = 0")) is None
    assert docs.select(toxicity.score(docs, None).alias("s")).agg(F.max("s")).first()[0] == 0
    assert toxicity.train(docs.limit(0), labels) is None
