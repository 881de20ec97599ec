import re

from test_linededup import plain as plain_lines
from test_pii import plain as plain_spans
from test_simhash import plain_components, plain_print

import corpus_pipeline as P
from lodgeflow.llm import language

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def test_stages_equal_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.union(spark.createDataFrame([(10**6, "12 34 !!", "en", "s", 8), (10**6 + 1, None, None, None, None), (10**6 + 2, "", "en", None, 0)], docs.schema))
    kept = P.identify_language(spark, docs, SF)
    assert kept.columns == COLUMNS
    m = language.train(docs)
    want = []
    for r in docs.collect():
        found = m.label([r["text"] or ""]).iloc[0]
        if found["lang_pred"] != "und" and found["score"] >= P.MIN_SHARE:
            want.append((r["doc_id"], r["text"]))
    assert rows_of(kept) == sorted(want, key=str) and len(want) >= docs.count() - 3 - 2

    lines = P.dedup_lines(spark, kept, SF)
    assert lines.columns == COLUMNS
    got = rows_of(lines)
    assert got == sorted(plain_lines(sorted(want)), key=str)
    assert all(r["n_chars"] == len(r["text"]) for r in lines.collect())

    single = P.dedup_documents(spark, lines, SF)
    assert single.columns == COLUMNS
    by_id = sorted(got)
    comp = plain_components([plain_print(t) for _, t in by_id], 2)
    assert rows_of(single) == sorted({c: by_id[c] for c in comp}.values(), key=str)

    clean = P.remove_personal_data(spark, single, SF)
    assert clean.columns == COLUMNS
    before = dict(rows_of(single))
    for i, t in rows_of(clean):
        spans = [x.split(":") for x in plain_spans(before[i]).split(",") if x]
        for _, a, b in spans:
            assert before[i][int(a):int(b)] not in re.sub(r"<[A-Z]+>", "", t)
        if not spans:
            assert t == before[i]

    packed = P.pack_sequences(spark, clean, SF).toPandas()
    words = {i: len(t.split()) for i, t in rows_of(clean)}
    assert packed.groupby("doc_id")["n_tokens"].sum().to_dict() == words


def test_run_and_empty_table(spark):
    assert P.run(spark, SF).count() > 0
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0
