import random

from pyspark.sql import functions as F

from lodgeflow.llm import linededup


def plain(rows):
    """Reference in plain Python: chunks by position, kept at the first place of their text, and the
    lines around them as far as they equal those around that place."""
    places = {}
    for key, text in rows:
        for no, chunk in linededup.chunks(text or ""):
            place = ((key is not None, key, no), text)
            places[chunk] = min(places.get(chunk, place), place, key=lambda p: p[0])

    def alike(a, b):
        n = 0
        while n < min(len(a), len(b), linededup.MAX_LINES) and a[n] == b[n]:
            n += 1
        return n

    out = []
    for key, text in rows:
        if text is None:
            out.append((key, None))
            continue
        lines, gone = text.split("\n"), set()
        ends = dict(linededup.cut(lines))
        for no, chunk in linededup.chunks(text):
            (_, first_key, first_no), first_text = places[chunk]
            if (first_key, first_no) == (key, no):
                continue
            other = first_text.split("\n")
            end, first_end = ends[no], first_no + ends[no] - no
            before = alike(lines[:no][::-1], other[:first_no][::-1])
            gone |= set(range(no - before, end + alike(lines[end:], other[first_end:])))
        out.append((key, "\n".join(x for i, x in enumerate(lines) if i not in gone)))
    return out


def test_shift_resistant():
    rng = random.Random(1)
    passage = [f"line {rng.random()}" for _ in range(40)]
    one = {c for _, c in linededup.chunks("\n".join(["a"] + passage))}
    two = {c for _, c in linededup.chunks("\n".join(["x", "y", "z"] + passage + ["tail"]))}
    assert len(one & two) >= len(one) - 3


def test_documents(spark, documents):
    rng = random.Random(2)
    passage = "\n".join(f"common line number {rng.random()}" for _ in range(12))
    rows = [(i, f"own {i}\nmore own {rng.random()}\n{passage}\nend {rng.random()}", "en") for i in range(8)]
    rows += [(20, None, None), (21, "", "en"), (22, "one line only", "en"), (23, "one line only", "en"), (24, "\n\n\n\n", "en"), (25, "\n\n\n\n", "en"),
             (None, passage, "en"), (30, passage + "\n" + passage, "en"), (31, "x\n" * 3000, "en")]
    got = linededup.dedup(documents(rows))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "removed_chunks", "removed_lines"]
    found = {(r["doc_id"], r["text"]) for r in got.collect()}
    assert found == set(plain([(k, t) for k, t, _ in rows]))
    assert got.count() == len(rows)
    assert dict(found)[None] == passage  # a null key sorts first and so keeps the passage
    assert linededup.dedup(documents(rows).limit(0)).count() == 0


def test_repeated_rows_and_clashing_names(spark):
    text = "\n".join(f"row {i}" for i in range(9))
    docs = spark.createDataFrame([(1, text, "a"), (1, text, "b"), (2, text, "c")], "doc_id long, text string, removed_lines string")
    got = sorted((r["doc_id"], r["text"] == text) for r in linededup.dedup(docs).collect())
    assert got[0] == got[1] == (1, True) and got[2][1] is False


def test_passages_go_to_their_edges(spark, documents):
    """Without the module's own cut: a passage of 16 lines stays at its first place only, to its first and
    last line; what is one document's own stays; each line that goes equals one that stays earlier."""
    rng = random.Random(7)

    def own(i, n):
        return [f"own {i} {rng.random()}" for _ in range(n)]

    passages = [[f"passage {p} line {rng.random()}" for _ in range(16)] for p in range(3)]
    long_line = " ".join(f"word{rng.random()}" for _ in range(60))
    rows = [(i, "\n".join(own(i, rng.randint(1, 9)) + passages[i % 3] + own(i, rng.randint(1, 9)) + [long_line] + own(i, 1))) for i in range(30)]
    found = {r["doc_id"]: r["text"].split("\n") for r in linededup.dedup(documents([(k, t, "en") for k, t in rows])).collect()}
    for i, text in rows:
        lines = text.split("\n")
        assert [x for x in lines if x.startswith("own")] == [x for x in found[i] if x.startswith("own")]
        assert [x for x in found[i] if x.startswith("passage")] == (passages[i] if i < 3 else [])
        assert (long_line in found[i]) == (i == 0)


def test_equal_hashes_of_other_bytes_stay(spark, documents, monkeypatch):
    """Line hashes that all agree: the bytes decide about the lines around a chunk."""
    chunk = [f"shared {i}" for i in range(40)]
    rows = [(i, "\n".join([f"before {i}", *chunk, f"after {i}"]), "en") for i in range(3)]
    docs = documents(rows)
    monkeypatch.setattr(linededup, "_common", lambda own, first: F.least(F.size(own), F.size(first)).cast("int"))
    got = {r["doc_id"]: r["text"].split("\n") for r in linededup.dedup(docs).collect()}
    for i in range(3):
        assert got[i][0] == f"before {i}" and got[i][-1] == f"after {i}"
    assert got[0] == rows[0][1].split("\n")
