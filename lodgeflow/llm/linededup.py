"""Removal of globally repeated runs of lines, cut by content.

A text is cut into chunks of lines. A rolling hash over the hashes of the last lines decides
after which line a chunk ends, so that a passage is cut alike wherever it stands and whatever
precedes it, but for its first and last chunk. A line of ``LONG_WORDS`` words or more is a chunk of its
own. A chunk of several lines, or of such a line, that occurs again anywhere in the table stays at its first
place only, by key and then position. Equal hashes only name candidates: their bytes are grouped
and compared before anything goes.

From a repeated chunk on, the lines before and after it go too as far as they equal those around the
chunk's first place, up to ``MAX_LINES`` on each side: that is where a passage ends within a chunk.
They too are compared by hash, then by bytes. Each line that goes equals one at an earlier place.

Defined results: null texts stay null, an empty text stays empty, a text of one line is never
cut. Chunks of short lines with fewer than two that hold more than white space are formatting and stay.
A null key sorts first. Rows with equal key and equal text count as one place and are treated
alike. Other columns pass through; the names given for the report are replaced where they exist.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgeflow.llm.common import written

#: Lines under the rolling hash; one boundary in so many lines; fewest and most lines of a chunk.
WINDOW = 2
DIVISOR = 2
MIN_LINES = 2
MAX_LINES = 16
#: A line of so many words is a chunk of its own.
LONG_WORDS = 50
_BASE = 0x100000001B3
_ALL = (1 << 64) - 1


def is_long(line: str) -> bool:
    return len(line) >= 2 * LONG_WORDS - 1 and len(line.split(None, LONG_WORDS - 1)) >= LONG_WORDS


def cut(lines: list[str]) -> list[tuple[int, int]]:
    """The chunks of a text as ranges of lines."""
    out = []
    begin = rolling = 0
    drop = pow(_BASE, WINDOW, 1 << 64)
    hashes: list[int] = []
    for i, line in enumerate(lines):
        if is_long(line):
            if begin < i:
                out.append((begin, i))
            out.append((i, i + 1))
            begin = i + 1
        hashes.append(h := xxhash.xxh64_intdigest(line.encode()))
        rolling = (rolling * _BASE + h) & _ALL
        if i >= WINDOW:
            rolling = (rolling - drop * hashes[i - WINDOW]) & _ALL
        n = i + 1 - begin
        # the upper bits: the lower ones of a product depend on few bits of the factors
        if n >= MAX_LINES or (n >= MIN_LINES and (rolling >> 40) % DIVISOR == 0):
            out.append((begin, i + 1))
            begin = i + 1
    if begin < len(lines):
        out.append((begin, len(lines)))
    return out


def chunks(text: str) -> Iterator[tuple[int, str]]:
    """Number and text of the chunks that count as passages; the number is that of the first line."""
    lines = text.split("\n")
    if len(lines) < 2:
        return
    for begin, end in cut(lines):
        if sum(1 for x in lines[begin:end] if x.strip()) >= 2 or (end - begin == 1 and is_long(lines[begin])):
            yield begin, "\n".join(lines[begin:end])


def _hashes(text: Column) -> Column:
    @F.pandas_udf("array<struct<no:int,hi:long,lo:long>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(t):
            out = []
            for no, chunk in chunks(t) if isinstance(t, str) else ():
                d = xxhash.xxh3_128_digest(chunk.encode())
                out.append({"no": no, "hi": int.from_bytes(d[:8], "big", signed=True), "lo": int.from_bytes(d[8:], "big", signed=True)})
            return out
        for batch in batches:
            yield pd.Series([one(t) for t in batch])

    return run(text)


def _texts(text: Column, numbers: Column) -> Column:
    """The texts of the chunks with these numbers, in their order."""
    @F.pandas_udf("array<string>")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for batch, asked in batches:
            yield pd.Series([[found[n] for n in nos] if (found := dict(chunks(t))) else [] for t, nos in zip(batch, asked)])

    return run(text, numbers)


def _around(lines: list[str], begin: int, end: int) -> tuple[list[str], list[str]]:
    """The lines before and after a chunk, nearest first."""
    return lines[max(0, begin - MAX_LINES):begin][::-1], lines[end:end + MAX_LINES]


def _contexts(text: Column, numbers: Column) -> Column:
    """Line hashes around the chunks with these numbers, in their order."""
    @F.pandas_udf("array<struct<before:array<long>,after:array<long>>>")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        def one(t, nos):
            lines = t.split("\n")
            ends = dict(cut(lines))
            hashes: dict[int, int] = {}

            def digests(places):
                return [hashes[i] if i in hashes else hashes.setdefault(i, xxhash.xxh3_64_intdigest(lines[i].encode()) - (1 << 63)) for i in places]
            return [{"before": digests(range(no - 1, max(-1, no - 1 - MAX_LINES), -1)),
                     "after": digests(range(ends[no], min(len(lines), ends[no] + MAX_LINES)))} for no in nos]
        for batch, asked in batches:
            yield pd.Series([one(t, nos) for t, nos in zip(batch, asked)])

    return run(text, numbers)


def _pieces(text: Column, asked: Column) -> Column:
    """The text of so many lines (``n``) before or after the chunk ``no``, for each of ``asked``."""
    @F.pandas_udf("array<string>")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        def one(t, wanted):
            lines = t.split("\n")
            ends = dict(cut(lines))
            return ["\n".join(_around(lines, w["no"], ends[w["no"]])[w["after"]][:w["n"]]) for w in wanted]
        for batch, wanted in batches:
            yield pd.Series([one(t, w) for t, w in zip(batch, wanted)])

    return run(text, asked)


def _common(own: Column, first: Column) -> Column:
    """How many leading entries of two arrays are equal."""
    n = F.least(F.size(own), F.size(first))
    differs = F.array_position(F.zip_with(F.slice(own, 1, n), F.slice(first, 1, n), lambda a, b: a == b), False)
    return F.when(differs > 0, differs - 1).otherwise(n).cast("int")


def _without(text: Column, gone: Column) -> Column:
    """The text without these chunks (no, lines before, lines after), and how many lines went."""
    @F.pandas_udf("text string, lines int")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        def one(t, chunks_):
            if chunks_ is None or not len(chunks_):
                return t, 0
            lines = t.split("\n")
            ends = dict(cut(lines))
            out = bytearray(len(lines))
            for c in chunks_:
                first, last = c["no"] - c["before"], ends[c["no"]] + c["after"]
                out[first:last] = b"\1" * (last - first)
            kept = [x for x, o in zip(lines, out) if not o]
            return "\n".join(kept), len(lines) - len(kept)
        for batch, asked in batches:
            yield pd.DataFrame([one(t, c) for t, c in zip(batch, asked)], columns=["text", "lines"])

    return run(text, gone)


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", chunks_out: str = "removed_chunks",
          lines_out: str = "removed_lines") -> DataFrame:
    """``docs`` with repeated chunks taken out of ``text``, and how many chunks and lines went."""
    place = [F.col(key).alias("k"), F.xxhash64(text).alias("th")]
    at = F.struct("k", "th", "no").alias("at")
    seen = written(
        docs.filter(F.instr(text, "\n") > 0).select(*place, F.explode(_hashes(F.col(text))).alias("c"))
        .select("k", "th", "c.no", "c.hi", "c.lo").distinct(), "line-chunks")
    # written, so that the join stands alone in its stage and a hot chunk's rows can be split
    repeated = written(seen.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("first")).filter("n > 1"), "line-hashes")
    named = written(seen.join(repeated, ["hi", "lo"]).select("k", "th", "no", "hi", "lo", F.struct("k", "th", "no").eqNullSafe(F.col("first")).alias("is_first")), "line-repeats")

    def joined(rows: DataFrame, prefix: str, how: str, *fields: str) -> DataFrame:
        """``docs`` with their ``rows`` as one array ``prefix`` of structs of ``fields``."""
        side = (rows.groupBy("k", "th").agg(F.collect_list(F.struct(*fields)).alias(prefix))
                .withColumnsRenamed({"k": f"{prefix}_k", "th": f"{prefix}_th"}))
        return docs.join(side, F.col(key).eqNullSafe(side[f"{prefix}_k"]) & (F.xxhash64(text) == side[f"{prefix}_th"]), how)

    def spread(rows: DataFrame, values, *fields: str) -> DataFrame:
        """``rows`` with ``values(text, rows of the text)``, one for each, read from the texts, as ``x``."""
        found = joined(rows, "__asked", "inner", *fields).select("__asked_k", "__asked_th", "__asked", values(F.col(text), F.col("__asked")).alias("x"))
        return found.select(F.col("__asked_k").alias("k"), F.col("__asked_th").alias("th"), F.explode(F.arrays_zip("__asked", "x")).alias("z")).select(
            "k", "th", *(F.col(f"z.__asked.{f}").alias(f) for f in fields), "z.x").distinct()

    # Byte comparison: all candidates of one hash grouped by their bytes.
    def bytes_of(rows: DataFrame) -> DataFrame:
        return spread(rows, lambda t, asked: _texts(t, asked["no"]), "no", "hi", "lo").withColumnRenamed("x", "t")

    kinds = written(bytes_of(named).groupBy("hi", "lo", "t").agg(F.min(at).alias("first"))
                    .groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1"), "line-collisions")
    places = named.select("k", "th", "no", "hi", "lo", F.lit(0).alias("kind"), "is_first")
    if not kinds.isEmpty():
        # one hash, several byte strings: decide those chunks by their bytes
        clash = bytes_of(named.join(kinds, ["hi", "lo"], "left_semi"))
        first = clash.groupBy("hi", "lo", "t").agg(F.min(at).alias("first"))
        first = first.withColumn("kind", F.row_number().over(Window.partitionBy("hi", "lo").orderBy("first")))
        places = places.join(kinds, ["hi", "lo"], "left_anti").select(places.columns).union(
            clash.join(first, ["hi", "lo", "t"]).select("k", "th", "no", "hi", "lo", "kind", F.struct("k", "th", "no").eqNullSafe(F.col("first"))))

    # The lines around a repeated chunk that equal those around its first place.
    around = written(spread(places, lambda t, asked: _contexts(t, asked["no"]), "no", "hi", "lo", "kind", "is_first"), "line-contexts")
    chunk = ["hi", "lo", "kind"]
    firsts = around.filter("is_first").select(*chunk, F.col("k").alias("k1"), F.col("th").alias("th1"), F.col("no").alias("no1"), F.col("x").alias("x1"))
    met = written(around.filter("not is_first").join(firsts, chunk).select(
        "k", "th", "no", *chunk, "k1", "th1", "no1", _common(F.col("x.before"), F.col("x1.before")).alias("before"),
        _common(F.col("x.after"), F.col("x1.after")).alias("after")), "line-met")
    sides = met.select("*", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("before").alias("n")), F.struct(F.lit(1).alias("side"), F.col("after").alias("n")))).alias("s"))
    sides = sides.select(*met.columns, "s.side", "s.n").filter("n > 0")
    piece = [*chunk, "side", "n"]

    def piece_bytes(rows: DataFrame) -> DataFrame:
        rows = rows.withColumnRenamed("side", "after").distinct()
        return spread(rows, _pieces, "no", *chunk, "after", "n").withColumnsRenamed({"after": "side", "x": "t"})

    of_first = sides.select(F.col("k1").alias("k"), F.col("th1").alias("th"), F.col("no1").alias("no"), *piece)
    of_rest = sides.select("k", "th", "no", *piece)
    odd = written(piece_bytes(of_first.union(of_rest)).groupBy(*piece, "t").count().groupBy(*piece).agg(F.count(F.lit(1)).alias("kinds"))
                  .filter("kinds > 1").select(*piece), "line-pieces")
    gone = met.select("k", "th", "no", "before", "after")
    if not odd.isEmpty():
        # equal hashes, other bytes: a side of another text than the first place's is not taken
        own = piece_bytes(of_rest.join(odd, piece, "left_semi"))
        first = piece_bytes(of_first.join(odd, piece, "left_semi")).select(*piece, "t")
        wrong = own.join(first, [*piece, "t"], "left_anti").groupBy("k", "th", "no").agg(
            F.max(1 - F.col("side")).alias("not_before"), F.max("side").alias("not_after")).withColumnsRenamed({"k": "wk", "th": "wth", "no": "wno"})
        gone = gone.join(wrong, F.col("k").eqNullSafe(F.col("wk")) & (F.col("th") == F.col("wth")) & (F.col("no") == F.col("wno")), "left").select(
            "k", "th", "no", F.when(F.col("not_before") == 1, 0).otherwise(F.col("before")).alias("before"),
            F.when(F.col("not_after") == 1, 0).otherwise(F.col("after")).alias("after"))
    out = joined(gone, "__gone", "left", "no", "before", "after").withColumn("__new", _without(F.col(text), F.col("__gone")))
    return out.withColumns({text: F.col("__new.text"), chunks_out: F.coalesce(F.size("__gone"), F.lit(0)), lines_out: F.col("__new.lines")}).drop(
        "__new", "__gone", "__gone_k", "__gone_th")
