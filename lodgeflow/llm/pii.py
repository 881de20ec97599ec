"""Personal data: pattern spans, and the terms that give them away.

Base spans are e-mail and IP addresses, card and phone numbers. Each distinct value of one is a
protected entity e. Terms are the words of a text outside its base spans. Over the documents of the
whole corpus, p(e|t) = n(e, t) / n(t) says how sure a reader who sees the term t can be of e, and
PMI(e; t) = log p(e|t) / p(e), measured in units of the information -log p(e) of the entity, how
much of it the term discloses: 0 tells nothing, 1 tells e. All three counts are of whole documents.

A term at or over ``DISCLOSURE`` for any entity is generalised wherever it stands in any text, one
at or over ``REMOVAL`` is removed. Where t falls on texts at random, the probability that so many
of those with e have it, by Hoeffding's bound for draws without replacement, must be ``ERROR`` at
most, divided by the number of pairs (e, t) that are tested. A pair that meets in one text only is no
evidence: any rare word beside a rare entity does. Nor are copies: equal texts count once, and k texts
whose shingles of five words agree by J on average count as k / (1 + (k - 1) J) in the bound, and not
at all from ``COPY`` on; J is estimated by ``HASHES`` smallest hashes of a text's shingles.

Built-in functions only. All counts are combined before the shuffle, by 64-bit hash. Entities of a
single text are left out first, and of the others only terms rare enough to reach the threshold are
paired with them, which changes no result. A text's spans are found ``CHUNK`` at a time, so that the
work grows with its length, not with the square of its matches.

Defined results: a null text has no spans; a null key stays; repeated rows are treated alike; an
entity that stands in every document has nothing left to disclose. Further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeflow.llm.common import written

KINDS = ("email", "ip", "card", "phone", "term")
#: Least length of a term; most probability that a term meets an entity so often by chance.
TERM_CHARS = 3
ERROR = 0.01
#: Different texts in which a term must meet an entity, and the likeness from which they are copies.
SUPPORT = 2
COPY = 0.8
HASHES = 8
#: Matches of a text that are handled together.
CHUNK = 256
DISCLOSURE = 0.9
REMOVAL = 1.0

# The contract's patterns, written so that no match backtracks over a long run: a match can start
# only where its run of characters starts or where the last match ended, and runs are possessive.
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
_CARD = r"[0-9](?:[\x20-]?[0-9]){13,}+"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_TERM = r"(?<![\p{L}\p{N}])\p{L}{%d,}+(?!\p{N})" % TERM_CHARS

_FOUND = "array<struct<start:int,end:int,value:string>>"
_SPAN = "array<struct<start:int,no:int,end:int,value:string>>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _chunks(items: Column) -> Column:
    """The array in slices of ``CHUNK``; none of an empty array."""
    def cut(bound: Column) -> Column:
        starts = F.when(F.size(bound) > 0, F.sequence(F.lit(1), F.size(bound), F.lit(CHUNK))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.slice(bound, i, CHUNK))

    return _let(items, cut)


def positions(text: Column, matches: Column, pattern: str, wanted: Callable[[Column], Callable[[Column], Column]] | None = None) -> Column:
    """Start and end in code points of all ``matches`` of ``pattern`` in ``text``. ``wanted`` makes, of the
    values of a chunk, the test that picks those to return."""
    # with the text behind the last match as one more pair, which goes again
    pairs = _let(F.zip_with(F.split(text, pattern, -1), matches, lambda g, m: F.struct(F.length(g).alias("gap"), m.alias("value"))),
                 lambda all_: F.slice(all_, 1, F.size(all_) - 1))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.length(x["value"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value")))).alias("out"))

    # ends within each chunk first, then where each chunk begins
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(_FOUND).alias("out"))
    local = F.transform(_chunks(pairs), lambda c: F.aggregate(c, zero, step))
    if wanted:
        local = F.transform(local, lambda c: F.struct(c["at"].alias("at"), _let(
            wanted(F.transform(c["out"], lambda x: x["value"])), lambda own: F.filter(c["out"], lambda x: F.array_contains(own, _hashed(x["value"])))).alias("out")))

    def moved(c: Column, at: Column) -> Column:
        return F.transform(c["out"], lambda x: F.struct((at + x["start"]).alias("start"), (at + x["end"]).alias("end"), x["value"].alias("value")))

    def shifted(local: Column) -> Column:
        begins = F.aggregate(local, F.array(F.lit(0)), lambda acc, c: F.concat(acc, F.array(F.element_at(acc, -1) + c["at"])))
        return F.flatten(F.zip_with(local, F.slice(begins, 1, F.size(local)), moved))

    return _let(local, shifted)


def rewritten(text: Column, spans: Column, put: Callable[[Column], Column], merge: bool) -> Column:
    """The text with ``put(span)`` for each of the sorted spans. Of overlapping spans the first counts;
    with ``merge`` each of them does, and all their characters go."""
    def step(acc: Column, s: Column) -> Column:
        piece = F.substring(acc["near"], acc["at"] - acc["base"] + 1, F.greatest(F.lit(0), s["start"] - acc["at"]))
        after = F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], piece, put(s)).alias("out"),
                         acc["outs"].alias("outs"), acc["base"].alias("base"), acc["near"].alias("near"))
        return after if merge else F.when(s["start"] >= acc["at"], after).otherwise(acc)

    def chunk(acc: Column, c: Column) -> Column:
        # a chunk works on the stretch of the text up to the last begin of its spans
        reach = F.greatest(F.lit(0), F.element_at(c, -1)["start"] - acc["at"])
        return F.aggregate(c, F.struct(
            acc["at"].alias("at"), F.lit("").alias("out"), F.concat(acc["outs"], F.array(acc["out"])).alias("outs"), acc["at"].alias("base"),
            F.substring(text, acc["at"] + 1, reach).alias("near")), step)

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"), F.array().cast("array<string>").alias("outs"), F.lit(0).alias("base"), F.lit("").alias("near"))
    return F.aggregate(_chunks(spans), zero, chunk, lambda acc: F.array_join(
        F.concat(acc["outs"], F.array(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))), ""))


def _luhn(value: Column) -> Column:
    digits = F.lpad(F.regexp_replace(value, "[^0-9]", ""), 19, "0")
    total = F.lit(0)
    for i in range(1, 20):
        d = F.substring(digits, i, 1).cast("int")
        total = total + (F.when(d > 4, 2 * d - 9).otherwise(2 * d) if (19 - i) % 2 else d)
    return total % 10 == 0


def _digits(value: Column) -> Column:
    return F.length(F.regexp_replace(value, "[^0-9]", ""))


def with_base_spans(docs: DataFrame, text: str, out: str) -> DataFrame:
    """``docs`` with the sorted base spans as an array column."""
    t = F.col(text)
    plans = [
        (0, _EMAIL, F.contains(t, F.lit("@")), None),
        (1, _IP, F.contains(t, F.lit(".")), lambda v: v.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")),
        (2, _CARD, F.lit(True), lambda v: (_digits(v) <= 19) & _luhn(v)),
        (3, _PHONE, F.contains(t, F.lit("+")), lambda v: _digits(v).between(10, 15)),
    ]
    none = F.array().cast("array<string>")
    names = [f"__pii{no}" for no, *_ in plans]
    matched = docs.withColumns({
        name: F.coalesce(F.when(maybe, F.regexp_extract_all(t, F.lit(pattern), F.lit(0))), none)
        for name, (_, pattern, maybe, _) in zip(names, plans)})
    def spans_of(name: str, no: int, pattern: str, check) -> Column:
        found = F.when(F.size(name) > 0, positions(t, F.col(name), pattern)).otherwise(F.array().cast(_FOUND))
        if check:
            found = F.filter(found, lambda x: check(x["value"]))
        return F.transform(found, lambda x: F.struct(x["start"].alias("start"), F.lit(no).alias("no"), x["end"].alias("end"), x["value"].alias("value")))

    parts = [spans_of(name, no, pattern, check) for name, (no, pattern, _, check) in zip(names, plans)]
    any_found = F.lit(False)
    for name in names:
        any_found = any_found | (F.size(name) > 0)
    return matched.withColumn(out, F.when(any_found, F.array_sort(F.concat(*parts))).otherwise(F.array().cast(_SPAN))).drop(*names)


def _blanked(text: Column, spans: Column) -> Column:
    """The text with a blank for each span."""
    return rewritten(text, spans, lambda s: F.lit(" "), merge=True)


def _hashed(word: Column) -> Column:
    return F.xxhash64(F.lower(word))


def _words(text: Column) -> Column:
    """Hashes of the different terms of a text."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(_TERM), F.lit(0)), _hashed))


def _signature(text: Column) -> Column:
    """The smallest of each of ``HASHES`` hashes of the text's shingles of five words."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    shingles = _let(words, lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(w) - 4)), lambda i: F.xxhash64(F.slice(w, i, 5))))
    return _let(shingles, lambda all_: F.array(*(F.array_min(F.transform(all_, lambda x: F.xxhash64(x, F.lit(j)))) for j in range(HASHES))))


def _likeness(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, likeness): how alike the texts of a group are on average, by their ``signature``, for
    groups of two texts or more."""
    same = rows.select(*keys, F.posexplode("signature").alias("i", "v")).groupBy(*keys, "i", "v").agg(F.count(F.lit(1)).alias("c"))
    sums = same.groupBy(*keys).agg(F.sum(F.col("c") * F.col("c")).alias("pairs"), F.sum("c").alias("k"))
    k = F.col("k") / HASHES
    return sums.select(*keys, ((F.col("pairs") / HASHES - k) / (k * k - k)).alias("likeness"))


def disclosing_terms(holders: DataFrame, docs: DataFrame, text: str, error: float = ERROR, threshold: float = DISCLOSURE) -> DataFrame:
    """(h, disclosure): the hashes of the terms at or over the threshold for an entity. ``holders``
    has the rows of ``docs`` with base spans, as ``row``, ``th``, ``base`` and the text."""
    entities = F.array_distinct(F.transform("base", lambda s: F.xxhash64(s["no"], F.lower(s["value"]))))
    once = written(holders.groupBy("th").agg(F.min("row").alias("row"), F.count(F.lit(1)).alias("copies")), "pii-texts")
    n = docs.count()
    theirs = holders.select("row", F.explode(entities).alias("e")).join(once.select("row", "copies"), "row")
    counts = written(theirs.groupBy("e").agg(F.sum("copies").alias("n_e"), F.count(F.lit(1)).alias("e_texts"))
                     .filter((F.col("e_texts") >= SUPPORT) & (F.col("n_e") < n)), "pii-entities")
    bare_text = _blanked(F.col(text), F.col("base"))
    signed = written(holders.join(theirs.join(counts, "e").select("row").distinct(), "row").select("row", _signature(bare_text).alias("signature")), "pii-signatures")
    apart = _likeness(theirs.join(counts, "e").join(signed, "row"), ["e"]).filter(F.col("likeness") < COPY).select("e")
    counts = written(counts.join(apart, "e"), "pii-apart")
    theirs = written(theirs.join(counts, "e"), "pii-holders-of")
    most = counts.agg(F.max("n_e")).first()[0]
    if most is None:  # no entity stands in several texts that are not copies
        return docs.sparkSession.createDataFrame([], "h long, disclosure double")
    texts = docs.select(F.xxhash64(text).alias("th")).distinct().count()
    held = holders.join(theirs.select("row").distinct(), "row", "left_semi")
    bare = _words(bare_text)
    near = held.select("row", F.explode(bare).alias("h"))
    # words that a text has inside its base spans only are none of its terms
    counted = docs.select(F.explode(_words(F.col(text))).alias("h"), F.lit(1).alias("w")).unionByName(
        holders.select(F.explode(F.array_except(_words(F.col(text)), bare)).alias("h"), F.lit(-1).alias("w")))

    def reach(n_e: Column) -> Column:
        """Over this n_t no term can be at the threshold, as n_et is n_e at most."""
        return n_e * F.pow(F.lit(float(n)) / n_e, F.lit(1 - threshold)) * (1 + 1e-6)

    n_t = counted.groupBy("h").agg(F.sum("w").alias("n_t"))
    rare = n_t.filter((F.col("n_t") >= SUPPORT) & (F.col("n_t") <= reach(F.lit(float(most)))))
    theirs = theirs.withColumnRenamed("row", "its")
    joint = written(near.join(rare, "h").join(theirs, (F.col("row") == F.col("its")) & (F.col("n_t") <= reach(F.col("n_e"))))
                    .select("e", "h", "row", "copies", "n_e", "e_texts", "n_t"), "pii-joint")
    tested = joint.groupBy("e", "h").agg(*(F.first(c).alias(c) for c in ("n_e", "e_texts", "n_t")), F.sum("copies").alias("n_et"),
                                         F.count(F.lit(1)).alias("texts")).filter(F.col("texts") >= SUPPORT)
    tested = written(tested, "pii-pairs")
    limit = math.log(error) - math.log(max(1, tested.count()))
    disclosure = F.log(F.col("n_et") * F.lit(float(n)) / (F.col("n_t") * F.col("n_e"))) / F.log(F.lit(float(n)) / F.col("n_e"))
    # the share of texts with the term: copies of those that show both count once
    share = F.least(F.lit(1.0), (F.col("texts") + F.col("n_t") - F.col("n_et")) / F.lit(float(texts)))
    seen = F.col("texts") / F.col("e_texts")
    others = F.when(F.col("texts") < F.col("e_texts"), (F.col("e_texts") - F.col("texts")) * F.log((1 - seen) / (1 - share))).otherwise(0.0)
    chance = F.when(seen > share, -(F.col("texts") * F.log(seen / share) + others)).otherwise(0.0)
    likely = (tested.withColumns({"disclosure": disclosure, "chance": chance})
              .filter((F.col("disclosure") >= threshold - 1e-9) & (F.col("chance") <= limit + 1e-9)).select("e", "h", "texts", "disclosure", "chance"))
    alike = _likeness(joint.select("e", "h", "row").join(likely.select("e", "h"), ["e", "h"]).join(signed, "row"), ["e", "h"])
    bound = F.col("chance") / (1 + (F.col("texts") - 1) * F.col("likeness"))
    return (likely.join(alike, ["e", "h"]).filter((F.col("likeness") < COPY) & (bound <= limit + 1e-9))
            .groupBy("h").agg(F.max("disclosure").alias("disclosure")))


def _terms(text: Column, base: Column, telling: Column) -> Column:
    """Spans of all words whose hash is in the map ``telling``, but for those inside a base span."""
    words = F.regexp_extract_all(text, F.lit(_TERM), F.lit(0))
    keys = F.map_keys(telling)
    found = positions(text, words, _TERM, lambda values: F.array_intersect(F.transform(values, _hashed), keys))
    spans = F.transform(found, lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index("term")).alias("no"), x["end"].alias("end"),
                                                  F.element_at(telling, _hashed(x["value"])).alias("value")))
    return F.when(F.size(base) > 0, F.filter(spans, lambda x: ~F.exists(base, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))).otherwise(spans)


def find(docs: DataFrame, text: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs`` with ``base`` and ``terms``, arrays of spans; texts without base spans are null
    unless ``keep_text``. A term's ``no`` is 4 and its ``value`` is ``generalise`` or ``remove``.
    Columns of these names are replaced. Only the rows with base spans are written."""
    based = with_base_spans(docs, text, "base")
    some = F.size("base") > 0
    th = F.xxhash64(text)
    holders = written(based.filter(some).withColumns({"row": F.monotonically_increasing_id(), "th": th}), "pii-holders")
    telling = written(disclosing_terms(holders, docs, text), "pii-telling")
    action = F.when(F.col("disclosure") >= REMOVAL - 1e-9, "remove").otherwise("generalise")
    # equal hashes of two texts only add terms to look for: a term is marked wherever it stands
    hits = docs.select(th.alias("__th"), F.explode(_words(F.col(text))).alias("h")).join(telling.select("h", action.alias("v")), "h")
    # written, so that its size is known and a short list is sent to the texts, not the texts to it
    hits = written(hits.distinct().groupBy("__th").agg(F.map_from_entries(F.collect_list(F.struct("h", "v"))).alias("__telling")), "pii-hits")

    def marked(rows: DataFrame) -> DataFrame:
        rows = rows.join(hits, F.xxhash64(text) == F.col("__th"), "left")
        terms = F.when(F.col("__telling").isNotNull(), _terms(F.col(text), F.col("base"), F.col("__telling")))
        return rows.withColumn("terms", F.coalesce(terms, F.array().cast(_SPAN))).drop("__th", "__telling")

    found = marked(holders.drop("terms", "row", "th"))
    clean = marked(based.filter(~some))
    if not keep_text:
        clean = clean.withColumn(text, F.lit(None).cast("string"))
    return found.unionByName(clean.select(*found.columns))


def digest(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    kind = F.array(*(F.lit(k) for k in KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kind, s["no"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["no"] == KINDS.index(kind))).cast("long")


def redacted(text: Column, spans: Column) -> Column:
    """The text with base spans and generalised terms replaced by their kind and removed terms
    taken out; of overlapping spans the first counts."""
    label = F.array(*(F.lit(f"<{k.upper()}>") for k in KINDS))

    def put(s: Column) -> Column:
        return F.when(s["value"].eqNullSafe("remove") & (s["no"] == KINDS.index("term")), "").otherwise(F.element_at(label, s["no"] + 1))

    return F.when(F.size(spans) > 0, rewritten(text, spans, put, merge=False)).otherwise(text)


def sanitise(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with personal data and the terms that disclose it taken out of ``text``."""
    found = find(docs.select(F.struct("*").alias("__doc"), F.col(text).alias("__text")), "__text", keep_text=True)
    spans = F.array_sort(F.concat("base", "terms"))
    fields = [F.col(f"__doc.`{c}`").alias(c) for c in docs.columns]
    return found.select(*fields, redacted(F.col("__text"), spans).alias("__new")).withColumn(text, F.col("__new")).drop("__new")
