"""URL filter by the ratio of two character language models.

One variable-order Markov model is learned from accepted and one from rejected URLs. The probability
of a character blends all context lengths from none to ``ORDER``: each longer context's counts are
smoothed by the estimate of the next shorter one. A URL's score is the difference of the
log-likelihoods under the two models, divided by its length. The threshold is set on URLs that
the models it uses have not seen: those of each half are scored by models of the other half.

Rules on host and path come first; their verdicts are the labels that the models learn from, and
all URLs with one are counted. A rule fits its host and all subdomains, if the path starts with
that of the rule; the longest wins.

Counts are exact and their table grows with the contexts that occur. A context of ``ORDER`` bytes
with the byte after it is one 64-bit number, a gram; shorter ones are its low bytes. What a byte adds
to a score depends on its gram alone, so the two models are one table with a row per gram,
computed from the shortest context to the longest by joins: a gram meets the estimate of its low
bytes, at most 256 to one. URLs are scored in blocks of about ``BLOCK_BYTES``; a block gets
the rows of its own grams. Each different URL is counted and scored once, with its number of rows.

The models read the whole URL, with what follows ``?`` or ``#``; rules read host and path.

Defined results: a null URL or one without ``://`` has empty host and path. A null URL is scored as
the empty string, whose score is 0, any other as it stands. Scores at the threshold are allowed. If there is no accepted or no
rejected URL to learn from, the method allows. Where a half lacks a class, the other half's URLs don't
calibrate; without both classes among those that do, the threshold is 0. Repeated rows are judged alike; the columns put out
replace any of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgeflow.llm.common import written

ALLOW, BLOCK = "allow", "block"
#: (verdict, rule): a host and the path that follows it.
RULES = ((BLOCK, "net/"), (ALLOW, "example.net/en/"), (BLOCK, "example.com/de/"), (ALLOW, "org/fr/"))
#: Longest context and the weight of the shorter context's estimate.
ORDER = 5
WEIGHT = 2.0
#: Bytes of URLs that are scored together in a task.
BLOCK_BYTES = 1 << 20
#: (half, class) that a count belongs to; class 1 is rejected.
COUNTS = ("n00", "n01", "n10", "n11")


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judged(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else nulls."""
    out = F.struct(F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        h, slash, p = rule.partition("/")
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(slash + p))
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _grams(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Each byte of ``data`` with the ``ORDER`` bytes before it, the byte itself lowest. ``at`` is its
    place in its URL; before a URL stands zero."""
    out = data.astype(np.int64)
    for back in range(1, ORDER + 1):
        c = np.zeros(len(data), np.int64)
        c[back:] = data[:len(data) - back]
        c[at < back] = 0
        out |= c << (8 * back)
    return out


def _bytes(urls: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes, the place of each in its URL, and the URL sizes; a zero byte ends a URL."""
    coded = [u.encode() + b"\0" for u in urls]
    sizes = np.array([len(c) for c in coded], np.int64)
    starts = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(coded), np.uint8)
    return data, np.arange(len(data)) - np.repeat(starts, sizes), sizes


def _pieces(urls: list[str]) -> Iterator[tuple[int, int]]:
    begin = size = 0
    for i, u in enumerate(urls):
        size += len(u)
        if size >= BLOCK_BYTES:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(urls):
        yield begin, len(urls)


def counted(urls: DataFrame) -> DataFrame:
    """``COUNTS`` by (block, gram) over all ``urls`` (url, half, rejected, n, block); grams of URLs that
    have no class (``rejected`` null) are there with what others count."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["url"].tolist()
            cell = (batch["half"] * 2 + batch["rejected"].fillna(0)).to_numpy(np.int64)
            weight = batch["n"].where(batch["rejected"].notna(), 0).to_numpy(np.int64)
            for begin, end in _pieces(texts):
                data, at, sizes = _bytes(texts[begin:end])
                rows = pd.DataFrame({"block": np.repeat(batch["block"].to_numpy()[begin:end], sizes), "gram": _grams(data, at)})
                own = np.repeat(cell[begin:end], sizes)
                n = np.repeat(weight[begin:end], sizes)
                for i, name in enumerate(COUNTS):
                    rows[name] = np.where(own == i, n, 0)
                yield rows.groupby(["block", "gram"], as_index=False).sum()

    schema = "block long, gram long, " + ", ".join(f"{c} long" for c in COUNTS)
    return urls.mapInPandas(count, schema).groupBy("block", "gram").agg(*(F.sum(c).alias(c) for c in COUNTS))


def log_odds(counts: DataFrame) -> DataFrame:
    """(gram, odds_0, odds_1, odds_2) for every gram of ``counts`` (gram, ``COUNTS``): the logarithm of a
    byte's likelihood under the rejected model over that under the accepted one. ``odds_0`` is by
    models of half 1, ``odds_1`` by those of half 0, ``odds_2`` by both halves' counts."""
    seen = {"0": ("n10", "n11"), "1": ("n00", "n01")}
    shorter = None
    for order in range(ORDER + 1):
        low = F.lit((1 << (8 * (order + 1))) - 1)
        rows = counts.groupBy(F.col("gram").bitwiseAND(low).alias("gram")).agg(*(F.sum(c).alias(c) for c in COUNTS))
        context = Window.partitionBy(F.shiftright("gram", 8))  # at most 256 rows
        rows = rows.withColumns({f"c{c}": F.sum(c).over(context) for c in COUNTS})
        if shorter is None:
            rows = rows.withColumns({f"p{m}{k}": F.lit(1 / 256) for m in "012" for k in "01"})
        else:
            below = F.lit((1 << (8 * order)) - 1)
            rows = rows.withColumn("low", F.col("gram").bitwiseAND(below)).join(shorter.withColumnRenamed("gram", "low"), "low")
        estimates = {}
        for m in "012":
            for k in (0, 1):
                n = F.col(seen[m][k]) if m in seen else F.col(COUNTS[k]) + F.col(COUNTS[2 + k])
                c = F.col("c" + seen[m][k]) if m in seen else F.col("c" + COUNTS[k]) + F.col("c" + COUNTS[2 + k])
                estimates[f"p{m}{k}"] = (n + WEIGHT * F.col(f"p{m}{k}")) / (c + WEIGHT)
        shorter = rows.select("gram", *(e.alias(name) for name, e in estimates.items()))
    return shorter.select("gram", *((F.log(f"p{m}1") - F.log(f"p{m}0")).alias(f"odds_{m}") for m in "012"))


def scored(urls: DataFrame, odds: DataFrame) -> DataFrame:
    """``urls`` with ``score`` by both halves' models and ``unseen_score`` by those of the half that is
    not the URL's own. ``odds`` by (block, gram)."""

    def score(own: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values("gram")
        grams = table["gram"].to_numpy()
        by_model = [table[f"odds_{m}"].to_numpy() for m in range(3)]
        texts = own["url"].tolist()
        halves = own["half"].to_numpy()
        both, unseen = np.zeros(len(texts)), np.zeros(len(texts))
        for begin, end in _pieces(texts):
            data, at, sizes = _bytes(texts[begin:end])
            rows = np.searchsorted(grams, _grams(data, at))
            starts = np.cumsum(sizes) - sizes
            by_half = [np.add.reduceat(o[rows], starts) / sizes for o in by_model]
            both[begin:end] = by_half[2]
            unseen[begin:end] = np.where(halves[begin:end] == 0, by_half[0], by_half[1])
        empty = np.array([not t for t in texts])
        both[empty] = unseen[empty] = 0
        return own[["url", "half", "rejected", "n"]].assign(score=both, unseen_score=unseen)

    schema = "url string, half int, rejected int, n long, score double, unseen_score double"
    return urls.groupBy("block").cogroup(odds.groupBy("block")).applyInPandas(score, schema)


#: Scores are calibrated on this grid, so that what the driver gets has one size.
GRID = 0.002
REACH = 2000


def calibrated(scores: DataFrame) -> float:
    """The threshold with the least sum of both classes' error rates, from a histogram of
    ``scores`` (score, rejected, n); 0 unless both classes occur."""
    cell = F.greatest(F.lit(-REACH), F.least(F.lit(REACH), F.floor(F.col("score") / GRID)))
    found = (scores.groupBy(cell.alias("cell"))
             .agg(F.sum(F.col("rejected") * F.col("n")).alias("r"), F.sum((1 - F.col("rejected")) * F.col("n")).alias("a")).toPandas())
    r, a = np.zeros(2 * REACH + 1), np.zeros(2 * REACH + 1)
    at = found["cell"].to_numpy(int) + REACH
    r[at], a[at] = found["r"], found["a"]
    if not r.any() or not a.any():
        return 0.0
    # blocked from cell k on: the rejected below k and the accepted from k on are wrong
    wrong = (np.cumsum(r) - r) / r.sum() + (a.sum() - np.cumsum(a) + a) / a.sum()
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    return float((best[len(best) // 2] - REACH) * GRID)


def judge(pages: DataFrame, url: str = "url", rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``pages`` with host, path, rule, verdict and score (above ``threshold``: blocked)."""
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "score", "threshold")]
    ruled = pages.select(F.struct(*kept).alias("doc"), F.coalesce(F.col(url), F.lit("")).alias("url"))
    ruled = ruled.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    ruled = ruled.withColumn("by_rule", judged(F.col("host"), F.col("path"), rules))
    half = F.pmod(F.xxhash64("host"), F.lit(2)).cast("int")  # a host's pages are alike: one half has them all
    rejected = (F.col("by_rule.verdict") == BLOCK).cast("int")
    urls = written(ruled.groupBy("url", half.alias("half"), rejected.alias("rejected")).agg(F.count(F.lit(1)).alias("n")), "urls")
    total = urls.agg(F.sum(F.octet_length("url") + 1).alias("bytes"),
                     *(F.count_if((F.col("half") == h) & (F.col("rejected") == k)).alias(f"n{h}{k}") for h in (0, 1) for k in (0, 1))).first()
    out = [F.col("doc.*"), F.col("host"), F.col("path"), F.col("by_rule.rule").alias("rule")]
    if not all(total[f"n0{k}"] + total[f"n1{k}"] for k in (0, 1)):
        return ruled.select(*out, F.coalesce("by_rule.verdict", F.lit(ALLOW)).alias("verdict"),
                            F.lit(0.0).alias("score"), F.lit(0.0).alias("threshold"))
    blocks = -(-total["bytes"] // BLOCK_BYTES)
    urls = urls.withColumn("block", F.pmod(F.xxhash64("url"), F.lit(blocks)))
    counts = written(counted(urls), "url-grams")
    odds = counts.select("block", "gram").join(log_odds(counts), "gram")
    scores = written(scored(urls, odds), "url-scores")
    can = [h for h in (0, 1) if total[f"n{1 - h}0"] and total[f"n{1 - h}1"]]
    known = scores.filter(F.col("rejected").isNotNull() & F.col("half").isin(can))
    threshold = calibrated(known.select("rejected", "n", F.col("unseen_score").alias("score")))
    found = ruled.join(scores.select("url", "score"), "url", "left")
    by_score = F.when(F.col("score") > threshold, BLOCK).otherwise(ALLOW)
    return found.select(*out, F.coalesce("by_rule.verdict", by_score).alias("verdict"), "score", F.lit(threshold).alias("threshold"))
