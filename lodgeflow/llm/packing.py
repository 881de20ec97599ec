"""Best-fit packing of documents into training sequences of several permitted lengths.

Documents longer than the largest length are cut into full pieces and a rest. Within a shard
the pieces are placed from the longest to the shortest, each into the open bin it leaves least
room in. Where none has room, a bin is opened: of the permitted lengths that hold the piece, the
one with the least cost for each token it can be expected to hold, given the tokens still to be
placed and the room already open. Once all is placed, each bin shrinks to the smallest permitted
length that holds its contents.

Only numbers travel: piece lengths are dealt at random to shards of about ``SHARD_PIECES`` pieces,
so a task holds a bounded number however many rows one source or key has, and what a shard can lose
against packing all at once is a part of its last bins.

Defined results: null, empty and blank texts hold no tokens; they come back as one row with
zero tokens and no bin. Repeated rows are packed each. Ties between bins go to the one opened first,
between pieces to the earlier row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeflow.llm.common import written

#: Permitted sequence lengths in tokens, and the fixed cost of a sequence in tokens.
CAPACITIES = (512, 1024, 2048, 4096)
BIN_COST = 16
SHARD_PIECES = 1 << 16


def word_count(text: Column) -> Column:
    """Tokens of a text: its words, separated by ASCII white space."""
    words = F.split(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")), " ")
    return F.when(F.coalesce(text, F.lit("")).rlike(r"[^\x20\x09-\x0D]"), F.size(words)).otherwise(0)


def pack(sizes: np.ndarray, capacities: Sequence[int] = CAPACITIES, bin_cost: float = BIN_COST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and place in it of each piece, and the capacity of each bin. No piece may exceed the
    largest capacity."""
    permitted = sorted(capacities)
    top = permitted[-1]
    bins = np.zeros(len(sizes), np.int64)
    places = np.zeros(len(sizes), np.int64)
    used: list[int] = []
    opened: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(top + 1)]  # open bins by free room, each a heap: the first opened comes first
    rooms = 0  # bit r is set if some bin has r tokens of room
    left, free = int(sizes.sum()), 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = heappop(by_room[room])
            if not by_room[room]:
                rooms ^= 1 << room
            free -= size
        else:
            later = max(0, left - size - free)  # tokens that will need room not open yet
            best = None
            for c in permitted:
                if c >= size:
                    held = size + min(c - size, later)
                    cost = (c + bin_cost) / held
                    if best is None or cost < best[0]:
                        best = (cost, c)
            room = best[1]
            b = len(used)
            used.append(0)
            opened.append(room)
            free += room - size
        bins[i], places[i] = b, used[b]
        used[b] += size
        left -= size
        rest = room - size
        if rest:
            heappush(by_room[rest], b)
            rooms |= 1 << rest
    filled = np.array(used, np.int64)
    final = np.array(permitted, np.int64)[np.searchsorted(permitted, filled)] if used else filled
    return bins, places, final


def pack_documents(docs: DataFrame, key: str = "doc_id", tokens: Column | None = None, text: str = "text",
                   capacities: Sequence[int] = CAPACITIES, bin_cost: float = BIN_COST, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """One row per piece: key, piece number, first token in the document, tokens, bin (shard and
    number), its capacity and the place of the piece in it."""
    top = max(capacities)
    n = word_count(F.col(text)) if tokens is None else tokens
    # the row number is part of the table from here on: a lost task reads it again
    rows = written(docs.select(F.col(key).alias("key"), F.coalesce(n.cast("long"), F.lit(0)).alias("n"))
                   .withColumn("row", F.monotonically_increasing_id()), "pack-sizes")
    pieces = F.greatest(F.lit(1), F.ceil(F.col("n") / top))
    total = rows.agg(F.coalesce(F.sum(pieces), F.lit(0)).alias("p")).first()["p"]
    shards = max(1, -(-int(total) // shard_pieces))
    cut = (rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), pieces.cast("long") - 1)))
           .withColumn("first_token", F.col("piece") * top)
           .withColumn("n_tokens", F.least(F.lit(top).cast("long"), F.col("n") - F.col("first_token")))
           .withColumn("shard", F.pmod(F.xxhash64("row", "piece"), F.lit(shards)).cast("int"))
           .select("shard", "row", "key", "piece", "first_token", "n_tokens"))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["row", "piece"], ignore_index=True)
        some = group["n_tokens"].to_numpy() > 0
        bins, places, final = pack(group["n_tokens"].to_numpy()[some], capacities, bin_cost)
        out = group[["key", "piece", "first_token", "n_tokens", "shard"]].copy()
        for name, values in (("bin", bins), ("bin_capacity", final[bins]), ("bin_offset", places)):
            column = np.full(len(out), np.nan)
            column[some] = values
            out[name] = pd.array(column, "Int64")
        out["key"] = group["key"]
        return out

    kind = cut.schema["key"].dataType.simpleString()
    out = cut.groupBy("shard").applyInPandas(run, f"key {kind}, piece long, first_token long, n_tokens long, shard int, bin long, bin_capacity long, bin_offset long")
    return out.select(F.col("key").alias(key), "piece", "first_token", "n_tokens", F.when(F.col("bin").isNotNull(), F.col("shard")).alias("shard"), "bin", "bin_capacity", "bin_offset")
