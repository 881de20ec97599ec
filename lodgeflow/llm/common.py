"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeflow.session import ensure_checkpoint_dir, scratch_path

#: Characters handled at once inside a task; bounds the memory of one vectorised pass.
BLOCK_CHARS = 1 << 20
#: Fractions are decided on this many hash values.
HASH_STEPS = 1 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, file_rows: int | None = None) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: lineage ends there. ``file_rows``:
    most rows of a file, if given."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.option("maxRecordsPerFile", file_rows) if file_rows else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in ``spark.checkpoint.dir``."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def below(key: Column, share: float) -> Column:
    """Whether the key hashes below ``share``: a sample that is the same on every run."""
    if share >= 1:
        return F.lit(True)
    return F.pmod(F.xxhash64(key, F.lit(17)), F.lit(HASH_STEPS)) < int(share * HASH_STEPS)


def text_groups(texts, most_chars: int) -> Iterator[tuple[int, int]]:
    """Index ranges over ``texts`` of about ``most_chars`` characters each."""
    begin = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most_chars:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def codepoints(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def restored(kind: type, state: dict):
    """An object of ``kind`` with the attributes ``state``: broadcasts carry plain data only."""
    out = object.__new__(kind)
    out.__dict__.update(state)
    return out
