"""Type-2 history.

History is built in closed form with window functions partitioned by the
entity key: one shuffle on the key, then a sort within each partition. The
incremental form (``scd2_apply``) touches only the open versions plus the new
batch; closed versions pass through without a shuffle.

Where one key may hold a large share of all rows, ``slices`` cuts its history into slices of
time: windows run inside (key, slice), and one row per slice carries what its neighbours need, so
the rows of a hot key are many tasks' work.

Versions carry ``dbt_valid_from`` / ``dbt_valid_to`` (TIMESTAMP_NTZ, open end
NULL). ``month_validity`` turns them into month-aligned validity.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VALID_FROM = "dbt_valid_from"
VALID_TO = "dbt_valid_to"
_SLICE = "_slice"


def _ts(c: Column) -> Column:
    return c.cast("timestamp_ntz")


def _observed(hist: DataFrame, key: str, updated_at: str, slices: str | None) -> DataFrame:
    """Rows with a key and a time, and the slice of time they are in: a calendar unit of ``trunc``, or
    ``day``. Dates need no time zone, so slices follow the order of the rows."""
    rows = hist.filter(F.col(key).isNotNull() & F.col(updated_at).isNotNull())
    if slices is None:
        return rows
    day = F.col(updated_at).cast("date")
    return rows.withColumn(_SLICE, day if slices == "day" else F.trunc(day, slices))


def _valid_to(starts: DataFrame, key: str, updated_at: str, slices: str | None) -> DataFrame:
    """``starts`` with the time at which the next version of the key starts (``_next``). Across slices
    it is the first start of the next slice that has one: one row per slice, summed up before the
    shuffle."""
    if slices is None:
        return starts.withColumn("_next", F.lead(updated_at).over(Window.partitionBy(key).orderBy(F.col(updated_at))))
    by_key = Window.partitionBy("_sk").orderBy("_ss")
    later = (starts.groupBy(F.col(key).alias("_sk"), F.col(_SLICE).alias("_ss")).agg(F.min(updated_at).alias("_begin"))
             .select("_sk", "_ss", F.lead("_begin").over(by_key).alias("_later")))
    inside = Window.partitionBy(key, _SLICE).orderBy(F.col(updated_at))
    return (starts.withColumn("_lead", F.lead(updated_at).over(inside))
            .join(later, (F.col(key) == F.col("_sk")) & (F.col(_SLICE) == F.col("_ss")))
            .withColumn("_next", F.coalesce("_lead", "_later")))


def scd2_timestamp(hist: DataFrame, key: str, updated_at: str, slices: str | None = None) -> DataFrame:
    """Timestamp strategy; every newer ``updated_at`` of a key opens a version.

    ``hist`` holds one row per (key, updated_at). The version is valid until
    the next ``updated_at`` of the same key; the newest version stays open.

    ``slices`` (``year``, ``quarter``, ``month``, ``week``, ``day``) is for hot keys: the result is the
    same, a task sorts a key's rows of one slice, and the history is read once more for the slices'
    first times.
    """
    rows = _observed(hist, key, updated_at, slices)
    return _valid_to(rows, key, updated_at, slices).select(
        *hist.columns, _ts(F.col(updated_at)).alias(VALID_FROM), _ts(F.col("_next")).alias(VALID_TO))


def _changed(check_cols: Sequence[str], w: Window) -> Column:
    """True when any check column differs (NULL-safe) from the previous row."""
    diff = F.lit(False)
    for c in check_cols:
        diff = diff | ~F.col(c).eqNullSafe(F.lag(c).over(w))
    return diff


def scd2_check(hist: DataFrame, key: str, updated_at: str,
               check_cols: Sequence[str], slices: str | None = None) -> DataFrame:
    """Check strategy; a version opens when any check column changes.

    ``valid_from`` is the ``updated_at`` of the changing row and a version ends
    where the next one begins. Both windows share one partitioning and sort.

    ``slices`` as in ``scd2_timestamp``: the first row of a slice is compared with the last row of the
    key's slice before it, of which there is one row per slice.
    """
    cols = hist.columns
    rows = _observed(hist, key, updated_at, slices)
    if slices is None:
        w = Window.partitionBy(key).orderBy(F.col(updated_at))
        marked = rows.withColumn("_start", (F.row_number().over(w) == 1) | _changed(check_cols, w))
    else:
        w = Window.partitionBy(key, _SLICE).orderBy(F.col(updated_at))
        checks = F.struct(*check_cols)
        by_key = Window.partitionBy("_ck").orderBy("_cs")
        before = (rows.groupBy(F.col(key).alias("_ck"), F.col(_SLICE).alias("_cs")).agg(F.max_by(checks, updated_at).alias("_last"))
                  .select("_ck", "_cs", F.lag("_last").over(by_key).alias("_before")))
        # a struct of nulls is no null: null is the key's first slice alone
        marked = (rows.withColumns({"_first": F.row_number().over(w) == 1, "_differs": _changed(check_cols, w)})
                  .join(before, (F.col(key) == F.col("_ck")) & (F.col(_SLICE) == F.col("_cs")))
                  .withColumn("_start", F.when(F.col("_first"), F.col("_before").isNull() | ~checks.eqNullSafe(F.col("_before")))
                              .otherwise(F.col("_differs"))))
    starts = marked.filter(F.col("_start")).select(*rows.columns)
    return _valid_to(starts, key, updated_at, slices).select(
        *cols, _ts(F.col(updated_at)).alias(VALID_FROM), _ts(F.col("_next")).alias(VALID_TO))


def _stacked(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of both frames. The columns of ``a`` are made anew: when both sides come partitioned
    by key, a union takes that partitioning as its own, although adaptive execution may give the
    sides different numbers of partitions, and windows or joins above it then see half a key."""
    anew = a.select(F.explode(F.array(F.struct(*a.columns))).alias("_r")).select("_r.*")
    return anew.unionByName(b)


def scd2_step(open_v: DataFrame | None, batch: DataFrame, key: str, updated_at: str,
              check_cols: Sequence[str] | None = None, close_missing: bool = False,
              as_of: Column | None = None, closed: DataFrame | None = None) -> DataFrame:
    """J3/J4 core: re-evaluate the open versions together with one batch.

    Returns the versions of every key in ``open_v`` or ``batch``: previously
    open versions (now possibly closed) plus the new ones. Work is one shuffle
    on ``key`` over open versions + batch only, independent of the closed
    history. Batch rows not newer than the open version of their key are
    ignored; with ``check_cols`` a row opens a version only if a check column
    changed, otherwise every newer row does. ``close_missing`` (hard deletes)
    closes open versions whose key is absent from the batch at ``as_of``
    (default: newest ``updated_at`` of the batch, fetched as one aggregated row).

    ``closed`` (the closed history) guards against replays: a row that a closed
    version of its key begins at or covers is ignored too, so an old batch does not
    reopen a key that was deleted since. Only keys of the batch are looked up,
    by key and times.
    """
    cols = list(batch.columns)
    batch = batch.filter(F.col(key).isNotNull() & F.col(updated_at).isNotNull())
    if open_v is None:
        versions = (scd2_check(batch, key, updated_at, check_cols) if check_cols
                    else scd2_timestamp(batch, key, updated_at))
        return versions.select(*cols, VALID_FROM, VALID_TO)

    open_from = open_v.select(F.col(key).alias("_k"), F.col(VALID_FROM).alias("_open_from"))
    when = _ts(F.col(updated_at))
    fresh = (batch.join(open_from, batch[key] == open_from["_k"], "left")
             .filter(F.col("_open_from").isNull() | (when > F.col("_open_from"))))
    if closed is not None:
        wanted = batch.select(F.col(key).alias("_c")).distinct()
        last = (closed.select(F.col(key).alias("_c"), VALID_FROM, VALID_TO)
                .join(wanted, "_c", "left_semi").groupBy("_c")
                .agg(F.max(VALID_FROM).alias("_closed_from"), F.max(VALID_TO).alias("_closed_to")))
        fresh = (fresh.join(last, fresh[key] == last["_c"], "left")
                 .filter(F.col("_closed_to").isNull()
                         | ((when >= F.col("_closed_to")) & (when > F.col("_closed_from")))))
    fresh = fresh.select(*cols, F.lit(False).alias("_is_open"),
                         F.lit(None).cast("timestamp_ntz").alias("_from"))
    carried = open_v.select(*cols, F.lit(True).alias("_is_open"), F.col(VALID_FROM).alias("_from"))
    both = _stacked(carried, fresh)

    w = Window.partitionBy(key).orderBy(F.col("_is_open").desc(), F.col(updated_at))
    if check_cols:
        keep = (both.withColumn("_keep", F.col("_is_open") | (F.row_number().over(w) == 1)
                                | _changed(check_cols, w))
                .filter("_keep").drop("_keep"))
    else:
        keep = both
    rebuilt = (keep.withColumn(VALID_FROM, F.coalesce(F.col("_from"), _ts(F.col(updated_at))))
               .withColumn(VALID_TO, _ts(F.lead(updated_at).over(w))))

    if close_missing:
        seen = batch.select(F.col(key).alias("_bk")).distinct().withColumn("_seen", F.lit(True))
        rebuilt = rebuilt.join(seen, rebuilt[key] == seen["_bk"], "left")
        if as_of is None:       # the batch time: one aggregated row, used as a literal
            newest = batch.agg(F.max(updated_at).cast("string").alias("t")).first()["t"]
            as_of = F.lit(newest)
        rebuilt = rebuilt.withColumn(
            VALID_TO, F.when(F.col(VALID_TO).isNull() & F.col("_seen").isNull(), _ts(as_of))
            .otherwise(F.col(VALID_TO)))
    return rebuilt.select(*cols, VALID_FROM, VALID_TO)


def scd2_apply(current: DataFrame | None, batch: DataFrame, key: str, updated_at: str,
               check_cols: Sequence[str] | None = None, close_missing: bool = False,
               as_of: Column | None = None) -> DataFrame:
    """Apply one batch to a snapshot table, as a snapshot run would.

    Closed versions of ``current`` pass through untouched (no shuffle); the
    open ones are re-evaluated with the batch by ``scd2_step``.
    """
    if current is None:
        return scd2_step(None, batch, key, updated_at, check_cols, close_missing, as_of)
    cols = list(batch.columns)
    closed = current.filter(F.col(VALID_TO).isNotNull()).select(*cols, VALID_FROM, VALID_TO)
    open_v = current.filter(F.col(VALID_TO).isNull())
    return _stacked(
        closed, scd2_step(open_v, batch, key, updated_at, check_cols, close_missing, as_of, closed))


def with_version_key(df: DataFrame, name: str, parts: Sequence[Column]) -> DataFrame:
    """Surrogate key ``md5(concat_ws('|', parts...))``."""
    return df.withColumn(name, F.md5(F.concat_ws("|", *parts)))


def month_validity(df: DataFrame, from_col: str = VALID_FROM, to_col: str = VALID_TO,
                   boundary: str = "overlap") -> DataFrame:
    """``is_current`` and month-aligned validity.

    ``valid_from_month`` is the month of ``from`` (NULL -> 1970-01). The open
    end stays NULL (consumers treat NULL as open). For a closed version:

    * ``overlap`` (the reference rule): exclusive end = month of ``to`` + 1,
      so the change month belongs to both the old and the new version;
    * ``half_open``: exclusive end = month of ``to``, so each month belongs to
      the last version begun in or before it.
    """
    if boundary not in ("overlap", "half_open"):
        raise ValueError(f"unknown boundary {boundary!r}")
    to_month = F.trunc(F.col(to_col), "month")
    if boundary == "overlap":
        to_month = F.add_months(to_month, 1)
    return df.withColumns({
        "is_current": F.col(to_col).isNull(),
        "valid_from_month": F.trunc(F.coalesce(F.col(from_col).cast("date"),
                                               F.lit("1970-01-01").cast("date")), "month"),
        "valid_to_month": F.when(F.col(to_col).isNotNull(), to_month),
    })
