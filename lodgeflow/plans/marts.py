"""Monthly KPI marts kept up to date from the snapshots' applies.

An apply changes the versions of some keys, and with them the months these versions cover or no
longer cover. Only these months are computed again, with the months that follow them in a group's
series, as their change compares with the month before (F4). They take the place of their
partitions; the other months' files stay.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodgeflow.functions import ratio
from lodgeflow.operators.history import VALID_FROM, VALID_TO, month_validity
from lodgeflow.operators.kpi import EXTRA_COLUMNS, MART_COLUMNS
from lodgeflow.operators.temporal import expand_months
from lodgeflow.plans import models as M
from lodgeflow.sources.sinks import list_names, materialize, overwrite_partitions
from lodgeflow.streaming.ingest import SnapshotTable

MONTH = "month_start"
#: Counts that the change columns compare: now and in the group's month before.
_COMPARED = {"listings_active": "before_active", "listings_inactive": "before_inactive"}


class MartTable:
    """One KPI mart over a listing and a host snapshot, partitioned by month.

    ``cells`` has the mart's rows, the counts beside the ratios and, of the month before in the group's
    series, the counts its change compares with. ``refreshes`` has one row per refresh: the
    applies it covers and the newest month. It is written last, so a refresh that failed anywhere is
    made again from the same applies and puts the same rows in the same partitions.

    The mart covers the months from ``since`` to that of the newest listing version. A month that has lost
    all its rows keeps one without a group, which ``mart`` leaves out.
    """

    def __init__(self, spark: SparkSession, base: str, kind: str, since: dt.date, boundary: str = "overlap"):
        self.spark = spark
        self.base = base.rstrip("/")
        self.boundary = boundary
        self.since = since
        l_groups, h_groups, self.how = M.MART_KINDS[kind]
        self.kind = kind
        self.groups = [*l_groups, *h_groups]

    # ------------------------------------------------------------------ reading
    def _last(self):
        """Row of the newest refresh, or None."""
        path = f"{self.base}/refreshes"
        done = [int(n.partition("=")[2]) for n in list_names(self.spark, path) if n.startswith("refresh=")]
        return self.spark.read.parquet(f"{path}/refresh={max(done)}").first().asDict() | {"refresh": max(done)} if done else None

    def _cells(self) -> DataFrame | None:
        path = f"{self.base}/cells"
        return self.spark.read.parquet(path) if any(n.startswith(f"{MONTH}=") for n in list_names(self.spark, path)) else None

    def mart(self, extra: bool = False) -> DataFrame | None:
        """The mart after the last refresh, as ``models.kpi_mart`` has it."""
        cells = self._cells()
        if cells is None:
            return None
        return (cells.withColumn(MONTH, F.col(MONTH).cast("date")).filter(F.col("listings_total") > 0)
                .select(*self.groups, *MART_COLUMNS, *(EXTRA_COLUMNS if extra else ())))

    # ----------------------------------------------------------------- refreshing
    def refresh(self, listings: SnapshotTable, hosts: SnapshotTable) -> list[dt.date]:
        """Bring the mart to the snapshots' last applies; the months that were written."""
        last = self._last() or {"refresh": -1, "listings": -1, "hosts": -1, "newest": None}
        if (last["listings"], last["hosts"]) == (listings.version, hosts.version) or listings.version < 0:
            return []
        newest = self._newest(listings)
        if newest is None or newest < self.since:
            return []
        touched = self._touched(listings, "listing_id", last["listings"], last["newest"], newest)
        touched |= self._touched(hosts, "host_id", last["hosts"], last["newest"], newest)
        written = self._recompute(sorted(touched), listings, hosts) if touched else []
        done = self.spark.createDataFrame([(last["refresh"] + 1, listings.version, hosts.version, newest)],
                                          "refresh int, listings int, hosts int, newest date")
        overwrite_partitions(done, f"{self.base}/refreshes", ["refresh"])
        return written

    def _newest(self, listings: SnapshotTable) -> dt.date | None:
        """Month of the newest listing version: the state has every key's newest one."""
        return listings.state().agg(F.trunc(F.max(VALID_FROM).cast("date"), "month").alias("m")).first()["m"]

    def _touched(self, table: SnapshotTable, key: str, since: int, old: dt.date | None, new: dt.date) -> set[dt.date]:
        """Months whose rows differ after the applies from ``since`` on: those that a new version
        covers, those that a closed one covered while it was open, and those that open versions reach
        as the mart's end moves from ``old`` to ``new``. The driver gets months."""
        found: set[dt.date] = set()
        if old is None or old < new:
            found |= set(_months(_next_month(old) if old else self.since, new))
        lo, hi = self.since, max(new, old or new)
        spans = []
        for apply in range(since + 1, table.version + 1):
            begun, ended = table.changes(apply, key)
            spans.append(begun.select(VALID_FROM, VALID_TO))
            if ended is not None:
                # before, it had no end: from the month it ends in on, the row may have gone
                spans.append(ended.select(F.col(VALID_TO).alias(VALID_FROM), F.lit(None).cast("timestamp_ntz").alias(VALID_TO)))
        if spans:
            # one row per pair of months before the pairs are spread over the months they cover
            covers = month_validity(reduce(DataFrame.unionByName, spans), boundary=self.boundary).select("valid_from_month", "valid_to_month").distinct()
            found |= {r[0] for r in expand_months(covers, lo, hi).select(MONTH).distinct().collect()}
        return {m for m in found if m >= self.since}

    def _recompute(self, touched: Sequence[dt.date], listings: SnapshotTable, hosts: SnapshotTable) -> list[dt.date]:
        """New rows of the touched months, and of those whose month before has changed."""
        own = F.col(MONTH).isin(list(touched))
        host_versions = hosts.current()
        if host_versions is None:
            raise ValueError("the host snapshot has no apply yet")
        # from the first to the last touched month; the versions' scan skips what ended before
        base = M.kpi_base(M.dim_snap_listing(listings.current(), self.boundary), M.dim_snap_host(host_versions, self.boundary),
                          (touched[0], touched[-1]), self.how).filter(own)
        base = materialize(self.spark, base, "mart-base")   # read by the sums and by the median
        fresh = materialize(self.spark, M.kpi_mart(base, self.kind, extra=True).drop("pct_change_active", "pct_change_inactive"), "mart-cells")
        series, stored = fresh.select(*self.groups, MONTH, *_COMPARED, *(F.lit(None).cast("long").alias(b) for b in _COMPARED.values()),
                                      F.lit(True).alias("_new")), self._cells()
        if stored is not None:
            stored = stored.withColumn(MONTH, F.col(MONTH).cast("date")).filter(~own & (F.col("listings_total") > 0))
            series = series.unionByName(stored.select(*self.groups, MONTH, *_COMPARED, *_COMPARED.values(), F.lit(False).alias("_new")))
        # a row per group and month: counts only, of which the table has few columns to read
        by_group = Window.partitionBy(*self.groups).orderBy(MONTH)
        lagged = series.withColumns({f"_{b}": F.lag(c).over(by_group) for c, b in _COMPARED.items()})
        same = F.lit(True)
        for b in _COMPARED.values():
            same = same & F.col(b).eqNullSafe(F.col(f"_{b}"))
        lagged = materialize(self.spark, lagged.withColumn("_same", ~F.col("_new") & same), "mart-series")
        after = [r[0] for r in lagged.filter(~F.col("_same") & ~F.col("_new")).select(MONTH).distinct().collect()]
        rows = fresh
        if after:
            kept = stored.filter(F.col(MONTH).isin(after)).drop("pct_change_active", "pct_change_inactive", *_COMPARED.values())
            rows = fresh.unionByName(kept)
        keys = [*self.groups, MONTH]
        before = lagged.filter(F.col(MONTH).isin([*touched, *after])).select(*keys, *(F.col(f"_{b}").alias(b) for b in _COMPARED.values()))
        rows = rows.join(before, keys, "left")
        rows = rows.withColumns({f"pct_change_{c.removeprefix('listings_')}": ratio(F.col(c) - F.col(b), F.col(b)) for c, b in _COMPARED.items()})
        # a touched month without rows is one row of no group, so that its partition is replaced too
        marks = self.spark.createDataFrame([(m,) for m in touched], f"{MONTH} date").join(fresh.select(MONTH).distinct(), MONTH, "left_anti")
        rows = materialize(self.spark, rows.unionByName(marks.withColumn("listings_total", F.lit(0).cast("long")), allowMissingColumns=True), "mart-rows")
        overwrite_partitions(rows, f"{self.base}/cells", [MONTH])
        return sorted({*touched, *after})


def _next_month(day: dt.date) -> dt.date:
    return dt.date(day.year + day.month // 12, day.month % 12 + 1, 1)


def _months(first: dt.date, last: dt.date) -> list[dt.date]:
    out = []
    while first <= last:
        out.append(first)
        first = _next_month(first)
    return out
