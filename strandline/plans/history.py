"""A type 2 history on plain Parquet, published load by load.

Spark cannot update Parquet in place.  A load therefore adds the versions it
opened and those it closed, and leaves all others alone, however many there are;
every now and then a load writes all open versions anew, so that readers have
few changes to put together.  Loads are whole folders: reading a state prunes to
the folders it needs.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.functions.expressions import version_id
from strandline.operators.dedup import latest_per_key
from strandline.operators.scd2 import (
    CHANGE,
    CLOSE,
    FROM,
    TO,
    UPDATED,
    VERSION,
    first_snapshot,
    merge_snapshot,
)
from strandline.sources.versions import LOAD, VersionedTable

STATE, OPEN, CLOSED = "state", "open", "closed"
# The load that opened a version.
OPENED_BY = "opened_by_load"


@dataclass(frozen=True)
class HistoryStore:
    """Every ``whole_every`` loads all open versions are written anew."""

    spark: SparkSession
    root: str
    keys: tuple[str, ...]
    check: tuple[str, ...]
    close_missing: bool = False
    whole_every: int = 10

    @property
    def table(self) -> VersionedTable:
        return VersionedTable(self.spark, self.root, partition_by=(STATE,))

    def apply(self, landing: DataFrame, snapshot_ts: datetime, token: str) -> int:
        """Merge a landing into the history; a known ``token`` changes nothing.

        The landing may be a part of the keys only, unless missing keys are to
        be closed.
        """
        table = self.table
        done = table.finished()
        known = [load.number for load in done if load.token == token]
        if known:
            return known[0]
        last = done[-1].number if done else 0
        load = last + 1
        whole = not done or load - table.base_of(last) >= self.whole_every
        if not done:
            rows = first_snapshot(landing, self.keys, snapshot_ts)
            opened_by = F.lit(load)
        else:
            rows = merge_snapshot(
                self._open(last),
                landing,
                self.keys,
                self.check,
                snapshot_ts,
                self.close_missing,
                changes_only=not whole,
                carry=[OPENED_BY],
            )
            opened_by = F.coalesce(F.col(OPENED_BY), F.lit(load))
        state = F.when(F.col(CHANGE) == CLOSE, CLOSED).otherwise(OPEN)
        marked = rows.withColumns(
            {OPENED_BY: opened_by.cast("bigint"), STATE: state}
        ).drop(CHANGE)
        table.write_load(marked, load, token, snapshot_ts, whole)
        return load

    def apply_deliveries(
        self,
        deliveries: DataFrame,
        date: str,
        ties: tuple[str, ...],
        token: str,
        snapshot_ts: datetime,
    ) -> int:
        """Take in several deliveries at once, by their dates; a known ``token``
        changes nothing.  All rows must be newer than what their keys have.

        The open versions are where the windows of ``history_from_deliveries`` begin,
        so one pass does for all deliveries, and one load is written.
        """
        table = self.table
        done = table.finished()
        known = [load.number for load in done if load.token == token]
        if known:
            return known[0]
        last = done[-1].number if done else 0
        load = last + 1
        whole = not done or load - table.base_of(last) >= self.whole_every
        fresh = latest_per_key(deliveries, [*self.keys, date], ties)
        start = F.col(date).cast("timestamp_ntz")
        opened = (
            fresh.withColumn(VERSION, version_id(list(self.keys), start))
            .withColumns({UPDATED: start, FROM: start, TO: F.lit(None).cast("timestamp_ntz")})
            .withColumns({OPENED_BY: F.lit(load).cast("bigint"), "_old": F.lit(False)})
        )
        if done:
            before = self._open(last).withColumn("_old", F.lit(True))
            opened = before.unionByName(opened.select(before.columns))
        line = Window.partitionBy(*self.keys).orderBy(FROM, F.col("_old").desc())
        state = F.struct(*self.check)
        versions = (
            opened.withColumn("_same", state.eqNullSafe(F.lag(state).over(line)))
            .filter(F.col("_old") | ~F.col("_same"))
            .withColumn(TO, F.lead(FROM).over(line))
        )
        if not whole:
            versions = versions.filter(~F.col("_old") | F.col(TO).isNotNull())
        state_of = F.when(F.col(TO).isNull(), OPEN).otherwise(CLOSED)
        marked = versions.withColumn(STATE, state_of).drop("_old", "_same")
        table.write_load(marked, load, token, snapshot_ts, whole)
        return load

    def _state(self, load: int | None) -> int:
        load = self.table.latest_load() if load is None else load
        if load is None:
            raise LookupError(f"{self.root} has no load yet")
        return load

    def _open(self, load: int) -> DataFrame:
        """Open versions: the last whole load, and what came and went since."""
        table = self.table
        base = table.base_of(load)
        rows = table.all_loads().filter(F.col(LOAD).between(base, load))
        opened = rows.filter(F.col(STATE) == OPEN).drop(LOAD, STATE)
        if base == load:
            return opened
        gone = rows.filter((F.col(STATE) == CLOSED) & (F.col(LOAD) > base))
        # A load may open several versions of a key, and loads may share a moment.
        version = [*self.keys, VERSION, OPENED_BY]
        # The join puts its columns first; the order of the table is kept.
        left = opened.join(gone.select(*version), version, "left_anti")
        return left.select(*opened.columns)

    def current(self, load: int | None = None) -> DataFrame:
        """The open versions after a load (the latest if none is named)."""
        return self._open(self._state(load)).drop(OPENED_BY)

    def history(self, load: int | None = None) -> DataFrame:
        """All versions after a load (the latest if none is named)."""
        last = self._state(load)
        closed = self.table.all_loads().filter(
            (F.col(STATE) == CLOSED) & (F.col(LOAD) <= last)
        )
        return self.current(last).unionByName(closed.drop(LOAD, STATE, OPENED_BY))
