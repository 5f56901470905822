"""Deliveries as a stream: bronze, landing and history are kept up batch by batch.

This adds to the batch flow; the result is the one a full rebuild would give, but for
rows that come too late to be a version after what their key already has.  Those are
kept in bronze and in a table of their own, and are counted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.operators.dedup import latest_per_key
from strandline.plans.history import HistoryStore
from strandline.sources.delimited import (
    KEEP,
    MALFORMED,
    SOURCE_FILE,
    header_lines,
    layouts_of,
    numbered,
    parsed,
    stream_text,
)
from strandline.sources.versions import LOAD, VersionedTable


@dataclass(frozen=True)
class DeliveryIngest:
    """One register that is fed by a stream of delivery rows.

    A batch is stored first and everything else is derived from what was
    stored.  Each step is known by its batch, so a batch that comes again after a
    failure goes on where it stopped.  Landing and history take in what changed;
    every ``whole_every`` batches they are written as a whole.
    """

    spark: SparkSession
    root: str
    keys: tuple[str, ...]
    date: str
    check: tuple[str, ...]
    ties: tuple[str, ...] = ()
    whole_every: int = 10

    @property
    def bronze(self) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/bronze")

    @property
    def landing_log(self) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/landing")

    @property
    def history(self) -> HistoryStore:
        return HistoryStore(
            self.spark,
            f"{self.root}/history",
            self.keys,
            self.check,
            whole_every=self.whole_every,
        )

    @property
    def quarantine(self) -> VersionedTable:
        """Rows whose date or key is unknown, by batch."""
        return VersionedTable(self.spark, f"{self.root}/quarantine")

    @property
    def late(self) -> VersionedTable:
        """Rows no newer than what their key had before their batch, by batch."""
        return VersionedTable(self.spark, f"{self.root}/late")

    @property
    def malformed(self) -> VersionedTable:
        """Lines that do not fit the header of their file, by batch."""
        return VersionedTable(self.spark, f"{self.root}/malformed")

    def apply_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Take in one batch: all its deliveries in one pass, in the order of their
        dates.  Rows without a date or key can be no version; they are kept apart.
        """
        load, token, never = batch_id + 1, f"batch-{batch_id}", datetime(1970, 1, 1)
        self.bronze.write_load(batch, load, token, never)
        stored = self.bronze.read_version(load)
        unknown = self._unknown()
        self.quarantine.write_load(stored.filter(unknown), load, token, never)
        self._apply_rows(stored.filter(~unknown), load, token)

    def apply_text(
        self,
        text: DataFrame,
        batch_id: int,
        columns: Sequence[str],
        to_rows: Callable[[DataFrame], DataFrame],
    ) -> None:
        """Take in one batch of delimited lines (``stream_text``).

        Each line is read by the header of its own file, which is in the same batch;
        ``columns`` that no header of the batch has are unknown.  ``to_rows`` makes
        delivery rows of these text columns and ``source_file``.  Malformed lines are
        kept apart.
        """
        lines = numbered(text)
        heads = header_lines(lines)
        known = layouts_of(heads)
        if not known:
            return
        rows = parsed(lines, heads, known, malformed=KEEP)
        bad = rows.filter(F.col(MALFORMED).isNotNull())
        self.malformed.write_load(
            bad.select(SOURCE_FILE, F.col(MALFORMED).alias("line")),
            batch_id + 1, f"batch-{batch_id}", datetime(1970, 1, 1),
        )
        have = {c.lower() for c in rows.columns}
        sound = rows.filter(F.col(MALFORMED).isNull()).select(
            *[
                F.col(c) if c.lower() in have else F.lit(None).cast("string").alias(c)
                for c in columns
            ],
            SOURCE_FILE,
        )
        self.apply_batch(to_rows(sound), batch_id)

    def _unknown(self):
        unknown = F.col(self.date).isNull()
        for key in self.keys:
            unknown = unknown | F.col(key).isNull()
        return unknown

    def quarantined(self) -> DataFrame:
        """Number of rows kept apart, per batch."""
        return self.quarantine.all_loads().groupBy(LOAD).agg(F.count(F.lit(1)).alias("rows"))

    def late_counts(self) -> DataFrame:
        """Number of rows that came too late, by batch, key and delivery."""
        keys = [LOAD, *self.keys, self.date]
        return self.late.all_loads().groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))

    def account(self) -> DataFrame:
        """For each batch: rows of ``bronze``, ``on_time``, ``late`` and ``quarantined``.

        On time is what bronze itself tells: newer than all rows of the key in batches
        before.  Late and quarantined are counted where they were put, so the three
        add up only if nothing got lost on the way.
        """
        stored = self.bronze.all_loads()
        at = F.struct(self.date, *self.ties)
        known = stored.filter(~self._unknown())
        # One row per key and batch, so the window is as long as there are batches.
        newest = known.groupBy(*self.keys, LOAD).agg(F.max(at).alias("_newest"))
        before = Window.partitionBy(*self.keys).orderBy(LOAD).rowsBetween(
            Window.unboundedPreceding, -1
        )
        seen = newest.withColumn("_seen", F.max("_newest").over(before)).drop("_newest")
        timely = known.join(seen, [*self.keys, LOAD]).filter(
            F.col("_seen").isNull() | (at > F.col("_seen"))
        )
        sides = {
            "bronze": stored, "on_time": timely,
            "late": self.late.all_loads(), "quarantined": self.quarantine.all_loads(),
        }
        counted = None
        for side, frame in sides.items():
            one = frame.groupBy(LOAD).agg(F.count(F.lit(1)).alias("rows"))
            one = one.withColumn("side", F.lit(side))
            counted = one if counted is None else counted.unionByName(one)
        return counted.groupBy(LOAD).agg(
            *[
                F.coalesce(F.sum(F.when(F.col("side") == side, F.col("rows"))), F.lit(0).cast("bigint"))
                .alias(side)
                for side in sides
            ]
        )

    def _newest(self, rows: DataFrame) -> DataFrame:
        return latest_per_key(rows, self.keys, [self.date, *self.ties])

    def _landing_rows(self, load: int) -> DataFrame:
        """The last whole landing and the winners of the deliveries since."""
        since = F.col(LOAD).between(self.landing_log.base_of(load), load)
        return self.landing_log.all_loads().filter(since).drop(LOAD)

    def landing(self) -> DataFrame:
        """One row per key, the newest of all deliveries so far."""
        last = self.landing_log.latest_load()
        if last is None:
            raise LookupError(f"{self.root} has no landing yet")
        return self._newest(self._landing_rows(last))

    def _apply_rows(self, rows: DataFrame, batch_load: int, token: str) -> None:
        log = self.landing_log
        moment = datetime(1970, 1, 1)
        load = log.load_of(token)
        before = load - 1 if load else (log.latest_load() or 0)
        if load is None:
            load = before + 1
            whole = not before or load - log.base_of(before) >= self.whole_every
            fresh = rows
            if whole and before:
                fresh = rows.unionByName(self._landing_rows(before))
            log.write_load(self._newest(fresh), load, token, moment, whole)
        # A delivery that is no newer than what its key had before came too late.
        if before:
            seen = self._newest(self._landing_rows(before)).select(
                *self.keys, F.struct(self.date, *self.ties).alias("_seen")
            )
            newer = F.col("_seen").isNull() | (F.struct(self.date, *self.ties) > F.col("_seen"))
            met = rows.join(seen, list(self.keys), "left").select(*rows.columns, newer.alias("_newer"))
            rows = met.filter("_newer").drop("_newer")
            late = met.filter("NOT _newer").drop("_newer")
        else:
            late = rows.filter(F.lit(False))
        self.late.write_load(late, batch_load, token, moment)
        self.history.apply_deliveries(rows, self.date, self.ties, token, moment)

    def start(self, deliveries: DataFrame):
        """Process everything that is there, then stop."""
        return (
            deliveries.writeStream.foreachBatch(self.apply_batch)
            .option("checkpointLocation", f"{self.root}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )


    def start_text(
        self,
        root: str,
        columns: Sequence[str],
        to_rows: Callable[[DataFrame], DataFrame],
        glob: str = "*.txt",
        files_at_once: int = 1000,
    ):
        """Process all delimited deliveries below ``root`` that are new, then stop."""
        text = stream_text(self.spark, root, glob, files_at_once=files_at_once)
        return (
            text.writeStream.foreachBatch(lambda t, i: self.apply_text(t, i, columns, to_rows))
            .option("checkpointLocation", f"{self.root}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )


def replay_as_stream(
    deliveries: DataFrame,
    root: str,
    keys: list[str],
    date: str,
    check: tuple[str, ...],
    ties: list[str],
) -> DataFrame:
    """Store rows as files, stream them in week by week, and return the history."""
    spark = deliveries.sparkSession
    inbox = f"{root}/inbox"
    week = F.date_trunc("WEEK", F.col(date).cast("timestamp_ntz"))
    register = DeliveryIngest(spark, root, tuple(keys), date, check, tuple(ties))
    weeks = deliveries.select(week.alias("week")).distinct().collect()
    for (start,) in sorted(weeks, key=lambda r: (r[0] is not None, r[0])):
        part = deliveries.filter(week.eqNullSafe(F.lit(start)))
        part.write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(deliveries.schema).parquet(inbox)
        register.start(stream).awaitTermination()
    return register.history.history()
