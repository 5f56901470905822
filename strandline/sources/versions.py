"""Tables that keep every load: read the latest one, one by number, or as of a time.

A load is written to a folder of its own and counts only once its line in the
list of loads is there, so readers never see half a load, and a load that was
cut short is simply written again.  One writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOAD = "load_id"
FILE, FILE_STATE = "source_file", "file_state"
_ENTRY = "token string, loaded_at timestamp_ntz, columns string, whole boolean"


@dataclass(frozen=True)
class Load:
    """One finished load; ``columns`` is its schema as JSON.

    A load that is not ``whole`` only holds what changed since the one before.
    """

    number: int
    token: str
    loaded_at: datetime
    columns: str
    whole: bool

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.columns))


@dataclass(frozen=True)
class VersionedTable:
    spark: SparkSession
    root: str
    partition_by: tuple[str, ...] = ()

    @property
    def data_path(self) -> str:
        return f"{self.root}/data"

    @property
    def loads_path(self) -> str:
        return f"{self.root}/loads"

    def loads(self) -> DataFrame:
        """``load_id``, ``token`` and ``loaded_at`` of every finished load."""
        return self._entries().select(LOAD, "token", "loaded_at")

    def _entries(self) -> DataFrame:
        try:
            return (
                self.spark.read.schema(f"{_ENTRY}, {LOAD} bigint")
                .parquet(self.loads_path)
                .select(LOAD, "token", "loaded_at", "columns", "whole")
            )
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], f"{LOAD} bigint, {_ENTRY}")

    def finished(self) -> list[Load]:
        """The finished loads in order; one small row per load."""
        found = [Load(*row) for row in self._entries().collect()]
        return sorted(found, key=lambda load: load.number)

    def latest_load(self) -> int | None:
        done = self.finished()
        return done[-1].number if done else None

    def load_of(self, token: str) -> int | None:
        """The number of the load that was made for ``token``, if it was."""
        numbers = (load.number for load in self.finished() if load.token == token)
        return next(numbers, None)

    def base_of(self, load_id: int) -> int:
        """The last whole load up to ``load_id``."""
        return max(
            load.number
            for load in self.finished()
            if load.whole and load.number <= load_id
        )

    def write_load(
        self,
        df: DataFrame,
        load_id: int,
        token: str,
        loaded_at: datetime,
        whole: bool = True,
    ) -> bool:
        """Write one load; False (and nothing done) if it is there already."""
        if any(load_id == load.number for load in self.finished()):
            return False
        writer = df.write.mode("overwrite")
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(f"{self.data_path}/{LOAD}={load_id}")
        text = loaded_at.strftime("%Y-%m-%d %H:%M:%S.%f")
        entry = self.spark.range(1, numPartitions=1).select(
            F.lit(token).alias("token"),
            F.lit(text).cast("timestamp_ntz").alias("loaded_at"),
            F.lit(df.schema.json()).alias("columns"),
            F.lit(whole).alias("whole"),
        )
        entry.write.mode("overwrite").parquet(f"{self.loads_path}/{LOAD}={load_id}")
        return True

    def all_loads(self) -> DataFrame:
        """The rows of all finished loads, with ``load_id``.

        Loads may differ in their columns: each row has the columns of all loads,
        unknown where its own load had none.
        """
        done = self.finished()
        if not done:
            raise LookupError(f"{self.root} has no load yet")
        fields = {}
        for load in done:
            fields.update({field.name: field for field in load.schema.fields})
        schema = T.StructType([*fields.values(), T.StructField(LOAD, T.LongType())])
        rows = (
            self.spark.read.option("basePath", self.data_path)
            .schema(schema)
            .parquet(self.data_path)
        )
        # A list of numbers prunes the folders of unfinished loads.
        return rows.filter(F.col(LOAD).isin([load.number for load in done]))

    def rows_of(self, load_id: int) -> int:
        """How many rows one load wrote."""
        path = f"{self.data_path}/{LOAD}={load_id}"
        return self.spark.read.parquet(path).count()

    def _read(self, load: Load) -> DataFrame:
        if not load.whole:
            raise LookupError(
                f"load {load.number} of {self.root} holds changes only, not the table"
            )
        path = f"{self.data_path}/{LOAD}={load.number}"
        return self.spark.read.schema(load.schema).parquet(path)

    def read_version(self, load_id: int) -> DataFrame:
        """The table as one load left it."""
        for load in self.finished():
            if load.number == load_id:
                return self._read(load)
        raise LookupError(f"{self.root} has no load {load_id}")

    def read_latest(self) -> DataFrame:
        done = self.finished()
        if not done:
            raise LookupError(f"{self.root} has no load yet")
        return self._read(done[-1])

    def load_as_of(self, moment: datetime) -> Load:
        known = [load for load in self.finished() if load.loaded_at <= moment]
        if not known:
            raise LookupError(f"{self.root} has no load before {moment}")
        return max(known, key=lambda load: (load.loaded_at, load.number))

    def read_as_of(self, moment: datetime) -> DataFrame:
        """The table as it stood at a time."""
        return self._read(self.load_as_of(moment))

    def expire(self, keep: int) -> list[int]:
        """Drop the loads that none of the last ``keep`` states needs; their numbers.

        The lines of the loads go first, so nobody begins to read one that is half
        gone.  A reader that began before fails: keep as many as readers may be behind.
        """
        if keep < 1:
            raise ValueError("at least one load must be kept")
        done = self.finished()
        if len(done) <= keep:
            return []
        first = self.base_of(done[-keep].number)
        gone = [load.number for load in done if load.number < first]
        hadoop = self.spark.sparkContext._jsc.hadoopConfiguration()
        for folder in (self.loads_path, self.data_path):
            for number in gone:
                path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{LOAD}={number}")
                path.getFileSystem(hadoop).delete(path, True)
        return gone


@dataclass(frozen=True)
class FileTable:
    """A table that takes in files, and in each load only those that are new or changed.

    A load adds rows to ``rows`` and then writes ``files``, a list with one row per file
    that names the load which holds its rows; a state is the rows that its list names.
    So a file that comes again, empty too, takes the place of what it brought before,
    one that is no longer listed goes, and earlier states stay as they were.  Rows of a
    load without a list are never seen.
    """

    spark: SparkSession
    root: str

    @property
    def rows(self) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/rows")

    @property
    def files(self) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/files")

    def latest_load(self) -> int | None:
        return self.files.latest_load()

    def load_of(self, token: str) -> int | None:
        return self.files.load_of(token)

    def take(
        self,
        listed: DataFrame,
        rows_of: Callable[[DataFrame], DataFrame],
        token: str,
        loaded_at: datetime,
    ) -> int:
        """Take in what is ``listed`` (``source_file``, ``file_state``: any text that
        changes with the file; each file once); a known ``token`` changes nothing.

        ``rows_of`` gets the files that are new or changed, with both columns, and
        returns their rows with ``source_file``.
        """
        known = self.load_of(token)
        if known is not None:
            return known
        load = max(self.rows.latest_load() or 0, self.files.latest_load() or 0) + 1
        listed = listed.select(FILE, FILE_STATE)
        if self.files.latest_load() is None:
            merged = listed.withColumn("held_by", F.lit(load).cast("bigint"))
        else:
            before = self.files.read_latest()
            merged = listed.join(before, [FILE, FILE_STATE], "left").select(
                FILE, FILE_STATE, F.coalesce("held_by", F.lit(load).cast("bigint")).alias("held_by")
            )
        fresh = merged.filter(F.col("held_by") == load).select(FILE, FILE_STATE)
        self.rows.write_load(rows_of(fresh), load, token, loaded_at, whole=False)
        self.files.write_load(merged, load, token, loaded_at)
        return load

    def _state(self, files: DataFrame, load: int) -> DataFrame:
        rows = self.rows.all_loads().filter(F.col(LOAD) <= load)
        held = files.select(FILE, F.col("held_by").alias(LOAD))
        columns = [c for c in rows.columns if c != LOAD]
        return rows.join(held, [FILE, LOAD], "left_semi").select(*columns)

    def read_version(self, load_id: int) -> DataFrame:
        return self._state(self.files.read_version(load_id), load_id)

    def read_latest(self) -> DataFrame:
        return self._state(self.files.read_latest(), self.files.latest_load())

    def read_as_of(self, moment: datetime) -> DataFrame:
        load = self.files.load_as_of(moment).number
        return self.read_version(load)
