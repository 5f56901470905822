"""One line per step of a run: what it did, how many rows, how long."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SCHEMA = "run_id string, step string, status string, rows bigint, seconds double"


@dataclass(frozen=True)
class RunLog:
    spark: SparkSession
    path: str
    run_id: str

    def add(self, step: str, status: str, rows: int | None, seconds: float) -> None:
        line = self.spark.range(1, numPartitions=1).select(
            F.lit(self.run_id).alias("run_id"),
            F.lit(step).alias("step"),
            F.lit(status).alias("status"),
            F.lit(rows).cast("bigint").alias("rows"),
            F.lit(float(seconds)).alias("seconds"),
        )
        line.write.mode("append").parquet(self.path)

    def write(
        self, step: str, df: DataFrame, action: Callable[[DataFrame], None]
    ) -> int:
        """Run a write and log it; rows are counted as they pass, not again."""
        counted = Observation()
        begin = time.monotonic()
        try:
            action(df.observe(counted, F.count(F.lit(1)).alias("rows")))
        except Exception:
            self.add(step, "error", None, time.monotonic() - begin)
            raise
        rows = counted.get["rows"]
        self.add(step, "success", rows, time.monotonic() - begin)
        return rows

    def lines(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.path)
