"""Hive-partitioned Parquet: reading, overwriting, and columns that come later."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

STATIC, DYNAMIC = "static", "dynamic"


def read_hive(spark: SparkSession, root: str, evolved: bool = False) -> DataFrame:
    """The table with the keys of its path; ``evolved`` unites differing schemas."""
    return (
        spark.read.option("basePath", root)
        .option("mergeSchema", str(evolved).lower())
        .parquet(root)
    )


def write_hive(
    df: DataFrame, root: str, partition_by: Sequence[str], overwrite: str = STATIC
) -> None:
    """Replace the table (static) or only the partitions that come in (dynamic).

    Rebalancing gives each partition few files of even size and splits one that
    holds most of the rows over several tasks.
    """
    if overwrite not in (STATIC, DYNAMIC):
        raise ValueError(f"unknown overwrite mode: {overwrite!r}")
    (
        df.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", overwrite)
        .partitionBy(*partition_by)
        .parquet(root)
    )


def append_evolving(df: DataFrame, root: str) -> None:
    """Add rows whose columns may differ from those before; read them ``evolved``."""
    df.write.mode("append").parquet(root)
