"""Relational databases over JDBC, as a sink with load strategies and a source."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from strandline.sources.tables import APPEND, TRUNCATE, check_strategy


@dataclass(frozen=True)
class Slices:
    """How a read is cut: a numeric or date column, its range, number of slices."""

    column: str
    lower: str
    upper: str
    count: int


def write_options(strategy: str, batch_rows: int, connections: int) -> dict[str, str]:
    check_strategy(strategy)
    return {
        "truncate": str(strategy == TRUNCATE).lower(),
        "batchsize": str(batch_rows),
        "numPartitions": str(connections),
    }


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    strategy: str,
    properties: Mapping[str, str] | None = None,
    batch_rows: int = 10_000,
    connections: int = 16,
) -> None:
    """Load a database table in batches over at most ``connections`` connections."""
    options = write_options(strategy, batch_rows, connections)
    mode = "append" if strategy == APPEND else "overwrite"
    df.write.options(**options).jdbc(url, table, mode, dict(properties or {}))


def read_options(
    url: str,
    table: str,
    properties: Mapping[str, str] | None,
    slices: Slices | None,
    fetch_rows: int,
) -> dict[str, str]:
    options = {
        "url": url,
        "dbtable": table,
        "fetchsize": str(fetch_rows),
        **(properties or {}),
    }
    if slices:
        options |= {
            "partitionColumn": slices.column,
            "lowerBound": slices.lower,
            "upperBound": slices.upper,
            "numPartitions": str(slices.count),
        }
    return options


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    slices: Slices | None = None,
    fetch_rows: int = 10_000,
) -> DataFrame:
    """A database table; with ``slices`` it is read in parallel.

    Filters and columns reach the database.  Without slices one task reads all,
    which only suits small tables.
    """
    options = read_options(url, table, properties, slices, fetch_rows)
    return spark.read.format("jdbc").options(**options).load()
