"""Catalog tables with the load strategies replace, truncate and append."""

from __future__ import annotations

from pyspark.sql import DataFrame

REPLACE, TRUNCATE, APPEND = "replace", "truncate", "append"
STRATEGIES = (REPLACE, TRUNCATE, APPEND)


def check_strategy(strategy: str) -> None:
    if strategy not in STRATEGIES:
        raise ValueError(
            f"unknown strategy {strategy!r}: use one of {', '.join(STRATEGIES)}"
        )


def write_table(
    df: DataFrame, table: str, strategy: str = REPLACE, by_name: bool = False
) -> None:
    """Load a table.

    ``replace`` makes the table anew, ``truncate`` keeps its schema and swaps
    the rows, ``append`` adds rows.  The last two need the table to exist and
    match columns by position, or by name if asked.
    """
    check_strategy(strategy)
    if strategy == REPLACE:
        df.write.mode("overwrite").format("parquet").saveAsTable(table)
        return
    if by_name:
        df = df.select(*df.sparkSession.table(table).columns)
    df.write.insertInto(table, overwrite=strategy == TRUNCATE)
