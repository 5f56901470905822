"""Surrogate keys: a hash of the business key, or a gapless sequence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.expressions import surrogate_key
from strandline.operators.ordering import (
    can_be_dealt,
    deciding_columns,
    global_positions,
    positions,
)


def with_surrogate_key(df: DataFrame, parts: Sequence[str], name: str) -> DataFrame:
    """Sixteen-byte key; the same parts give the same key in every run."""
    return df.withColumn(name, surrogate_key(*parts))


def with_sequence_key(
    df: DataFrame,
    name: str,
    order: Sequence[str],
    start: int = 1,
    partitions: int | None = None,
) -> DataFrame:
    """Gapless numbers from ``start`` in the given order, without a single task."""
    deciding = deciding_columns(df, (), order)
    if can_be_dealt(df):
        nulls_last = [c for name in deciding for c in (F.col(name).isNull(), F.col(name))]
        placed = positions(df, nulls_last, "_at", partitions)
    else:
        ascending = [F.col(c).asc_nulls_last() for c in deciding]
        placed = global_positions(df, ascending, "_at", partitions)
    return placed.withColumn(name, F.col("_at") + F.lit(start)).drop("_at")


def with_load_defaults(
    df: DataFrame,
    loaded_at: Column | None = None,
    batch_id: str | None = None,
    time_column: str = "stg_loaded_at",
    batch_column: str = "dbt_batch_id",
) -> DataFrame:
    """Audit columns of a landing row; give the time for a repeatable result."""
    stamp = F.current_timestamp() if loaded_at is None else loaded_at
    return df.withColumn(time_column, stamp).withColumn(batch_column, F.lit(batch_id))
