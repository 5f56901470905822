"""Sums per key over a pruned, hive-partitioned table, named from a small lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sum_of_known(
    df: DataFrame, known: Column, keys: Sequence[str], measure: str, name: str
) -> DataFrame:
    """Sum of a measure per key, without placeholder keys.

    Filter ``df`` by bare partition columns first: then other partitions are not
    even listed.
    """
    return df.filter(known).groupBy(*keys).agg(F.sum(measure).alias(name))


def with_lookup(
    summary: DataFrame, lookup: DataFrame, key: str, how: str = "inner"
) -> DataFrame:
    """Attach the attributes of a key.  Spark broadcasts the lookup if it is small."""
    return summary.join(lookup, key, how)
