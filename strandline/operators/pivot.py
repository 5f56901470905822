"""Entity-attribute-value rows: to wide form, and a first look at them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def entity_id(df: DataFrame, row_id: str, name: str) -> DataFrame:
    """The digits that end a technical row id such as ``householdID_1919``.

    An id without such digits belongs to no entity: NULL.
    """
    return df.withColumn(name, F.regexp_substr(F.col(row_id), F.lit(r"\d+$")))


def rows_without_entity(df: DataFrame, entity: str) -> DataFrame:
    """One row: how many rows the pivot leaves out because they have no entity."""
    return df.filter(F.col(entity).isNull()).agg(F.count(F.lit(1)).alias("rows_without_entity"))


def pivot_attributes(
    df: DataFrame,
    entity: str,
    context: str,
    attribute: str,
    value: str,
    columns: Mapping[str, tuple[str, str]],
    texts: str | None = None,
) -> DataFrame:
    """One row per entity and context; ``columns`` maps attribute -> (name, type).

    Columns of type ``string`` take their values from the column ``texts``, if one is
    named, all others from ``value``.  Rows without an entity are left out
    (``rows_without_entity`` counts them), or they would all be one.

    The attributes are given, so no extra pass looks for them, and one
    aggregation (partial before its shuffle) fills all columns.  The largest
    value wins if an attribute is repeated.
    """
    # Rows without an entity end in one group, after the partial aggregate; a filter
    # on the entity itself would be moved down and compute it once more.
    pivoted = df.groupBy(entity, context).agg(
        F.count(entity).alias("_known"),
        *[
            F.max(
                F.when(
                    F.col(attribute) == wanted,
                    F.col(texts if texts and kind == "string" else value),
                )
            )
            .cast(kind)
            .alias(name)
            for wanted, (name, kind) in columns.items()
        ],
    )
    return pivoted.filter("_known > 0").drop("_known")


def rows_per_report(df: DataFrame, report: str = "report_table") -> DataFrame:
    return (
        df.groupBy(report)
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.col(report).asc_nulls_last())
    )


def sample_with_value(
    df: DataFrame, value: str, order: list[str], n: int = 5
) -> DataFrame:
    """The first n rows that carry a value; ordered, so that it can be repeated."""
    known = df.filter(F.col(value).isNotNull())
    return known.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)


def first_report_rows(
    df: DataFrame, report: str, order: list[str], n: int = 10
) -> DataFrame:
    """The first n rows of the first report."""
    first = df.agg(F.min(report).alias("_first"))
    return (
        df.join(F.broadcast(first), F.col(report) == F.col("_first"))
        .drop("_first")
        .orderBy(*[F.col(c).asc_nulls_last() for c in order])
        .limit(n)
    )
