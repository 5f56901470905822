"""Comparing two relations, as sets, as bags, and key by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.operators.ordering import repeat_rows


def _comparable(
    a: DataFrame, b: DataFrame, exclude: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    left, right = a.drop(*exclude), b.drop(*exclude)
    if sorted(left.columns) != sorted(right.columns):
        only = sorted(set(left.columns) ^ set(right.columns))
        raise ValueError(f"the relations differ in their columns: {', '.join(only)}")
    return left, right.select(*left.columns)


def row_counts_by_side(
    a: DataFrame, b: DataFrame, exclude: Sequence[str] = ()
) -> DataFrame:
    """Every distinct row with its number of copies on either side (one shuffle)."""
    left, right = _comparable(a, b, exclude)
    columns = left.columns
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    tagged = left.select("*", one.alias("_a"), none.alias("_b")).union(
        right.select("*", none.alias("_a"), one.alias("_b"))
    )
    return tagged.groupBy(*columns).agg(
        F.sum("_a").alias("copies_a"), F.sum("_b").alias("copies_b")
    )


def compare_relations(
    a: DataFrame, b: DataFrame, exclude: Sequence[str] = (), bag: bool = False
) -> DataFrame:
    """How many rows are on both sides, or on one only.

    As sets, a row counts once; as bags (``bag=True``) its copies are matched one
    to one and the surplus counts for its side.
    """
    sides = row_counts_by_side(a, b, exclude)
    in_a, in_b = F.col("copies_a"), F.col("copies_b")
    if bag:
        shared = F.least(in_a, in_b)
        measures = (shared, in_a - shared, in_b - shared)
    else:
        measures = (
            ((in_a > 0) & (in_b > 0)).cast("bigint"),
            (in_b == 0).cast("bigint"),
            (in_a == 0).cast("bigint"),
        )
    # One row with the three counts, then one row per count.
    sums = sides.agg(*[F.sum(m).alias(f"n{at}") for at, m in enumerate(measures)])
    where = ((True, True), (True, False), (False, True))
    parts = F.array(
        *[
            F.struct(
                F.lit(left).alias("in_a"),
                F.lit(right).alias("in_b"),
                F.col(f"n{at}").alias("count"),
            )
            for at, (left, right) in enumerate(where)
        ]
    )
    whole = F.col("n0") + F.col("n1") + F.col("n2")
    return (
        sums.select(whole.alias("whole"), F.explode(parts).alias("part"))
        .select("part.*", "whole")
        .filter(F.col("count") > 0)
        .withColumn(
            "percent_of_total",
            F.round(F.lit(100.0) * F.col("count") / F.col("whole"), 2),
        )
        .drop("whole")
    )


def surplus_rows(
    a: DataFrame, b: DataFrame, exclude: Sequence[str] = ()
) -> DataFrame:
    """The rows behind the counts, with their copies on either side."""
    return row_counts_by_side(a, b, exclude).filter(
        F.col("copies_a") != F.col("copies_b")
    )


def keyed_diff(
    a: DataFrame,
    b: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str] | None = None,
) -> DataFrame:
    """Per key: on one side only, changed (and which columns), or repeated.

    Both sides are folded to one row per key in a single aggregation, so a key
    that is repeated on both sides is reported with its copies instead of being
    paired with itself.  Equal keys are left out.
    """
    columns = list(compare or [c for c in a.columns if c not in keys])

    def side(df: DataFrame, mine: str, other: str) -> DataFrame:
        values = F.struct(*[F.col(c) for c in columns])
        kind = "struct<" + ",".join(
            f"`{c}`:{a.schema[c].dataType.simpleString()}" for c in columns
        ) + ">"
        return df.select(
            *keys,
            F.lit(1).cast("bigint").alias(f"n_{mine}"),
            values.cast(kind).alias(f"v_{mine}"),
            F.lit(0).cast("bigint").alias(f"n_{other}"),
            F.lit(None).cast(kind).alias(f"v_{other}"),
        )

    both = side(a, "a", "b").unionByName(side(b, "b", "a"))
    folded = both.groupBy(*keys).agg(
        F.sum("n_a").alias("copies_a"),
        F.sum("n_b").alias("copies_b"),
        F.max("v_a").alias("v_a"),
        F.max("v_b").alias("v_b"),
    )
    changed = F.filter(
        F.array(
            *[
                F.when(~_same(c), F.lit(c))
                for c in columns
            ]
        ),
        lambda c: c.isNotNull(),
    )
    single = (F.col("copies_a") <= 1) & (F.col("copies_b") <= 1)
    status = (
        F.when(~single, "repeated")
        .when(F.col("copies_b") == 0, "only_a")
        .when(F.col("copies_a") == 0, "only_b")
        .when(F.size("_changed") > 0, "changed")
    )
    return (
        folded.withColumn("_changed", changed)
        .withColumn("status", status)
        .filter(F.col("status").isNotNull())
        .select(
            *keys,
            "status",
            F.when(F.col("status") == "changed", F.col("_changed"))
            .otherwise(F.array().cast("array<string>"))
            .alias("changed_columns"),
            "copies_a",
            "copies_b",
        )
    )


def _same(name: str) -> Column:
    return F.col(f"v_a.{name}").eqNullSafe(F.col(f"v_b.{name}"))


def common_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows found on both sides, each once."""
    sides = row_counts_by_side(a, b)
    return sides.filter("copies_a > 0 AND copies_b > 0").select(*a.columns)


def rows_missing_from(a: DataFrame, b: DataFrame, bag: bool = False) -> DataFrame:
    """Rows of ``a`` that ``b`` lacks, as a set or counting copies.

    Copies are counted before the shuffle and, as a bag, dealt out again in
    pieces, so that very many copies of one row burden no single task.
    """
    sides = row_counts_by_side(a, b)
    if not bag:
        return sides.filter("copies_a > 0 AND copies_b = 0").select(*a.columns)
    surplus = sides.withColumn("_n", F.col("copies_a") - F.col("copies_b"))
    return repeat_rows(surplus.filter("_n > 0"), "_n").select(*a.columns)
