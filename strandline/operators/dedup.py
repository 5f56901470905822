"""One winner per business key, the losers quarantined, and the proof of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.operators.diff import row_counts_by_side
from strandline.operators.ordering import deciding_columns, rank_within

RANK = "_dedup_rank"


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The row of every key that is largest in the ``order`` columns.

    An aggregation that is partial before the shuffle: a task sends one row per
    key, so a key that owns many rows costs no more than any other.  It sorts by
    the key alone, which is several times cheaper than ranking.
    """
    deciding = deciding_columns(df, keys, order)
    others = [c for c in df.columns if c not in keys and c not in deciding]
    if others:  # columns that cannot be compared come along
        row = F.max_by(F.struct(*deciding, *others), F.struct(*deciding))
    elif deciding:
        row = F.max(F.struct(*deciding))
    else:
        return df.distinct()
    best = df.groupBy(*keys).agg(row.alias("_best"))
    return best.select(
        *[F.col(c) if c in keys else F.col(f"_best.{c}") for c in df.columns]
    )


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """All rows with their rank; split it by ``winners`` and ``rejects``."""
    return rank_within(df, keys, order, RANK)


def winners(ranked_rows: DataFrame) -> DataFrame:
    return ranked_rows.filter(F.col(RANK) == 1).drop(RANK)


def rejects(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Every row but the winner; rank 2 is the runner-up."""
    return ranked(df, keys, order).filter(F.col(RANK) > 1)


def reject_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys`` and ``rejected`` of every key that has rejects; counted, not ranked."""
    counts = df.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("rejected"))
    return counts.filter(F.col("rejected") > 0)


def reconcile_counts(
    bronze: DataFrame,
    winner_rows: DataFrame,
    reject_rows: DataFrame,
    rejected: str | None = None,
) -> DataFrame:
    """One row: how many rows came in, won, were rejected and are missing.

    ``rejected`` names a column that says for how many rejects a row stands.
    """
    one = F.lit(1).cast("bigint")
    tagged = [
        frame.select(F.lit(tag).alias("layer"), n.alias("n"))
        for frame, tag, n in (
            (bronze, "bronze", one),
            (winner_rows, "winners", one),
            (reject_rows, "rejects", F.col(rejected) if rejected else one),
        )
    ]
    every = tagged[0].union(tagged[1]).union(tagged[2])
    none = F.lit(0).cast("bigint")
    counts = every.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("layer") == tag, F.col("n"))), none).alias(f"{tag}_n")
            for tag in ("bronze", "winners", "rejects")
        ]
    )
    return counts.withColumn(
        "missing_rows",
        F.col("bronze_n") - (F.col("winners_n") + F.col("rejects_n")),
    )


def reconcile_bags(
    bronze: DataFrame, winner_rows: DataFrame, reject_rows: DataFrame
) -> DataFrame:
    """The counts, and rows of bronze and of winners with rejects that have no equal
    row on the other side: ``lost_rows`` and ``foreign_rows``.
    """
    columns = bronze.columns
    out = winner_rows.select(*columns).unionByName(reject_rows.select(*columns))
    bags = row_counts_by_side(bronze, out)
    surplus = F.col("copies_a") - F.col("copies_b")
    off = bags.agg(
        F.coalesce(F.sum(F.greatest(surplus, F.lit(0))), F.lit(0)).alias("lost_rows"),
        F.coalesce(F.sum(F.greatest(-surplus, F.lit(0))), F.lit(0)).alias("foreign_rows"),
    )
    one = F.lit(1).alias("_one")
    counts = reconcile_counts(bronze, winner_rows, reject_rows).select("*", one)
    # One row each.
    return counts.join(off.select("*", one), "_one").drop("_one")


def reconciliation_failures(counts: DataFrame) -> DataFrame:
    """Empty when the counts add up."""
    return counts.filter(
        F.col("bronze_n") != F.col("winners_n") + F.col("rejects_n")
    )


def deliveries_per_key(
    df: DataFrame, key: str, date: str, at_least: int = 2
) -> DataFrame:
    """Keys seen in several deliveries: the normal input of a history."""
    return (
        df.groupBy(key)
        .agg(F.count_distinct(F.col(date)).alias("deliveries_seen"))
        .filter(F.col("deliveries_seen") >= at_least)
    )


def copies_in_delivery(df: DataFrame, delivery: Sequence[str]) -> DataFrame:
    """Keys repeated inside one delivery: a sign of damage upstream."""
    return (
        df.groupBy(*delivery)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
    )


def losing_copies(
    df: DataFrame, key: str, date: str, extra: Sequence[str] = ()
) -> DataFrame:
    """Rejected copies per key and delivery, and whether the winner is as recent.

    Rows are counted per delivery before anything is compared, so the window
    sees one row per key and delivery, not one per copy.
    """
    per_delivery = df.groupBy(key, date, *extra).agg(F.count(F.lit(1)).alias("_copies"))
    by_key = Window.partitionBy(key)
    newest = per_delivery.withColumn("winner_date", F.max(date).over(by_key))
    order = by_key.orderBy(F.col(date).desc(), *[F.col(e).desc() for e in extra])
    holder = newest.withColumn("_place", F.row_number().over(order))
    losing = F.col("_copies") - F.when(F.col("_place") == 1, 1).otherwise(0)
    return (
        holder.withColumn("losing_copies", losing)
        .filter(F.col("losing_copies") > 0)
        .withColumn("same_day_as_winner", F.col(date) == F.col("winner_date"))
        .drop("_copies", "_place")
    )
