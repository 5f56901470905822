"""Ranks and positions that hold when one key owns a large share of the rows.

A ``row_number`` over a key sends all rows of that key to one task.  Keeping
only rank 1 is harmless (Spark drops the losers before the shuffle), but a full
ranking is not.  Rows are therefore dealt to buckets, which follow each other in the
order and split inside a key, and even inside a run of identical rows: what a row
has before it is what earlier buckets have, from one count, and what its own bucket
has, from a window over it.  All of this is one query, and one way for all keys.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.functions.expressions import whole_div
from strandline.session import cut_lineage

# Copies of one row that one task writes out.
EXPAND_CHUNK = 100_000

# Copies of one row that stay together when rows are dealt to buckets.
PIECE = 10_000
# Rows looked at for each bound between buckets.
SAMPLED = 20

_POSITION_BITS = 33  # monotonically_increasing_id: task number above, row below


def deciding_columns(
    df: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> list[str]:
    """``order`` made total: remaining ties are decided by every other column.

    Rows that still tie are identical in all columns that can be compared, so
    which of them comes first makes no difference.
    """
    rest = [
        field.name
        for field in df.schema.fields
        if field.name not in keys
        and field.name not in order
        and not isinstance(field.dataType, (T.MapType, T.VariantType))
    ]
    return [*order, *rest]


def global_positions(
    df: DataFrame,
    order: Sequence[Column],
    name: str = "position",
    partitions: int | None = None,
) -> DataFrame:
    """Dense 0-based position of every row in the given order.

    One range shuffle; the sorted rows are checkpointed so that positions stay
    fixed when tasks are repeated, and one count per partition is brought
    together to place the partitions one after another.
    """
    spark = df.sparkSession
    # The number of the input task splits runs of identical rows; it does not
    # change when a task is repeated.
    salted = df.withColumn("_task", F.spark_partition_id())
    ordered = [*order, F.col("_task").asc()]
    # Without a number Spark fits the partitions to the size of the data.
    ranged = (
        salted.repartitionByRange(partitions, *ordered)
        if partitions
        else salted.repartitionByRange(*ordered)
    )
    placed = (
        ranged.sortWithinPartitions(*ordered)
        .drop("_task")
        .withColumn("_id", F.monotonically_increasing_id())
    )
    fixed = cut_lineage(placed)
    part = F.shiftright(F.col("_id"), _POSITION_BITS)
    sizes = sorted(fixed.groupBy(part.alias("part")).count().collect())
    starts = accumulate((size for _, size in sizes), initial=0)
    offsets = spark.createDataFrame(
        [(row[0], start) for row, start in zip(sizes, starts)],
        "_part bigint, _start bigint",
    )
    # One row per partition of the sort, never more.
    return (
        fixed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(
            name,
            F.col("_start")
            + F.col("_id").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)),
        )
        .drop("_part", "_start", "_id")
    )


def can_be_dealt(df: DataFrame) -> bool:
    """Whether rows can be told apart by all their columns."""
    unlike = (T.MapType, T.VariantType)
    return not any(isinstance(f.dataType, unlike) for f in df.schema.fields)


def dealt(df: DataFrame, order: Sequence[Column], buckets: int | None = None) -> DataFrame:
    """The different rows of ``df`` with ``_copies``, ``_piece`` and ``_bucket``.

    Many copies of one row become pieces of bounded size.  Rows, and pieces of one
    row, of a bucket come before those of the next in ``order`` (rising, nulls
    first).  The bounds are quantiles of the rows with the smallest hashes; a row finds
    its bucket in two steps, each over the square root of their number.
    """
    n = F.col("_n")
    pieces = (
        df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("bigint"), whole_div(n - 1, PIECE))))
        .withColumn("_copies", F.least(n - F.col("_piece") * PIECE, F.lit(PIECE).cast("bigint")))
        .drop("_n")
    )
    key = F.struct(*[c.alias(f"c{i}") for i, c in enumerate(order)], F.col("_piece"))
    return in_buckets(pieces, key, pieces.select(key.alias("key"), F.col("_copies").alias("weight")), buckets)


def bucket_width(df: DataFrame, buckets: int | None = None) -> int:
    """Square root of the number of buckets."""
    wanted = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return math.isqrt(max(1, wanted) - 1) + 1


def in_buckets(
    rows: DataFrame, key: Column, keys: DataFrame, buckets: int | None = None
) -> DataFrame:
    """``rows`` with ``_bucket``: those of one bucket come before those of the next by
    ``key``, a struct.  Bounds are quantiles of a sample of ``keys`` (different ``key``,
    and ``weight``, the rows it stands for): those whose hash by weight is smallest, so
    they depend on the rows alone, and no job or task that is repeated moves them."""
    width = bucket_width(rows, buckets)
    if width == 1:
        return rows.withColumn("_bucket", F.lit(0))
    chance = F.expr("shiftrightunsigned(xxhash64(key), 1) div weight")
    wanted = SAMPLED * width**2
    few = keys.select("key", "weight", chance.alias("chance")).orderBy("chance", "key").limit(wanted)
    # A key of the sample stands for its own rows, or for those of a key of the chance
    # that the last one had, if these are more.
    unit = F.when(F.count(F.lit(1)) < wanted, F.sum("weight") / wanted).otherwise(
        F.lit(2.0**63) / (F.max("chance") + 1)
    )
    items = few.agg(F.array_sort(F.collect_list(F.struct("key", "weight"))).alias("items"), unit.alias("unit"))
    times = lambda x: F.greatest(F.lit(1), F.round(x["weight"] / F.col("unit")).cast("int"))
    drawn = items.select(
        F.flatten(F.transform("items", lambda x: F.array_repeat(x["key"], times(x)))).alias("all")
    )
    bound = lambda i: F.get("all", whole_div(i * F.size("all"), width**2).cast("int"))
    upper = F.transform(F.sequence(F.lit(1), F.lit(width - 1)), lambda g: bound(g * width))
    inner = lambda g: F.transform(
        F.sequence(F.lit(1), F.lit(width - 1)), lambda i: bound(g * width + i)
    )
    lists = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), inner)
    bounds = drawn.select(F.struct(upper.alias("upper"), lists.alias("lists"))).scalar()

    def passed(held: Column) -> Column:
        """How many of the bounds are not above the key; written out, so it is compiled."""
        each = [(F.get(held, F.lit(i)) <= F.col("_sought")).cast("int") for i in range(width - 1)]
        return sum((F.coalesce(e, F.lit(0)) for e in each), F.lit(0))

    return (
        rows.withColumns({"_sought": key, "_bounds": bounds})
        .withColumn("_group", passed(F.col("_bounds.upper")))
        .withColumn("_lower", F.get("_bounds.lists", F.col("_group")))
        .withColumn("_bucket", F.col("_group") * width + passed(F.col("_lower")))
        .drop("_sought", "_bounds", "_group", "_lower")
    )


def positions(
    df: DataFrame, order: Sequence[Column], name: str, buckets: int | None = None
) -> DataFrame:
    """Dense 0-based position of every row in ``order`` (rising, nulls first)."""
    rows = dealt(df, order, buckets)
    sizes = rows.groupBy("_bucket").agg(F.sum("_copies").alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # One row per bucket.
    starts = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_bucket").orderBy(*order, "_piece").rowsBetween(
        Window.unboundedPreceding, -1
    )
    at = F.col("_start") + F.coalesce(F.sum("_copies").over(inside), F.lit(0))
    return (
        rows.join(F.broadcast(starts), "_bucket")
        .withColumn("_at", at)
        .withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1)))
        .select(*df.columns, (F.col("_at") + F.col("_copy")).alias(name))
    )


def rank_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str
) -> DataFrame:
    """1-based rank of every row within its key, largest ``order`` columns first."""
    deciding = deciding_columns(df, keys, order)
    if not can_be_dealt(df):
        return _rank_by_position(df, keys, deciding, name)
    rows = dealt(df, [F.col(c) for c in (*keys, *deciding)])
    counts = rows.groupBy(*keys, "_bucket").agg(F.sum("_copies").alias("_size"))
    later = Window.partitionBy(*keys).orderBy(F.col("_bucket").desc()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    # A bucket shares at most one key with buckets after it: fewer rows than buckets.
    shared = counts.withColumn("_later", F.sum("_size").over(later)).filter("_later IS NOT NULL")
    shared = shared.select(
        F.col("_bucket").alias("_b"), "_later", *[F.col(k).alias(f"_k_{k}") for k in keys]
    )
    match = F.col("_bucket") == F.col("_b")
    for key in keys:
        match = match & rows[key].eqNullSafe(shared[f"_k_{key}"])
    own = Window.partitionBy("_bucket", *keys).orderBy(
        *[F.col(c).desc() for c in deciding], F.col("_piece").desc()
    ).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    first = 1 + F.coalesce("_later", zero) + F.coalesce(F.sum("_copies").over(own), zero)
    return (
        rows.join(F.broadcast(shared), match, "left")
        .withColumn("_first", first)
        .withColumn("_copy", F.explode(F.sequence(zero, F.col("_copies") - 1)))
        .select(*df.columns, (F.col("_first") + F.col("_copy")).alias(name))
    )


def _rank_by_position(
    df: DataFrame, keys: Sequence[str], deciding: Sequence[str], name: str
) -> DataFrame:
    """The same for rows with columns that cannot be grouped.

    A rank is the distance to the first position of the key.  These meet in an
    ordinary join, of which Spark splits busy keys.
    """
    full = [F.col(c).desc() for c in deciding]
    placed = global_positions(df, [*[F.col(k).asc() for k in keys], *full], "_at")
    firsts = placed.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(
        F.min("_at").alias("_first")
    )
    match = F.lit(True)
    for key in keys:
        match = match & placed[key].eqNullSafe(firsts[f"_k_{key}"])
    return placed.join(firsts, match).select(
        *df.columns, (F.col("_at") - F.col("_first") + 1).alias(name)
    )


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Every row as often as its ``times`` says (at least once)."""
    last = whole_div(F.col(times) - 1, EXPAND_CHUNK)
    pieces = F.sequence(F.lit(0).cast("bigint"), last)
    dealt = df.withColumn("_piece", F.explode(pieces))
    dealt = dealt.repartition(*dealt.columns)
    left = F.col(times) - F.col("_piece") * F.lit(EXPAND_CHUNK)
    copies = F.sequence(F.lit(1), F.least(left, F.lit(EXPAND_CHUNK)).cast("int"))
    return dealt.withColumn("_copy", F.explode(copies)).drop("_piece", "_copy")
