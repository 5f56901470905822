"""Type 2 history: one row per version of a key, with its validity interval."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.expressions import version_id
from strandline.operators import ordering
from strandline.operators.dedup import latest_per_key

FROM, TO = "dbt_valid_from", "dbt_valid_to"
UPDATED, VERSION = "dbt_updated_at", "dbt_scd_id"
META = (VERSION, UPDATED, FROM, TO)

KEEP, CLOSE, INSERT = "keep", "close", "insert"
CHANGE = "_change"

# Parts into which the facts of one key and moment can be split.
SALTS = 256


def _moment(value: datetime | Column) -> Column:
    if isinstance(value, datetime):
        text = value.strftime("%Y-%m-%d %H:%M:%S.%f")
        return F.lit(text).cast("timestamp_ntz")
    return value


def with_version_columns(
    df: DataFrame, keys: Sequence[str], valid_from: datetime | Column
) -> DataFrame:
    """Rows as freshly opened versions."""
    start = _moment(valid_from)
    return (
        df.withColumn(VERSION, version_id(list(keys), start))
        .withColumn(UPDATED, start)
        .withColumn(FROM, start)
        .withColumn(TO, F.lit(None).cast("timestamp_ntz"))
    )


def first_snapshot(
    landing: DataFrame, keys: Sequence[str], snapshot_ts: datetime
) -> DataFrame:
    """Every landing row becomes a current version."""
    opened = with_version_columns(one_row_per_key(landing, keys), keys, snapshot_ts)
    return opened.withColumn(CHANGE, F.lit(INSERT))


def one_row_per_key(landing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The landing itself; the job fails before anything is published if a key
    comes twice or is unknown.

    An aggregation that is partial before its shuffle, by the keys the merge needs
    anyway: a landing that one busy key has broken fails without being sorted.
    """
    others = [c for c in landing.columns if c not in keys]
    unknown = F.lit(False)
    for key in keys:
        unknown = unknown | F.col(key).isNull()
    found = landing.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_copies"), F.first(F.struct(*others)).alias("_row")
    )
    shown = F.concat_ws(",", *[F.col(k).cast("string") for k in keys])
    twice = F.raise_error(F.concat(F.lit("landing holds a key more than once: "), shown))
    none = F.raise_error(F.lit("landing holds a row without its key"))
    sound = (
        F.when(unknown, none.cast("boolean"))
        .when(F.col("_copies") > 1, twice.cast("boolean"))
        .otherwise(F.lit(True))
    )
    return found.filter(sound).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}") for c in landing.columns]
    )


def merge_snapshot(
    current: DataFrame,
    landing: DataFrame,
    keys: Sequence[str],
    check: Sequence[str],
    snapshot_ts: datetime,
    close_missing: bool = False,
    changes_only: bool = False,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Compare the open versions with a landing and say what becomes of each row.

    Result: all open versions and new versions, ``_change`` telling kept, closed
    and inserted ones apart.  A version is replaced when any ``check`` column
    differs (NULL equals NULL only); unchanged versions keep all their columns.
    Keys that the landing lacks stay open unless ``close_missing``.

    With ``changes_only`` kept versions are left out, and versions whose key the
    landing lacks need not take part in the join.  ``carry`` names columns that
    only ``current`` has; they are unknown in new versions.
    """
    columns = [c for c in landing.columns if c not in META]
    source = one_row_per_key(landing.select(*columns), keys)
    old = current.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        F.struct(*columns, *META, *carry).alias("old"),
    )
    new = source.select(*keys, F.struct(*columns).alias("new"))
    match = F.lit(True)
    for key in keys:
        match = match & (F.col(f"_key_{key}") == F.col(key))
    every_key = close_missing or not changes_only
    joined = old.join(new, match, "full" if every_key else "right")

    has_old, has_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    differs = F.lit(False)
    for name in check:
        same = F.col(f"old.{name}").eqNullSafe(F.col(f"new.{name}"))
        differs = differs | ~same
    changed = has_old & has_new & differs
    gone = has_old & ~has_new & F.lit(close_missing)

    now = _moment(snapshot_ts)
    none = F.lit(None).cast("timestamp_ntz")
    carried = {c: current.schema[c].dataType for c in carry}

    def row(side: str, change: Column, *meta: Column) -> Column:
        return F.struct(
            *[F.col(f"{side}.{c}").alias(c) for c in columns],
            *[value.alias(name) for name, value in zip(META, meta, strict=True)],
            *[
                (F.col(f"old.{c}") if side == "old" else F.lit(None).cast(kind)).alias(c)
                for c, kind in carried.items()
            ],
            change.alias(CHANGE),
        )

    closing = changed | gone
    kept = row(
        "old",
        F.when(closing, CLOSE).otherwise(KEEP),
        F.col(f"old.{VERSION}"),
        F.col(f"old.{UPDATED}"),
        F.col(f"old.{FROM}"),
        F.when(closing, now).otherwise(F.col(f"old.{TO}")),
    )
    fresh_id = version_id([f"new.{k}" for k in keys], now)
    opened = row("new", F.lit(INSERT), fresh_id, now, now, none)
    inserts = (has_new & ~has_old) | changed
    rows = F.filter(
        F.array(
            F.when(closing if changes_only else has_old, kept),
            F.when(inserts, opened),
        ),
        lambda r: r.isNotNull(),
    )
    return joined.select(F.explode(rows).alias("row")).select("row.*")


def history_from_deliveries(
    bronze: DataFrame,
    keys: Sequence[str],
    date: str,
    check: Sequence[str],
    ties: Sequence[str] = (),
) -> DataFrame:
    """The whole history in one pass over all deliveries.

    Equals merging the deliveries one by one in date order.  Within a delivery
    the winner counts (the largest ``ties``); the windows over a key then see
    one row per delivery at most, so ``date`` must be a delivery date.
    """
    per_delivery = latest_per_key(bronze, [*keys, date], ties)
    line = Window.partitionBy(*keys).orderBy(date)
    state = F.struct(*check)
    versions = (
        per_delivery.withColumn("_before", F.lag(state).over(line))
        .filter(~state.eqNullSafe(F.col("_before")))
        .drop("_before")
    )
    start = F.col(date).cast("timestamp_ntz")
    return (
        versions.withColumn(VERSION, version_id(list(keys), start))
        .withColumn(UPDATED, start)
        .withColumn(FROM, start)
        .withColumn(TO, F.lead(start).over(line))
    )


def current_versions(history: DataFrame) -> DataFrame:
    return history.filter(F.col(TO).isNull())


def versions_as_of(history: DataFrame, moment: datetime | Column) -> DataFrame:
    """What was known at one moment."""
    at = _moment(moment)
    return history.filter(
        (F.col(FROM) <= at) & (F.col(TO).isNull() | (F.col(TO) > at))
    )


def point_in_time(
    facts: DataFrame,
    history: DataFrame,
    fact_key: str,
    key: str,
    moment: str,
    columns: Sequence[str],
    buckets: int | None = None,
) -> DataFrame:
    """Each fact with the version that was valid at its own moment.

    Facts and versions stand in one line by key and time, cut into buckets of even
    size; inside a bucket the last version is carried on to the facts behind it, and
    the last one before a bucket goes to all of it.  A busy key, and facts of one
    moment, are split over buckets.  Facts without a key, a moment or a version get
    nulls.  A key has one version per moment, so facts are not multiplied.
    """
    start, end = F.col(FROM).cast("timestamp_ntz"), F.col(TO).cast("timestamp_ntz")
    # Empty intervals are valid at no moment.
    versions = history.filter(F.col(key).isNotNull() & (end.isNull() | (end > start))).select(
        F.col(key).alias("_key"), start.alias("_at"), F.lit(0).alias("_kind"),
        F.lit(0).alias("_salt"), end.alias("_end"),
        F.struct(*[F.col(c) for c in columns]).alias("_held"),
    )
    # The number of the input task splits facts of one moment.
    asked = facts.select(
        F.col(fact_key).alias("_key"), F.col(moment).cast("timestamp_ntz").alias("_at"),
        F.lit(1).alias("_kind"), F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("_salt"),
        F.struct(*[F.col(f"`{c}`") for c in facts.columns]).alias("_fact"),
    )
    spot = ["_key", "_at", "_kind"]
    crowds = (
        asked.select(*spot).union(versions.select(*spot))
        .groupBy(*spot).agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_parts", F.least("_n", F.lit(SALTS)).cast("int"))
        .withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        .withColumn("_salt", F.expr(f"int(_part * {SALTS} div _parts)"))
    )
    place = F.struct(*spot, "_salt")
    keys = crowds.select(place.alias("key"), F.expr("_n div _parts").alias("weight"))

    def placed(rows: DataFrame) -> DataFrame:
        spots = rows.withColumn("_place", place)
        return ordering.in_buckets(spots, F.col("_place"), keys, buckets).drop("_place")

    version = F.struct("_key", "_end", "_held")
    inside = Window.partitionBy("_bucket").orderBy(*spot).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    line = placed(asked.unionByName(versions, allowMissingColumns=True)).withColumn(
        "_own", F.last(F.when(F.col("_kind") == 0, version), ignorenulls=True).over(inside)
    )
    ends = placed(versions).groupBy("_bucket").agg(
        F.max_by(version, F.struct("_key", "_at")).alias("_end_of")
    )
    # One row per bucket, with the last version of those before it.
    number = ordering.bucket_width(facts, buckets) ** 2
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        facts.sparkSession.range(number).select(F.col("id").cast("int").alias("_bucket"))
        .join(ends, "_bucket", "left")
        .select("_bucket", F.last("_end_of", ignorenulls=True).over(before).alias("_carried"))
    )
    found = F.coalesce(
        *[F.when(F.col(c)["_key"] == F.col("_key"), F.col(c)) for c in ("_own", "_carried")]
    )
    known = F.col("_found._end").isNull() | (F.col("_found._end") > F.col("_at"))
    return (
        line.filter("_kind = 1")
        .join(F.broadcast(carried), "_bucket", "left")
        .withColumn("_found", F.when(F.col("_at").isNotNull(), found))
        .select(
            *[F.col("_fact")[c].alias(c) for c in facts.columns],
            *[F.when(known, F.col("_found._held")[c]).alias(c) for c in columns],
        )
    )


def totals(history: DataFrame) -> DataFrame:
    """One row: versions in all and open ones."""
    return history.agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col(TO).isNull(), 1)).alias("current_n"),
    )


def interval_problems(history: DataFrame, key: str) -> DataFrame:
    """Versions of a key that overlap, leave a gap, are empty or start together.

    Versions with one start are folded first, so that a key takes part in the
    window with one row per snapshot at most.
    """
    folded = history.groupBy(key, FROM).agg(
        F.count(F.lit(1)).alias("copies"),
        F.count(TO).alias("closed"),
        F.max(TO).alias("last_to"),
    )
    # An open version among several that start together has the latest end.
    is_open = F.col("copies") > F.col("closed")
    line = Window.partitionBy(key).orderBy(FROM)
    end, following = F.col("last_to"), F.col("next_from")
    problem = (
        F.when(F.col("copies") > 1, "several versions start together")
        .when(~is_open & (F.col(FROM) >= end), "empty interval")
        .when(following.isNotNull() & is_open, "overlap")
        .when(following < end, "overlap")
        .when(following > end, "gap")
    )
    return (
        folded.withColumn("next_from", F.lead(FROM).over(line))
        .withColumn("problem", problem)
        .filter(F.col("problem").isNotNull())
        .select(
            "problem",
            key,
            FROM,
            F.when(~is_open, end).alias(TO),
            "next_from",
            "copies",
        )
    )
