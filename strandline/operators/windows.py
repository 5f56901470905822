"""Time windows over events: tumbling, hopping, sliding and per-day sessions.

Each one first reduces the events to a grid whose cells have a fixed upper
bound (minutes of a day, panes of a window, microseconds of a second).  That
reduction is a partial aggregate, so neither a busy hour nor many events at one
instant can overload a task, and the windows then run on the small grid.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.expressions import (
    MICROS,
    MINUTE_US,
    bucket_us,
    epoch_us,
    from_us,
    minute_boundaries,
    whole_div,
)
from strandline.session import require_utc

# Copies of one instant that one task writes out.
EXPAND_CHUNK = 100_000


def _type_of(df: DataFrame, ts: str) -> str:
    return df.schema[ts].dataType.simpleString()


def _instant(df: DataFrame, ts: str, moment: datetime) -> Column:
    """A literal of the column's own type, so that the scan can use it."""
    return F.lit(moment.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(_type_of(df, ts))


def _us(moment: datetime) -> int:
    delta = moment - datetime(1970, 1, 1)
    return (delta.days * 86_400 + delta.seconds) * MICROS + delta.microseconds


def between_instants(
    df: DataFrame, ts: str, start: datetime, end: datetime
) -> DataFrame:
    """Rows in ``[start, end)``; a range on the bare column prunes row groups."""
    low, high = _instant(df, ts, start), _instant(df, ts, end)
    return df.filter((F.col(ts) >= low) & (F.col(ts) < high))


def in_year(df: DataFrame, ts: str, year: int) -> DataFrame:
    return between_instants(df, ts, datetime(year, 1, 1), datetime(year + 1, 1, 1))


# --- tumbling --------------------------------------------------------------


def hourly_counts(df: DataFrame, ts: str, year: int) -> DataFrame:
    """Events per hour of one year."""
    hour = F.date_trunc("HOUR", F.col(ts)).cast(_type_of(df, ts))
    return (
        in_year(df, ts, year)
        .groupBy(hour.alias("station_service_time_hour"))
        .agg(F.count(F.lit(1)).alias("number_of_services"))
        .orderBy("station_service_time_hour")
    )


def time_of_day_profile(
    df: DataFrame,
    ts: str,
    year: int,
    days: int = 366,
    width_minutes: int = 15,
    offset_minutes: int = 0,
) -> DataFrame:
    """Average events per bucket of the day, over ``days`` days."""
    require_utc(df)
    start = bucket_us(
        epoch_us(ts), width_minutes * MINUTE_US, offset_minutes * MINUTE_US
    )
    label = F.date_format(F.timestamp_micros(start), "HH:mm")
    return (
        in_year(df, ts, year)
        .groupBy(label.alias("station_service_time_hour_quarter"))
        .agg((F.count(F.lit(1)) / F.lit(days)).alias("number_of_services"))
        .orderBy("station_service_time_hour_quarter")
    )


# --- hopping ---------------------------------------------------------------


def hopping_counts(
    df: DataFrame,
    ts: str,
    ident: str,
    start: datetime,
    end: datetime,
    size_minutes: int = 15,
    hop_minutes: int = 5,
) -> DataFrame:
    """Counts per window ``[w, w + size)`` for every ``w = start + k*hop < end``.

    Windows begin only inside ``[start, end)``; the last ones reach beyond it.
    Windows without events are absent.  Events are counted once per pane (the
    common divisor of size and hop), and only the panes are spread over the
    windows that contain them.
    """
    require_utc(df)
    size, hop = size_minutes * MINUTE_US, hop_minutes * MINUTE_US
    pane = gcd(size, hop)
    first = _us(start)
    last_index = (_us(end) - first - 1) // hop
    if last_index < 0:
        raise ValueError("end must lie after start")
    stop = start + timedelta(microseconds=last_index * hop + size)

    offset = whole_div(epoch_us(ts) - F.lit(first), pane) * F.lit(pane)
    panes = (
        between_instants(df, ts, start, stop)
        .groupBy(offset.alias("offset"))
        .agg(F.count(ident).alias("n"))
    )
    lowest = whole_div(F.col("offset") + F.lit(pane - size + hop - 1), hop)
    highest = whole_div(F.col("offset"), hop)
    lo = F.greatest(lowest, F.lit(0).cast("bigint"))
    hi = F.least(highest, F.lit(last_index).cast("bigint"))
    if hop > size:  # else every pane lies in a window
        panes = panes.filter(lo <= hi)
    spread = panes.select(F.explode(F.sequence(lo, hi)).alias("k"), "n")
    begin = F.lit(first) + F.col("k") * F.lit(hop)
    like = _type_of(df, ts)
    return (
        spread.groupBy("k")
        .agg(F.sum("n").alias("number_of_services"))
        .select(
            from_us(begin, like).alias("window_start"),
            from_us(begin + F.lit(size), like).alias("window_end"),
            "number_of_services",
        )
    )


def window_starts(
    df: DataFrame, ts: str, hop_minutes: int = 5
) -> DataFrame:
    """The starts of all hopping windows from the first to the last day of ``df``.

    The end of the last day is not a start any more.  The two days come from a
    one-row aggregate; days are spread out before they are cut into starts.
    """
    if 24 * 60 % hop_minutes:
        raise ValueError("hop_minutes must divide a day")
    day = F.to_date(F.col(ts))
    days = df.agg(F.min(day).alias("first"), F.max(day).alias("last")).select(
        F.explode(F.sequence("first", "last")).alias("day")
    )
    midnight = F.col("day").cast("timestamp_ntz")
    hop = F.make_dt_interval(mins=F.lit(hop_minutes))
    until = midnight + F.make_dt_interval(days=F.lit(1)) - F.make_dt_interval(
        secs=F.lit(1)
    )
    starts = F.explode(F.sequence(midnight, until, hop))
    return days.repartition("day").select(starts.alias("window_start"))


def busiest(df: DataFrame, count: str, start: str, n: int = 5) -> DataFrame:
    """The n highest counts, earliest first among equals."""
    return df.orderBy(F.col(count).desc(), F.col(start).asc_nulls_last()).limit(n)


# --- sliding ---------------------------------------------------------------


def sliding_by_instant(
    df: DataFrame, ts: str, ident: str, minutes: int = 15
) -> DataFrame:
    """Per distinct instant: events in the ``minutes`` before it, both ends in.

    Columns ``us`` (microseconds), ``piece``, ``events`` (rows at that instant) and
    ``number_of_services``.  An instant with very many rows comes in several
    pieces, so that no task has to write all of them out.

    The count is put together from whole seconds and the two cut seconds at the
    ends, all from running sums.  A second has at most a million instants and a
    block of seconds at most the seconds of the window, each with one mark more
    for a window that begins there, so every window group below is bounded.
    """
    require_utc(df)
    span = minutes * 60
    instants = (
        df.groupBy(epoch_us(ts).alias("us"))
        .agg(F.count(F.lit(1)).alias("events"), F.count(ident).alias("n"))
        .withColumn("sec", whole_div(F.col("us"), MICROS))
    )
    cut = _cut_seconds(instants, span)
    seconds = _whole_seconds(instants, span)
    left = F.col("events") - F.col("piece") * F.lit(EXPAND_CHUNK)
    return cut.join(seconds, "sec", "left").select(
        "us",
        "piece",
        F.least(left, F.lit(EXPAND_CHUNK)).alias("events"),
        (F.col("cut") + F.coalesce("whole", F.lit(0)))
        .cast("bigint")
        .alias("number_of_services"),
    )


def _mark(at: Column, place: Column, opens: bool, add: Column) -> Column:
    """A point of a running sum within ``at``.

    A window that opens at a place stands before what happens there.
    """
    return F.struct(
        at.alias("at"),
        (place * 2 + F.lit(0 if opens else 1)).alias("spot"),
        F.lit(opens).alias("opens"),
        add.alias("add"),
    )


def _cut_seconds(instants: DataFrame, span: int) -> DataFrame:
    """Per instant: events up to it in its own second, less those before the
    window in the second where the window begins.
    """
    us, sec = F.col("us"), F.col("sec")
    none = F.lit(0).cast("bigint")

    def marks_of(piece: Column) -> Column:
        own = F.when(piece == 0, F.col("n")).otherwise(none)
        pair = (
            _mark(sec, us, False, own),
            _mark(sec - span, us - F.lit(span * MICROS), True, none),
        )
        return F.array(*[F.struct(piece.alias("piece"), m.alias("m")) for m in pair])

    pieces = F.sequence(none, whole_div(F.col("events") - 1, EXPAND_CHUNK))
    marks = F.when(F.col("events") <= EXPAND_CHUNK, marks_of(none)).otherwise(
        F.flatten(F.transform(pieces, marks_of))
    )
    upto = (
        Window.partitionBy("at")
        # ``opens`` only matters for events without a time, whose places tie.
        .orderBy("spot", F.col("opens").desc(), "piece")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    run = F.sum("add").over(upto)
    return (
        instants.select("us", "sec", "events", F.explode(marks).alias("p"))
        .select("us", "sec", "events", "p.piece", "p.m.*")
        .withColumn("run", run)
        .select(
            "us",
            "sec",
            "events",
            "piece",
            F.when(F.col("opens"), -F.col("run")).otherwise(F.col("run")).alias("part"),
        )
        # By second, which serves the aggregation and the join after it.
        .repartition("sec")
        .groupBy("sec", "us", "piece")
        .agg(F.max("events").alias("events"), F.sum("part").alias("cut"))
    )


def _whole_seconds(instants: DataFrame, span: int) -> DataFrame:
    """Per second with events: the events of the ``span`` seconds before it.

    Blocks are as long as the window, so it meets its own block and the one
    before: what came before it here, and what was left there when it began.
    """
    sec = F.col("sec")
    block = whole_div(sec, span)
    # The same columns of ``instants`` as in the other branch, so Spark runs the
    # shuffle below them once and reads it twice.
    totals = (
        instants.groupBy("sec")
        .agg(F.sum("n").alias("total"), F.sum("events").alias("rows"))
        .filter(F.col("rows") > 0)
    )
    marks = F.array(
        _mark(block, sec, False, F.col("total")),
        _mark(block - 1, sec - span, True, F.lit(0).cast("bigint")),
    )
    in_block = Window.partitionBy("at")
    upto = in_block.orderBy("spot").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    run, whole = F.col("run"), F.col("all")
    part = F.when(F.col("opens"), whole - run).otherwise(run - F.col("add"))
    return (
        totals.select("sec", F.explode(marks).alias("m"))
        .select("sec", "m.*")
        .withColumn("run", F.sum("add").over(upto))
        .withColumn("all", F.sum("add").over(in_block))
        .groupBy("sec")
        .agg(F.sum(part).alias("whole"))
    )


def _sliding_rows(
    instants: DataFrame, like: str, minutes: int, most: int = EXPAND_CHUNK
) -> DataFrame:
    """One row per event, at most ``most`` per piece; pieces of one instant are dealt
    to different tasks before they are written out."""
    instants = instants.repartition("us", "piece")
    copies = F.sequence(F.lit(1), F.least(F.col("events"), F.lit(most)).cast("int"))
    return instants.withColumn("copy", F.explode(copies)).select(
        from_us(F.col("us") - F.lit(minutes * MINUTE_US), like).alias("window_start"),
        from_us("us", like).alias("window_end"),
        "number_of_services",
    )


def sliding_counts(
    df: DataFrame, ts: str, ident: str, minutes: int = 15
) -> DataFrame:
    """One row per event with the count of its trailing window.

    Events at one instant share their row, so it is repeated instead of joining
    the events back.
    """
    instants = sliding_by_instant(df, ts, ident, minutes)
    return _sliding_rows(instants, _type_of(df, ts), minutes)


def sliding_top(
    df: DataFrame, ts: str, ident: str, minutes: int = 15, n: int = 5
) -> DataFrame:
    """The n events with the fullest trailing window.

    Only the n best instants can matter, and each for n events at most.
    """
    instants = busiest(
        sliding_by_instant(df, ts, ident, minutes), "number_of_services", "us", n
    )
    rows = _sliding_rows(instants, _type_of(df, ts), minutes, most=n)
    return busiest(rows, "number_of_services", "window_start", n)


# --- sessions --------------------------------------------------------------


def daily_sessions(
    df: DataFrame,
    ts: str,
    ident: str,
    gap_minutes: int = 10,
    first_hour: int = 6,
    last_hour: int = 23,
) -> DataFrame:
    """Sessions per day: a gap of ``gap_minutes`` minute marks starts a new one.

    Gaps count minute marks, so only the minutes that have events matter: a day
    has at most 1440 of them, however many events it holds.  ``gap_minutes`` of
    a session is its largest gap, the one before it included; it is NULL only
    for a day's first session if that is a single event.
    """
    clock = F.hour(ts) * 60 + F.minute(ts)
    minutes = (
        df.filter(F.hour(ts).between(first_hour, last_hour))
        .groupBy(
            F.to_date(F.col(ts)).alias("station_service_date"),
            clock.cast("bigint").alias("minute"),
        )
        .agg(
            F.min(ts).alias("first_ts"),
            F.max(ts).alias("last_ts"),
            F.count(F.lit(1)).alias("events"),
            F.count(ident).alias("n"),
        )
    )
    day = Window.partitionBy("station_service_date").orderBy("minute")
    step = F.col("minute") - F.lag("minute").over(day)
    inside = F.when(F.col("events") > 1, F.lit(0).cast("bigint"))
    starts = F.when(
        F.col("step").isNull() | (F.col("step") >= gap_minutes), 1
    ).otherwise(0)
    upto = day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = (
        minutes.withColumn("step", step)
        .withColumn("starts", starts)
        .withColumn("session_id_in_day", F.sum("starts").over(upto))
        .withColumn("gap", F.greatest("step", inside))
    )
    return numbered.groupBy("station_service_date", "session_id_in_day").agg(
        F.max("gap").alias("gap_minutes"),
        F.min("first_ts").alias("window_start"),
        F.max("last_ts").alias("window_end"),
        F.sum("n").alias("number_of_services"),
    )


def days_with_most_sessions(sessions: DataFrame, n: int = 5) -> DataFrame:
    """Days ranked by their number of sessions, with the longest one in hours."""
    hours = F.ceil(
        minute_boundaries("window_start", "window_end") / F.lit(60)
    ).cast("bigint")
    return (
        sessions.groupBy("station_service_date")
        .agg(
            F.max(hours).alias("number_of_hours_without_gap"),
            F.count(F.lit(1)).alias("number_of_sessions"),
        )
        .filter(F.col("number_of_hours_without_gap") != 0)
        .orderBy(F.col("number_of_sessions").desc(), "station_service_date")
        .limit(n)
    )


def sessions_of_day(sessions: DataFrame, day: str | Column) -> DataFrame:
    """The sessions of one day; a literal day reaches the scan of the events."""
    wanted = F.lit(day).cast("date") if isinstance(day, str) else day
    return sessions.filter(F.col("station_service_date") == wanted)


def distinct_gaps(sessions: DataFrame) -> DataFrame:
    """The different gap lengths in order, an unknown one last."""
    return (
        sessions.select("gap_minutes")
        .distinct()
        .orderBy(F.col("gap_minutes").asc_nulls_last())
    )
