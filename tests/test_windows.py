from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from strandline.operators import windows
from tests.conftest import plan_of, rows

SCHEMA = "service_sk bigint, ts timestamp_ntz"
DAY = datetime(2024, 1, 5)


def t(clock: str, day: datetime = DAY) -> datetime:
    hour, minute, second = clock.split(":")
    return day + timedelta(hours=int(hour), minutes=int(minute), seconds=float(second))


def events(spark, *times, ident=1):
    return spark.createDataFrame([(ident, x) for x in times], SCHEMA)


def busy_day(seed: int) -> list[tuple]:
    """Events with ties, unknown ids, and a third of all rows in one second."""
    rng = random.Random(seed)
    data = []
    for n in range(300):
        if rng.random() < 0.35:
            offset = timedelta(hours=12, microseconds=rng.randrange(5))
        else:
            offset = timedelta(minutes=rng.randrange(0, 1440, 5)) + timedelta(
                microseconds=rng.choice([0, 0, 1, 999_999])
            )
        data.append((None if rng.random() < 0.1 else n, DAY + offset))
    return data


def test_hours_of_one_year(spark):
    df = events(
        spark,
        datetime(2023, 12, 31, 23, 59, 59),
        datetime(2024, 1, 1),
        datetime(2024, 1, 1, 0, 59),
        datetime(2024, 12, 31, 23, 59, 59, 999999),
        datetime(2025, 1, 1),
    )
    assert rows(windows.hourly_counts(df, "ts", 2024)) == [
        (datetime(2024, 1, 1), 2),
        (datetime(2024, 12, 31, 23), 1),
    ]


def test_profile_takes_the_days_as_given(spark):
    df = events(spark, t("00:14:59"), t("00:15:00"), t("00:16:00"))
    assert rows(windows.time_of_day_profile(df, "ts", 2024, days=4)) == [
        ("00:00", 0.25),
        ("00:15", 0.5),
    ]
    shifted = windows.time_of_day_profile(df, "ts", 2024, 1, 15, 5)
    assert rows(shifted) == [("00:05", 3.0)]


def brute_hopping(data, start, end, size, hop) -> list[tuple]:
    found = []
    begin = start
    while begin < end:
        stop = begin + timedelta(minutes=size)
        inside = [ident for ident, ts in data if ts and begin <= ts < stop]
        if inside:
            found.append((begin, stop, sum(i is not None for i in inside)))
        begin += timedelta(minutes=hop)
    return found


@pytest.mark.parametrize("size, hop", [(15, 5), (15, 10), (10, 15), (7, 3)])
def test_hopping_equals_brute_force_also_at_the_edges(spark, size, hop):
    start, end = t("03:00:00"), t("15:01:00")
    data = busy_day(1) + [
        (1, start - timedelta(minutes=1)),
        (2, end + timedelta(minutes=1)),
        (3, end + timedelta(minutes=30)),
    ]
    df = spark.createDataFrame(data, SCHEMA)
    found = windows.hopping_counts(df, "ts", "service_sk", start, end, size, hop)
    expected = brute_hopping(data, start, end, size, hop)
    assert [tuple(r) for r in found.orderBy("window_start").collect()] == expected
    top = windows.busiest(found, "number_of_services", "window_start")
    assert [tuple(r) for r in top.collect()] == sorted(
        expected, key=lambda r: (-r[2], r[0])
    )[:5]


def brute_sliding(data, minutes: int) -> list[tuple]:
    span = timedelta(minutes=minutes)
    return [
        (
            ts - span,
            ts,
            sum(i is not None for i, other in data if ts - span <= other <= ts),
        )
        for _, ts in data
    ]


@pytest.mark.parametrize("minutes", [1, 15])
def test_sliding_equals_brute_force(spark, minutes):
    data = busy_day(2) + [(7, t("10:00:00")), (8, t("10:15:00")), (9, t("10:15:00.000001"))]
    df = spark.createDataFrame(data, SCHEMA)
    expected = brute_sliding(data, minutes)
    assert rows(windows.sliding_counts(df, "ts", "service_sk", minutes)) == sorted(
        expected, key=lambda r: [(v is not None, str(v)) for v in r]
    )
    top = windows.sliding_top(df, "ts", "service_sk", minutes)
    best = sorted(expected, key=lambda r: (-r[2], r[0]))[:5]
    assert [tuple(r) for r in top.collect()] == best


def test_sliding_keeps_events_without_a_time(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, t("10:00:00"))], SCHEMA)
    found = windows.sliding_counts(df, "ts", "service_sk")
    assert rows(found.select("window_end", "number_of_services")) == [
        (None, 2),
        (None, 2),
        (t("10:00:00"), 1),
    ]


def test_sliding_deals_out_many_copies(spark, monkeypatch):
    monkeypatch.setattr(windows, "EXPAND_CHUNK", 7)
    df = events(spark, *[t("10:00:00")] * 50)
    found = windows.sliding_counts(df, "ts", "service_sk")
    assert rows(found.select("number_of_services")) == [(50,)] * 50


def test_no_window_runs_in_a_single_task(spark):
    df = spark.createDataFrame(busy_day(3), SCHEMA)
    for found in (
        windows.sliding_counts(df, "ts", "service_sk"),
        windows.daily_sessions(df, "ts", "service_sk"),
    ):
        assert "SinglePartition" not in plan_of(found)


def brute_sessions(data, gap: int) -> list[tuple]:
    found = []
    inside = sorted(
        (ts, n, ident)
        for n, (ident, ts) in enumerate(data)
        if 6 <= ts.hour <= 23
    )
    before, number = None, 0
    for ts, _, ident in inside:
        minute = ts.replace(second=0, microsecond=0)
        step = None
        if before is not None and before.date() == ts.date():
            last = before.replace(second=0, microsecond=0)
            step = int((minute - last).total_seconds()) // 60
        else:
            number = 0
        if step is None or step >= gap:
            number += 1
            found.append([ts.date(), number, step, ts, ts, 0])
        current = found[-1]
        gaps = [g for g in (current[2], step) if g is not None]
        current[2] = max(gaps) if gaps else None
        current[4] = ts
        current[5] += ident is not None
        before = ts
    return [tuple(f) for f in found]


@pytest.mark.parametrize("gap", [5, 10])
def test_sessions_equal_brute_force(spark, gap):
    data = busy_day(4) + [
        (i, ts + timedelta(days=1, seconds=i % 50)) for i, (_, ts) in enumerate(busy_day(5))
    ]
    df = spark.createDataFrame(data, SCHEMA)
    found = windows.daily_sessions(df, "ts", "service_sk", gap)
    assert [tuple(r) for r in found.orderBy("window_start").collect()] == brute_sessions(
        data, gap
    )


def test_gaps_count_minute_marks(spark):
    df = events(
        spark,
        t("05:59:59"),  # before service hours
        t("06:00:59"),
        t("06:10:00"),  # ten marks in 9:01 minutes: a new session
        t("06:19:59"),  # nine marks in 9:59
        t("06:29:58"),  # ten marks in 9:59
        t("23:59:59"),
        t("06:00:00", DAY + timedelta(days=1)),
    )
    found = windows.daily_sessions(df, "ts", "service_sk")
    summary = found.select("session_id_in_day", "gap_minutes", "number_of_services")
    assert rows(summary.filter(F.col("station_service_date") == DAY.date())) == [
        (1, None, 1),
        (2, 10, 2),
        (3, 10, 1),
        (4, 1050, 1),
    ]
    gaps = [r[0] for r in windows.distinct_gaps(found).collect()]
    assert gaps == [10, 1050, None]


def test_first_session_with_two_events_in_a_minute_has_gap_zero(spark):
    df = events(spark, t("07:00:01"), t("07:00:02"))
    found = windows.daily_sessions(df, "ts", "service_sk")
    assert rows(found.select("gap_minutes")) == [(0,)]


def test_days_with_most_sessions_and_one_day(spark):
    next_day = DAY + timedelta(days=1)
    df = events(
        spark,
        *[t(c) for c in ("07:00:00", "07:30:00", "07:31:00")],
        *[t(c, next_day) for c in ("07:00:00", "09:00:00", "09:09:00", "10:00:00")],
        t("08:00:00", DAY + timedelta(days=2)),
    )
    sessions = windows.daily_sessions(df, "ts", "service_sk")
    top = [tuple(r) for r in windows.days_with_most_sessions(sessions).collect()]
    assert top == [(next_day.date(), 1, 3), (DAY.date(), 1, 2)]
    assert windows.sessions_of_day(sessions, "2024-01-05").count() == 2


def test_time_zone_must_be_utc(spark):
    df = events(spark, t("07:00:00"))
    spark.conf.set("spark.sql.session.timeZone", "Europe/Stockholm")
    try:
        with pytest.raises(ValueError, match="UTC"):
            windows.sliding_counts(df, "ts", "service_sk")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_busy_instant_is_written_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(windows, "EXPAND_CHUNK", 100)
    at = F.lit("2024-01-01 10:00:00").cast("timestamp_ntz").alias("ts")
    df = spark.range(0, 5000, 1, 4).select(at, F.col("id").alias("user_id"))
    small = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(small, "false")  # else so few rows are put together again
    try:
        found = windows.sliding_counts(df, "ts", "user_id")
        per_task = found.groupBy(F.spark_partition_id().alias("t")).count().collect()
    finally:
        spark.conf.set(small, "true")
    assert sum(r["count"] for r in per_task) == 5000
    assert len(per_task) > 1 and max(r["count"] for r in per_task) < 5000
    assert found.select("number_of_services").distinct().collect()[0][0] == 5000
