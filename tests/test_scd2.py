from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strandline.operators import dedup, ordering, scd2
from strandline.plans.history import HistoryStore
from tests.conftest import plan_of, rows

SCHEMA = "k string, d date, a string, b int, src string"
CHECK = ("a", "b")


def day(n: int) -> date:
    return date(2024, 1, n)


def at(n: int) -> datetime:
    return datetime(2024, 1, n)


def landing(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def spans(df) -> list[tuple]:
    """Key, attributes and interval of every version."""
    return rows(df.select("k", "a", "b", scd2.FROM, scd2.TO))


def fold(spark, deliveries: dict, close_missing: bool = False):
    """Merge landings one by one, in plain Spark."""
    history = None
    for moment, data in sorted(deliveries.items()):
        new = spark.createDataFrame(data, SCHEMA)
        if history is None:
            history = scd2.first_snapshot(new, ["k"], moment).drop(scd2.CHANGE)
        else:
            closed = history.filter(F.col(scd2.TO).isNotNull())
            merged = scd2.merge_snapshot(
                scd2.current_versions(history), new, ["k"], CHECK, moment, close_missing
            )
            history = closed.unionByName(merged.drop(scd2.CHANGE))
        history = spark.createDataFrame(history.collect(), history.schema)
    return history


def test_first_snapshot_opens_every_row(spark):
    opened = scd2.first_snapshot(landing(spark, ("x", day(1), "1", 1, "f")), ["k"], at(1))
    assert spans(opened) == [("x", "1", 1, at(1), None)]
    assert opened.first()[scd2.UPDATED] == at(1)
    assert opened.first()[scd2.CHANGE] == scd2.INSERT


def test_unknown_to_value_and_back_makes_three_versions(spark):
    history = fold(
        spark,
        {
            at(1): [("x", day(1), None, 1, "f1")],
            at(2): [("x", day(2), "v", 1, "f2")],
            at(3): [("x", day(3), None, 1, "f3")],
            at(4): [("x", day(4), None, 1, "f4")],
        },
    )
    assert spans(history) == [
        ("x", None, 1, at(1), at(2)),
        ("x", None, 1, at(3), None),
        ("x", "v", 1, at(2), at(3)),
    ]


def test_unchanged_rows_keep_what_was_first_seen(spark):
    history = fold(
        spark,
        {
            at(1): [("x", day(1), "v", 1, "first")],
            at(2): [("x", day(2), "v", 1, "second")],
        },
    )
    assert rows(history.select("d", "src", scd2.FROM)) == [(day(1), "first", at(1))]


@pytest.mark.parametrize("close_missing", [False, True])
def test_missing_keys(spark, close_missing):
    history = fold(
        spark,
        {
            at(1): [("x", day(1), "v", 1, "f"), ("y", day(1), "v", 1, "f")],
            at(2): [("x", day(2), "v", 1, "f")],
        },
        close_missing,
    )
    end = at(2) if close_missing else None
    assert spans(history) == [("x", "v", 1, at(1), None), ("y", "v", 1, at(1), end)]


def test_a_repeated_landing_key_stops_the_merge(spark):
    twice = landing(spark, ("x", day(1), "v", 1, "f"), ("x", day(1), "w", 1, "f"))
    with pytest.raises(PySparkException, match="more than once: x"):
        scd2.first_snapshot(twice, ["k"], at(1)).collect()


def random_deliveries(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    return [
        (
            f"k{rng.randrange(6)}",
            day(rng.randrange(1, 9)),
            rng.choice(["p", "q", None]),
            rng.choice([1, None]),
            f"f{n:03d}",
        )
        for n in range(60)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_one_pass_equals_the_fold(spark, seed):
    data = random_deliveries(seed)
    bronze = spark.createDataFrame(data, SCHEMA)
    deliveries = {}
    for d in sorted({r[1] for r in data}):
        so_far = bronze.filter(F.col("d") <= F.lit(d))
        newest = dedup.latest_per_key(
            so_far, ["k"], ["d", "src"]
        )
        moment = datetime(d.year, d.month, d.day)
        deliveries[moment] = [tuple(r) for r in newest.collect()]
    folded = fold(spark, deliveries)
    passed = scd2.history_from_deliveries(
        bronze, ["k"], "d", CHECK, ["src"]
    )
    assert rows(passed.select(folded.columns)) == rows(folded)
    assert scd2.interval_problems(folded, "k").isEmpty()
    assert rows(scd2.totals(folded)) == [(folded.count(), len({r[0] for r in data}))]


def test_a_late_delivery_leaves_the_fold_but_not_the_one_pass_history(spark):
    in_time = [("x", day(1), "a", 1, "f1"), ("x", day(3), "b", 1, "f3")]
    late = ("x", day(2), "late", 1, "f2")
    folded = fold(
        spark,
        {at(1): in_time[:1], at(3): in_time[1:], at(4): in_time[1:]},
    )
    assert len(spans(folded)) == 2
    bronze = landing(spark, *in_time, late)
    again = scd2.history_from_deliveries(bronze, ["k"], "d", CHECK)
    assert [s[1] for s in sorted(spans(again), key=lambda s: s[3])] == ["a", "late", "b"]


def test_as_of_and_point_in_time(spark):
    history = fold(
        spark,
        {
            at(1): [("x", day(1), "a", 1, "f")],
            at(5): [("x", day(5), "b", 1, "f")],
        },
    )
    assert spans(scd2.versions_as_of(history, at(4))) == [("x", "a", 1, at(1), at(5))]
    assert spans(scd2.versions_as_of(history, at(5))) == [("x", "b", 1, at(5), None)]
    facts = spark.createDataFrame(
        [(n, "x", at(n)) for n in (1, 4, 5, 9)] + [(0, "y", at(3)), (-1, "x", None)],
        "n int, who string, seen timestamp_ntz",
    )
    for buckets in (1, 2, 30, None):
        found = scd2.point_in_time(facts, history, "who", "k", "seen", ["a"], buckets)
        assert rows(found.select("n", "a")) == rows(
            spark.createDataFrame(
                [(-1, None), (0, None), (1, "a"), (4, "a"), (5, "b"), (9, "b")],
                "n int, a string",
            )
        )


def test_broken_intervals_are_found(spark):
    data = [
        ("ok", at(1), at(2)),
        ("ok", at(2), None),
        ("gap", at(1), at(2)),
        ("gap", at(3), None),
        ("overlap", at(1), at(4)),
        ("overlap", at(3), None),
        ("open", at(1), None),
        ("open", at(3), None),
        ("empty", at(2), at(2)),
        ("twice", at(1), None),
        ("twice", at(1), at(2)),
    ]
    schema = f"k string, {scd2.FROM} timestamp_ntz, {scd2.TO} timestamp_ntz"
    found = scd2.interval_problems(spark.createDataFrame(data, schema), "k")
    assert rows(found.select("k", "problem")) == [
        ("empty", "empty interval"),
        ("gap", "gap"),
        ("open", "overlap"),
        ("overlap", "overlap"),
        ("twice", "several versions start together"),
    ]


@pytest.mark.parametrize(
    "whole_every, close_missing", [(1, False), (2, False), (2, True), (10, True)]
)
def test_store_equals_the_fold(spark, tmp_path, whole_every, close_missing):
    deliveries = {
        at(1): [("x", day(1), "a", 1, "f"), ("y", day(1), "a", 1, "f")],
        at(2): [("x", day(2), "b", 1, "f"), ("y", day(2), "a", 1, "f")],
        at(3): [("x", day(3), "c", 1, "f"), ("z", day(3), "n", None, "f")],
        at(4): [("x", day(4), "c", 1, "f"), ("y", day(4), "b", 1, "f")],
    }
    folded = fold(spark, deliveries, close_missing)
    store = HistoryStore(
        spark, str(tmp_path / "h"), ("k",), CHECK, close_missing, whole_every
    )
    for moment, data in deliveries.items():
        store.apply(spark.createDataFrame(data, SCHEMA), moment, str(moment))
    columns = folded.columns
    assert rows(store.history().select(columns)) == rows(folded)
    assert rows(store.current().select(columns)) == rows(scd2.current_versions(folded))
    early = fold(spark, {m: d for m, d in deliveries.items() if m <= at(2)}, close_missing)
    assert rows(store.history(2).select(columns)) == rows(early)


def test_two_merges_at_one_moment_keep_their_versions_apart(spark, tmp_path):
    store = HistoryStore(spark, str(tmp_path / "h"), ("k",), CHECK)
    for n, value in enumerate("abc"):
        store.apply(landing(spark, ("x", day(1), value, 1, "f")), at(1), f"run-{n}")
    assert spans(store.current()) == [("x", "c", 1, at(1), None)]
    assert store.history().count() == 3


def test_a_load_of_changes_leaves_other_versions_alone(spark, tmp_path):
    store = HistoryStore(spark, str(tmp_path / "h"), ("k",), CHECK)
    many = [(f"k{n}", day(1), "a", 1, "f") for n in range(50)]
    store.apply(landing(spark, *many), at(1), "run-1")
    store.apply(landing(spark, ("k7", day(2), "b", 1, "f")), at(2), "run-2")
    assert store.table.rows_of(2) == 2
    with pytest.raises(LookupError, match="changes only"):
        store.table.read_version(2)
    assert store.current().count() == 50 and store.history().count() == 51


def test_store_publishes_loads_and_ignores_repeats(spark, tmp_path):
    store = HistoryStore(spark, str(tmp_path / "h"), ("k",), CHECK)
    with pytest.raises(LookupError):
        store.history()
    one = landing(spark, ("x", day(1), "a", 1, "f"), ("y", day(1), "a", 1, "f"))
    two = landing(spark, ("x", day(2), "b", 1, "f"), ("y", day(2), "a", 1, "f"))
    assert store.apply(one, at(1), "run-1") == 1
    assert store.apply(two, at(2), "run-2") == 2
    assert store.apply(two, at(3), "run-2") == 2
    assert spans(store.history()) == [
        ("x", "a", 1, at(1), at(2)),
        ("x", "b", 1, at(2), None),
        ("y", "a", 1, at(1), None),
    ]
    assert spans(store.history(1)) == spans(store.current(1))
    assert len(spans(store.current())) == 2


def test_a_load_that_was_cut_short_does_not_count(spark, tmp_path):
    store = HistoryStore(spark, str(tmp_path / "h"), ("k",), CHECK)
    store.apply(landing(spark, ("x", day(1), "a", 1, "f")), at(1), "run-1")
    half = store.current().withColumn("state", F.lit("closed"))
    half.write.partitionBy("state").parquet(f"{store.table.data_path}/load_id=2")
    assert len(spans(store.history())) == 1
    store.apply(landing(spark, ("x", day(2), "b", 1, "f")), at(2), "run-2")
    assert len(spans(store.history())) == 2


def test_a_landing_with_a_busy_or_unknown_key_is_refused(spark):
    keys = F.when(F.col("id") % 3 == 0, "busy").otherwise(F.col("id").cast("string"))
    landing = spark.range(0, 3000, 1, 4).select(keys.alias("k"), F.col("id").alias("v"))
    plan = plan_of(scd2.one_row_per_key(landing, ["k"]))
    assert "Window" not in plan
    with pytest.raises(Exception, match="more than once: busy"):
        scd2.one_row_per_key(landing, ["k"]).collect()
    unknown = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    with pytest.raises(Exception, match="without its key"):
        scd2.first_snapshot(unknown, ["k"], datetime(2024, 1, 1)).collect()


def test_version_ids_tell_keys_and_moments_apart(spark):
    from strandline.functions.expressions import version_id

    data = [("a|b", "c"), ("a", "b|c"), (None, "c"), ("", "c"), ("~", "c"), ("1:a", "c")]
    df = spark.createDataFrame(data, "k string, l string")
    moments = [f"2024-01-01 10:00:00.00000{i}" for i in range(3)]
    ids = [
        r[0]
        for m in moments
        for r in df.select(version_id(["k", "l"], F.lit(m).cast("timestamp_ntz"))).collect()
    ]
    assert len(set(ids)) == len(data) * len(moments)


def test_point_in_time_runs_no_job_while_it_is_built(spark):
    facts = spark.createDataFrame([("a", datetime(2024, 1, 5))], "c string, d timestamp_ntz")
    history = scd2.history_from_deliveries(
        spark.createDataFrame([("a", date(2024, 1, 1), "x")], "k string, d date, v string"),
        ["k"], "d", ["v"],
    )
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "build")
    found = scd2.point_in_time(facts, history.drop("d"), "c", "k", "d", ["v"])
    assert not tracker.getJobIdsForGroup("build")
    spark.sparkContext.setJobGroup("run", "run")
    assert found.first()["v"] == "x"
    assert scd2.point_in_time(facts.limit(0), history.drop("d"), "c", "k", "d", ["v"]).isEmpty()


@pytest.mark.parametrize("buckets", [1, 3, 16, 60])
def test_point_in_time_equals_a_lookup_one_by_one(spark, buckets):
    """A busy key, many facts of one moment, repeated facts, gaps and empty intervals."""
    rng = random.Random(buckets)
    versions, known = [], {}
    for k in "abc":
        t = 0
        while t < 40:
            length = rng.choice([0, 1, 3, 9])
            end = None if t + length > 38 else t + length
            if rng.random() < 0.8:
                versions.append((k, at(1) + timedelta(hours=t), end if end is None else at(1) + timedelta(hours=end), f"{k}{t}"))
                known.setdefault(k, []).append((t, end, f"{k}{t}"))
            if end is None:
                break
            t += max(1, length)
    data = [(i, rng.choice("aaaaaabcz"), rng.randrange(-3, 45)) for i in range(600)]
    data += [(1000, "a", 7)] * 500 + [(2000, None, 5), (2001, "a", None)]
    facts = spark.createDataFrame(
        [(i, k, None if t is None else at(1) + timedelta(hours=t)) for i, k, t in data],
        "n int, who string, seen timestamp_ntz",
    ).repartition(7)
    history = spark.createDataFrame(
        versions, f"k string, {scd2.FROM} timestamp_ntz, {scd2.TO} timestamp_ntz, a string"
    )
    found = scd2.point_in_time(facts, history, "who", "k", "seen", ["a"], buckets)
    valid = lambda k, t: next(
        (v for b, e, v in known.get(k, []) if t is not None and b <= t and (e is None or t < e)), None
    )
    expected = [(i, valid(k, t)) for i, k, t in data]
    assert sorted(map(str, map(tuple, found.select("n", "a").collect()))) == sorted(map(str, expected))


def test_point_in_time_splits_a_busy_moment(spark):
    facts = spark.range(0, 30_000, 1, 12).selectExpr(
        "id", "if(id % 3 > 0, 'hot', concat('k', id % 100)) AS who",
        "if(id % 3 > 0, timestamp_ntz '2024-01-05', timestamp_ntz '2024-01-01' + make_dt_interval(id % 9)) AS seen",
    )
    history = scd2.history_from_deliveries(
        facts.selectExpr("who", "date '2024-01-02' AS d", "'v' AS v").distinct(), ["who"], "d", ["v"]
    )
    rows_of = facts.selectExpr("who AS _key", "seen AS _at", "1 AS _kind", "spark_partition_id() AS _salt")
    place = F.struct("_key", "_at", "_kind", "_salt")
    keys = rows_of.groupBy("_key", "_at", "_kind", "_salt").count()
    dealt = ordering.in_buckets(
        rows_of, place, keys.select(place.alias("key"), F.col("count").alias("weight")), 16
    )
    assert dealt.groupBy("_bucket").count().agg(F.max("count")).first()[0] < 6000
    found = scd2.point_in_time(facts, history.drop("d"), "who", "who", "seen", ["v"], 16)
    assert found.count() == 30_000
    assert found.filter("v IS NOT NULL").count() == facts.filter("seen >= '2024-01-02'").count()
