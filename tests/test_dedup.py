from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strandline.operators import dedup, ordering
from tests.conftest import plan_of, rows

SCHEMA = "k string, d int, f string, v string"
ORDER = ["d", "f"]


def deliveries(seed: int, n: int = 400) -> list[tuple]:
    """A third of all rows belongs to one key, many of them exact copies."""
    rng = random.Random(seed)
    data = []
    for _ in range(n):
        hot = rng.random() < 0.35
        key = None if not hot and rng.random() < 0.05 else f"k{rng.randrange(40)}"
        data.append(
            (
                "hot" if hot else key,
                rng.choice([1, 1, 1, 2, 3]) if hot else rng.randrange(6),
                rng.choice(["a", "b"]),
                rng.choice(["x", "x", "x", "y", None]),
            )
        )
    return data


def brute_ranks(data: list[tuple]) -> Counter:
    groups: dict = {}
    for row in data:
        groups.setdefault(row[0], []).append(row)
    ranked = Counter()
    for group in groups.values():
        group.sort(key=lambda r: (r[1], r[2], r[3] is not None, r[3] or ""), reverse=True)
        for place, row in enumerate(group, 1):
            ranked[(*row, place)] += 1
    return ranked


@pytest.mark.parametrize("seed", [1, 2])
def test_ranks_equal_brute_force(spark, seed):
    data = deliveries(seed)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    found = dedup.ranked(df, ["k"], ORDER)
    assert Counter(tuple(r) for r in found.collect()) == brute_ranks(data)


def test_winners_and_rejects_are_bronze_as_bags(spark):
    data = deliveries(3)
    df = spark.createDataFrame(data, SCHEMA)
    won = dedup.latest_per_key(df, ["k"], ORDER)
    lost = dedup.rejects(df, ["k"], ORDER)
    together = [tuple(r) for r in won.collect()]
    assert len(together) == len({r[0] for r in data})
    together += [tuple(r)[:-1] for r in lost.collect()]
    assert Counter(together) == Counter(data)
    counts = dedup.reconcile_counts(df, won, lost)
    assert dedup.reconciliation_failures(counts).isEmpty()
    bags = dedup.reconcile_bags(df, won, lost).first()
    assert (bags["missing_rows"], bags["lost_rows"], bags["foreign_rows"]) == (0, 0, 0)
    counted = dedup.reconcile_counts(df, won, dedup.reject_counts(df, ["k"]), "rejected")
    assert rows(counted) == rows(counts)


def test_bags_show_what_counts_cannot(spark):
    df = spark.createDataFrame(deliveries(6), SCHEMA)
    won = dedup.latest_per_key(df, ["k"], ORDER)
    lost = dedup.rejects(df, ["k"], ORDER)
    changed = lost.withColumn("v", F.when(F.col("k") == "hot", "z").otherwise(F.col("v")))
    bags = dedup.reconcile_bags(df, won, changed).first()
    hot = lost.filter("k = 'hot'").count()
    assert (bags["missing_rows"], bags["lost_rows"], bags["foreign_rows"]) == (0, hot, hot)


def test_lost_rows_show_up(spark):
    df = spark.createDataFrame(deliveries(4), SCHEMA)
    won = dedup.latest_per_key(df, ["k"], ORDER)
    lost = dedup.rejects(df, ["k"], ORDER).filter("d <> 1")
    failed = dedup.reconciliation_failures(dedup.reconcile_counts(df, won, lost))
    assert failed.first()["missing_rows"] == sum(1 for r in deliveries(4) if r[1] == 1) - (
        won.filter("d = 1").count()
    )


def test_one_row_per_key_and_task_is_shuffled(spark):
    df = spark.createDataFrame(deliveries(1), SCHEMA)
    plan = plan_of(dedup.latest_per_key(df, ["k"], ORDER))
    assert "partial_max" in plan[plan.index("Exchange") :]
    assert plan.count("Exchange") == 1 and "Window" not in plan


def test_columns_that_cannot_be_compared_come_along(spark):
    df = spark.range(3).select(
        F.lit("a").alias("k"), "id", F.create_map(F.lit("n"), "id").alias("m")
    )
    assert rows(dedup.latest_per_key(df, ["k"], ["id"])) == [("a", 2, {"n": 2})]
    keys_only = df.select("k")
    assert rows(dedup.latest_per_key(keys_only, ["k"], [])) == [("a",)]


def test_conflicting_copies_have_one_winner_everywhere(spark):
    data = [("a", 1, "f", "old"), ("a", 1, "f", "new"), ("a", 1, "f", None)]
    for given in (data, data[::-1]):
        df = spark.createDataFrame(given, SCHEMA)
        assert rows(dedup.latest_per_key(df, ["k"], ORDER)) == [("a", 1, "f", "old")]
        ranks = rows(dedup.rejects(df, ["k"], ORDER).select("v", "_dedup_rank"))
        assert ranks == [(None, 3), ("new", 2)]


def test_one_key_is_sorted_by_several_tasks(spark):
    df = spark.range(0, 4000, 1, 8).select(F.lit("hot").alias("k"), "id")
    placed = ordering.global_positions(df, [F.col("k").asc(), F.col("id").desc()], "p", 4)
    per_task = placed.groupBy(F.spark_partition_id().alias("t")).count().collect()
    assert max(r["count"] for r in per_task) < 4000
    ranks = dedup.ranked(df, ["k"], ["id"]).select("id", "_dedup_rank").collect()
    assert sorted(tuple(r) for r in ranks) == [(i, 4000 - i) for i in range(4000)]


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_positions_are_gapless_and_ordered(spark, partitions):
    df = spark.createDataFrame([(i * 37 % 101,) for i in range(101)], "v int")
    placed = ordering.global_positions(df, [F.col("v").asc()], "p", partitions)
    assert sorted(tuple(r) for r in placed.collect()) == [(i, i) for i in range(101)]


def test_identical_rows_are_split_over_tasks(spark):
    df = spark.range(0, 4000, 1, 8).select(F.lit("same").alias("k"), F.lit(1).alias("v"))
    placed = ordering.global_positions(df, [F.col("k").asc()], "p", 4)
    assert sorted(r.p for r in placed.collect()) == list(range(4000))
    per_task = placed.groupBy(F.spark_partition_id().alias("t")).count().collect()
    assert max(r["count"] for r in per_task) < 4000


def test_flavours_of_duplicates(spark):
    data = [
        ("a", 1, "f1", "x"),
        ("a", 2, "f2", "x"),
        ("a", 2, "f2", "x"),
        ("b", 1, "f1", "x"),
        ("b", 1, "f1", "y"),
        ("c", 1, "f1", "x"),
    ]
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(dedup.deliveries_per_key(df, "k", "d")) == [("a", 2)]
    assert rows(dedup.copies_in_delivery(df, ["k", "d", "f"])) == [
        ("a", 2, "f2", 2),
        ("b", 1, "f1", 2),
    ]
    assert rows(dedup.losing_copies(df, "k", "d", ["f"])) == [
        ("a", 1, "f1", 2, 1, False),
        ("a", 2, "f2", 2, 1, True),
        ("b", 1, "f1", 1, 1, True),
    ]
