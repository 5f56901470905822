from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from strandline.functions import expressions as ex
from strandline.operators import dedup, diff, keys, ordering, pivot, privacy, quality, summaries
from strandline.plans import verify
from tests.conftest import plan_of, rows

NAMES = {
    "foretagsnamn": privacy.COMPANY,
    "namn": privacy.ENTITY,
    "coadress": privacy.PERSON,
}
PEOPLE = "peorgnr string, foretagsnamn string, namn string, coadress string, file string"


# --- diff ------------------------------------------------------------------


def ab(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "z")], "k int, v string")
    b = spark.createDataFrame([("x", 1), (None, 2), ("w", 3)], "v string, k int")
    return a, b


def test_sets_and_bags(spark):
    a, b = ab(spark)
    assert rows(diff.compare_relations(a, b)) == [
        (False, True, 1, 25.0),
        (True, False, 1, 25.0),
        (True, True, 2, 50.0),
    ]
    assert rows(diff.compare_relations(a, b, bag=True)) == [
        (False, True, 1, 20.0),
        (True, False, 2, 40.0),
        (True, True, 2, 40.0),
    ]
    assert rows(diff.surplus_rows(a, b)) == [(1, "x", 2, 1), (3, "w", 0, 1), (3, "z", 1, 0)]
    assert rows(diff.rows_missing_from(a, b)) == [(3, "z")]
    assert rows(diff.rows_missing_from(a, b, bag=True)) == [(1, "x"), (3, "z")]
    assert rows(diff.common_rows(a, b)) == [(1, "x"), (2, None)]


def test_many_copies_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(ordering, "EXPAND_CHUNK", 7)
    a = spark.range(50).select(F.lit("x").alias("v"))
    b = spark.createDataFrame([("x",)] * 3 + [("y",)], "v string")
    assert rows(diff.rows_missing_from(a, b, bag=True)) == [("x",)] * 47
    assert rows(diff.rows_missing_from(b, a, bag=True)) == [("y",)]


def test_excluded_columns_and_differing_schemas(spark):
    a, b = ab(spark)
    only = diff.compare_relations(a.withColumn("at", F.rand()), b, exclude=["at", "v"])
    assert rows(only) == [(True, True, 3, 100.0)]
    with pytest.raises(ValueError, match="extra"):
        diff.compare_relations(a.withColumn("extra", F.lit(1)), b)


def test_keyed_diff_names_columns_and_never_pairs_copies(spark):
    schema = "k int, v string, w int"
    a = spark.createDataFrame(
        [(1, "x", 1), (2, None, 1), (3, "c", 1), (4, "d", 1)] + [(9, "r", 0)] * 50, schema
    )
    b = spark.createDataFrame(
        [(1, "x", 1), (2, "n", 2), (3, None, 1), (5, "e", 1)] + [(9, "r", 0)] * 50, schema
    )
    found = diff.keyed_diff(a, b, ["k"])
    assert rows(found) == [
        (2, "changed", ["v", "w"], 1, 1),
        (3, "changed", ["v"], 1, 1),
        (4, "only_a", [], 1, 0),
        (5, "only_b", [], 0, 1),
        (9, "repeated", [], 50, 50),
    ]
    assert "Join" not in plan_of(found)


# --- checks ----------------------------------------------------------------


def test_checks_have_severities_and_keep_failures(spark, tmp_path):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    outcomes = quality.run_checks(
        spark,
        [
            quality.Check("known", lambda: quality.not_null_failures(df, "k")),
            quality.Check(
                "once", lambda: quality.unique_failures(df, "k"), quality.WARN, store=True
            ),
            quality.Check("fine", lambda: df.limit(0)),
        ],
        str(tmp_path),
    )
    assert [(o.name, o.status, o.failures) for o in outcomes] == [
        ("known", "fail", 2),
        ("once", "warn", 1),
        ("fine", "pass", 0),
    ]
    assert rows(spark.read.parquet(str(tmp_path / "once"))) == [("a", 2)]
    with pytest.raises(ValueError, match="severity"):
        quality.run_checks(spark, [quality.Check("x", lambda: df, "fatal")])
    with pytest.raises(ValueError, match="audit_root"):
        quality.run_checks(spark, [quality.Check("x", lambda: df, store=True)])


def test_rules_in_one_scan(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", 1.0, None), ("a", 2.0, None), (None, 2.0, None), (None, None, "x")],
        "k string, x double, z string",
    )
    rules = [
        quality.Rule("known", quality.NOT_NULL, "k"),
        quality.Rule("once", quality.UNIQUE, "k", quality.WARN, store=True),
        quality.Rule("x_once", quality.UNIQUE, "x"),
        quality.Rule("z_known", quality.NOT_NULL, "z", quality.WARN),
        quality.Rule("z_once", quality.UNIQUE, "z", store=True),
    ]
    root = str(tmp_path)
    assert [(o.name, o.status, o.failures) for o in quality.run_rules(df, rules, root)] == [
        ("known", "fail", 2), ("once", "warn", 1), ("x_once", "fail", 1),
        ("z_known", "warn", 3), ("z_once", "pass", 0),
    ]
    assert rows(quality.stored(df, rules, root, "once")) == [("a", 2)]
    # A run without failures leaves nothing of the one before.
    assert all(o.status == quality.PASSED for o in quality.run_rules(df.limit(0), rules, root))
    assert quality.stored(df, rules, root, "once").count() == 0
    with pytest.raises(ValueError, match="kind"):
        quality.run_rules(df, [quality.Rule("x", "positive", "k")], root)
    with pytest.raises(ValueError, match="severity"):
        quality.run_rules(df, [quality.Rule("x", quality.UNIQUE, "k", "fatal")], root)


def test_one_rule_alone(spark, tmp_path):
    df = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    for kind in (quality.NOT_NULL, quality.UNIQUE):
        found = quality.run_rules(df, [quality.Rule("r", kind, "k")], str(tmp_path))
        assert found == [quality.Outcome("r", quality.FAILED, 1)]


# --- reports ---------------------------------------------------------------


def test_reports_on_sound_and_broken_layers(spark):
    bronze = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("b", 1, "x")], "k string, d int, v string"
    )
    order = ["d"]
    landing = dedup.latest_per_key(bronze, ["k"], order)
    lost = dedup.rejects(bronze, ["k"], order)
    stamp = F.lit("2024-01-01").cast("timestamp_ntz")
    end = F.when(F.col("d") == 1, F.when(F.col("k") == "a", stamp))
    history = bronze.withColumn("dbt_valid_from", stamp).withColumn("dbt_valid_to", end)

    counted = verify.layer_counts(
        [
            verify.whole_layer(landing, "landing"),
            verify.counted_history(history, "scd2"),
            verify.whole_layer(bronze, "bronze"),
        ]
    )
    assert [tuple(r) for r in counted.collect()] == [
        ("bronze", 3), ("landing", 2), ("scd2 current only", 2), ("scd2 total", 3),
    ]

    key = verify.interesting_key(history, "k")
    assert key == "a"
    assert verify.interesting_key(landing, "k") == "a"
    assert verify.interesting_key(landing.limit(0), "k") is None
    lineage = verify.entity_lineage(
        [
            verify.plain_layer(bronze, "bronze"),
            verify.rejects_layer(lost),
            verify.history_layer(history, "scd2"),
        ],
        "k",
        "v",
        "d",
        key,
    )
    start = "valid 2024-01-01 00:00:00 until "
    assert [tuple(r) for r in lineage.collect()] == [
        ("bronze", "a", "x", 1, None),
        ("bronze", "a", "y", 2, None),
        ("rejects, place 2", "a", "x", 1, None),
        ("scd2", "a", "x", 1, f"{start}2024-01-01 00:00:00"),
        ("scd2", "a", "y", 2, f"{start}now"),
    ]

    sound = verify.integrity_problems(
        "k", {"landing": landing}, {"scd2": history},
        dedup.reconcile_counts(bronze, landing, lost),
    )
    assert rows(verify.number_of_problems(sound)) == [(0,)]
    broken = verify.integrity_problems(
        "k",
        {"landing": bronze},
        {"scd2": history.withColumn("dbt_valid_to", F.lit(None).cast("timestamp_ntz"))},
        dedup.reconcile_counts(bronze, landing, lost.limit(0)),
    )
    assert rows(verify.number_of_problems(broken)) == [(3,)]
    assert rows(broken) == [
        ("landing: k comes more than once", "a", 2),
        ("of 3 bronze rows, 2 won and 0 were rejected", None, 1),
        ("scd2: several open versions of one k", "a", 2),
    ]


# --- privacy ---------------------------------------------------------------

# Pseudonyms of known keys.
COMPANIES = {
    "161020159271": "DEMO AB 2334",
    "169999999901": "DEMO AB 2649",
    "169999999902": "DEMO AB 2193",
    "169999999903": "DEMO AB 0190",
}


def test_pseudonyms_equal_the_known_ones(spark):
    data = [(k, "Some Name", "", None, "f") for k in COMPANIES]
    data.append(("161020159248", "\t ", "Person", None, "f"))
    data.append(("", "Kept", "Kept", "Kept", "f"))
    data.append((None, "Kept", None, None, "f"))
    found = privacy.pseudonymise(spark.createDataFrame(data, PEOPLE), "peorgnr", NAMES)
    by_key = {r.peorgnr: r for r in found.collect()}
    for key, name in COMPANIES.items():
        assert by_key[key].foretagsnamn == name
        assert by_key[key].namn == "" and by_key[key].coadress is None
    assert by_key["161020159248"].foretagsnamn == "\t "
    assert by_key["161020159248"].namn == "DEMO ENTITY 2249"
    assert by_key[""].coadress == "Kept" and by_key[None].foretagsnamn == "Kept"
    with pytest.raises(ValueError, match="coadress"):
        privacy.pseudonymise(found.drop("coadress"), "peorgnr", NAMES)


@pytest.mark.parametrize("mod", [1, 7, 10_000, 2**31 - 1])
def test_hash_equals_the_big_number_remainder(spark, mod):
    texts = [f"ftg:{n}å" for n in range(50)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = {r.t: r.h for r in df.select("t", ex.digest_mod(F.sha2("t", 256), mod).alias("h")).collect()}
    for text in texts:
        digest = hashlib.sha256(text.encode()).hexdigest()
        assert found[text] == int(digest, 16) % mod


def test_files_that_are_done_are_left_alone(spark):
    data = [
        ("1", "DEMO AB 1", "", None, "done"),
        ("2", " DEMO AB 2", "DEMO ENTITY 2", None, "done"),
        ("3", "DEMO AB 3", "Open", None, "half"),
        ("4", "", " ", None, "nameless"),
    ]
    df = spark.createDataFrame(data, PEOPLE)
    report = privacy.pseudonymisation_report(df, "file", "peorgnr", NAMES)
    assert rows(report) == [
        ("done", 2, 0, True),
        ("half", 1, 1, False),
        ("nameless", 1, 1, False),
    ]
    found = privacy.pseudonymise_open_files(df, "file", "peorgnr", NAMES)
    kept = {tuple(r) for r in found.collect()}
    assert set(data[:2]) <= kept and data[3] in kept and data[2] not in kept
    again = privacy.pseudonymise_open_files(found, "file", "peorgnr", NAMES)
    assert rows(again) == rows(found)


# --- keys, pivot, sums -----------------------------------------------------


def test_surrogate_key_is_sixteen_bytes_of_the_content(spark):
    df = spark.createDataFrame([(1919, "2025_data.parquet")], "id int, f string")
    key = keys.with_surrogate_key(df, ["id", "f"], "sk").first().sk
    assert bytes(key) == hashlib.md5(b"19192025_data.parquet").digest()


def test_sequence_and_load_columns(spark):
    df = spark.createDataFrame([(n,) for n in (5, 3, 9, 3)], "v int")
    numbered = keys.with_sequence_key(df, "id", ["v"], start=100, partitions=3)
    assert rows(numbered.select("id", "v")) == [(100, 3), (101, 3), (102, 5), (103, 9)]
    stamped = keys.with_load_defaults(df, batch_id="b").first()
    assert stamped.dbt_batch_id == "b" and stamped.stg_loaded_at is not None


def test_attributes_become_columns(spark):
    long = spark.createDataFrame(
        [
            ("householdID_1919", "f1", "income", 10.25, "r1"),
            ("householdID_1919", "f1", "children", 2.0, "r1"),
            ("householdID_1919", "f2", "income", None, "r2"),
            ("no id", "f2", "income", 1.0, None),
        ],
        "row_id string, filename string, column_id string, val_dec double, report_table string",
    )
    with_id = pivot.entity_id(long, "row_id", "bk")
    wide = pivot.pivot_attributes(
        with_id, "bk", "filename", "column_id", "val_dec",
        {"income": ("income_before_tax", "decimal(18,2)"), "children": ("n", "int")},
    )
    assert dict(wide.dtypes) == {
        "bk": "string", "filename": "string", "income_before_tax": "decimal(18,2)", "n": "int",
    }
    found = [(r[0], r[1], r[2] and float(r[2]), r[3]) for r in wide.collect()]
    assert sorted(found, key=str) == sorted(
        [("1919", "f1", 10.25, 2), ("1919", "f2", None, None)],
        key=str,
    )
    assert rows(pivot.rows_without_entity(with_id, "bk")) == [(1,)]
    texts = with_id.withColumn("val_str", F.concat(F.lit("t"), "column_id"))
    named = {"income": ("label", "string"), "children": ("n", "int")}
    both = pivot.pivot_attributes(texts, "bk", "filename", "column_id", "val_dec", named, "val_str")
    assert rows(both) == [("1919", "f1", "tincome", 2), ("1919", "f2", "tincome", None)]
    reports = [tuple(r) for r in pivot.rows_per_report(long).collect()]
    assert reports == [("r1", 2), ("r2", 1), (None, 1)]
    first = pivot.first_report_rows(long, "report_table", ["row_id", "column_id"])
    assert [r.column_id for r in first.collect()] == ["children", "income"]
    sample = pivot.sample_with_value(long, "val_dec", ["val_dec"], 2)
    assert [r.val_dec for r in sample.collect()] == [1.0, 2.0]


def test_sums_skip_placeholders_and_unknowns(spark):
    df = spark.createDataFrame(
        [("p1", 2), ("p1", 3), ("unknown", 9), (None, 4)], "province_sk string, n int"
    )
    known = F.col("province_sk") != "unknown"
    summed = summaries.sum_of_known(df, known, ["province_sk"], "n", "rides")
    names = spark.createDataFrame([("p1", "North"), ("p2", "South")], "province_sk string, name string")
    assert rows(summaries.with_lookup(summed, names, "province_sk")) == [("p1", 5, "North")]


def test_surviving_time_expressions(spark):
    df = spark.createDataFrame(
        [("1969-12-31 23:59:59.5", "1970-01-01 00:00:00")], "a string, b string"
    ).select(*[F.col(c).cast("timestamp_ntz").alias(c) for c in "ab"])
    assert df.select(ex.minute_boundaries("a", "b")).first()[0] == 1
    assert df.select(ex.minute_no("a")).first()[0] == -1
