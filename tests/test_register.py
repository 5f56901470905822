from __future__ import annotations

import random
import shutil
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from strandline import __main__ as command_line
from strandline.operators import dedup, diff, quality, scd2
from strandline.plans import register
from strandline.plans.register import BUSINESS, COLUMNS, KEY, Layers
from strandline.sources.delimited import read_deliveries
from strandline.sources.parquet import read_hive
from strandline.streaming import windows as stream_windows
from strandline.streaming.ingest import DeliveryIngest
from tests.conftest import rows
from tests.test_sources import write_delivery

HEADER = [c.capitalize() for c in BUSINESS] + [f"m{c}" for c in BUSINESS]


def line(key: str, **values: str) -> list[str]:
    have = {KEY: key, "foretagsnamn": "Firma", "postort": "MALMÖ", **values}
    return [have.get(c, "") for c in BUSINESS] + ["1"] * len(BUSINESS)


@pytest.fixture(scope="module")
def flow(spark, tmp_path_factory):
    """Two runs of the whole flow over growing deliveries."""
    root = tmp_path_factory.mktemp("register")
    inbox = root / "inbox"
    layers = Layers(spark, str(root / "lake"))
    write_delivery(
        inbox / "reg_20240301T120000_1.txt",
        HEADER,
        [
            line("1", postort="MALMÖ"),
            line("2"),
            line("2"),
            line("3", gatuadress="GAMLA VÄGEN 7"),
            line("3", gatuadress="NYA VÄGEN 99"),
            line("4"),
        ],
    )
    write_delivery(inbox / "nodate.txt", HEADER, [line("9")])
    first = register.run(layers, str(inbox), "run-1", datetime(2024, 3, 1))
    write_delivery(
        inbox / "reg_20240308T120000_1.txt",
        list(reversed(HEADER)),
        [
            list(reversed(line("1", postort="LUND"))),
            list(reversed(line("2"))),
            list(reversed(line("5"))),
        ],
    )
    second = register.run(layers, str(inbox), "run-2", datetime(2024, 3, 8))
    return layers, first, second


def test_outcomes_warn_about_repeated_keys(flow):
    _, first, second = flow
    expected = [
        ("not_null_peorgnr", "pass"),
        ("unique_peorgnr", "warn"),
        ("not_null_effective_date", "pass"),
        ("dedup_reconciliation", "pass"),
    ]
    assert [(o.name, o.status) for o in first] == expected
    assert [(o.name, o.status) for o in second] == expected
    assert second[1].failures == 3


def test_layers_hold_what_they_should(spark, flow):
    layers, _, _ = flow
    stored = read_hive(spark, layers.path("bronze"))
    assert stored.columns == [*COLUMNS, "year", "month", "day"]
    landing, lost = layers.landing(), layers.rejects()
    assert landing.columns == list(COLUMNS)
    assert lost.columns == [*COLUMNS, dedup.RANK]
    assert rows(landing.select(KEY, "postort", "gatuadress", "effective_date")) == [
        ("1", "LUND", None, date(2024, 3, 8)),
        ("2", "MALMÖ", None, date(2024, 3, 8)),
        ("3", "MALMÖ", "NYA VÄGEN 99", date(2024, 3, 1)),
        ("4", "MALMÖ", None, date(2024, 3, 1)),
        ("5", "MALMÖ", None, date(2024, 3, 8)),
    ]
    assert rows(lost.select(KEY, dedup.RANK)) == [("1", 2), ("2", 2), ("2", 3), ("3", 2)]
    together = landing.union(lost.drop(dedup.RANK))
    assert diff.surplus_rows(together, layers.bronze()).isEmpty()


@pytest.mark.parametrize("path", [register.PARQUET, register.LAKE])
def test_history(flow, path):
    layers, _, _ = flow
    history = layers.history(path)
    seen = history.history().select(KEY, "postort", "effective_date", scd2.FROM, scd2.TO)
    one, two = datetime(2024, 3, 1), datetime(2024, 3, 8)
    assert rows(seen) == [
        ("1", "LUND", date(2024, 3, 8), two, None),
        ("1", "MALMÖ", date(2024, 3, 1), one, two),
        ("2", "MALMÖ", date(2024, 3, 1), one, None),
        ("3", "MALMÖ", date(2024, 3, 1), one, None),
        ("4", "MALMÖ", date(2024, 3, 1), one, None),
        ("5", "MALMÖ", date(2024, 3, 8), two, None),
    ]
    assert history.history(1).count() == 4


def test_bronze_can_be_read_as_of_a_time(flow):
    layers, _, _ = flow
    assert layers.bronze_lake.read_as_of(datetime(2024, 3, 5)).count() == 6
    assert layers.bronze_lake.read_latest().count() == 9


def test_a_run_that_stops_publishes_nothing(flow, spark, tmp_path, monkeypatch):
    """Rejects that get lost are found before readers see the landing."""
    copy = str(tmp_path / "stopped")
    shutil.copytree(flow[0].root, copy)
    layers = Layers(spark, copy)
    before = rows(layers.landing()), rows(layers.rejects())
    inbox = tmp_path / "in"
    write_delivery(inbox / "reg_20240315T120000_1.txt", HEADER, [line("6"), line("6")])
    lost = dedup.rejects
    monkeypatch.setattr(dedup, "rejects", lambda *a: lost(*a).limit(2))
    outcomes = register.run(layers, str(inbox), "run-3", datetime(2024, 3, 15))
    assert outcomes[-1].status == quality.FAILED
    assert (rows(layers.landing()), rows(layers.rejects())) == before

    def fails(*a):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(dedup, "rejects", fails)
    with pytest.raises(RuntimeError):
        register.run(layers, str(inbox), "run-4", datetime(2024, 3, 16))
    assert rows(layers.landing()) == before[0]
    monkeypatch.setattr(dedup, "rejects", lost)
    register.run(layers, str(inbox), "run-5", datetime(2024, 3, 17))
    assert layers.landing().count() == 6 and layers.rejects().count() == 5
    assert register.integrity(layers).isEmpty()
    kept = [load.number for load in layers.loads("rejects").finished()]
    assert kept[-1] == layers.published() and len(kept) == register.KEPT


def test_reports(flow):
    layers, _, _ = flow
    assert rows(register.summary(layers)) == [
        ("bronze lake", 9),
        ("bronze parquet", 9),
        ("landing (from lake)", 5),
        ("landing (from parquet)", 5),
        ("raw", 9),
        ("rejects", 4),
        ("scd2 (lake path) current only", 5),
        ("scd2 (lake path) total", 6),
        ("scd2 (parquet path) current only", 5),
        ("scd2 (parquet path) total", 6),
    ]
    found = register.lineage(layers)
    assert {r[KEY] for r in found.collect()} == {"1"}
    assert found.count() == 2 + 2 + 2 + 1 + 1 + 1 + 2 + 2
    assert register.lineage(layers, "5").count() == 7
    assert register.integrity(layers).isEmpty()
    assert rows(register.compare_landings(layers)) == [(True, True, 5, 100.0)]
    assert rows(register.compare_histories(layers)) == [(True, True, 6, 100.0)]


def test_runs_are_logged_and_failures_kept(spark, flow):
    layers, _, _ = flow
    lines = layers.log("").lines()
    counted = lines.filter("run_id = 'run-2'").select("step", "status", "rows")
    assert set(rows(counted)) >= {
        ("bronze-parquet", "success", 9),
        ("bronze-lake", "success", 3),
        ("landing-parquet", "success", 5),
        ("landing-lake", "success", 5),
        ("rejects", "success", 4),
        ("unique_peorgnr", "warn", 3),
        ("dedup_reconciliation", "pass", 0),
    }
    kept = quality.stored(layers.bronze(), register.BRONZE_RULES, layers.path("audit"), "unique_peorgnr")
    assert rows(kept) == [("1", 2), ("2", 3), ("3", 2)]


def test_unknown_keys_stop_the_run(spark, tmp_path):
    write_delivery(tmp_path / "in/reg_20240301T120000_1.txt", HEADER, [line("")])
    layers = Layers(spark, str(tmp_path / "lake"))
    outcomes = register.run(layers, str(tmp_path / "in"), "r", datetime(2024, 3, 1))
    assert outcomes[0] == quality.Outcome("not_null_peorgnr", quality.FAILED, 1)
    assert not (tmp_path / "lake/landing-parquet").exists()


def test_pseudonyms_in_deliveries(spark, tmp_path):
    source, target = tmp_path / "raw", str(tmp_path / "masked")
    day = source / "year=2024/month=03/day=01"
    open_rows = [line("169999999901", namn="Eva"), line("169999999902")]
    write_delivery(day / "open_20240301.txt", HEADER, open_rows)
    done_rows = [line("169999999903", foretagsnamn="DEMO AB 9999")]
    write_delivery(day / "done_20240301.txt", HEADER, done_rows)
    glob = "*.txt"
    dry = register.pseudonymise_deliveries(spark, str(source), target, glob, dry_run=True)
    counts = dry.select("rows_seen", "rows_rewritten", "already_anonymised")
    assert rows(counts) == [(1, 0, True), (2, 2, False)]
    assert not (tmp_path / "masked").exists()
    register.pseudonymise_deliveries(spark, str(source), target, glob)
    masked = read_deliveries(spark, target, "*.csv")
    assert rows(masked.select("Peorgnr", "Foretagsnamn", "Postort")) == [
        ("169999999901", "DEMO AB 2649", "MALMÖ"),
        ("169999999902", "DEMO AB 2193", "MALMÖ"),
        ("169999999903", "DEMO AB 9999", "MALMÖ"),
    ]


def test_pseudonyms_per_file(spark, tmp_path):
    """Flat folder; one file lacks name columns, one is done, one is open."""
    source, target = tmp_path / "flat", str(tmp_path / "masked")
    write_delivery(source / "open.txt", HEADER, [line("169999999901", namn="Eva")])
    write_delivery(source / "done.txt", HEADER, [line("169999999903", foretagsnamn="DEMO AB 9999")])
    write_delivery(source / "other.txt", ["Peorgnr", "Foretagsnamn"], [["5", "Firma"]])
    report = register.pseudonymise_deliveries(spark, str(source), target, "*.txt")
    assert rows(report) == [
        ("done.txt", 1, 0, True, ""),
        ("open.txt", 1, 1, False, ""),
        ("other.txt", 1, 0, False, "namn, coadress"),
    ]
    masked = read_deliveries(spark, target, "*.csv")
    assert rows(masked.select("source_file", "Foretagsnamn", "Namn")) == [
        ("done.txt", "DEMO AB 9999", None),
        ("open.txt", "DEMO AB 2649", masked.filter("source_file = 'open.txt'").first()["Namn"]),
        ("other.txt", "Firma", None),
    ]
    with pytest.raises(ValueError, match="same folder"):
        register.pseudonymise_deliveries(spark, target, target, "*.csv")


def test_command_line(flow, spark, tmp_path, capsys, monkeypatch):
    layers, _, _ = flow
    monkeypatch.setattr(command_line, "build_session", lambda: spark)
    assert command_line.main(["verify", "--root", layers.root]) == 0
    shown = capsys.readouterr().out
    assert "scd2 (lake path) total" in shown and "no issues detected" in shown
    assert command_line.main(["verify", "--root", layers.root, "--key", "5"]) == 0
    assert "landing (from lake)" in capsys.readouterr().out
    assert command_line.main(["verify", "--root", str(tmp_path)]) == 2
    broken = layers.landing().limit(3)
    copy = str(tmp_path / "broken")
    shutil.copytree(layers.root, copy)
    number = layers.published()
    broken.write.mode("overwrite").parquet(f"{copy}/landing-parquet/data/load_id={number}")
    assert command_line.main(["verify", "--root", copy, "--integrity"]) == 1
    assert "of 9 bronze rows, 3 won and 4 were rejected" in capsys.readouterr().out


# --- streams ---------------------------------------------------------------

DELIVERY = "k string, d date, v string, n int"


def make_ingest(spark, root, whole_every=10):
    ties = ("n",)
    return DeliveryIngest(spark, str(root), ("k",), "d", ("v",), ties, whole_every)


@pytest.mark.parametrize("whole_every", [2, 10])
def test_stream_of_batches_equals_a_rebuild(spark, tmp_path, whole_every):
    rng = random.Random(7)
    data = [
        (f"k{rng.randrange(5)}", date(2024, 1, rng.randrange(1, 6)), rng.choice("abc"), n)
        for n in range(60)
    ]
    data.sort(key=lambda r: r[1])
    inbox = tmp_path / "inbox"
    register_ = make_ingest(spark, tmp_path / "store", whole_every)
    stream_schema = spark.createDataFrame([], DELIVERY).schema
    for day in sorted({r[1] for r in data}):
        part = [r for r in data if r[1] == day]
        spark.createDataFrame(part, DELIVERY).write.mode("append").parquet(str(inbox))
        stream = spark.readStream.schema(stream_schema).parquet(str(inbox))
        register_.start(stream).awaitTermination()
    bronze = spark.createDataFrame(data, DELIVERY)
    expected = scd2.history_from_deliveries(bronze, ["k"], "d", ["v"], ["n"])
    found = register_.history.history()
    assert rows(found.select(expected.columns)) == rows(expected)
    newest = dedup.latest_per_key(bronze, ["k"], ["d", "n"])
    assert rows(register_.landing()) == rows(newest)
    stored = register_.bronze.all_loads().drop("load_id")
    assert Counter(tuple(r) for r in stored.collect()) == Counter(data)


def test_late_and_repeated_batches(spark, tmp_path):
    store = make_ingest(spark, tmp_path)

    def batch(*data):
        return spark.createDataFrame(list(data), DELIVERY)

    store.apply_batch(batch(("x", date(2024, 1, 3), "new", 1)), 0)
    before = rows(store.history.history())
    store.apply_batch(batch(("x", date(2024, 1, 2), "late", 2)), 1)
    assert rows(store.history.history()) == before
    assert rows(store.landing()) == [("x", date(2024, 1, 3), "new", 1)]
    late = store.late_counts()
    assert rows(late) == [(2, "x", date(2024, 1, 2), 1)]
    assert rows(store.account()) == [(1, 1, 1, 0, 0), (2, 1, 0, 1, 0)]
    store.apply_batch(batch(("x", date(2024, 1, 4), "newer", 3)), 2)
    after = rows(store.history.history())
    store.apply_batch(batch(("x", date(2024, 1, 4), "newer", 3)), 2)
    assert rows(store.history.history()) == after and len(after) == 2


def test_text_deliveries_as_a_stream(spark, tmp_path):
    store, inbox = make_ingest(spark, tmp_path / "store"), tmp_path / "inbox"
    inbox.mkdir()

    def to_rows(found):
        return found.select("k", F.col("d").cast("date").alias("d"), "v", F.col("n").cast("int").alias("n"))

    bodies = ["k\td\tv\tn\nx\t2024-01-01\ta\t1\n", "n\tk\td\n2\tx\t2024-01-02\nbad\n", ""]
    for turn, body in enumerate(bodies):
        (inbox / f"f{turn}.txt").write_text(body)
        store.start_text(str(inbox), ["k", "d", "v", "n"], to_rows).awaitTermination()
    assert rows(store.landing()) == [("x", date(2024, 1, 2), None, 2)]
    assert store.history.history().count() == 2
    assert rows(store.malformed.all_loads().select("source_file", "line"))[0][1] == "bad"


def test_a_failure_between_landing_and_history_is_made_good(spark, tmp_path):
    store = make_ingest(spark, tmp_path)
    data = spark.createDataFrame([("x", date(2024, 1, 3), "v", 1)], DELIVERY)
    store.bronze.write_load(data, 1, "batch-0", datetime(1970, 1, 1))
    store.landing_log.write_load(data, 1, "batch-0", datetime(2024, 1, 3))
    store.apply_batch(data, 0)
    assert store.history.history().count() == 1
    assert store.landing_log.latest_load() == 1


def test_append_mode_writes_windows_the_watermark_has_passed(spark, tmp_path):
    folder = tmp_path / "in"
    times = ["10:00:00", "10:04:00", "10:20:00", "11:30:00"]
    df = spark.createDataFrame([(f"2024-01-01 {t}",) for t in times], "ts string")
    df.select(F.col("ts").cast("timestamp_ntz")).coalesce(1).write.parquet(str(folder))
    stream = stream_windows.file_stream(spark, str(folder), "*.parquet")
    counts = stream_windows.tumbling_counts(stream, "ts", "15 minutes")
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    stream_windows.append_to(counts, out, state).awaitTermination()
    assert rows(spark.read.parquet(out)) == [
        (datetime(2024, 1, 1, 10, 0), datetime(2024, 1, 1, 10, 15), 2),
        (datetime(2024, 1, 1, 10, 15), datetime(2024, 1, 1, 10, 30), 1),
    ]


def test_stream_sessions_keep_a_gap_of_exactly_the_limit(spark, tmp_path):
    folder = str(tmp_path / "in")
    times = ["23:55:00", "23:59:59"]
    data = [(1, f"2024-01-01 {t}") for t in times] + [(1, "2024-01-02 00:09:59")]
    df = spark.createDataFrame(data, "u bigint, ts string")
    df.withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(folder)
    stream = stream_windows.file_stream(spark, folder, "*.parquet")
    counts = stream_windows.session_counts(stream, "ts", "u")
    found = stream_windows.run_to_end(counts, str(tmp_path / "run"))
    assert rows(found.select("number_of_services")) == [(3,)]
