from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from strandline.sources import delimited, jdbc
from strandline.sources.parquet import append_evolving, read_hive, write_hive
from strandline.sources.runlog import RunLog
from strandline.sources.tables import write_table
from strandline.sources.versions import FileTable, VersionedTable
from tests.conftest import plan_of, rows


def write_delivery(path, header: list[str], lines: list[list[str]]):
    """One delivery: tabs, Latin-1, and a last column without a name."""
    path.parent.mkdir(parents=True, exist_ok=True)
    text = "".join("\t".join([*line, ""]) + "\n" for line in [header, *lines])
    path.write_bytes(text.encode("latin-1"))


@pytest.fixture
def raw(tmp_path):
    root = tmp_path / "raw"
    write_delivery(
        root / "year=2024/month=03/day=01/reg_20240301T120000_1.txt",
        ["PeOrgNr", "Namn", "PostOrt"],
        [["161020159248", "ÅÄÖ", "MALMÖ"], ["161020159271", "", "LUND"]],
    )
    write_delivery(
        root / "year=2024/month=03/day=02/reg_20240302T120000_1.txt",
        ["Namn", "PeOrgNr", "Extra"],
        [["NY", "161020159248", "more"]],
    )
    return root


def test_deliveries_are_united_by_name(spark, raw):
    df = delimited.read_deliveries(spark, str(raw))
    assert set(df.columns) == {
        "PeOrgNr", "Namn", "PostOrt", "Extra", "year", "month", "day", "source_file",
    }
    found = df.select("PeOrgNr", "Namn", "PostOrt", "Extra", "year", "month", "day")
    assert rows(found) == [
        ("161020159248", "NY", None, "more", 2024, 3, 2),
        ("161020159248", "ÅÄÖ", "MALMÖ", None, 2024, 3, 1),
        ("161020159271", None, "LUND", None, 2024, 3, 1),
    ]
    files = {r[0].rsplit("/", 1)[1] for r in df.select("source_file").collect()}
    assert files == {"reg_20240301T120000_1.txt", "reg_20240302T120000_1.txt"}


@pytest.fixture
def small_blocks(spark):
    """Files are cut at 1000 bytes, and the end of one is read before the start of another."""
    sizes = {
        "spark.sql.files.maxPartitionBytes": "1000", "spark.sql.files.openCostInBytes": "0",
        "spark.sql.files.minPartitionNum": "1",
    }
    before = {name: spark.conf.get(name, None) for name in sizes}
    for name, value in sizes.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_headers_behind_the_end_of_another_file_are_no_rows(spark, tmp_path, small_blocks):
    long = [[str(1000 + i), "n" * 20] for i in range(50)]
    short = [["s" * 20, str(i)] for i in range(10)]
    write_delivery(tmp_path / "raw/a_20240301.txt", ["PeOrgNr", "Namn"], long)
    write_delivery(tmp_path / "raw/b_20240301.txt", ["Namn", "PeOrgNr"], short)
    df = delimited.read_deliveries(spark, str(tmp_path / "raw"))
    assert df.rdd.getNumPartitions() > 1
    expected = [tuple(r) for r in long] + [tuple(r[::-1]) for r in short]
    assert rows(df.select("PeOrgNr", "Namn")) == sorted(expected)


def test_listing_does_not_read_the_files(spark, raw):
    files = delimited.list_files(spark, str(raw), "*.txt")
    assert rows(files.select("name")) == [
        ("reg_20240301T120000_1.txt",),
        ("reg_20240302T120000_1.txt",),
    ]
    scan = files._jdf.queryExecution().optimizedPlan().toString()
    assert "content" not in scan.split("Relation")[0]


def test_stage_types_and_names(spark, raw):
    df = delimited.read_deliveries(spark, str(raw))
    loaded = F.lit("2024-03-03 10:00:00").cast("timestamp_ntz")
    staged = delimited.stage(df, ["PeOrgNr", "Namn"], "run-1", loaded)
    assert staged.columns == [
        "peorgnr", "namn", "effective_date", "source_file", "last_updated_dt",
        "invocation_id",
    ]
    parts = delimited.with_day_parts(staged).select("peorgnr", "effective_date", "year", "month", "day")
    assert rows(parts)[0] == ("161020159248", date(2024, 3, 1), 2024, 3, 1)
    assert dict(parts.dtypes)["month"] == "int"


def test_impossible_days_have_no_date(spark):
    df = spark.createDataFrame(
        [(2024, 2, 30, "f"), (2024, 2, 29, "f")],
        "year int, month int, day int, source_file string",
    )
    staged = delimited.stage(df, [], "r")
    assert {r.effective_date for r in staged.collect()} == {None, date(2024, 2, 29)}


NAMES = {
    "reg_20240301T120000_1.txt": ("2024", "03", "01", True),
    "nodate.txt": (None, None, None, False),
    "x_169999999901.txt": (None, None, None, False),
    "a_20240230_20240228.txt": (None, None, None, False),
    "x20240229.txt": ("2024", "02", "29", True),
    "20230229.txt": (None, None, None, False),
    "00000101.txt": (None, None, None, False),
}


def test_layout_takes_the_first_date_only(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "name string")
    laid_out = delimited.with_layout(df)
    assert {r[0]: tuple(r)[1:] for r in laid_out.collect()} == NAMES
    assert rows(delimited.layout_totals(laid_out)) == [(2, 5)]


def test_landing_an_inbox(spark, tmp_path):
    inbox, raw_root = tmp_path / "inbox", str(tmp_path / "raw")
    header = ["PeOrgNr", "Namn"]
    write_delivery(inbox / "reg_20240301T120000_1.txt", header, [["1", "Å"], ["2", "b"]])
    write_delivery(inbox / "reg_20240301T130000_2.txt", header[::-1], [["c", "3"]])
    write_delivery(inbox / "nodate.txt", header, [["9", "x"]])
    for _ in range(2):  # a repeated run changes nothing
        files = delimited.land_deliveries(spark, str(inbox), raw_root)
        assert rows(delimited.layout_totals(files)) == [(2, 1)]
    assert (tmp_path / "raw/year=2024/month=03/day=01").is_dir()
    df = delimited.read_raw(spark, raw_root)
    assert rows(df.select("PeOrgNr", "Namn", "source_file")) == [
        ("1", "Å", "reg_20240301T120000_1.txt"),
        ("2", "b", "reg_20240301T120000_1.txt"),
        ("3", "c", "reg_20240301T130000_2.txt"),
    ]


def test_quotes_and_empty_files(spark, tmp_path):
    write_delivery(tmp_path / "q.txt", ["PeOrgNr", "Namn"], [["1", '"say ""hi"" now"']])
    (tmp_path / "empty.txt").write_bytes(b"")
    df = delimited.read_deliveries(spark, str(tmp_path))
    assert rows(df.select("PeOrgNr", "Namn")) == [("1", 'say "hi" now')]
    with pytest.raises(FileNotFoundError):
        delimited.read_deliveries(spark, str(tmp_path), "none*.txt")


def test_overwrite_all_or_only_touched_partitions(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 2023), (2, 2024)], "v int, year int")
    new = spark.createDataFrame([(3, 2024)], "v int, year int")
    write_hive(df, root, ["year"])
    write_hive(new, root, ["year"], "dynamic")
    assert rows(read_hive(spark, root)) == [(1, 2023), (3, 2024)]
    write_hive(new, root, ["year"])
    assert rows(read_hive(spark, root)) == [(3, 2024)]
    with pytest.raises(ValueError, match="overwrite"):
        write_hive(new, root, ["year"], "merge")


def test_columns_that_come_later(spark, tmp_path):
    root = str(tmp_path / "t")
    append_evolving(spark.createDataFrame([(1,)], "a int"), root)
    append_evolving(spark.createDataFrame([(2, "x")], "a int, b string"), root)
    assert rows(read_hive(spark, root, evolved=True).select("a", "b")) == [
        (1, None),
        (2, "x"),
    ]


def test_table_strategies(spark):
    a = spark.createDataFrame([(1, "a")], "n int, s string")
    b = spark.createDataFrame([("b", 2)], "s string, n int")
    with pytest.raises(Exception, match="strategies_t"):
        write_table(a, "strategies_t", "append")
    write_table(a, "strategies_t")
    write_table(b, "strategies_t", "append", by_name=True)
    assert rows(spark.table("strategies_t")) == [(1, "a"), (2, "b")]
    write_table(a, "strategies_t", "truncate")
    assert rows(spark.table("strategies_t")) == [(1, "a")]
    write_table(b, "strategies_t", "replace")
    assert spark.table("strategies_t").columns == ["s", "n"]
    spark.sql("DROP TABLE strategies_t")
    with pytest.raises(ValueError, match="unknown strategy 'upsert'"):
        write_table(a, "strategies_t", "upsert")
    assert not spark.catalog.tableExists("strategies_t")


def test_jdbc_strategies_become_writer_settings(monkeypatch, spark):
    """No database is started here: only the settings are looked at."""
    seen = []

    class Writer:
        def options(self, **options):
            seen.append(options)
            return self

        def jdbc(self, url, table, mode, properties):
            seen.append((url, table, mode, properties))

    class Frame:
        write = Writer()

    for strategy, mode, truncate in (
        ("replace", "overwrite", "false"),
        ("truncate", "overwrite", "true"),
        ("append", "append", "false"),
    ):
        seen.clear()
        jdbc.write_jdbc(Frame(), "jdbc:x", "t", strategy, {"user": "u"})
        assert seen[0]["truncate"] == truncate
        assert seen[1] == ("jdbc:x", "t", mode, {"user": "u"})
    with pytest.raises(ValueError, match="unknown strategy"):
        jdbc.write_jdbc(Frame(), "jdbc:x", "t", "merge")


def test_jdbc_reads_can_be_sliced():
    slices = jdbc.Slices("id", "1", "1000", 8)
    options = jdbc.read_options("jdbc:x", "t", {"user": "u"}, slices, 500)
    assert options == {
        "url": "jdbc:x", "dbtable": "t", "fetchsize": "500", "user": "u",
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "1000",
        "numPartitions": "8",
    }
    assert "numPartitions" not in jdbc.read_options("jdbc:x", "t", None, None, 1)


def test_versions_by_number_and_time(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "v"))
    one = spark.createDataFrame([(1,)], "v int")
    two = spark.createDataFrame([(1,), (2,)], "v int")
    with pytest.raises(LookupError):
        table.read_latest()
    assert table.write_load(one, 1, "a", datetime(2024, 1, 1))
    assert table.write_load(two, 2, "b", datetime(2024, 1, 3))
    assert not table.write_load(one, 2, "b", datetime(2024, 1, 3))
    assert rows(table.read_version(1)) == [(1,)]
    assert rows(table.read_latest()) == [(1,), (2,)]
    assert rows(table.read_as_of(datetime(2024, 1, 2))) == [(1,)]
    assert rows(table.read_as_of(datetime(2024, 1, 3))) == [(1,), (2,)]
    assert table.load_of("b") == 2 and table.load_of("c") is None
    for missing in (lambda: table.read_version(3), lambda: table.read_as_of(datetime(2023, 1, 1))):
        with pytest.raises(LookupError):
            missing()


def test_loads_may_differ_in_columns_or_be_empty(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "v"), partition_by=("p",))
    none = spark.createDataFrame([], "v int, p string")
    more = spark.createDataFrame([(2, "x", "new")], "v int, p string, extra string")
    table.write_load(none, 1, "a", datetime(2024, 1, 1))
    assert table.read_latest().isEmpty()
    table.write_load(none.union(spark.createDataFrame([(1, "x")], none.schema)), 2, "b", datetime(2024, 1, 2))
    table.write_load(more, 3, "c", datetime(2024, 1, 3))
    found = table.all_loads().select("load_id", "v", "p", "extra")
    assert rows(found) == [(2, 1, "x", None), (3, 2, "x", "new")]
    assert rows(table.loads().select("load_id", "token")) == [(1, "a"), (2, "b"), (3, "c")]


def test_run_log_counts_rows_as_they_pass(spark, tmp_path):
    log = RunLog(spark, str(tmp_path / "runs"), "run-1")
    out = str(tmp_path / "out")
    df = spark.range(7)
    assert log.write("load", df, lambda d: d.write.parquet(out)) == 7
    with pytest.raises(Exception):
        log.write("again", df, lambda d: d.write.parquet(out))
    log.add("check", "warn", 2, 0.5)
    assert rows(log.lines().select("run_id", "step", "status", "rows")) == [
        ("run-1", "again", "error", None),
        ("run-1", "check", "warn", 2),
        ("run-1", "load", "success", 7),
    ]


def test_raw_only_grows(spark, tmp_path):
    raw_root, header = str(tmp_path / "raw"), ["PeOrgNr", "Namn"]
    for turn, (name, key) in enumerate(
        [("a_20240301_1.txt", "1"), ("b_20240301_2.txt", "2"), ("a_20240301_1.txt", "1")]
    ):
        inbox = tmp_path / f"inbox{turn}"
        write_delivery(inbox / name, header, [[key, "x"]])
        delimited.land_deliveries(spark, str(inbox), raw_root)
    df = delimited.read_raw(spark, raw_root)
    assert rows(df.select("PeOrgNr", "source_file")) == [
        ("1", "a_20240301_1.txt"), ("2", "b_20240301_2.txt"),
    ]


def test_what_comes_again_replaces_all_it_brought(spark, tmp_path):
    raw_root, header = str(tmp_path / "raw"), "PeOrgNr\tNamn\n"
    bodies = [
        {"a": "1\tx\n2\tbad\tmore\n", "b": "3\ty\n", "c": "4\tz\n"},
        {"a": "1\tx\n2\tgood\n", "b": "", "c": "4\n5\n"},
        {"c": "4\n5\n"},
    ]
    for turn, files in enumerate(bodies):
        inbox = tmp_path / f"inbox{turn}"
        inbox.mkdir()
        for name, body in files.items():
            (inbox / f"{name}_20240301.txt").write_text(header + body)
        delimited.land_deliveries(spark, str(inbox), raw_root)
    df = delimited.read_raw(spark, raw_root)
    assert rows(df.select("PeOrgNr", "Namn")) == [("1", "x"), ("2", "good")]
    assert rows(delimited.quarantined(spark, raw_root)) == [
        ("c_20240301.txt", "4"), ("c_20240301.txt", "5"),
    ]
    # What came as it was before is in the manifest once; so is an empty file.
    loads = delimited.manifest(spark, raw_root).groupBy("source_file").count()
    assert rows(loads) == [(f"{n}_20240301.txt", 2) for n in "abc"]
    empty = tmp_path / "inbox9"
    empty.mkdir()
    (empty / "a_20240301.txt").write_text("")
    delimited.land_deliveries(spark, str(empty), raw_root)
    assert delimited.newest_loads(spark, raw_root).count() == 3
    assert delimited.quarantined(spark, raw_root).count() == 2
    with pytest.raises(FileNotFoundError):
        delimited.read_raw(spark, raw_root)


def test_headers_meet_lines_without_a_shuffle_of_lines(spark, tmp_path, monkeypatch):
    write_delivery(tmp_path / "a_20240301.txt", ["PeOrgNr"], [["1"], ["2"]])
    write_delivery(tmp_path / "b_20240301.txt", ["Namn", "PeOrgNr"], [["x", "3"]])
    few = delimited.read_deliveries(spark, str(tmp_path))
    assert "BroadcastHashJoin" in plan_of(few) and "SortMergeJoin" not in plan_of(few)
    monkeypatch.setattr(delimited, "BROADCAST_FILES", 1)
    many = delimited.read_deliveries(spark, str(tmp_path))
    assert rows(many) == rows(few) and few.count() == 3


def test_rows_of_a_file_are_not_sorted_before_they_are_written(spark, tmp_path):
    """A sort by folder holds all rows of a task, more the larger a file is."""
    keys = spark.range(1000).select(
        F.lit("2024").alias("year"), F.concat(F.lit("f"), F.col("id") % 2).alias("source_file"),
        F.col("id").cast("string").alias("PeOrgNr"),
    )
    at_once = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(at_once)
    delimited.write_deliveries(keys, str(tmp_path / "raw"))
    assert spark.conf.get(at_once) == before
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    done = spark._jsparkSession.sharedState().statusStore().executionsList().last()
    plan = done.physicalPlanDescription()
    assert "WriteFiles" in plan and "Sort" not in plan
    found = delimited.read_deliveries(spark, str(tmp_path / "raw"), "*.csv")
    assert rows(found.select("source_file", "PeOrgNr")) == rows(keys.select("source_file", "PeOrgNr"))


RAGGED = 'PeOrgNr\tNamn\n1\tok\n2\ttoo\tmany\n3\n4\t"over\ntwo lines"\n5\t"quoted\tfield"\n\n6\t\n'


def test_malformed_lines_go_to_quarantine(spark, tmp_path):
    inbox, raw_root = tmp_path / "in", str(tmp_path / "raw")
    inbox.mkdir()
    (inbox / "r_20240301.txt").write_bytes(RAGGED.encode("latin-1"))
    write_delivery(inbox / "s_20240301.txt", ["PeOrgNr", "Namn"], [["7", "fine"]])
    delimited.land_deliveries(spark, str(inbox), raw_root)
    df = delimited.read_raw(spark, raw_root)
    assert rows(df.select("PeOrgNr", "Namn")) == [
        ("1", "ok"), ("5", "quoted\tfield"), ("6", None), ("7", "fine"),
    ]
    bad = delimited.quarantined(spark, raw_root)
    assert rows(bad.select("line")) == [
        ("2\ttoo\tmany",), ("3",), ('4\t"over',), ('two lines"',),
    ]
    assert rows(delimited.quarantine_counts(bad)) == [("r_20240301.txt", 4)]


def test_malformed_lines_stop_a_plain_read(spark, tmp_path):
    (tmp_path / "r.txt").write_bytes(RAGGED.encode("latin-1"))
    df = delimited.read_deliveries(spark, str(tmp_path))
    with pytest.raises(Exception, match="malformed line"):
        df.select("PeOrgNr").collect()
    kept = delimited.read_deliveries(spark, str(tmp_path), malformed=delimited.KEEP)
    assert kept.filter("_malformed IS NOT NULL").count() == 4


def test_headers_of_any_length_and_several_blocks(spark, tmp_path):
    names = [f"column{i}" for i in range(30_000)]
    for at in range(3):
        write_delivery(tmp_path / f"f{at}.txt", names, [[str(at)] * len(names)] * 2)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 100_000)
    try:
        (layout,) = delimited.header_layouts(spark, str(tmp_path))
        assert layout.files == 3 and layout.columns[:-1] == tuple(names)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_file_table_adds_what_changed(spark, tmp_path):
    table = FileTable(spark, str(tmp_path / "files"))
    contents = {}

    def take(token, day, **files):
        contents.update(files)
        states = [(name, str(hash(tuple(lines)))) for name, lines in contents.items()]
        listed = spark.createDataFrame(states, "source_file string, file_state string")

        def rows_of(fresh):
            names = {r[0] for r in fresh.collect()}
            data = [(n, v) for n, lines in contents.items() if n in names for v in lines]
            return spark.createDataFrame(data, "source_file string, v int")

        return table.take(listed, rows_of, token, datetime(2024, 1, day))

    assert table.latest_load() is None
    assert take("one", 1, a=[1, 1], b=[2]) == 1
    assert take("two", 2, a=[3], c=[]) == 2
    assert take("three", 3, b=[]) == 3
    assert take("three", 4, b=[9]) == 3
    assert rows(table.read_version(1)) == [("a", 1), ("a", 1), ("b", 2)]
    assert rows(table.read_as_of(datetime(2024, 1, 2))) == [("a", 3), ("b", 2)]
    assert rows(table.read_latest()) == [("a", 3)]
    assert [table.rows.rows_of(n) for n in (1, 2, 3)] == [3, 1, 0]
    # Rows without a list, as after a failure, are not seen, nor taken for later ones.
    orphan = spark.createDataFrame([("b", 7)], "source_file string, v int")
    table.rows.write_load(orphan, 4, "cut short", datetime(2024, 1, 4), whole=False)
    assert take("five", 5, b=[7]) == 5
    assert rows(table.read_latest()) == [("a", 3), ("b", 7)]


def test_expired_loads(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    for n in range(1, 6):
        table.write_load(spark.range(n), n, str(n), datetime(2024, 1, n), whole=n != 5)
    assert table.expire(9) == []
    assert table.expire(1) == [1, 2, 3]
    assert table.read_version(4).count() == 4
    assert table.all_loads().count() == 9
    with pytest.raises(LookupError):
        table.read_version(3)
