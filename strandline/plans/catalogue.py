"""The operators applied to the benchmark tables, one query per operator.

``orders`` stands for the register (customer = business key, order date =
delivery date, order key = tie-break), ``events`` for deliveries with many
copies per key and day and for the time series, ``lineitem`` for
entity-attribute-value rows and ``customer`` for names.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions.expressions import surrogate_key
from strandline.operators import (
    dedup,
    diff,
    keys,
    pivot,
    privacy,
    quality,
    scd2,
    summaries,
    windows,
)
from strandline.plans import register, verify
from strandline.plans.history import HistoryStore
from strandline.session import scratch_path
from strandline.sources.delimited import (
    DAY_PARTS,
    LAYOUT,
    SOURCE_FILE,
    header_layouts,
    land_deliveries,
    layout_totals,
    quarantine_counts,
    quarantined,
    read_deliveries,
    read_raw,
    stage,
    with_day_parts,
    with_layout,
)
from strandline.sources.parquet import append_evolving, read_hive, write_hive
from strandline.sources.runlog import RunLog
from strandline.sources.tables import APPEND, REPLACE, TRUNCATE, write_table
from strandline.sources.versions import FILE, FILE_STATE, LOAD, FileTable, VersionedTable
from strandline.streaming import ingest
from strandline.streaming import windows as stream_windows

Query = Callable[[SparkSession, str], DataFrame]

YEAR = 2024
YEAR_START, YEAR_END = datetime(2024, 1, 1), datetime(2025, 1, 1)
SESSION_DAY = "2024-01-15"
AS_OF = datetime(2024, 1, 15, 12)
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
FIRST_CUT, SECOND_CUT = datetime(1999, 1, 1), datetime(2002, 1, 1)

ORDER_CHECK = ("o_orderstatus", "o_orderpriority")
EVENT_CHECK = ("event_type", "band")
NEWEST_ORDER = ("o_orderdate", "o_orderkey")
NEWEST_EVENT = ("effective_date", "event_id")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- shared inputs ---------------------------------------------------------


def order_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_custkey",
        "o_orderkey",
        "o_orderdate",
        "o_orderstatus",
        "o_orderpriority",
    )


def event_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as deliveries; ``band`` is an attribute that is often unknown."""
    band = F.when(F.col("value") >= 20, F.floor(F.col("value") / 50).cast("bigint"))
    return table(spark, sf_dir, "events").select(
        "user_id",
        "event_id",
        F.to_date("ts").alias("effective_date"),
        "event_type",
        band.alias("band"),
    )


def order_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.history_from_deliveries(
        order_deliveries(spark, sf_dir),
        ["o_custkey"],
        "o_orderdate",
        ORDER_CHECK,
        ["o_orderkey"],
    )


def event_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.history_from_deliveries(
        event_deliveries(spark, sf_dir),
        ["user_id"],
        "effective_date",
        EVENT_CHECK,
        ["event_id"],
    )


def order_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.latest_per_key(
        order_deliveries(spark, sf_dir), ["o_custkey"], NEWEST_ORDER
    )


def order_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.rejects(
        order_deliveries(spark, sf_dir), ["o_custkey"], NEWEST_ORDER
    )


# --- staging and duplicates ------------------------------------------------


def stage_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("User_Id"),
        F.col("event_type").alias("Event_Type"),
        F.col("event_id").alias("Event_Id"),
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        F.dayofmonth("ts").alias("day"),
        F.concat(F.lit("events/"), F.col("event_type")).alias("source_file"),
    )
    loaded = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    return with_day_parts(
        stage(raw, ["User_Id", "Event_Type", "Event_Id"], "run-1", loaded)
    )


def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_landing(spark, sf_dir)


def dedup_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_rejects(spark, sf_dir)


def dedup_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze against winners and rejects that were made apart from it, as bags."""
    return dedup.reconcile_bags(
        order_deliveries(spark, sf_dir),
        order_landing(spark, sf_dir),
        order_rejects(spark, sf_dir),
    )


def dup_cross_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.deliveries_per_key(
        event_deliveries(spark, sf_dir), "user_id", "effective_date"
    )


def dup_intra_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.copies_in_delivery(
        event_deliveries(spark, sf_dir), ["user_id", "effective_date", "event_type"]
    )


def dup_losing_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.losing_copies(
        event_deliveries(spark, sf_dir), "user_id", "effective_date", ["event_type"]
    ).orderBy(F.col("losing_copies").desc(), "user_id", "effective_date", "event_type")


# --- history ---------------------------------------------------------------


def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_history(spark, sf_dir)


def scd2_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.current_versions(event_history(spark, sf_dir))


def scd2_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.versions_as_of(event_history(spark, sf_dir), AS_OF)


def scd2_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = [
        scd2.totals(history).select(F.lit(src).alias("src"), "n", "current_n")
        for src, history in (
            ("orders", order_history(spark, sf_dir)),
            ("events", event_history(spark, sf_dir)),
        )
    ]
    return both[0].union(both[1])


def scd2_point_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with what was known about its customer that day."""
    facts = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("customer"), "o_orderdate"
    )
    history = order_history(spark, sf_dir).drop("o_orderkey", "o_orderdate")
    return scd2.point_in_time(
        facts, history, "customer", "o_custkey", "o_orderdate", list(ORDER_CHECK)
    )


def scd2_interval_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intervals taken from all orders as if they were one history."""
    spans = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.col("l_shipdate").alias(scd2.FROM),
        F.when(
            F.col("l_linestatus") == "F",
            (F.col("l_shipdate") + F.expr("make_dt_interval(cast(l_quantity as int))")),
        ).alias(scd2.TO),
    )
    return scd2.interval_problems(spans, "l_orderkey")


def _two_landings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Newest order per customer before a cut, and among those after it."""
    bronze = order_deliveries(spark, sf_dir)
    cut = F.lit(FIRST_CUT.strftime("%Y-%m-%d")).cast("timestamp_ntz")
    old, new = (
        bronze.filter(F.col("o_orderdate") < cut),
        bronze.filter(F.col("o_orderdate") >= cut),
    )
    return tuple(
        dedup.latest_per_key(part, ["o_custkey"], NEWEST_ORDER) for part in (old, new)
    )


def _merged(spark: SparkSession, sf_dir: str, close_missing: bool) -> DataFrame:
    first, second = _two_landings(spark, sf_dir)
    opened = scd2.first_snapshot(first, ["o_custkey"], FIRST_CUT).drop(scd2.CHANGE)
    return scd2.merge_snapshot(
        opened, second, ["o_custkey"], ORDER_CHECK, SECOND_CUT, close_missing
    ).withColumnRenamed(scd2.CHANGE, "change")


def scd2_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir, close_missing=False)


def scd2_merge_close_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir, close_missing=True)


def scd2_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge published load by load, and read back."""
    first, second = _two_landings(spark, sf_dir)
    store = HistoryStore(
        spark, scratch_path(spark, "history"), ("o_custkey",), ORDER_CHECK
    )
    store.apply(first, FIRST_CUT, "first")
    store.apply(second, SECOND_CUT, "second")
    store.apply(second, SECOND_CUT, "second")
    return store.history()


# --- time windows ----------------------------------------------------------


def tumbling_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.hourly_counts(table(spark, sf_dir, "events"), "ts", YEAR)


def tumbling_quarter_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.time_of_day_profile(table(spark, sf_dir, "events"), "ts", YEAR)


def tumbling_offset_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.time_of_day_profile(
        table(spark, sf_dir, "events"), "ts", YEAR, 30, 25, 5
    )


def hopping_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.hopping_counts(
        table(spark, sf_dir, "events"), "ts", "user_id", YEAR_START, YEAR_END
    )


def hopping_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.window_starts(table(spark, sf_dir, "events"), "ts")


def hopping_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.busiest(
        hopping_all(spark, sf_dir), "number_of_services", "window_start"
    )


def sliding_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.sliding_counts(table(spark, sf_dir, "events"), "ts", "user_id")


def sliding_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.sliding_top(table(spark, sf_dir, "events"), "ts", "user_id")


def session_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.daily_sessions(table(spark, sf_dir, "events"), "ts", "user_id")


def session_top_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.days_with_most_sessions(session_windows(spark, sf_dir))


def session_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.sessions_of_day(session_windows(spark, sf_dir), SESSION_DAY)


def session_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.distinct_gaps(session_windows(spark, sf_dir))


# --- reports and checks ----------------------------------------------------


def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.layer_counts(
        [
            verify.whole_layer(table(spark, sf_dir, "orders"), "raw"),
            verify.whole_layer(order_deliveries(spark, sf_dir), "bronze"),
            verify.whole_layer(order_landing(spark, sf_dir), "landing"),
            verify.counted_rejects(
                order_deliveries(spark, sf_dir), ["o_custkey"], "rejects"
            ),
            verify.counted_history(order_history(spark, sf_dir), "scd2"),
        ]
    )


def entity_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = order_history(spark, sf_dir)
    key = verify.interesting_key(history, "o_custkey")
    # The layers are made from the rows of this key alone.
    bronze = order_deliveries(spark, sf_dir)
    mine = bronze.filter(F.col("o_custkey").eqNullSafe(F.lit(key)))
    return verify.entity_lineage(
        [
            verify.plain_layer(mine, "bronze"),
            verify.plain_layer(
                dedup.latest_per_key(mine, ["o_custkey"], NEWEST_ORDER), "landing"
            ),
            verify.rejects_layer(dedup.rejects(mine, ["o_custkey"], NEWEST_ORDER)),
            verify.history_layer(history, "scd2"),
        ],
        "o_custkey",
        "o_orderstatus",
        "o_orderdate",
        key,
    )


def integrity_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing and a history that are broken: one row per delivery, all open."""
    bronze = event_deliveries(spark, sf_dir)
    per_delivery = dedup.latest_per_key(
        bronze, ["user_id", "effective_date"], ["event_id"]
    )
    history = event_history(spark, sf_dir)
    all_open = history.withColumn(scd2.TO, F.lit(None).cast("timestamp_ntz"))
    landing = dedup.latest_per_key(bronze, ["user_id"], NEWEST_EVENT)
    recon = dedup.reconcile_counts(
        bronze,
        bronze.select("user_id").distinct(),
        dedup.reject_counts(per_delivery, ["user_id"]),
        "rejected",
    )
    return verify.integrity_problems(
        "user_id",
        {
            "landing": landing,
            "landing per delivery": per_delivery,
        },
        {"scd2": history, "scd2 all open": all_open},
        recon,
    )


def scd2_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = event_history(spark, sf_dir)
    return verify.history_side_by_side(
        {"all": history, "current": scd2.current_versions(history)},
        "user_id",
        "event_type",
        "effective_date",
    )


def unique_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unique_failures(table(spark, sf_dir, "orders"), "o_custkey")


def not_null_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.not_null_failures(event_deliveries(spark, sf_dir), "band")


def stored_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outcome of three checks in one scan, of which one keeps its failures."""
    rules = [
        quality.Rule("not_null_user", quality.NOT_NULL, "user_id"),
        quality.Rule("unique_user", quality.UNIQUE, "user_id", quality.WARN, store=True),
        quality.Rule("not_null_band", quality.NOT_NULL, "band"),
    ]
    root = scratch_path(spark, "audit")
    events = event_deliveries(spark, sf_dir)
    outcomes = quality.run_rules(events, rules, root)
    rows = [(o.name, o.status, o.failures) for o in outcomes]
    kept = quality.stored(events, rules, root, "unique_user")
    stored = kept.groupBy(F.lit("unique_user").alias("name")).agg(
        F.count(F.lit(1)).alias("stored")
    )
    summary = spark.createDataFrame(rows, "name string, status string, failures bigint")
    return summary.join(stored, "name", "left")


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the steps of a run wrote, as the log tells it; one of them fails."""
    log = RunLog(spark, scratch_path(spark, "runs"), "run-1")
    steps = {
        "bronze": event_deliveries(spark, sf_dir),
        "landing": order_landing(spark, sf_dir),
        "history": event_history(spark, sf_dir),
    }
    for step, rows in steps.items():
        path = scratch_path(spark, step)
        log.write(step, rows, lambda df, path=path: df.write.parquet(path))
    begin = time.monotonic()
    unknown = quality.not_null_failures(steps["bronze"], "band").count()
    log.add("not_null_band", quality.FAILED, unknown, time.monotonic() - begin)
    timed = F.col("seconds") > 0
    return log.lines().select("run_id", "step", "status", "rows", timed.alias("timed"))


# --- comparing relations ---------------------------------------------------


def _two_relations(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The newest order and the largest order of every customer."""
    orders = table(spark, sf_dir, "orders")
    newest = dedup.latest_per_key(orders, ["o_custkey"], NEWEST_ORDER)
    largest = dedup.latest_per_key(
        orders, ["o_custkey"], ["o_totalprice", "o_orderkey"]
    )
    return newest, largest


def relation_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diff.compare_relations(
        *_two_relations(spark, sf_dir), exclude=["o_orderkey", "o_totalprice"]
    )


def _two_bags(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Event kinds per user in the two halves of the month, copies and all."""
    events = event_deliveries(spark, sf_dir)
    half = F.lit(SESSION_DAY).cast("date")
    columns = ["user_id", "event_type", "band"]
    return (
        events.filter(F.col("effective_date") <= half).select(*columns),
        events.filter(F.col("effective_date") > half).select(*columns),
    )


def relation_diff_bag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diff.compare_relations(*_two_bags(spark, sf_dir), bag=True)


def relation_surplus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diff.surplus_rows(*_two_bags(spark, sf_dir))


def relation_diff_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = diff.keyed_diff(
        *_two_landings(spark, sf_dir), ["o_custkey"], ["o_orderdate", *ORDER_CHECK]
    )
    return found.withColumn(
        "changed_columns", F.concat_ws(",", F.array_sort("changed_columns"))
    )


def relation_diff_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyed comparison where keys are repeated on both sides."""
    found = diff.keyed_diff(*_two_bags(spark, sf_dir), ["user_id", "event_type"])
    return found.withColumn(
        "changed_columns", F.concat_ws(",", F.array_sort("changed_columns"))
    )


def set_common(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diff.common_rows(*_two_bags(spark, sf_dir))


def set_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diff.rows_missing_from(*_two_bags(spark, sf_dir))


def bag_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diff.rows_missing_from(*_two_bags(spark, sf_dir), bag=True)


# --- privacy ---------------------------------------------------------------

CUSTOMER_NAMES = {
    "foretagsnamn": privacy.COMPANY,
    "namn": privacy.ENTITY,
    "coadress": privacy.PERSON,
}


def _named_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("peorgnr"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("foretagsnamn"),
        F.when(segment == "HOUSEHOLD", F.lit(" ")).otherwise(segment).alias("namn"),
        F.when(segment != "MACHINERY", F.col("c_name")).alias("coadress"),
        F.col("c_nationkey").cast("string").alias("postort"),
        segment.alias("source_file"),
    )


def pseudonymise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.pseudonymise(
        _named_customers(spark, sf_dir), "peorgnr", CUSTOMER_NAMES
    )


def _half_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of which some segments carry pseudonyms already."""
    people = _named_customers(spark, sf_dir)
    done = F.col("source_file").isin("BUILDING", "HOUSEHOLD")
    return people.filter(~done).unionByName(
        privacy.pseudonymise(people.filter(done), "peorgnr", CUSTOMER_NAMES)
    )


def anonymised_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.pseudonymisation_report(
        _half_done(spark, sf_dir), "source_file", "peorgnr", CUSTOMER_NAMES
    )


def anonymise_open_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.pseudonymise_open_files(
        _half_done(spark, sf_dir), "source_file", "peorgnr", CUSTOMER_NAMES
    )


# --- keys, pivot, pruned sums ----------------------------------------------


def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hexadecimal text of the binary key, and its width in bytes."""
    orders = table(spark, sf_dir, "orders")
    file = F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("_data.parquet"))
    keyed = orders.withColumn("source_file", file).withColumn(
        "order_sk", surrogate_key("o_orderkey", "source_file")
    )
    return keyed.select(
        "o_orderkey",
        "source_file",
        F.lower(F.hex("order_sk")).alias("order_sk"),
        F.octet_length("order_sk").alias("key_bytes"),
    )


def sequence_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return keys.with_sequence_key(orders, "order_seq", ["o_custkey", "o_orderkey"])


# attribute -> (column, type)
HOUSEHOLD = {
    "incomeBeforeTax": ("income_before_tax", "decimal(18,2)"),
    "debtTotal": ("debt_total", "decimal(18,2)"),
    "numChildren": ("num_children", "int"),
    "ltiCreditAmount": ("lti_credit_amount", "decimal(18,2)"),
}


def attribute_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in long form; values below 0.01 count as unknown."""
    pairs = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_id"),
                F.col(source).cast("double").alias("val_dec"),
            )
            for name, source in zip(
                HOUSEHOLD, ("l_extendedprice", "l_tax", "l_linenumber", "l_discount")
            )
        ]
    )
    long = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("householdID_"), F.col("l_orderkey")).alias("row_id"),
        F.col("l_returnflag").alias("filename"),
        F.concat(F.lit("report_"), F.col("l_linestatus")).alias("report_table"),
        F.explode(pairs).alias("pair"),
    )
    known = F.when(F.col("pair.val_dec") >= 0.01, F.col("pair.val_dec"))
    return long.select(
        "row_id",
        "filename",
        "report_table",
        "pair.column_id",
        known.alias("val_dec"),
    )


def eav_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = pivot.entity_id(attribute_rows(spark, sf_dir), "row_id", "household_bk")
    return pivot.pivot_attributes(
        long, "household_bk", "filename", "column_id", "val_dec", HOUSEHOLD
    ).withColumnRenamed("filename", "source_file")


def household_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide rows with key and audit columns, as the v1 landing table holds them."""
    loaded = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    wide = keys.with_surrogate_key(
        eav_pivot(spark, sf_dir), ["household_bk", "source_file"], "household_sk"
    )
    return keys.with_load_defaults(wide, loaded, "batch-1").withColumn(
        "household_sk", F.lower(F.hex("household_sk"))
    )


def eav_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot.rows_per_report(attribute_rows(spark, sf_dir))


EAV_ORDER = ["row_id", "column_id", "filename", "report_table", "val_dec"]


def eav_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot.sample_with_value(attribute_rows(spark, sf_dir), "val_dec", EAV_ORDER)


def eav_first_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot.first_report_rows(
        attribute_rows(spark, sf_dir), "report_table", EAV_ORDER
    )


def filename_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_layout(delivery_names(spark, sf_dir))


def filename_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout_totals(with_layout(delivery_names(spark, sf_dir)))


def delivery_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names with a good date, with a bad one before a good one, with none."""
    day = F.date_format("o_orderdate", "yyyyMMdd")
    year = F.date_format("o_orderdate", "yyyy")
    status = F.col("o_orderstatus")
    key = F.col("o_orderkey").cast("string")
    good = F.concat(F.lit("reg_JE_"), day, F.lit("T120000_"), key, F.lit(".txt"))
    bad = F.concat(F.lit("a_"), year, F.lit("0230_"), day, F.lit(".txt"))
    none = F.concat(F.lit("nodate_"), F.col("o_orderpriority"), F.lit(".txt"))
    name = F.when(status == "F", good).when(status == "P", bad).otherwise(none)
    return table(spark, sf_dir, "orders").select("o_orderkey", name.alias("name"))


def pruned_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order value per nation in one year.

    Sums per customer come before the join with customers, sums per nation
    before the join with names.
    """
    orders = table(spark, sf_dir, "orders")
    per_customer = (
        windows.in_year(orders, "o_orderdate", 1998)
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("amount"))
    )
    place = F.when(F.col("c_mktsegment") == "MACHINERY", "unknown").otherwise(
        F.col("c_nationkey").cast("string")
    )
    places = table(spark, sf_dir, "customer").select(
        "c_custkey", place.alias("province_sk")
    )
    summed = summaries.sum_of_known(
        per_customer.join(places, "c_custkey"),
        F.col("province_sk") != "unknown",
        ["province_sk"],
        "amount",
        "number_of_rides",
    )
    names = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("province_sk"),
        F.col("n_name").alias("province_name"),
    )
    return summaries.with_lookup(summed, names, "province_sk").withColumn(
        "number_of_rides", F.col("number_of_rides").cast("double")
    )


# --- stored and read back --------------------------------------------------


def hive_pruned_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned table is written, one of its days replaced, one year summed."""
    root = scratch_path(spark, "hive")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_orderstatus").alias("province_sk"),
        F.year("o_orderdate").alias("service_year"),
    )
    write_hive(orders, root, ["service_year"])
    write_hive(
        orders.filter(F.col("service_year") == 1997).withColumn(
            "province_sk", F.lit("unknown")
        ),
        root,
        ["service_year"],
        "dynamic",
    )
    stored = read_hive(spark, root).withColumn("rides", F.lit(1).cast("bigint"))
    return summaries.sum_of_known(
        stored.filter(F.col("service_year").isin(1997, 1998)),
        F.col("province_sk") != "unknown",
        ["service_year", "province_sk"],
        "rides",
        "number_of_rides",
    )


def raw_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited deliveries with two column orders, read by name and staged."""
    root = scratch_path(spark, "raw")
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("PeOrgNr"),
        F.col("event_type").alias("Namn"),
        F.concat(F.lit("Å Ä Ö "), F.col("event_id")).alias("Gatuadress"),
        F.date_format("ts", "yyyy").alias("year"),
        F.date_format("ts", "MM").alias("month"),
        F.date_format("ts", "dd").alias("day"),
        F.dayofmonth("ts").alias("of_month"),
    )
    early = events.filter("of_month <= 15").drop("of_month")
    late = events.filter("of_month > 15").select(
        "Namn", "PeOrgNr", "Gatuadress", *DAY_PARTS
    )
    for part in (early, late.drop("Gatuadress")):
        (
            part.hint("rebalance", *DAY_PARTS)
            .write.mode("append")
            .options(delimiter="\t", header="true", encoding="ISO-8859-1")
            .partitionBy(*DAY_PARTS)
            .csv(root)
        )
    loaded = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    staged = stage(
        read_deliveries(spark, root, "*.csv"),
        ["PeOrgNr", "Namn", "Gatuadress"],
        "run-1",
        loaded,
    )
    return staged.drop("source_file")


def raw_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The header lines found among delimited files."""
    root = scratch_path(spark, "layouts")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    for frame, name in ((orders, "orders"), (customers, "customers")):
        frame.write.options(delimiter="\t", header="true").csv(f"{root}/{name}")
    layouts = header_layouts(spark, root, "*.csv")
    rows = read_deliveries(spark, root, "*.csv", layouts=layouts, with_layout=True)
    header = F.replace(F.col(LAYOUT), F.lit("\t"), F.lit(","))
    return rows.groupBy(header.alias("header")).agg(F.count(F.lit(1)).alias("rows"))


def _inbox(rows: DataFrame, folder: str) -> None:
    """A delivery as files of ready-made lines, each file led by the header."""
    line = F.concat_ws("\t", *rows.columns).alias("\t".join(rows.columns))
    # A separator that no line has, and no quotes: lines are written as they are.
    options = {"sep": "\u0001", "quote": "", "header": "true"}
    # Fields at either end may be empty.
    options |= {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    rows.select(line).write.options(**options).csv(folder)


def _landed(spark: SparkSession, sf_dir: str) -> str:
    """Deliveries of orders that come in turn: two files of one day, one of them
    twice, and one with lines that are too short, too long, or broken in a quote.

    A delivery is a folder that carries the name of its file.
    """
    root = scratch_path(spark, "landed")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("PeOrgNr"),
        F.col("o_orderstatus").alias("Namn"),
        F.col("o_orderpriority").alias("PostOrt"),
    )
    key = F.col("PeOrgNr").cast("bigint")
    last = F.col("PostOrt")
    damaged = (
        F.when(key % 9 == 1, F.concat(F.lit('"'), last))
        .when(key % 9 == 4, F.concat(last, F.lit("\tmore")))
        .when(key % 27 != 7, last)
    )
    first = orders.filter(key % 3 == 0).select("Namn", "PostOrt", "PeOrgNr")
    second = orders.filter(key % 3 == 2)
    third = orders.filter(key % 3 == 1).withColumn("PostOrt", damaged)
    turns = (
        (first, "reg_20240301T120000_1.txt"),
        (second, "reg_20240301T130000_2.txt"),
        (first, "reg_20240301T120000_1.txt"),
        (third, "reg_20240302T120000_1.txt"),
    )
    for turn, (rows, name) in enumerate(turns):
        inbox = f"{root}/inbox/{turn}"
        _inbox(rows, f"{inbox}/{SOURCE_FILE}={name}")
        land_deliveries(spark, inbox, f"{root}/raw", "*.csv")
    return f"{root}/raw"


def raw_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything that was delivered, once, whatever came before or again."""
    raw = read_raw(spark, _landed(spark, sf_dir))
    return raw.select("PeOrgNr", "Namn", "PostOrt", "year", "month", "day")


def raw_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per file they came from."""
    raw = read_raw(spark, _landed(spark, sf_dir))
    return raw.groupBy(SOURCE_FILE).agg(F.count(F.lit(1)).alias("rows"))


def raw_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that did not fit their header, per file."""
    return quarantine_counts(quarantined(spark, _landed(spark, sf_dir)))


def raw_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that come again corrected, damaged, empty and all malformed: rows and lines
    in quarantine of each file, of which nothing old is left."""
    root = scratch_path(spark, "replaced")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("PeOrgNr"), F.col("o_orderstatus").alias("Namn")
    )
    key = F.col("PeOrgNr").cast("bigint")

    def part(at: int, broken: Column) -> DataFrame:
        name = F.when(broken, F.concat("Namn", F.lit("\tmore"))).otherwise(F.col("Namn"))
        return orders.filter(key % 4 == at).withColumn("Namn", name)

    some, all_, none = key % 5 == 0, F.lit(True), F.lit(False)
    turns = [
        [(0, part(0, some)), (1, part(1, none)), (2, part(2, none)), (3, part(3, some))],
        [(0, part(0, none)), (1, part(1, some)), (2, part(2, none).limit(0)), (3, part(3, all_))],
        [(1, part(1, some))],
    ]
    for turn, files in enumerate(turns):
        for at, rows in files:
            _inbox(rows, f"{root}/inbox/{turn}/{SOURCE_FILE}=reg_2024030{at + 1}.txt")
        land_deliveries(spark, f"{root}/inbox/{turn}", f"{root}/raw", "*.csv")
    rows = read_raw(spark, f"{root}/raw").select(SOURCE_FILE, F.lit("raw").alias("side"))
    lines = quarantined(spark, f"{root}/raw").select(SOURCE_FILE, F.lit("quarantine").alias("side"))
    return rows.union(lines).groupBy(SOURCE_FILE, "side").agg(F.count(F.lit(1)).alias("rows"))


def lake_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of a table; rows per status by number, by time and at the end."""
    lake = VersionedTable(spark, scratch_path(spark, "lake"))
    first, second = _two_landings(spark, sf_dir)
    lake.write_load(first, 1, "first", FIRST_CUT)
    lake.write_load(second, 2, "second", SECOND_CUT)
    views = {
        "version 1": lake.read_version(1),
        "as of 2000": lake.read_as_of(datetime(2000, 1, 1)),
        "latest": lake.read_latest(),
    }
    counted = [
        df.groupBy("o_orderstatus")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(name).alias("view"), "o_orderstatus", "rows")
        for name, df in views.items()
    ]
    return counted[0].union(counted[1]).union(counted[2])


def lake_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A year of orders is a file.  Two loads, the second with years that are new, one
    that is corrected and one that is empty: rows by file of both states, and of what
    the second load wrote."""
    lake = FileTable(spark, scratch_path(spark, "lake-files"))
    year = F.year("o_orderdate")
    orders = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("orders-"), year).alias(FILE), year.alias("year"), "o_orderkey"
    )
    first = orders.filter("year <= 1995")
    second = orders.filter("year > 1992 AND (year <> 1995 OR o_orderkey % 2 = 0)")
    for turn, (shown, rows) in enumerate([(first, first), (orders, second)], 1):
        content = rows.groupBy(FILE).agg(
            F.sum(F.xxhash64("o_orderkey").cast("decimal(38,0)")).cast("string").alias("digest")
        )
        state = F.coalesce("digest", F.lit("empty")).alias(FILE_STATE)
        listed = shown.select(FILE).distinct().join(content, FILE, "left").select(FILE, state)
        lake.take(
            listed,
            lambda fresh: rows.join(fresh, FILE, "left_semi").select(FILE, "o_orderkey"),
            f"turn-{turn}",
            (FIRST_CUT, SECOND_CUT)[turn - 1],
        )
    views = {
        "as of 2000": lake.read_as_of(datetime(2000, 1, 1)),
        "latest": lake.read_latest(),
        "added": lake.rows.all_loads().filter(F.col(LOAD) == 2),
    }
    counted = [
        df.groupBy(FILE).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("view"), FILE, "rows")
        for name, df in views.items()
    ]
    return counted[0].union(counted[1]).union(counted[2])


def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that only later loads have."""
    root = scratch_path(spark, "evolving")
    orders = table(spark, sf_dir, "orders")
    append_evolving(
        orders.filter(F.col("o_orderstatus") != "F").select(
            "o_orderkey", "o_orderstatus"
        ),
        root,
    )
    append_evolving(
        orders.filter(F.col("o_orderstatus") == "F").select(
            "o_orderkey", "o_orderstatus", "o_orderpriority"
        ),
        root,
    )
    return read_hive(spark, root, evolved=True)


def strategy_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that is appended to, truncated, and appended to by name."""
    path = scratch_path(spark, "tables")
    name = "strandline_" + path.rsplit("-", 1)[1]
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    spark.sql(
        f"CREATE TABLE {name} (o_orderkey BIGINT, o_orderstatus STRING) "
        f"USING parquet LOCATION '{path}'"
    )

    def part(status: str) -> DataFrame:
        return orders.filter(F.col("o_orderstatus") == status)

    write_table(part("F"), name, APPEND)
    write_table(part("O"), name, TRUNCATE)
    swapped = part("P").select("o_orderstatus", "o_orderkey")
    write_table(swapped, name, APPEND, by_name=True)
    # The entry in the catalogue goes, the files stay.
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema("o_orderkey bigint, o_orderstatus string").parquet(path)


def strategy_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that is replaced by one with other columns, then appended to."""
    path = scratch_path(spark, "replaced-table")
    name = "strandline_" + path.rsplit("-", 1)[1]
    orders = table(spark, sf_dir, "orders")
    priority = F.substring("o_orderpriority", 1, 1).cast("int").alias("priority")
    write_table(orders.select("o_orderkey", "o_orderstatus"), name, REPLACE)
    write_table(orders.filter("o_orderstatus = 'F'").select("o_orderkey", priority), name, REPLACE)
    write_table(orders.filter("o_orderstatus = 'P'").select("o_orderkey", priority), name, APPEND)
    spark.table(name).write.parquet(path)
    # The table was made here, under a name that nobody else has.
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(path)


def _customer_files(spark: SparkSession, sf_dir: str) -> str:
    """A file of customers for each segment: some are done, one has no name columns
    but the first, the others are open."""
    root = scratch_path(spark, "names")
    people = _half_done(spark, sf_dir)
    lines = people.select(
        F.col("peorgnr").alias("PeOrgNr"), F.col("foretagsnamn").alias("Foretagsnamn"),
        F.col("namn").alias("Namn"), F.col("coadress").alias("CoAdress"),
        F.col("postort").alias("PostOrt"), SOURCE_FILE,
    ).na.fill("")
    for segment in SEGMENTS:
        mine = lines.filter(F.col(SOURCE_FILE) == segment).drop(SOURCE_FILE)
        if segment == "MACHINERY":
            mine = mine.drop("Namn", "CoAdress")
        _inbox(mine, f"{root}/{SOURCE_FILE}={segment}.txt")
    return root


def anonymise_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was rewritten of files that are open, done, or lack columns."""
    source = _customer_files(spark, sf_dir)
    return register.pseudonymise_deliveries(
        spark, source, scratch_path(spark, "masked"), "*.csv"
    )


def anonymise_files_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of these files after that."""
    target = scratch_path(spark, "masked")
    register.pseudonymise_deliveries(spark, _customer_files(spark, sf_dir), target, "*.csv")
    masked = read_deliveries(spark, target, "*.csv")
    return masked.select("PeOrgNr", "Foretagsnamn", "Namn", "CoAdress", "PostOrt", SOURCE_FILE)


# --- streams ---------------------------------------------------------------


def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily deliveries that arrive as a stream, a week in a batch, end in the same
    history."""
    return ingest.replay_as_stream(
        event_deliveries(spark, sf_dir),
        scratch_path(spark, "ingest"),
        ["user_id"],
        "effective_date",
        EVENT_CHECK,
        ["event_id"],
    )


def _event_ingest(spark: SparkSession) -> ingest.DeliveryIngest:
    root = scratch_path(spark, "ingest")
    return ingest.DeliveryIngest(spark, root, ("user_id",), "effective_date", EVENT_CHECK, ("event_id",))


def ingest_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited deliveries of two layouts that stream in by halves of the time end in
    the same history."""
    store = _event_ingest(spark)
    rows = event_deliveries(spark, sf_dir)
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in rows.columns]
    # The day in the middle of all days, one row.
    day = F.datediff("effective_date", F.lit("1970-01-01"))
    middle = rows.agg(((F.min(day) + F.max(day)) / 2).cast("int").alias("middle"))
    early = day <= middle.scalar()
    columns = {f.name: f.dataType for f in rows.schema.fields}

    def to_rows(found: DataFrame) -> DataFrame:
        return found.select(*[F.col(c).cast(kind).alias(c) for c, kind in columns.items()])

    for turn, (part, order) in enumerate(((early, rows.columns), (~early, rows.columns[::-1]))):
        name = f"{store.root}-inbox/{SOURCE_FILE}=events_{turn}.txt"
        _inbox(rows.filter(part).select(*text).select(*order), name)
        store.start_text(f"{store.root}-inbox", list(columns), to_rows, "*.csv").awaitTermination()
    return store.history.history()


def ingest_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that stream in out of order, some of them without a key: every row of
    bronze is on time, late or in quarantine."""
    store = _event_ingest(spark)
    rows = event_deliveries(spark, sf_dir).withColumn(
        "user_id", F.when(F.col("event_id") % 50 != 0, F.col("user_id"))
    )
    for turn in range(3):
        store.apply_batch(rows.filter(F.col("event_id") % 3 == turn), turn)
    return store.account()


def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_windows.replay(
        table(spark, sf_dir, "events"),
        "ts",
        lambda stream: stream_windows.tumbling_counts(stream, "ts", "1 hour"),
        scratch_path(spark, "stream"),
    )


def stream_hopping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_windows.replay(
        table(spark, sf_dir, "events"),
        "ts",
        lambda stream: stream_windows.hopping_counts(stream, "ts"),
        scratch_path(spark, "stream"),
    )


def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_windows.replay(
        table(spark, sf_dir, "events"),
        "ts",
        lambda stream: stream_windows.session_counts(stream, "ts", "user_id"),
        scratch_path(spark, "stream"),
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        stage_projection,
        dedup_latest,
        dedup_rejects,
        dedup_reconciliation,
        dup_cross_delivery,
        dup_intra_delivery,
        dup_losing_copies,
        scd2_history,
        scd2_current,
        scd2_as_of,
        scd2_totals,
        scd2_point_in_time,
        scd2_interval_check,
        scd2_merge,
        scd2_merge_close_missing,
        scd2_published,
        tumbling_hour,
        tumbling_quarter_profile,
        tumbling_offset_profile,
        hopping_all,
        hopping_starts,
        hopping_top5,
        sliding_count,
        sliding_top5,
        session_windows,
        session_top_days,
        session_of_day,
        session_gaps,
        layer_counts,
        entity_lineage,
        integrity_problems,
        scd2_listing,
        unique_failures,
        not_null_failures,
        stored_failures,
        run_log,
        relation_diff,
        relation_diff_bag,
        relation_surplus,
        relation_diff_keyed,
        relation_diff_repeated,
        set_common,
        set_missing,
        bag_missing,
        pseudonymise,
        anonymised_check,
        anonymise_open_files,
        surrogate_keys,
        sequence_keys,
        eav_pivot,
        household_landing,
        eav_reports,
        eav_sample,
        eav_first_report,
        filename_partition,
        filename_totals,
        pruned_sum,
        hive_pruned_sum,
        raw_union_by_name,
        raw_layouts,
        raw_landing,
        raw_lineage,
        raw_quarantine,
        raw_replaced,
        lake_versions,
        lake_increments,
        schema_evolution,
        strategy_modes,
        strategy_replace,
        anonymise_files,
        anonymise_files_rows,
        incremental_ingest,
        ingest_text,
        ingest_account,
        stream_tumbling,
        stream_hopping,
        stream_sessions,
    )
}
