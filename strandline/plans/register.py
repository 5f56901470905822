"""The company register flow: one configuration of the operators.

raw text -> staging -> bronze -> landing + rejects -> history

Bronze is kept twice, as hive-partitioned Parquet and as a table with versions, to
which a run adds the files that are new or changed.  Both copies feed a landing and a
history of their own, and the two paths are compared with each other.

Landings and rejects are loads.  They are published together, once bronze is found to
be their sum; until then, and after a run that fails, readers see those before.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.operators import dedup, diff, privacy, quality
from strandline.plans import verify
from strandline.plans.history import HistoryStore
from strandline.sources.delimited import (
    DAY_PARTS,
    LAYOUT,
    SOURCE_FILE,
    header_layouts,
    land_deliveries,
    newest_loads,
    read_deliveries,
    read_raw,
    stage,
    with_day_parts,
    write_deliveries,
)
from strandline.sources.parquet import read_hive, write_hive
from strandline.sources.runlog import RunLog
from strandline.sources.versions import FILE_STATE, FileTable, VersionedTable

# The columns of the register.
KEY = "peorgnr"
TRACKED = (
    "foretagsnamn",
    "coadress",
    "gatuadress",
    "postnr",
    "postort",
    "jurform",
    "ftgstat",
    "jestat",
    "namn",
    "ng1",
    "ng2",
    "ng3",
    "ng4",
    "ng5",
    "regdatktid",
    "reklamsparrtyp",
    "forandrtyp",
)
BUSINESS = (KEY, *TRACKED)
META = ("effective_date", "source_file", "last_updated_dt", "invocation_id")
COLUMNS = (*BUSINESS, *META)
NAMES = {
    "foretagsnamn": privacy.COMPANY,
    "namn": privacy.ENTITY,
    "coadress": privacy.PERSON,
}

PARQUET, LAKE = "parquet", "lake"  # the two ways from bronze to history
REJECTS, PUBLISHED = "rejects", "published"
LOADED = (f"landing-{PARQUET}", f"landing-{LAKE}", REJECTS, PUBLISHED)
# The latest delivery wins; ties go by the file, and then by all columns.
LATEST = ("effective_date", "source_file")
RUN_COLUMNS = ("last_updated_dt", "invocation_id", "source_file")
#: Publications of landings and rejects that are kept: the last, and the one before for
#: those who still read it.
KEPT = 2


@dataclass(frozen=True)
class Layers:
    """Where the layers of one register live."""

    spark: SparkSession
    root: str

    def path(self, layer: str) -> str:
        return f"{self.root}/{layer}"

    def raw(self) -> DataFrame:
        return read_raw(self.spark, self.path("raw"))

    def bronze(self) -> DataFrame:
        return read_hive(self.spark, self.path("bronze")).select(*COLUMNS)

    @property
    def bronze_lake(self) -> FileTable:
        return FileTable(self.spark, self.path("bronze-lake"))

    def loads(self, layer: str) -> VersionedTable:
        return VersionedTable(self.spark, self.path(layer))

    def published(self) -> int:
        """The number of the landings and rejects that readers see."""
        last = self.loads(PUBLISHED).latest_load()
        if last is None:
            raise LookupError(f"{self.root} has no landing yet")
        return last

    def landing(self, path: str = PARQUET, load: int | None = None) -> DataFrame:
        return self.loads(f"landing-{path}").read_version(load or self.published())

    def rejects(self, load: int | None = None) -> DataFrame:
        return self.loads(REJECTS).read_version(load or self.published())

    def history(self, path: str = PARQUET) -> HistoryStore:
        root = self.path(f"history-{path}")
        return HistoryStore(self.spark, root, (KEY,), TRACKED)

    def log(self, run_id: str) -> RunLog:
        return RunLog(self.spark, self.path("runs"), run_id)


#: Key and date must be known; a repeated key is worth a warning only.
BRONZE_RULES = (
    quality.Rule(f"not_null_{KEY}", quality.NOT_NULL, KEY),
    quality.Rule(f"unique_{KEY}", quality.UNIQUE, KEY, quality.WARN, store=True),
    quality.Rule("not_null_effective_date", quality.NOT_NULL, "effective_date"),
)


def run(
    layers: Layers, inbox: str, run_id: str, snapshot_ts: datetime
) -> list[quality.Outcome]:
    """One full run.  Each layer is written and then read back by the next one.

    A check that fails stops the run before the landings are touched.
    """
    log = layers.log(run_id)
    _write_bronze(layers, inbox, run_id, snapshot_ts)

    bronze = layers.bronze()
    begin = time.monotonic()
    outcomes = quality.run_rules(bronze, BRONZE_RULES, layers.path("audit"))
    seconds = time.monotonic() - begin
    for outcome in outcomes:
        # One scan for all: each gets its share of the time.
        log.add(outcome.name, outcome.status, outcome.failures, seconds / len(outcomes))
    if any(o.status == quality.FAILED for o in outcomes):
        return outcomes

    # Beyond every number in use, also by a run that was cut short.
    load = 1 + max(layers.loads(name).latest_load() or 0 for name in LOADED)

    def write(name: str, rows: DataFrame) -> None:
        log.write(
            name, rows, lambda df: layers.loads(name).write_load(df, load, run_id, snapshot_ts)
        )

    write(f"landing-{PARQUET}", dedup.latest_per_key(bronze, [KEY], LATEST))
    lake = layers.bronze_lake.read_latest()
    write(f"landing-{LAKE}", dedup.latest_per_key(lake, [KEY], LATEST))
    write(REJECTS, dedup.rejects(bronze, [KEY], LATEST))

    begin = time.monotonic()
    wrong = dedup.reconciliation_failures(reconciliation(layers, load)).count()
    status = quality.FAILED if wrong else quality.PASSED
    outcomes.append(quality.Outcome("dedup_reconciliation", status, wrong))
    log.add("dedup_reconciliation", status, wrong, time.monotonic() - begin)
    if wrong:
        return outcomes
    counted = layers.spark.range(1, numPartitions=1).select(F.lit(run_id).alias("run_id"))
    layers.loads(PUBLISHED).write_load(counted, load, run_id, snapshot_ts)

    for path in (PARQUET, LAKE):
        begin = time.monotonic()
        history = layers.history(path)
        load = history.apply(layers.landing(path), snapshot_ts, run_id)
        written = history.table.rows_of(load)
        log.add(f"history-{path}", "success", written, time.monotonic() - begin)
    for name in LOADED:
        layers.loads(name).expire(KEPT)
    return outcomes


def _write_bronze(
    layers: Layers, inbox: str, run_id: str, snapshot_ts: datetime
) -> None:
    log = layers.log(run_id)
    land_deliveries(layers.spark, inbox, layers.path("raw"))
    stamp = F.lit(snapshot_ts.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")
    staged = stage(layers.raw(), BUSINESS, run_id, stamp)
    log.write(
        "bronze-parquet",
        with_day_parts(staged),
        lambda df: write_hive(df, layers.path("bronze"), DAY_PARTS),
    )
    raw = layers.path("raw")
    current = newest_loads(layers.spark, raw)
    everything = layers.raw()

    def rows_of(fresh: DataFrame) -> DataFrame:
        some = fresh.select(SOURCE_FILE, F.col(FILE_STATE).alias(current.columns[-1]))
        if header_layouts(layers.spark, raw, "*.csv", current=some):
            rows = read_raw(layers.spark, raw, current=some)
        else:
            rows = everything.limit(0)
        # New files may lack columns that others have.
        rows = everything.limit(0).unionByName(rows, allowMissingColumns=True)
        return stage(rows, BUSINESS, run_id, stamp)

    begin = time.monotonic()
    lake = layers.bronze_lake
    if lake.load_of(run_id) is None:
        try:
            load = lake.take(current.toDF(SOURCE_FILE, FILE_STATE), rows_of, run_id, snapshot_ts)
        except Exception:
            log.add("bronze-lake", "error", None, time.monotonic() - begin)
            raise
        added = lake.rows.rows_of(load)
        log.add("bronze-lake", "success", added, time.monotonic() - begin)


# --- reports ---------------------------------------------------------------


def reconciliation(layers: Layers, load: int | None = None) -> DataFrame:
    """Bronze as it is stored against the landing and the rejects as they are (those
    that are published if no load is named)."""
    return dedup.reconcile_counts(
        layers.bronze(), layers.landing(load=load), layers.rejects(load)
    )


def summary(layers: Layers) -> DataFrame:
    """Rows per layer."""
    return verify.layer_counts(
        [
            verify.whole_layer(layers.raw(), "raw"),
            verify.whole_layer(layers.bronze(), "bronze parquet"),
            verify.whole_layer(layers.bronze_lake.read_latest(), "bronze lake"),
            verify.whole_layer(layers.landing(PARQUET), "landing (from parquet)"),
            verify.whole_layer(layers.landing(LAKE), "landing (from lake)"),
            verify.whole_layer(layers.rejects(), "rejects"),
            verify.counted_history(
                layers.history(PARQUET).history(), "scd2 (parquet path)"
            ),
            verify.counted_history(layers.history(LAKE).history(), "scd2 (lake path)"),
        ]
    )


def lineage(layers: Layers, key: str | None = None) -> DataFrame | None:
    """One company in every layer; without a key an interesting one is taken."""
    parquet = layers.history(PARQUET).history()
    wanted = verify.interesting_key(parquet, KEY) if key is None else key
    if wanted is None:
        return None
    staged = stage(layers.raw(), BUSINESS, "")
    return verify.entity_lineage(
        [
            verify.plain_layer(staged, "raw"),
            verify.plain_layer(layers.bronze(), "bronze parquet"),
            verify.plain_layer(layers.bronze_lake.read_latest(), "bronze lake"),
            verify.plain_layer(layers.landing(PARQUET), "landing (from parquet)"),
            verify.plain_layer(layers.landing(LAKE), "landing (from lake)"),
            verify.rejects_layer(layers.rejects()),
            verify.history_layer(parquet, "scd2 parquet"),
            verify.history_layer(layers.history(LAKE).history(), "scd2 lake"),
        ],
        KEY,
        "namn",
        "effective_date",
        wanted,
    )


def integrity(layers: Layers) -> DataFrame:
    """Empty if the layers are sound."""
    return verify.integrity_problems(
        KEY,
        {
            "landing-from-parquet": layers.landing(PARQUET),
            "landing-from-lake": layers.landing(LAKE),
        },
        {
            "scd2 parquet": layers.history(PARQUET).history(),
            "scd2 lake": layers.history(LAKE).history(),
        },
        reconciliation(layers),
    )


def compare_landings(layers: Layers) -> DataFrame:
    """Both bronze paths must give the same landing."""
    return diff.compare_relations(
        layers.landing(PARQUET), layers.landing(LAKE), exclude=RUN_COLUMNS
    )


def compare_histories(layers: Layers) -> DataFrame:
    """Both histories, intervals included: the two are taken at one given time."""
    return diff.compare_relations(
        layers.history(PARQUET).history(),
        layers.history(LAKE).history(),
        exclude=RUN_COLUMNS,
        bag=True,
    )


# --- pseudonyms ------------------------------------------------------------


def pseudonymise_deliveries(
    spark: SparkSession, source: str, target: str, glob: str, dry_run: bool = False
) -> DataFrame:
    """Deliveries with pseudonyms for names, written to ``target``; one line per
    file says what was (or would be) rewritten.  The source is left alone.

    A file whose header lacks the key or a name column is reported with these and
    written as it is.  The source may be laid out by day or flat.
    """
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("source and target are the same folder")
    layouts = header_layouts(spark, source, glob)
    rows = read_deliveries(spark, source, glob, layouts=layouts, with_layout=True)
    file = F.element_at(F.split(SOURCE_FILE, "/"), -1)
    reports = []
    # One turn for each header line, of which there are few.
    for layout in layouts:
        own = {c.lower(): c for c in layout.columns}
        have = {c.lower(): c for c in rows.columns}
        folders = [c for c in DAY_PARTS if c in rows.columns]
        columns = [have[c] for c in own if c in have and c != SOURCE_FILE]
        mine = rows.filter(F.col(LAYOUT) == F.lit(layout.header)).select(
            *columns, *[c for c in folders if c not in columns], file.alias(SOURCE_FILE)
        )
        lacking = privacy.missing_columns(mine, KEY, NAMES)
        names = {have[n]: kind for n, kind in NAMES.items() if n not in lacking}
        if lacking:
            report = mine.groupBy(SOURCE_FILE).agg(
                F.count(F.lit(1)).alias("rows_seen"),
                F.lit(0).cast("bigint").alias("rows_rewritten"),
                F.lit(False).alias("already_anonymised"),
            )
        else:
            report = privacy.pseudonymisation_report(mine, SOURCE_FILE, have[KEY], names)
        reports.append(report.withColumn("missing_columns", F.lit(", ".join(lacking))))
        if not dry_run:
            done = mine
            if not lacking:
                done = privacy.pseudonymise_open_files(mine, SOURCE_FILE, have[KEY], names)
            write_deliveries(done, target)
    return reduce(DataFrame.unionByName, reports)
