"""Delimited deliveries: reading them by column name, and laying them out by day."""

from __future__ import annotations

import csv
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.functions.expressions import checked_date, file_date, file_date_text
from strandline.session import scratch_path, setting

# The format of a delivery.
DELIMITER = "\t"
ENCODING = "ISO-8859-1"

SOURCE_FILE = "source_file"
DAY_PARTS = ("year", "month", "day")
MALFORMED = "_malformed"  # the whole line, where it does not fit its header
LAYOUT = "_layout"  # the header line of the file
FAIL, KEEP = "fail", "keep"  # what becomes of malformed lines
QUARANTINE = "-quarantine"
MANIFEST = "-manifest"
LOAD = "load"  # the folder of a file that holds what one landing brought
#: Headers of up to so many files are sent to all tasks; more meet the lines in a join.
BROADCAST_FILES = 20_000
#: Files that a task writes side by side; only rows of further ones are sorted by folder.
OPEN_FILES = 32


def _csv_options(delimiter: str, encoding: str) -> dict[str, str]:
    return {
        "delimiter": delimiter,
        "encoding": encoding,
        "header": "true",
        "escape": '"',
    }


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Path, name and size of the files below ``root``; none of them is opened.

    A scan passes over files of no bytes; they are told from the list of files that
    Spark's driver holds for any scan.
    """
    found = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(root)
    )
    whole = F.regexp_replace("path", "^([a-z0-9]+):/+", "$1:/")
    uri = F.url_decode(F.replace(F.col("uri"), F.lit("+"), F.lit("%2B")))
    known = spark.createDataFrame([(u,) for u in found.inputFiles()], "uri string")
    return (
        known.select(uri.alias("path")).select(whole.alias("path"))
        .join(found.select(whole.alias("path"), F.col("length")), "path", "left")
        .select(
            "path",
            F.element_at(F.split("path", "/"), -1).alias("name"),
            F.coalesce("length", F.lit(0).cast("bigint")).alias("bytes"),
        )
    )


@dataclass(frozen=True)
class Layout:
    """A header line, its columns, and how many files begin with it."""

    header: str
    columns: tuple[str, ...]
    files: int
    dated: bool


def _text(reader, root: str, glob: str, encoding: str) -> DataFrame:
    """``path``, ``line`` and whether it is in the first block (``early``) of all lines.

    Spark's text reader hands the bytes on as they are; they are decoded here.
    """
    return (
        reader.option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .schema("value string")
        .text(root)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.decode(F.col("value").cast("binary"), encoding).alias("line"),
            (F.col("_metadata.file_block_start") == 0).alias("early"),
        )
    )


def numbered(text: DataFrame) -> DataFrame:
    """``path``, ``line``, ``id`` (growing within a file), and ``at_start``, the same for
    lines of the first block only.

    A number inside a condition would count only the lines that meet it.
    """
    every = text.select("path", "line", "early", F.monotonically_increasing_id().alias("id"))
    return every.select("path", "line", F.when(F.col("early"), F.col("id")).alias("at_start"), "id")


def _lines(spark: SparkSession, root: str, glob: str, encoding: str) -> DataFrame:
    return numbered(_text(spark.read, root, glob, encoding))


def stream_text(
    spark: SparkSession,
    root: str,
    glob: str = "*.txt",
    encoding: str = ENCODING,
    files_at_once: int = 1000,
) -> DataFrame:
    """The lines of deliveries as a stream; ``numbered`` and ``parsed`` read its batches.

    A batch takes whole files, so each line finds its header in its own batch.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", files_at_once)
    return _text(reader, root, glob, encoding)


def header_lines(lines: DataFrame) -> DataFrame:
    """``path``, ``header`` and ``header_id`` of every file that is not empty: the
    first line of its first block, found by a partial aggregate."""
    return lines.groupBy("path").agg(
        F.min_by("line", "at_start").alias("header"), F.min("at_start").alias("header_id")
    )


def _heads(lines: DataFrame, current: DataFrame | None) -> DataFrame:
    """Headers of all files, or of those in the loads that ``current`` (``source_file``,
    ``load``) names."""
    heads = header_lines(lines)
    if current is None:
        return heads
    named = heads.withColumns({SOURCE_FILE: _in_path(SOURCE_FILE), LOAD: _in_path(LOAD)})
    return named.join(current, [SOURCE_FILE, LOAD], "left_semi").drop(SOURCE_FILE, LOAD)


def _columns_of(header: str, delimiter: str) -> tuple[str, ...]:
    names = next(csv.reader([header], delimiter=delimiter))
    return tuple(name.strip() or f"_c{at}" for at, name in enumerate(names))


def header_layouts(
    spark: SparkSession,
    root: str,
    glob: str = "*.txt",
    encoding: str = ENCODING,
    delimiter: str = DELIMITER,
    current: DataFrame | None = None,
) -> list[Layout]:
    """The different header lines below ``root``; nothing else comes together here."""
    return layouts_of(_heads(_lines(spark, root, glob, encoding), current), delimiter)


def layouts_of(headers: DataFrame, delimiter: str = DELIMITER) -> list[Layout]:
    """The different headers among ``header_lines``."""
    dated = F.bool_and(F.col("path").rlike(_day_pattern("year")))
    found = headers.groupBy("header").agg(
        F.count(F.lit(1)).alias("files"), dated.alias("dated")
    )
    return [
        Layout(r.header, _columns_of(r.header, delimiter), r.files, r.dated)
        for r in found.orderBy("header").collect()
    ]


def _day_pattern(part: str) -> str:
    return f"/{part}=([0-9]+)/"


def _in_path(name: str) -> Column:
    """The value that a folder ``name=value`` of the path carries, or NULL."""
    found = F.regexp_extract("path", f"/{name}=([^/]+)/", 1)
    return F.when(found != "", F.url_decode(F.replace(found, F.lit("+"), F.lit("%2B"))))


def read_deliveries(
    spark: SparkSession,
    root: str,
    glob: str = "*.txt",
    encoding: str = ENCODING,
    delimiter: str = DELIMITER,
    malformed: str = FAIL,
    layouts: list[Layout] | None = None,
    with_layout: bool = False,
    current: DataFrame | None = None,
) -> DataFrame:
    """All deliveries below ``root`` as text columns, united by column name.

    Adds the partition columns of the path and ``source_file``.  Each line meets the
    header of its own file, and is read by it; the headers of a bounded number of
    files (``BROADCAST_FILES``, counted before) go to the lines, more are joined.
    ``current`` (see ``newest_loads``) leaves out what was replaced.  A line that has more or
    fewer fields than its header, or a quote that is not closed on it, is malformed:
    it stops the job, or with ``KEEP`` comes along in ``_malformed`` with all other
    columns unknown.  ``with_layout`` adds the header line as ``_layout``.
    """
    known = layouts
    if known is None:
        known = header_layouts(spark, root, glob, encoding, delimiter, current)
    if not known:
        raise FileNotFoundError(f"no deliveries match {glob!r} below {root}")
    lines = _lines(spark, root, glob, encoding)
    return parsed(lines, _heads(lines, current), known, delimiter, malformed, with_layout)


def parsed(
    lines: DataFrame,
    heads: DataFrame,
    known: list[Layout],
    delimiter: str = DELIMITER,
    malformed: str = FAIL,
    with_layout: bool = False,
) -> DataFrame:
    """The rows of ``lines``, read by their own ``heads`` (see ``read_deliveries``)."""
    if sum(layout.files for layout in known) <= BROADCAST_FILES:
        heads = F.broadcast(heads)
    rows = lines.join(heads, "path").filter(
        (F.col("id") != F.col("header_id")) & (F.col("line") != "")
    )
    options = {"sep": delimiter, "escape": '"', "columnNameOfCorruptRecord": MALFORMED}
    parsed = []
    for layout in known:
        fields = [T.StructField(n, T.StringType()) for n in (*layout.columns, MALFORMED)]
        record = F.from_csv("line", T.StructType(fields).simpleString(), options)
        parsed.append(F.when(F.col("header") == F.lit(layout.header), record))
    rows = rows.select(
        "path", "line", "header", *[p.alias(f"_r{i}") for i, p in enumerate(parsed)]
    )

    # Spelling of a column as first met -> where it stands.
    places: dict[str, tuple[str, list[str]]] = {}
    for i, layout in enumerate(known):
        for name in layout.columns:
            if not _unnamed(name):
                places.setdefault(name.lower(), (name, []))[1].append(f"_r{i}.`{name}`")
    broken = F.coalesce(*[F.col(f"_r{i}.{MALFORMED}") for i in range(len(known))])
    quotes = F.length("line") - F.length(F.replace(F.col("line"), F.lit('"'), F.lit("")))
    broken = F.coalesce(broken, F.when(quotes % 2 == 1, F.col("line")))
    rows = rows.withColumn(MALFORMED, broken)
    sound = F.col(MALFORMED).isNull()
    own = places.pop(SOURCE_FILE, (SOURCE_FILE, []))[1]
    lineage = [F.when(sound, F.col(c)) for c in own] + [_in_path(SOURCE_FILE), F.col("path")]
    days = [F.regexp_extract("path", _day_pattern(p), 1).cast("int").alias(p) for p in DAY_PARTS]
    if malformed == FAIL:
        message = F.concat(F.col("path"), F.lit(": malformed line: "), F.col(MALFORMED))
        rows = rows.filter(F.when(sound, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    return rows.select(
        *[
            F.when(sound, F.coalesce(*[F.col(c) for c in at])).alias(name)
            for name, at in places.values()
        ],
        *(days if all(layout.dated for layout in known) else []),
        F.coalesce(*lineage).alias(SOURCE_FILE),
        *([F.col(MALFORMED)] if malformed == KEEP else []),
        *([F.col("header").alias(LAYOUT)] if with_layout else []),
    )


def _unnamed(column: str) -> bool:
    return column.startswith("_c") and column[2:].isdigit()


# --- laying out by day -----------------------------------------------------


def with_layout(files: DataFrame, name: str = "name") -> DataFrame:
    """Day of delivery from each file name, and whether the file is accepted."""
    found = files.withColumn("_digits", file_date_text(name))
    accepted = F.col("accepted")
    return found.withColumn("accepted", file_date("_digits").isNotNull()).select(
        *files.columns,
        *[F.when(accepted, part).alias(p) for p, part in day_texts("_digits").items()],
        "accepted",
    )


def day_texts(digits: str) -> dict[str, Column]:
    """Year, month and day of eight digits, zeros kept."""
    cuts = ((1, 4), (5, 2), (7, 2))
    return {
        part: F.substring(digits, start, length)
        for part, (start, length) in zip(DAY_PARTS, cuts)
    }


def layout_totals(laid_out: DataFrame) -> DataFrame:
    """One row: files taken and files left out."""
    return laid_out.agg(
        F.count(F.when(F.col("accepted"), 1)).alias("uploaded"),
        F.count(F.when(~F.col("accepted"), 1)).alias("skipped"),
    )


def land_deliveries(
    spark: SparkSession,
    inbox: str,
    raw_root: str,
    glob: str = "*.txt",
    encoding: str = ENCODING,
    delimiter: str = DELIMITER,
) -> DataFrame:
    """Write the inbox as ``year=/month=/day=/source_file=/load=`` text, and say what
    became of files.

    Path values keep their zeros.  The raw area only grows: each landing writes the
    files that are new or changed into folders of its own, their malformed lines to a
    table beside it, and at last a manifest with one row per file and landing.  Readers
    (``read_raw``, ``quarantined``) see the newest load of each file in the manifest,
    so a file that comes again replaces all it brought before, also when it is empty
    or malformed by now; a landing that fails half-way is not seen at all.  A file that
    comes again as it was is passed over.  Files without a valid date are not written;
    they show in the result with ``accepted`` false.  Landings run one at a time.
    """
    listed = list_files(spark, inbox, glob)
    laid_out = with_layout(listed)
    known = manifest(spark, raw_root)
    fresh = _changed(listed, _lines(spark, inbox, glob, encoding), newest(known))
    path = scratch_path(spark, "fresh")
    fresh.write.parquet(path)
    fresh = spark.read.schema(fresh.schema).parquet(path)
    number = (known.agg(F.max(F.split(LOAD, "-")[0].cast("bigint"))).first()[0] or 0) + 1
    load = F.lit(f"{number:010d}-{uuid.uuid4().hex[:8]}")
    layouts = header_layouts(spark, inbox, glob, encoding, delimiter)
    if layouts:
        rows = read_deliveries(
            spark, inbox, glob, encoding, delimiter, KEEP, layouts
        ).drop(*DAY_PARTS)
        file = F.element_at(F.split(SOURCE_FILE, "/"), -1)
        taken = rows.withColumn(SOURCE_FILE, file).join(fresh, SOURCE_FILE, "left_semi")
        dated = taken.withColumn("_digits", file_date_text(SOURCE_FILE))
        laid = dated.withColumns(day_texts("_digits")).drop("_digits").withColumn(LOAD, load)
        sound = laid.filter(F.col(MALFORMED).isNull()).drop(MALFORMED)
        write_deliveries(sound, raw_root, encoding, delimiter)
        bad = laid.filter(F.col(MALFORMED).isNotNull())
        bad.select(F.col(MALFORMED).alias("line"), SOURCE_FILE, LOAD).write.mode("append").parquet(
            raw_root.rstrip("/") + QUARANTINE
        )
    fresh.withColumn(LOAD, load).write.mode("append").parquet(raw_root.rstrip("/") + MANIFEST)
    return laid_out


def _changed(listed: DataFrame, lines: DataFrame, last: DataFrame) -> DataFrame:
    """``source_file``, ``digest``, ``lines`` of the dated files whose lines are not those
    that ``last`` has; the digest is a sum, partial before its shuffle."""
    name = F.coalesce(_in_path(SOURCE_FILE), F.element_at(F.split("path", "/"), -1))
    files = listed.select(name.alias(SOURCE_FILE)).distinct()
    dated = files.filter(file_date(file_date_text(SOURCE_FILE)).isNotNull())
    content = lines.groupBy(name.alias(SOURCE_FILE)).agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.xxhash64("line").cast("decimal(38,0)")).cast("string").alias("digest"),
    )
    found = dated.join(content, SOURCE_FILE, "left").select(
        SOURCE_FILE, F.coalesce("digest", F.lit("0")).alias("digest"),
        F.coalesce("lines", F.lit(0).cast("bigint")).alias("lines"),
    )
    same = ["digest", "lines", SOURCE_FILE]
    return found.join(last, same, "left_anti")


def manifest(spark: SparkSession, raw_root: str) -> DataFrame:
    """``source_file``, ``digest``, ``lines``, ``load`` of every file in every landing."""
    schema = f"{SOURCE_FILE} string, digest string, lines bigint, {LOAD} string"
    try:
        return spark.read.schema(schema).parquet(raw_root.rstrip("/") + MANIFEST)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def newest(landed: DataFrame) -> DataFrame:
    """The last row of each file of a manifest."""
    row = F.max_by(F.struct("digest", "lines", LOAD), LOAD).alias("row")
    return landed.groupBy(SOURCE_FILE).agg(row).select(SOURCE_FILE, "row.*")


def newest_loads(spark: SparkSession, raw_root: str) -> DataFrame:
    """``source_file`` and the ``load`` that readers of a raw area see of it."""
    return newest(manifest(spark, raw_root)).select(SOURCE_FILE, LOAD)


def read_raw(
    spark: SparkSession,
    raw_root: str,
    encoding: str = ENCODING,
    delimiter: str = DELIMITER,
    current: DataFrame | None = None,
) -> DataFrame:
    """The rows of a raw area as the manifest has them (see ``read_deliveries``), or of
    some of its files, given as rows of ``newest_loads``."""
    if current is None:
        current = newest_loads(spark, raw_root)
    return read_deliveries(spark, raw_root, "*.csv", encoding, delimiter, current=current)


def quarantined(spark: SparkSession, raw_root: str) -> DataFrame:
    """``source_file`` and ``line`` of the malformed lines beside a raw area."""
    found = spark.read.schema(f"line string, {SOURCE_FILE} string, {LOAD} string").parquet(
        raw_root.rstrip("/") + QUARANTINE
    )
    seen = found.join(newest_loads(spark, raw_root), [SOURCE_FILE, LOAD], "left_semi")
    return seen.select(SOURCE_FILE, "line")


def quarantine_counts(lines: DataFrame) -> DataFrame:
    """Malformed lines per file."""
    return lines.groupBy(SOURCE_FILE).agg(F.count(F.lit(1)).alias("lines"))


def write_deliveries(
    rows: DataFrame,
    root: str,
    encoding: str = ENCODING,
    delimiter: str = DELIMITER,
) -> None:
    """Delimited text by day, file and load (as far as there are such columns); the
    folders that come in replace the same folders, and no others.

    What is written is evened out, however large one file is.  A task that writes few
    files passes its rows on as they come and holds none of them.
    """
    folders = [c for c in (*DAY_PARTS, SOURCE_FILE, LOAD) if c in rows.columns]
    at_once = "spark.sql.maxConcurrentOutputFileWriters"
    with setting(rows.sparkSession, at_once, str(OPEN_FILES)):
        (
            rows.hint("rebalance", *folders)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .options(**_csv_options(delimiter, encoding))
            .partitionBy(*folders)
            .csv(root)
        )


# --- staging ---------------------------------------------------------------


def stage(
    raw: DataFrame,
    columns: Sequence[str],
    run_id: str,
    loaded_at: Column | None = None,
) -> DataFrame:
    """Typed, lower-case columns, the delivery date and the data of the run.

    Nothing is stored.  Give ``loaded_at`` for a repeatable result.
    """
    stamp = F.current_timestamp() if loaded_at is None else loaded_at
    day = checked_date(*[F.col(p) for p in DAY_PARTS])
    return raw.select(
        *[F.col(c).cast("string").alias(c.lower()) for c in columns],
        day.alias("effective_date"),
        F.col(SOURCE_FILE),
        stamp.alias("last_updated_dt"),
        F.lit(run_id).alias("invocation_id"),
    )


def with_day_parts(df: DataFrame, date: str = "effective_date") -> DataFrame:
    """Whole-number ``year``, ``month`` and ``day``, last, for partitioning."""
    return df.select(
        "*", *[F.date_part(F.lit(p), F.col(date)).cast("int").alias(p) for p in DAY_PARTS]
    )
