"""Time windows over streams of events.

These follow Spark's own window rules with a watermark for late events; sessions
differ from the per-day sessions of the batch operator: they belong to a key, may
cross midnight, and a gap of exactly the limit does not split them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_TIME = "_event_time"
SPAN = "_span"
FILES_AT_ONCE = 1000  # files that one batch takes in, at most
FILE_ROWS = 1_000_000  # rows of a replayed file, about


def file_stream(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """Parquet files of a folder as a stream, with the schema they have now."""
    schema = spark.read.parquet(f"{folder}/{glob}").schema
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", FILES_AT_ONCE)
        .parquet(folder)
    )


def _timed(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    # Event time must carry a zone; the session is in UTC, so no instant moves.
    return stream.withColumn(EVENT_TIME, F.col(ts).cast("timestamp")).withWatermark(
        EVENT_TIME, delay
    )


def _flat(counts: DataFrame, window: str, keys: Sequence[str]) -> DataFrame:
    return counts.select(
        *keys,
        F.col(f"{window}.start").cast("timestamp_ntz").alias("window_start"),
        F.col(f"{window}.end").cast("timestamp_ntz").alias("window_end"),
        "number_of_services",
    )


def tumbling_counts(
    stream: DataFrame,
    ts: str,
    width: str,
    delay: str = "10 minutes",
    keys: Sequence[str] = (),
) -> DataFrame:
    counts = (
        _timed(stream, ts, delay)
        .groupBy(*keys, F.window(EVENT_TIME, width).alias("w"))
        .agg(F.count(F.lit(1)).alias("number_of_services"))
    )
    return _flat(counts, "w", keys)


def hopping_counts(
    stream: DataFrame,
    ts: str,
    size: str = "15 minutes",
    hop: str = "5 minutes",
    delay: str = "10 minutes",
    keys: Sequence[str] = (),
) -> DataFrame:
    counts = (
        _timed(stream, ts, delay)
        .groupBy(*keys, F.window(EVENT_TIME, size, hop).alias("w"))
        .agg(F.count(F.lit(1)).alias("number_of_services"))
    )
    return _flat(counts, "w", keys)


def session_counts(
    stream: DataFrame,
    ts: str,
    key: str,
    gap: str = "10 minutes",
    delay: str = "10 minutes",
) -> DataFrame:
    """Sessions per key; Spark has no streaming sessions without one."""
    counts = (
        _timed(stream, ts, delay)
        .groupBy(key, F.session_window(EVENT_TIME, gap).alias("w"))
        .agg(F.count(F.lit(1)).alias("number_of_services"))
    )
    return _flat(counts, "w", [key])


def append_to(counts: DataFrame, path: str, checkpoint: str, once: bool = True):
    """Write each window when the watermark has passed it, and only then."""
    writer = (
        counts.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def replay(
    rows: DataFrame,
    ts: str,
    counts_of: Callable[[DataFrame], DataFrame],
    root: str,
    parts: int = 2,
) -> DataFrame:
    """Windows of stored rows as a stream in append mode gives them, batch by batch.

    Rows are delivered in spans of time, one after the other: at least ``parts`` of
    about the same number of rows, more for tables of many rows.  A span is one batch,
    so no event comes after the watermark has passed it.  A last record, two days
    later, moves the watermark past all windows, so each is written once and its
    state dropped; the window of that record stays open.
    """
    spark = rows.sparkSession
    inbox, out = f"{root}/inbox", f"{root}/windows"
    at = F.col(ts)
    first, last, n = rows.agg(F.min(at), F.max(at), F.count(at)).first()
    if first is None:
        return counts_of(rows)
    parts = max(parts, -(-n // (FILES_AT_ONCE * FILE_ROWS)))
    shares = [i / parts for i in range(1, parts)]
    inner = rows.agg(F.percentile_approx(at, shares, 10 * parts + 1000)).first()[0] if shares else []
    cuts = sorted({first, *inner})
    span = sum([(at >= F.lit(c)).cast("int") for c in cuts[1:]], F.lit(0)).alias(SPAN)
    staged = f"{root}/staged"
    # All spans are told apart in one pass; each is read alone.
    rows.filter(at.isNotNull()).select("*", span).write.partitionBy(SPAN).parquet(staged)
    closing = last + timedelta(days=2)
    late = spark.range(1).select(
        *[
            F.lit(closing if f.name == ts else None).cast(f.dataType).alias(f.name)
            for f in rows.schema.fields
        ]
    )
    stored = spark.read.schema(rows.select("*", span).schema).parquet(staged)
    spans = [stored.filter(F.col(SPAN) == i).drop(SPAN) for i in range(len(cuts))]
    for part in (*spans, late):
        # No more files than one batch takes.
        files = part.coalesce(FILES_AT_ONCE).write.option("maxRecordsPerFile", 0)
        files.mode("append").parquet(inbox)
        counts = counts_of(file_stream(spark, inbox, "*.parquet"))
        append_to(counts, out, f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(out)


def run_to_end(counts: DataFrame, root: str) -> DataFrame:
    """Process what is there and return all windows, also those still open."""

    def replace(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/windows")

    (
        counts.writeStream.outputMode("complete")
        .foreachBatch(replace)
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return counts.sparkSession.read.parquet(f"{root}/windows")
