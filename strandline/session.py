"""Session defaults, and the shared folder that long lineages are cut into."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

UTC_NAMES = {"UTC", "Etc/UTC", "GMT", "Z", "+00:00"}

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    # Checkpoints go when the frames that use them are gone.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Sessions of a busy key are merged before they are shuffled.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build_session(
    app: str = "strandline", master: str | None = None, **settings: str
) -> SparkSession:
    """A session with the defaults this package relies on.

    ``settings`` uses ``__`` for the dots of a Spark option name.  The master is
    left to ``spark-submit`` unless one is given.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in DEFAULTS.items():
        builder = builder.config(name, value)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A Spark option for what runs inside; after it the option is as it was."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def require_utc(df: DataFrame) -> None:
    """Time arithmetic goes through epoch microseconds, so the session is UTC."""
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_NAMES:
        raise ValueError(
            f"spark.sql.session.timeZone is {zone!r}; time windows need 'UTC'"
        )


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which all executors reach.

    Only a local session without that setting gets a temporary folder of its
    own; anywhere else a missing setting is an error, because a folder on one
    machine would be lost with it.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    already = context.getCheckpointDir()
    if already:
        return already
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="strandline-")
    context.setCheckpointDir(made)
    return made


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives the loss of executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
