"""What the operators share: tables, folds, bounded samples, tables in between."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.session import scratch_path, setting

#: Shuffle files go when the job that wrote them is done.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """``crc32`` of the id as text, modulo ``folds`` (a null id counts as '')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, and safe
    from the loss of executors.  What it shuffled does not stay on disk."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with setting(spark, TIDY, "true"):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, rows: int, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch of at most ``rows`` rows and about ``size`` bytes."""
    if batch.num_rows == 0:
        return
    each = max(1, min(rows, int(batch.num_rows * size / max(1, batch.nbytes))))
    for at in range(0, batch.num_rows, each):
        yield batch.slice(at, each)
    # Workers serve many tasks: what Arrow no longer needs goes back.
    pa.default_memory_pool().release_unused()


def utf8(texts: pa.Array) -> list[bytes]:
    """The texts as UTF-8; null reads as empty."""
    if not pa.types.is_large_binary(texts.type):
        texts = texts.cast(pa.large_string()).cast(pa.large_binary())
    return [x or b"" for x in texts.to_pylist()]


def flat_utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts in one array, and where each text begins and ends."""
    whole = pa.concat_arrays([texts.cast(pa.large_string()).fill_null("")])
    _, offsets, data = whole.buffers()
    bounds = np.frombuffer(offsets, np.int64)[whole.offset : whole.offset + len(whole) + 1]
    if len(whole) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(whole) + 1, np.int64)
    flat = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]]
    return flat, bounds - bounds[0]


def smallest_by_hash(df: DataFrame, key: Column, n: int) -> DataFrame:
    """About ``n`` rows of ``df``, always the same ones: those whose hashed key is
    smallest.  Only the hash is sorted; the rows are picked by its n-th value."""
    hashed = F.xxhash64(key)
    cut = df.select(hashed.alias("h")).orderBy("h").limit(n).agg(F.max("h")).first()[0]
    return df.filter(hashed <= F.lit(cut)) if cut is not None else df.filter(F.lit(False))
