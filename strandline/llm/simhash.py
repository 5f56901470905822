"""SimHash fingerprints of word shingles, linked by meet-in-the-middle balls.

Two fingerprints that differ in at most two bits share a variant that differs from
either in at most one.  So each distinct fingerprint emits itself and its 64
one-bit neighbours, equal variants meet in a shuffle, and what meets is verified.
At most 65 distinct fingerprints can emit one variant, however many documents
have them, so no group can grow.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.common import slices, utf8, written
from strandline.llm.components import components

SHINGLE = 3
SEED = 42
BITS = 64
RADIUS = 2
AT_ONCE = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Fingerprint of a UTF-8 text: a bit is set if it is in more than half of the
    hashes of its shingles, repeats included.  No words: 0."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    ends = ends[-n:]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, AT_ONCE):
        spans = zip(starts[at : min(n, at + AT_ONCE)].tolist(), ends[at : at + AT_ONCE].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``text_hash`` (of the text, null for null) and ``bits`` (the
    fingerprint as a signed long) for every row, from whole texts.

    A null or empty text has fingerprint 0.  Repeated rows stay repeated.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 2000):
                found = np.array([fingerprint(x) for x in utf8(batch.column(2))], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(found.view(np.int64))],
                    ["doc_id", "text_hash", "bits"],
                )

    picked = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.when(F.col(text).isNotNull(), F.xxhash64(text)).alias("text_hash"),
        F.col(text).alias("text"),
    )
    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(run, f"doc_id {kind}, text_hash bigint, bits bigint")


def _flip(bits: Column, at: int) -> Column:
    mask = 1 << at
    return bits.bitwiseXOR(F.lit(mask - (1 << BITS) if at == BITS - 1 else mask))


def links(distinct_bits: DataFrame) -> DataFrame:
    """``a``, ``b``: verified pairs of different fingerprints within two bits, enough
    of them to connect all that are linked.

    All members of one variant lie within two bits of each other, so a chain
    through them in order says as much as all their pairs.
    """
    bits = F.col("bits")
    variants = distinct_bits.select(
        "bits", F.explode(F.array(bits, *[_flip(bits, i) for i in range(BITS)])).alias("variant")
    )
    before = F.lag("bits").over(Window.partitionBy("variant").orderBy("bits"))
    return (
        variants.select("bits", before.alias("before"))
        .filter("before IS NOT NULL")
        .select(F.col("before").alias("a"), F.col("bits").alias("b"))
        .distinct()
        .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS)
    )


def groups(marked: DataFrame) -> DataFrame:
    """``bits``, ``first`` for every distinct fingerprint of ``marked`` (a table from
    ``fingerprints``): the smallest (doc_id, text_hash) that it reaches, nulls last."""
    row = F.struct(
        F.col("doc_id").isNull().alias("none"), F.col("doc_id"),
        F.col("text_hash").isNull().alias("no_text"), F.col("text_hash"),
    )
    own = written(marked.groupBy("bits").agg(F.min(row).alias("own")), "simhash-own")
    roots = components(links(own.select("bits")))
    linked = own.join(roots.withColumnRenamed("node", "bits"), "bits", "left").select(
        "bits", "own", F.coalesce("root", "bits").alias("root")
    )
    lowest = linked.groupBy("root").agg(F.min("own").alias("first"))
    return linked.join(lowest, "root").select("bits", "first")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` for
    every row: the smallest doc_id reachable over links of at most two bits.

    Texts without words share the fingerprint zero and are linked like any other.
    Rows without an id take part; a group of such rows alone has no component_id.
    An empty table gives no rows.
    """
    marked = written(fingerprints(docs, doc_id, text), "simhash")
    return marked.join(groups(marked), "bits").select(
        "doc_id",
        F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"),
        F.col("first.doc_id").alias("component_id"),
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, one of each group: the one with
    the smallest doc_id (ties: by the hash of the text, then any of equal rows)."""
    marked = written(fingerprints(docs, doc_id, text), "simhash")
    return first_rows(docs, groups(marked), doc_id, text)


def first_rows(docs: DataFrame, firsts: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The rows of ``docs`` that ``first`` (doc_id, text_hash) of ``firsts`` names, one
    of equal ones."""
    first = F.col("first")
    keys = ["id", "no_id", "hash", "no_text"]

    def keyed(df: DataFrame, at: Column, hashed: Column, *more: Column) -> DataFrame:
        zero = F.lit(0).cast("long")
        return df.select(
            F.coalesce(at.cast("string"), F.lit("")).alias("id"), at.isNull().alias("no_id"),
            F.coalesce(hashed, zero).alias("hash"), hashed.isNull().alias("no_text"), *more,
        )

    firsts = keyed(firsts, first["doc_id"], first["text_hash"]).distinct()
    hashed = F.when(F.col(text).isNotNull(), F.xxhash64(text))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    # Grouped first: a task sends one of equal rows, however often they are repeated.
    # The join has the same keys, so the texts are shuffled once.
    return (
        keyed(docs, F.col(doc_id), hashed, row)
        .groupBy(keys)
        .agg(F.first("row").alias("row"))
        .join(firsts, keys)
        .select("row.*")
    )
