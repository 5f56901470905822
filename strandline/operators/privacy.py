"""Deterministic pseudonyms for name columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.expressions import digest_mod, has_text

# The marker, and per kind of name the hash prefix and the label.
MARKER = "DEMO "
COMPANY = ("ftg:", "AB")
ENTITY = ("ent:", "ENTITY")
PERSON = ("co:", "PERSON")
POOL = 10_000  # numbers of four digits

NameKinds = Mapping[str, tuple[str, str]]


def missing_columns(df: DataFrame, key: str, names: NameKinds) -> list[str]:
    have = {c.lower() for c in df.columns}
    return [c for c in (key, *names) if c.lower() not in have]


def _has_key(key: str) -> Column:
    return F.coalesce(F.col(key).cast("string") != "", F.lit(False))


def pseudonymise(
    df: DataFrame, key: str, names: NameKinds, where: Column | None = None
) -> DataFrame:
    """Replace every non-empty name by a pseudonym that depends on the key only.

    Empty names stay as they are, and so do rows without a key, or those that
    ``where`` leaves out.
    """
    lacking = missing_columns(df, key, names)
    if lacking:
        raise ValueError(f"missing columns: {', '.join(lacking)}")
    text = F.col(key).cast("string")
    wanted = _has_key(key) if where is None else _has_key(key) & where
    # The digest gets a column of its own, else it is computed once per digit.
    hashed = df.select(
        "*",
        *[
            F.when(
                has_text(name) & wanted, F.sha2(F.concat(F.lit(p), text), 256)
            ).alias(f"_sha_{name}")
            for name, (p, _) in names.items()
        ],
    )

    def pseudonym(name: str) -> Column:
        digest = F.col(f"_sha_{name}")
        number = F.lpad(digest_mod(digest, POOL).cast("string"), 4, "0")
        label = F.lit(f"{MARKER}{names[name][1]} ")
        return F.when(digest.isNotNull(), F.concat(label, number)).otherwise(
            F.col(name)
        )

    return hashed.select(
        *[pseudonym(c).alias(c) if c in names else F.col(c) for c in df.columns]
    )


def pseudonymisation_report(
    df: DataFrame, file: str, key: str, names: NameKinds
) -> DataFrame:
    """Per file: rows seen, rows to rewrite, and whether nothing is left to do.

    A file is done when it has names and all of them carry the marker.
    """
    named = F.lit(0)
    marked = F.lit(0)
    for name in names:
        marker = F.regexp_replace(F.col(name), r"^\s+", "").startswith(MARKER)
        named = named + has_text(name).cast("bigint")
        marked = marked + (has_text(name) & F.coalesce(marker, F.lit(False))).cast(
            "bigint"
        )
    counts = df.groupBy(file).agg(
        F.count(F.lit(1)).alias("rows_seen"),
        F.sum(named).alias("names"),
        F.sum(marked).alias("marked"),
    )
    done = (F.col("names") > 0) & (F.col("names") == F.col("marked"))
    return counts.select(
        file,
        "rows_seen",
        F.when(done, F.lit(0).cast("bigint"))
        .otherwise(F.col("rows_seen"))
        .alias("rows_rewritten"),
        done.alias("already_anonymised"),
    )


def pseudonymise_open_files(
    df: DataFrame, file: str, key: str, names: NameKinds
) -> DataFrame:
    """Pseudonymise all files but those that are already done.

    The report has one row per file; Spark decides by its size whether it is
    broadcast, and splits a file that owns most rows if it is not.
    """
    report = pseudonymisation_report(df, file, key, names).select(
        F.col(file).alias("_file"), F.col("already_anonymised").alias("_done")
    )
    known = df.join(report, F.col(file).eqNullSafe(F.col("_file")), "left")
    rewritten = pseudonymise(known, key, names, where=~F.col("_done"))
    return rewritten.select(*df.columns)
