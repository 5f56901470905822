"""Checks on one relation.  A check is a DataFrame of failures: empty is good."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

ERROR, WARN = "error", "warn"
PASSED, WARNED, FAILED = "pass", "warn", "fail"
NOT_NULL, UNIQUE = "not_null", "unique"
AUDIT = "failures"


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; unknown values do not count."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("unique_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


@dataclass(frozen=True)
class Check:
    """``failures`` gives the offending rows; ``store`` keeps them for reading."""

    name: str
    failures: Callable[[], DataFrame]
    severity: str = ERROR
    store: bool = False


@dataclass(frozen=True)
class Rule:
    """What one column must be: ``NOT_NULL`` or ``UNIQUE``."""

    name: str
    kind: str
    column: str
    severity: str = ERROR
    store: bool = False


@dataclass(frozen=True)
class Outcome:
    name: str
    status: str
    failures: int


def run_checks(
    spark: SparkSession, checks: Iterable[Check], audit_root: str | None = None
) -> list[Outcome]:
    """Count the failures of every check and keep those that are to be stored.

    Stored failures replace those of the run before and are counted from what
    was written, so the check itself runs once.
    """
    outcomes = []
    for check in checks:
        if check.severity not in (ERROR, WARN):
            raise ValueError(f"unknown severity: {check.severity!r}")
        rows = check.failures()
        if check.store:
            if audit_root is None:
                raise ValueError(f"check {check.name!r} stores rows: give audit_root")
            path = f"{audit_root.rstrip('/')}/{check.name}"
            rows.write.mode("overwrite").parquet(path)
            rows = spark.read.parquet(path)
        failed = rows.count()
        bad = FAILED if check.severity == ERROR else WARNED
        outcomes.append(Outcome(check.name, bad if failed else PASSED, failed))
    return outcomes


def run_rules(df: DataFrame, rules: Sequence[Rule], audit_root: str) -> list[Outcome]:
    """All rules in one scan of ``df``: one grouping set for each, so rows are counted
    before the shuffle, and busy values or many nulls cost one row per task.

    Failures go to one table below ``audit_root`` by rule, read by ``stored``; they
    replace those of the run before, and are counted from there.  A rule that does not
    store its values keeps their numbers only.  An empty ``df`` passes.
    """
    for rule in rules:
        if rule.severity not in (ERROR, WARN):
            raise ValueError(f"unknown severity: {rule.severity!r}")
        if rule.kind not in (NOT_NULL, UNIQUE):
            raise ValueError(f"unknown kind of rule: {rule.kind!r}")
    names = [f"v{i}" for i in range(len(rules))]
    seen = df.select(*[
        (F.col(r.column) if r.kind == UNIQUE else F.when(F.col(r.column).isNull(), True)).alias(v)
        for r, v in zip(rules, names)
    ])
    ones = (1 << len(rules)) - 1
    counted = seen.groupingSets([[v] for v in names], *names).agg(
        F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("n_records")
    )
    which, bad = F.lit(None).cast("string"), F.lit(False)
    for i, (rule, v) in enumerate(zip(rules, names)):
        own = F.col("_set") == ones - (1 << (len(rules) - 1 - i))
        which = F.when(own, F.lit(rule.name)).otherwise(which)
        # A rule against nulls sees true where there is one, and null elsewhere.
        wrong = F.col(v).isNotNull()
        bad = bad | (own & (wrong if rule.kind == NOT_NULL else wrong & (F.col("n_records") > 1)))
    failures = counted.filter(bad).select(which.alias("rule"), *names, "n_records")
    path = f"{audit_root.rstrip('/')}/{AUDIT}"
    kept = [F.when(F.lit(r.store), F.col(v)).alias(v) for r, v in zip(rules, names)]
    failures.select("rule", *kept, "n_records").write.mode("overwrite").partitionBy("rule").parquet(path)
    read = df.sparkSession.read.schema(failures.schema).parquet(path)
    found = {
        r[0]: (r[1], r[2])
        for r in read.groupBy("rule").agg(F.count(F.lit(1)), F.sum("n_records")).collect()
    }
    outcomes = []
    for rule in rules:
        failed = found.get(rule.name, (0, 0))[rule.kind == NOT_NULL]
        worst = FAILED if rule.severity == ERROR else WARNED
        outcomes.append(Outcome(rule.name, worst if failed else PASSED, failed))
    return outcomes


def stored(df: DataFrame, rules: Sequence[Rule], audit_root: str, name: str) -> DataFrame:
    """``unique_field``, ``n_records``: what the last run over ``df`` kept of one rule."""
    rule = next(r for r in rules if r.name == name)
    field = StructField(f"v{list(rules).index(rule)}", df.schema[rule.column].dataType)
    schema = StructType([field]).add("n_records", LongType()).add("rule", StringType())
    rows = df.sparkSession.read.schema(schema).parquet(f"{audit_root.rstrip('/')}/{AUDIT}")
    return rows.filter(F.col("rule") == name).select(
        F.col(field.name).alias("unique_field"), "n_records"
    )
