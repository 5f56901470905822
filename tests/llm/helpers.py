"""A small corpus with every edge that the operators must bear, and its readers."""

from __future__ import annotations

import random
import zlib

from pyspark.sql import DataFrame, SparkSession

SYLLABLES = {
    "en": "the th ing er on an re ed nd ha en of and to st sh wh ly tion".split(),
    "de": "sch ein ung lich keit ge be ver en zu au ach ie ß ä der die und".split(),
    "fr": "que eau eux tion ment ré é è le la de ou oi ai elle".split(),
}
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(rng: random.Random, lang: str, n: int) -> str:
    parts = SYLLABLES[lang]
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(n))


def rows(n: int = 120, seed: int = 1) -> list[tuple]:
    """Prose, exact and near copies, then nulls, blanks, junk, and repeated rows."""
    rng = random.Random(seed)
    texts: list[tuple[str | None, str | None]] = []
    for _ in range(n):
        lang = rng.choice(list(SYLLABLES))
        texts.append((prose(rng, lang, rng.choice([1, 2, 5, 40, 120])), lang))
    long = prose(rng, "en", 150)
    texts += [(long, "en")] * 3 + [(long.replace("the", "THE"), "en"), (long + " again", "en")]
    texts += [(None, "en"), ("", None), (" \t\n", "de"), ("?!? 123", "fr"), ("漢字 😀 ▁x\x00y", None)]
    texts += [("a", "en"), ("word " * 3000, "en"), ("x" * 4000, "en"), ("line one\r\nline\ttwo  ", "en")]
    out = [(i * 3 - 5, t, lang, f"s{i % 3}", None) for i, (t, lang) in enumerate(texts)]
    out += [out[0], out[0], (None, "no id at all", "en", None, 5), (None, None, None, None, None)]
    rng.shuffle(out)
    return out


def documents(spark: SparkSession, data: list[tuple] | None = None) -> DataFrame:
    """The corpus with further columns whose names operators use for results."""
    df = spark.createDataFrame(rows() if data is None else data, SCHEMA)
    clash = ["score", "fingerprint", "row", "word", "bits", "text_hash", "signature", "ids", "n", "copy"]
    return df.selectExpr("*", *[f"'x' AS {c}" for c in clash]).repartition(3)


def fold(doc_id: int | None, folds: int) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % folds


def bag(df: DataFrame, *columns: str) -> list[tuple]:
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, str(v)) for v in r])


def same(found: list[tuple], expected: list[tuple]) -> None:
    key = lambda r: [(v is not None, str(v)) for v in r]
    assert sorted(found, key=key) == sorted(expected, key=key)
