"""From raw documents to token ids: the pipeline over the operators of strandline.llm."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import decontaminate, language, sentencepieces, simhash, toxicity
from strandline.llm.common import table, written
from strandline.llm.queries import tokenizer_file

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A language that the network gives a smaller share than this is a guess.
SURE_LANGUAGE = 0.3


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity below the threshold stay, all columns as they are.

    The model learns from all labelled rows of ``docs``.  Null and empty texts stay.
    """
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return docs.filter(toxicity.scorer(model)(F.col("text")) < toxicity.TOXIC_AT)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the labelled languages stay, all columns as they are; texts
    that are null, without a letter, or in no language more than in others, go."""
    found = language.identifier(language.train(docs))(F.col("text"))
    return docs.filter(found["score"] >= SURE_LANGUAGE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (SimHash of three-word shingles, links
    of at most two bits) stays, that with the smallest id, all columns as they are."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of the benchmark stay, all columns as they are."""
    clean = F.lit(True)
    for phrases in decontaminate.blocks(table(spark, sf_dir, "benchmark"), "item_id", "text"):
        clean = clean & (F.size(decontaminate.finder(phrases)(F.col("text"))["begins"]) == 0)
    return docs.filter(clean)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left: ``doc_id``, ``ids``, ``n_tokens`` and digests."""
    return sentencepieces.encoded(docs, tokenizer_file("piece_bpe_32k.model"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxic),
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", tokens),
]

# No stage can be said in SQL: each applies a trained model, a hash or a library's
# tokens.  The tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
