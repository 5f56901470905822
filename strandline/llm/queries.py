"""One query for each operator, over its whole table, and its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import (
    brown,
    decontaminate,
    html_text,
    jaccard_join,
    language,
    order_minhash,
    sentencepieces,
    simhash,
    spelling,
    token_counts,
    toxicity,
    warc,
    whitening,
)
from strandline.llm.common import fold, table

TOKEN_LIMIT = 512


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.fingerprints(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold(F.col("doc_id"), 4) == 2
    network = language.train(docs, ~held_out)
    found = docs.select(
        "doc_id", held_out.alias("held_out"), language.identifier(network)(F.col("text")).alias("found")
    )
    return found.select(
        "doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score")
    )


def tokenizer_file(name: str) -> str:
    """Where the file of a public tokenizer is, on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    file = tokenizer_file("byte_bpe_50k.json")
    return token_counts.token_counts(table(spark, sf_dir, "documents"), file, TOKEN_LIMIT)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tokenizer_file("piece_bpe_32k.model")
    found = sentencepieces.encoded(table(spark, sf_dir, "documents"), model)
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    archive = warc.archived(pages)
    entries = warc.captures(archive, pages.select("url"))
    return warc.read_back(archive, entries).drop("payload", "url")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["past"] - x["first"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 3) == 1
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = docs.select(
        "doc_id", held_out.alias("held_out"), toxicity.scorer(model)("text").alias("score")
    )
    toxic = F.col("score") >= toxicity.TOXIC_AT
    return scored.withColumn("predicted", toxic.cast("int"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 7) == 2
    return brown.language_model(docs, ~held_out).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score",
    )


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whitened(table(spark, sf_dir, "embeddings"))
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "value")
    return found.select(
        "vec_id", "n", F.expr("try_cast(deviation AS bigint)").alias("deviation"),
        "identity_error", each,
    ).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation",
        "value.whitened", "value.explained", "identity_error",
    )


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_order_minhash": op1_order_minhash,
    "op2_language_id": op2_language_id,
    "op3_token_counts": op3_token_counts,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_warc": op5_warc,
    "op6_decontamination": op6_decontamination,
    "op7_toxicity": op7_toxicity,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_html_text": op10_html_text,
    "op11_whitening": op11_whitening,
    "op12_spelling": op12_spelling,
    "op13_jaccard_join": op13_jaccard_join,
}

ORACLE: dict[str, str] = {
    "op5_warc": """
        WITH payloads AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
        ), marked AS (
            SELECT page_id, octet_length(payload) AS n, sha256(payload) AS digest FROM payloads
        ), firsts AS (
            SELECT digest, min(page_id) AS first FROM marked WHERE n >= 100 GROUP BY digest
        )
        SELECT page_id, n AS payload_bytes, m.digest AS payload_digest,
               CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END
                   AS record_type,
               CASE WHEN first <> page_id THEN first END AS refers_to
        FROM marked m LEFT JOIN firsts f ON m.digest = f.digest AND m.n >= 100
    """,
}
