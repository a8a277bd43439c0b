"""The operators as queries over the given tables: (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemart.llm import covers, decontaminate, langid, packing, pages, quality, repeats, secrets, simhash, tokens, turns, urls, vantage
from tidemart.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = langid.identified(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", langid.held_out().alias("held_out"), "_lang.*")


def op2_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.apply_policy(quality.ledger(table(spark, sf_dir, "documents")), quality.V1)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "failed",
    )


def op3_secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secrets.with_spans(table(spark, sf_dir, "documents"))
    text = "transform({}, x -> concat_ws(':', x.kind, x.start, x.end))"
    strong = f"filter(spans, x -> x.kind IN {secrets.STRONG})"
    return rows.select(
        "doc_id",
        *[F.expr(f"cast(size(filter(spans, x -> x.kind = '{k}')) AS bigint)").alias(f"n_{k}") for k in secrets.STRONG],
        F.sha2(F.array_join(F.expr(text.format(strong)), ","), 256).alias("base_sha256"),
        F.array_join(F.expr(text.format("spans")), ",").alias("spans"),
    )


def op4_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pages.extracted(table(spark, sf_dir, "pages"))
    return rows.select("page_id", "url", F.col("_text").alias("text"), F.length("_text").cast("long").alias("n_chars"))


def op5_simhash_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tokens.token_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return rows.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


def op7_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"))


def op8_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(table(spark, sf_dir, "documents"))


def op9_packed_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op10_benchmark_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op11_vantage_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vantage.digest(*vantage.clustered(table(spark, sf_dir, "embeddings")))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = turns.damaged(table(spark, sf_dir, "conversations"))
    return turns.digest(rows, turns.faults(rows))


def op13_cover_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covers.digest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        op1_language_centroids, op2_quality_ledger, op3_secret_links, op4_page_text, op5_simhash_variants, op6_token_counts,
        op7_url_cascade, op8_repeated_strings, op9_packed_groups, op10_benchmark_winnowing,
        op11_vantage_centroids, op12_turn_repair, op13_cover_passages,
    )
}
