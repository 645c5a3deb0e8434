"""Keyed queries of the operators: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import chat, decontaminate, pivots
from strata.llm.alignment import alignment_digests
from strata.llm.bpe import encode_digests
from strata.llm.divergence import quality
from strata.llm.jaccard import similarity_components
from strata.llm.language import identify
from strata.llm.licenses import license_scan
from strata.llm.pii import span_report
from strata.llm.runs import run_digests
from strata.llm.substring import deduplicated
from strata.llm.tokens import token_counts
from strata.queries.tables import table


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_perspective_rotation(spark: SparkSession, folder: str) -> DataFrame:
    return chat.perspectives(table(spark, folder, "conversations"))


def op2_distribution_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return quality(table(spark, folder, "documents"))


def op3_two_tier_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"), _tokenizer("piece_bpe_32k.model"))


def op4_winnowing_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


def op5_streaming_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return encode_digests(table(spark, folder, "documents"), _tokenizer("word_bpe_49k.json"))


def op6_weak_supervision_pii(spark: SparkSession, folder: str) -> DataFrame:
    return span_report(table(spark, folder, "documents"))


def op7_subword_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return identify(table(spark, folder, "documents"))


def op8_patience_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan(table(spark, folder, "documents"))


def op9_partenum_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return similarity_components(table(spark, folder, "documents"), size=4, percent=85)


def op10_automaton_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return deduplicated(table(spark, folder, "documents"), span=35)


def scaled(vectors: DataFrame) -> DataFrame:
    """Components as floor(64 * x); a vector with one that is null, not finite or beyond a long is null."""
    finite = "not exists(embedding, x -> x is null or isnan(x) or abs(64 * double(x)) >= 9.2e18D)"
    whole = f"case when {finite} then transform(embedding, x -> floor(64 * double(x))) end"
    return vectors.selectExpr("vec_id", f"{whole} as embedding")


def op11_pivot_top_products(spark: SparkSession, folder: str) -> DataFrame:
    vectors = scaled(table(spark, folder, "embeddings"))
    return pivots.top_products(vectors, F.col("vec_id") % 20 == 0, k=20)


def op12_diagonal_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    models = _tokenizer("byte_bpe_50k.json"), _tokenizer("piece_bpe_32k.model")
    return alignment_digests(table(spark, folder, "documents"), *models)


def planted_repeats(docs: DataFrame) -> DataFrame:
    """The texts with the repeats that the contract of operator 13 writes into a tenth of them.

    Where h = crc32(doc_id as text) ends in 0, every word from number a = g % n on becomes word
    a + (i - a) % p, with g = h / 10 and p = 1 + (n - a) / (3 + g % 8) without remainders.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.array_remove(F.split("text", r"[ \t-\r]+"), "")
    rows = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"), F.floor(h / 10).alias("g"))
    rows = rows.withColumn("n", F.nullif(F.size("words"), F.lit(0)))
    rows = rows.selectExpr("*", "int(g % n) as a").selectExpr("*", "int(1 + (n - a) div (3 + g % 8)) as p")
    repeated = "flatten(array_repeat(slice(words, a + 1, p), int((n - a + p - 1) div p)))"
    written = f"array_join(concat(slice(words, 1, a), slice({repeated}, 1, n - a)), ' ')"
    return rows.selectExpr("doc_id", f"case when n > 0 then {written} else text end as text")


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return run_digests(planted_repeats(table(spark, folder, "documents")), least=6, times=4)


#: name -> (query, SQL twin or None)
QUERIES = {
    "op1_perspective_rotation": (op1_perspective_rotation, chat.SQL),
    "op2_distribution_divergence": (op2_distribution_divergence, None),
    "op3_two_tier_token_counts": (op3_two_tier_token_counts, None),
    "op4_winnowing_decontamination": (op4_winnowing_decontamination, decontaminate.SQL),
    "op5_streaming_bpe": (op5_streaming_bpe, None),
    "op6_weak_supervision_pii": (op6_weak_supervision_pii, None),
    "op7_subword_language_id": (op7_subword_language_id, None),
    "op8_patience_license_scan": (op8_patience_license_scan, None),
    "op9_partenum_jaccard": (op9_partenum_jaccard, None),
    "op10_automaton_substring_dedup": (op10_automaton_substring_dedup, None),
    "op11_pivot_top_products": (op11_pivot_top_products, pivots.SQL),
    "op12_diagonal_token_alignment": (op12_diagonal_token_alignment, None),
    "op13_periodic_runs": (op13_periodic_runs, None),
}
