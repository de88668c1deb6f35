"""The registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from natatio.llm.codebooks import compress_sql, compress_vectors, hex_codes
from natatio.llm.cotraining import quality_scores
from natatio.llm.decontaminate import find_leaks
from natatio.llm.katz import katz_scores
from natatio.llm.language import language_ids
from natatio.llm.lines import dedup_lines
from natatio.llm.maxscore import TOP_SQL, top_inner_products
from natatio.llm.mixing import standard_mix, standard_mix_sql
from natatio.llm.negatives import NEGATIVES_SQL, hard_negatives
from natatio.llm.pieces import encode_pieces
from natatio.llm.shared import shared_path, table
from natatio.llm.simhash import simhash_groups
from natatio.llm.simple8b import read_token_ids, token_digests, write_token_ids
from natatio.llm.substrings import kept_digests


def tokenizer_file() -> str:
    """The tokenizer that the registered queries use."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_quality_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How likely each document is good, by its words, by its metadata and by both."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    found = language_ids(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "lang_family", F.col("lang_score").alias("score"))


#: The mix asks for so much of all tokens, from so many epochs of a leaf at most.
MIX_SHARE, MIX_EPOCHS = 0.6, 4


def op3_mixing_to_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents the mix takes, in which epoch, and how many of their tokens."""
    mixed = standard_mix(table(spark, sf_dir, "documents"), MIX_SHARE, MIX_EPOCHS)
    return mixed.select("doc_id", "mix_domain", "lang", "source", "mix_epoch", "mix_tokens", "mix_taken")


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash_groups(table(spark, sf_dir, "documents"))


def op5_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Katz and add-half scores of every document."""
    return katz_scores(table(spark, sf_dir, "documents"))


def op6_maxscore_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors of every 50th."""
    return top_inner_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the blocks of lines it shares with earlier ones."""
    kept = dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op8_token_ids_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written to Simple-8b files and read back."""
    path = shared_path(spark, "token-ids")
    write_token_ids(table(spark, sf_dir, "documents"), path, tokenizer_file())
    return token_digests(read_token_ids(spark, path))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 50-word repeats of earlier ones."""
    return kept_digests(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a benchmark item, with its place and score."""
    found = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "score", "first_word", "end_word")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each of the five best positives of every 50th vector; every seventh label is moved on by one first."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every vector, by four codebooks of 256 entries."""
    coded, books = compress_vectors(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", hex_codes(F.col("codes")).alias("code"), "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def piece_file() -> str:
    """The model whose pieces the registered query codes by."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op13_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's piece ids and of the text they decode to."""
    coded = encode_pieces(table(spark, sf_dir, "documents"), piece_file(), decode=True)
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), digest(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"), digest(F.col("decoded")).alias("decoded_sha256"))


QUERIES = {
    "op1_quality_cotraining": op1_quality_cotraining,
    "op2_language_id": op2_language_id,
    "op3_mixing_to_weights": op3_mixing_to_weights,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_katz_backoff": op5_katz_backoff,
    "op6_maxscore_top_k": op6_maxscore_top_k,
    "op7_line_dedup": op7_line_dedup,
    "op8_token_ids_binary": op8_token_ids_binary,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_decontamination": op10_decontamination,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_vector_codes": op12_vector_codes,
    "op13_sentence_pieces": op13_sentence_pieces,
}

ORACLE: dict[str, str] = {
    "op6_maxscore_top_k": TOP_SQL,
    "op11_hard_negatives": NEGATIVES_SQL,
    "op12_vector_codes": compress_sql(),
    "op3_mixing_to_weights": standard_mix_sql(MIX_SHARE, MIX_EPOCHS),
}
