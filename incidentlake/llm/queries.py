"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incidentlake.llm import embedding_join, license_scan, packing, periodic_runs, secret_scan, sql, vector_codes
from incidentlake.llm._stored import scratch_path
from incidentlake.llm.language_id import identify
from incidentlake.llm.line_dedup import PASSAGE_WORDS, drop_repeated_lines
from incidentlake.llm.mixing import mix
from incidentlake.llm.ngram_join import near_duplicates
from incidentlake.llm.piece_codec import encode_and_check
from incidentlake.llm.quality import apply_rules
from incidentlake.llm.token_counts import token_counts


def _read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet").select(*columns)


def op1_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents", "doc_id", "text")
    return encode_and_check(docs, str(public_tokenizers.path("piece_bpe_32k.model")))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_read(spark, sf_dir, "documents", "doc_id", "text"), str(public_tokenizers.path("byte_bpe_50k.json")))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_read(spark, sf_dir, "documents", "doc_id", "text"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept".split()
    return apply_rules(_read(spark, sf_dir, "documents", "doc_id", "text")).select(*columns)


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table against a new ledger."""
    docs = _read(spark, sf_dir, "documents", "doc_id", "text")
    scanned = secret_scan.scan_versions(docs, scratch_path(spark, "secret-ledger"))
    return secret_scan.digest(scanned).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op8_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents", "doc_id", "text")
    columns = "doc_id n_words n_base first_word last_word base_labels labels score".split()
    return license_scan.digest(license_scan.scan_licenses(docs)).select(*columns)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents", "doc_id", "source", "text")
    return mix(docs, keep_text=False).select("doc_id", "size", "source_size", "target", "taken", "source")


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.near_duplicates(_read(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated_lines(_read(spark, sf_dir, "documents", "doc_id", "text"), min_words=PASSAGE_WORDS)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return identify(docs).select("doc_id", "held_out", "lang_pred", "score")


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents", "doc_id", "text")
    pieces = packing.token_pieces(docs, str(public_tokenizers.path("word_bpe_49k.json")))
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(_read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.repeat_tails(_read(spark, sf_dir, "documents", "doc_id", "text"))
    return periodic_runs.digest(periodic_runs.find_runs(docs, keep_text=False))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return sql.ORACLE
