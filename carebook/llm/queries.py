"""Registered queries of the operators: ``opN_<name>(spark, sf_dir)``, and ``pipeline``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from carebook.llm import (bit_sliced, chat, decontaminate, filter_audit, hamming_search, language, licenses, line_templates, packing, prefix_trie, secrets,
                          simhash, simhash_sql, token_files)
from carebook.llm.common import table
from carebook.session import fresh_dir

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written as token files and digested from them."""
    path = fresh_dir(spark, "llm-tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, TOKENIZER, end_id=2)
    return token_files.token_digests(token_files.read_tokens(spark, path))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of every document: 3-word shingles, at most 2 differing bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_distance=2).select(
        "doc_id", "fingerprint", "component_id")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a copy, verbatim or edited, of a benchmark item."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


def op4_bit_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best other vectors of every twentieth vector, by inner product of quantised components."""
    return bit_sliced.top_k(table(spark, sf_dir, "embeddings"), every=20, k=20)


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from every participant's perspective, turn by turn."""
    return chat.rotate(table(spark, sf_dir, "conversations"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from two thirds of them."""
    return language.identify(table(spark, sf_dir, "documents")).select(
        "doc_id", "held_out", "lang_pred", "score", "rejected", "entropy", "symbols")


def op7_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines whose template an earlier document has."""
    found = line_templates.deduplicated(table(spark, sf_dir, "documents"))
    return found.select("row.doc_id", "text", "lines", "lines_dropped")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and spans."""
    return secrets.secret_digests(secrets.find_secrets(table(spark, sf_dir, "documents")))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document, as a file of a directory tree."""
    return licenses.licences(licenses.standin_paths(table(spark, sf_dir, "documents")))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of a power of two of at most 2048 ids."""
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER, end_id=1, max_length=2048).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations, one row per node."""
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in every order, per source."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_hamming_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest other vectors of every fiftieth vector, by cosine."""
    return hamming_search.nearest(table(spark, sf_dir, "embeddings"), every=50, k=5)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": op1_token_files,
    "op2_simhash": op2_simhash,
    "op3_decontaminate": op3_decontaminate,
    "op4_bit_sliced": op4_bit_sliced,
    "op5_chat": op5_chat,
    "op6_language": op6_language,
    "op7_line_templates": op7_line_templates,
    "op8_secrets": op8_secrets,
    "op9_licenses": op9_licenses,
    "op10_packing": op10_packing,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_filter_audit": op12_filter_audit,
    "op13_hamming_search": op13_hamming_search,
}

ORACLE_SQL: dict[str, str] = {
    "op2_simhash": simhash_sql.oracle(shingle=3, max_distance=2),
    "op4_bit_sliced": bit_sliced.ORACLE,
    "op5_chat": chat.ORACLE,
    "op7_line_templates": line_templates.ORACLE,
    "op8_secrets": secrets.ORACLE,
    "op11_prefix_trie": prefix_trie.ORACLE,
    "op12_filter_audit": filter_audit.ORACLE,
}
