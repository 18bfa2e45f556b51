"""The queries of this subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

import os

from spanloom.llm import chat_format, decontamination, embedding_dedup, language_id, line_templates, minhash_dedup, mixing, oracle, secret_scan, suffix_dedup, token_counts
from spanloom.llm.common import table

#: Where the vocabulary files of public tokenizers are.
TOKENIZERS = os.environ.get("TOKENIZER_FILES", "")


def vocabulary(name: str) -> str:
    """The place of a vocabulary file, by the package that brings them unless a folder is set."""
    if TOKENIZERS:
        return os.path.join(TOKENIZERS, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


QUERIES = {
    "op1_minhash_dedup": lambda spark, sf_dir: minhash_dedup.near_duplicates(table(spark, sf_dir, "documents")),
    "op2_secret_scan": lambda spark, sf_dir: secret_scan.digest(table(spark, sf_dir, "documents")),
    "op3_mixing": lambda spark, sf_dir: mixing.digest(table(spark, sf_dir, "documents")),
    "op4_language_id": lambda spark, sf_dir: language_id.digest(table(spark, sf_dir, "documents")),
    "op5_chat_format": lambda spark, sf_dir: chat_format.digest(table(spark, sf_dir, "conversations"), vocabulary("byte_bpe_50k.json")),
    "op6_embedding_dedup": lambda spark, sf_dir: embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings")),
    "op7_line_templates": lambda spark, sf_dir: line_templates.digest(table(spark, sf_dir, "documents")),
    "op8_decontamination": lambda spark, sf_dir: decontamination.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")),
    "op9_token_counts": lambda spark, sf_dir: token_counts.digest(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json")),
    "op10_suffix_dedup": lambda spark, sf_dir: suffix_dedup.digest(table(spark, sf_dir, "documents")),
}

ORACLE_SQL: dict[str, str] = {
    "op1_minhash_dedup": oracle.MINHASH,
    "op2_secret_scan": oracle.secrets(),
    "op3_mixing": mixing.ORACLE_SQL,
    "op6_embedding_dedup": oracle.EMBEDDING,
    "op7_line_templates": oracle.LINES,
    "op8_decontamination": decontamination.ORACLE_SQL,
    "op10_suffix_dedup": oracle.SUFFIX,
}
