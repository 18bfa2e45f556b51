"""The extraction plan: documents to entity rows, without a shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from spanloom.functions import cleaning, expansion
from spanloom.functions.expansion import ExpansionConfig
from spanloom.operators import assembly, chunking, grouping, metrics, tagging

Tagger = Callable[[DataFrame], DataFrame]


def tagged(docs: DataFrame, max_tokens: int = 512, overlap_ratio: float = 0.0, tagger: Tagger = tagging.rule, tokens: chunking.Tokens = chunking.tokens) -> DataFrame:
    """Chunk rows with predictions. The rule needs no list of the pattern's tokens."""
    if tagger is tagging.rule and tokens is chunking.tokens:
        tagger = tagging.rule_of_text
    return tagger(chunking.chunk_rows(docs, max_tokens, overlap_ratio, tokens))


def grouped(docs: DataFrame, min_confidence: float = 0.5, **chunked) -> DataFrame:
    """Chunk rows with entities."""
    return grouping.with_entities(kept(docs, min_confidence, **chunked))


def kept(docs: DataFrame, min_confidence: float = 0.5, max_tokens: int = 512, overlap_ratio: float = 0.0, tagger: Tagger = tagging.rule, tokens: chunking.Tokens = chunking.tokens) -> DataFrame:
    """Chunk rows with the predictions of that score or more, at their places in the document."""
    if tagger is tagging.rule and tokens is chunking.tokens:
        return tagging.rule_of_text(chunking.chunk_rows(docs, max_tokens, overlap_ratio, tokens), min_confidence)
    return tagging.shifted(tagging.confident(tagged(docs, max_tokens, overlap_ratio, tagger, tokens), min_confidence))


def final_entities(entities: DataFrame, config: ExpansionConfig = ExpansionConfig(), unicode: bool = True) -> DataFrame:
    """Entity rows with their final text and places; entities of other types stay as they are."""
    rows = expansion.expanded(entities, config)
    text = F.col("new_text")
    if config.enable_final_cleaning:
        text = F.when(expansion.eligible(config), cleaning.cleaned(text, F.col("type"), config.enable_beginning_cleaning, unicode)).otherwise(text)
    rows = rows.withColumn("final_text", text)
    return rows.select(
        "doc_id",
        "chunk_id",
        "ent_idx",
        F.col("final_text").alias("text"),
        "type",
        "confidence",
        F.col("new_start").alias("start_pos"),
        F.col("new_end").alias("end_pos"),
        "changed",
        "kind",
        (F.col("final_text") != F.col("new_text")).alias("cleaned"),
        F.col("inside").alias("original_text"),
    )


def extract(docs: DataFrame, expand: bool = True, config: ExpansionConfig = ExpansionConfig(), confidence: bool = True, positions: bool = True, unicode: bool = True, seen: Observation | None = None, **options) -> DataFrame:
    """The rows of the result table for ``docs`` (doc_id, text); ``seen`` gets the counts of chunks and entities when they are made."""
    chunks = grouped(docs, **options)
    entities = grouping.entity_rows(metrics.observed_chunks(chunks, seen) if seen else chunks)
    if expand:
        entities = final_entities(entities, config, unicode)
    return assembly.output_rows(entities, confidence, positions)
