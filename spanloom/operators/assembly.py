"""Documents from their chunks, and the rows that are written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reassembled(chunks: DataFrame) -> DataFrame:
    """(doc_id, text, total_chunks): chunk texts in order without separators, of documents whose chunks are all there."""
    whole = chunks.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("chunk_id", "text"))).alias("parts"), F.max("total_chunks").alias("total_chunks"))
    whole = whole.where(F.size("parts") == F.col("total_chunks"))
    return whole.select("doc_id", F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"), "total_chunks")


def incomplete(chunks: DataFrame) -> DataFrame:
    """(doc_id, chunks, total_chunks) of documents that lack a chunk."""
    return chunks.groupBy("doc_id").agg(F.count("*").alias("chunks"), F.max("total_chunks").alias("total_chunks")).where("chunks <> total_chunks")


def document_entities(entities: DataFrame) -> DataFrame:
    """(doc_id, entities): a document's entities in order of chunk and place."""
    row = F.struct("chunk_id", "ent_idx", F.concat_ws(":", "type", "text").alias("entity"))
    out = entities.groupBy("doc_id").agg(F.array_sort(F.collect_list(row)).alias("e"))
    return out.select("doc_id", F.array_join(F.transform("e", lambda x: x["entity"]), "|").alias("entities"), F.size("e").cast("long").alias("n_entities"))


def without_repeats(entities: DataFrame) -> DataFrame:
    """One row per place and type: for chunks that overlap."""
    return entities.dropDuplicates(["doc_id", "type", "start_pos", "end_pos"])


def output_rows(entities: DataFrame, confidence: bool = True, positions: bool = True) -> DataFrame:
    """The rows of the result table; ``text`` and the places are the final ones."""
    columns = [F.col("doc_id"), F.coalesce("type", F.lit("MISC")).alias("entity_type"), F.col("text").alias("entity_text")]
    if confidence:
        columns.append(F.coalesce(F.round("confidence", 4), F.lit(0.5)).alias("confidence"))
    if positions:
        columns += [F.coalesce(F.col(c), F.lit(0)).cast("int").alias(c) for c in ("start_pos", "end_pos")]
    return entities.select(*columns)
