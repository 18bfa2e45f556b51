"""Statistics of a run, as aggregates over its tables."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from spanloom.sources.files import Files


def entities_by_type(entities: DataFrame) -> DataFrame:
    return entities.groupBy(F.col("type").alias("entity_type")).agg(F.count("*").alias("entities"))


def chunk_stats(chunks: DataFrame) -> DataFrame:
    """One row: documents, chunks, tokens and documents of several chunks."""
    first = F.col("chunk_id") == 0
    return chunks.agg(
        F.count_if(first).alias("documents"),
        F.count("*").alias("chunks"),
        F.coalesce(F.sum("token_count"), F.lit(0)).cast("long").alias("tokens"),
        F.count_if(first & (F.col("total_chunks") > 1)).alias("long_documents"),
    )


def run_stats(grouped: DataFrame) -> DataFrame:
    """One row over chunk rows with entities: the counts of a run, in one pass."""
    first, number = F.col("chunk_id") == 0, F.size("entities")
    of = lambda kind: F.coalesce(F.sum(F.size(F.filter("entities", lambda e: e["type"] == kind))), F.lit(0)).cast("long").alias(f"entities_{kind.lower()}")
    return grouped.agg(
        F.count_if(first).alias("documents"),
        F.count("*").alias("chunks"),
        F.coalesce(F.sum("token_count"), F.lit(0)).cast("long").alias("tokens"),
        F.coalesce(F.sum(number), F.lit(0)).cast("long").alias("entities"),
        F.count_distinct(F.when(number > 0, F.col("doc_id"))).alias("documents_with_entities"),
        F.coalesce(F.max("doc_id"), F.lit(0)).cast("long").alias("last_id"),
        *(of(k) for k in ("LOC", "PER", "ORG", "MISC")),
    )


def expansion_stats(expanded: DataFrame) -> DataFrame:
    """One row: attempts, what they came to, and why others were not made."""
    tried = F.col("reason").isNull() | (F.col("reason") != "type")
    kind = lambda k: F.count_if(F.col("changed") & (F.col("kind") == k)).alias(f"expanded_{k}")
    why = lambda r: F.count_if(F.col("reason") == r).alias(f"rejected_{r.replace(' ', '_')}")
    share = F.round(100.0 * F.count_if("changed") / F.greatest(F.count_if(tried), F.lit(1)), 1)
    return expanded.agg(F.count_if(tried).alias("attempts"), kind("left"), kind("right"), kind("both"), F.count_if("changed").alias("expanded_total"), *(why(r) for r in ("length", "stopword", "capital", "no room")), share.alias("expand_percent"))


def observed_docs(docs: DataFrame, seen: Observation) -> DataFrame:
    """``docs`` as they are; what passes is counted on the way."""
    return docs.observe(seen, F.count("*").alias("documents"), F.coalesce(F.max("doc_id"), F.lit(0)).cast("long").alias("last_id"))


def observed_chunks(chunks: DataFrame, seen: Observation) -> DataFrame:
    number = lambda kind: F.coalesce(F.sum(F.size(F.filter("entities", lambda e: e["type"] == kind))), F.lit(0)).cast("long")
    return chunks.observe(
        seen,
        F.count("*").alias("chunks"),
        F.count_if((F.col("chunk_id") == 0) & (F.col("total_chunks") > 1)).alias("long_documents"),
        F.coalesce(F.sum("token_count"), F.lit(0)).cast("long").alias("tokens"),
        F.coalesce(F.sum(F.size("entities")), F.lit(0)).cast("long").alias("entities"),
        *(number(k).alias(k) for k in ("LOC", "PER", "ORG", "MISC")),
    )


def final_stats(docs: dict, chunks: dict, seconds: float) -> dict:
    """The statistics of a run, from what was observed and the time that it took."""
    rate = lambda n: round(n / seconds, 2) if seconds > 0 else 0.0
    return {
        "documents": docs["documents"],
        "chunks": chunks["chunks"],
        "tokens": chunks["tokens"],
        "long_documents": chunks["long_documents"],
        "total_entities": chunks["entities"],
        "entities_by_type": {k: chunks[k] for k in ("LOC", "PER", "ORG", "MISC") if chunks[k]},
        "seconds": round(seconds, 2),
        "documents_per_second": rate(docs["documents"]),
        "chunks_per_second": rate(chunks["chunks"]),
    }


def added(old: dict, new: dict) -> dict:
    """Counts of several sessions together; times and rates are the last session's."""
    types = {k: old.get("entities_by_type", {}).get(k, 0) + new.get("entities_by_type", {}).get(k, 0) for k in {**old.get("entities_by_type", {}), **new.get("entities_by_type", {})}}
    return new | {k: old.get(k, 0) + new[k] for k in ("documents", "chunks", "tokens", "long_documents", "total_entities") if k in new} | {"entities_by_type": types}


def save_state(files: Files, path: str, last_id: int, processed: int, stats: dict, version: str) -> dict:
    """A run's state as JSON, written whole; ids only grow, and counts add up over sessions."""
    old = load_state(files, path) or {}
    state = {
        "last_id": max(last_id, old.get("last_id", 0)),
        "processed": processed + old.get("processed", 0),
        "stats": added(old.get("stats", {}), stats),
        "timestamp": datetime.now().isoformat(),
        "version": version,
    }
    files.write(path, json.dumps(state, ensure_ascii=False))
    return state


def load_state(files: Files, path: str) -> dict | None:
    """The state of earlier runs; none if the file is missing or not readable. A write that was cut short leaves the state before it."""
    for place in (path, f"{path}.old"):
        try:
            text = files.read(place)
            if text is not None:
                return json.loads(text)
        except ValueError:
            return None
    return None
