"""Registered queries over the test tables, each with SQL for the same rows where SQL can express them."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.functions import cleaning, expansion
from spanloom.operators import assembly, chunking, grouping, metrics, sinks, tagging
from spanloom.plans import extract as plan
from spanloom.plans import oracle
from spanloom.schemas import OUTPUT_ROW
from spanloom.sources import tables
from spanloom.sources.files import shared_dir
from spanloom.streaming import extract as stream

OVERLAP = 0.25
SMALL = 128
LAST_ID, PAGE = 100, 50


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.documents(_table(spark, sf_dir, "documents"), "doc_id", "text")


def _work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents for queries that take more than a scan: over all cores also where the table is one small file."""
    return tables.spread(_docs(spark, sf_dir))


def _chunks(spark: SparkSession, sf_dir: str, max_tokens: int = 512, overlap: float = 0.0) -> DataFrame:
    return chunking.chunk_rows(_work(spark, sf_dir), max_tokens, overlap)


def _entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouping.entity_rows(plan.grouped(_work(spark, sf_dir)))


def _predictions(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "chunk_id", F.inline_outer("predictions")).where(F.col("idx").isNotNull())


def _shared(spark: SparkSession) -> str:
    """A new folder below the one that driver and executors share."""
    return f"{shared_dir(spark)}/{uuid.uuid4().hex}"


# Scans.
def doc_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.total_count(_docs(spark, sf_dir))


def doc_max_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.max_id(_docs(spark, sf_dir))


def keyset_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.page(_docs(spark, sf_dir), LAST_ID, PAGE)


def resume_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.after(_docs(spark, sf_dir), LAST_ID).select("doc_id", F.length("text").alias("n_chars"))


def limit_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).orderBy("doc_id").limit(PAGE).select("doc_id", F.length("text").alias("n_chars"))


def text_column_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = [tables.documents(_table(spark, sf_dir, t), k).select(F.lit(t).alias("source"), "doc_id", "text") for t, k in (("conversations", "conv_id"), ("pages", "page_id"))]
    return found[0].union(found[1])


# Tokens and chunks.
def tokenize_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _work(spark, sf_dir).select("doc_id", F.inline_outer(chunking.tokens(F.col("text")))).where(F.col("start").isNotNull()).withColumnsRenamed({"start": "start_pos", "end": "end_pos"})


def tokens_per_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _work(spark, sf_dir).select("doc_id", chunking.token_count(F.col("text")).cast("long").alias("tokens"))


_SPAN = ("doc_id", "chunk_id", "total_chunks", "global_start", "global_end", "token_count")


def chunk_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chunks(spark, sf_dir).select(*_SPAN)


def chunk_spans_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chunks(spark, sf_dir, SMALL, OVERLAP).select(*_SPAN)


def chunk_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chunks(spark, sf_dir).select("doc_id", "chunk_id", "text")


def long_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.chunk_stats(_chunks(spark, sf_dir))


# Predictions.
def tag_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _predictions(plan.tagged(_work(spark, sf_dir))).withColumnsRenamed({"start": "start_pos", "end": "end_pos"})


def confidence_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _predictions(tagging.confident(plan.tagged(_work(spark, sf_dir)))).withColumnsRenamed({"start": "start_pos", "end": "end_pos"})


def offset_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _predictions(tagging.shifted(tagging.confident(plan.tagged(_work(spark, sf_dir))))).select("doc_id", "chunk_id", "idx", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"))


# Groups and entities.
def bio_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = plan.grouped(_work(spark, sf_dir)).select("doc_id", "chunk_id", F.posexplode_outer("groups").alias("grp", "g")).where(F.col("grp").isNotNull())
    return rows.select("doc_id", "chunk_id", "grp", F.posexplode(F.transform("g", lambda p: p["idx"])).alias("place", "idx")).drop("place")


def bio_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _entities(spark, sf_dir).select("doc_id", "chunk_id", "ent_idx", "text", "type", "confidence", "start_pos", "end_pos", F.size("positions").cast("long").alias("n_tokens"))


def entity_type_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _predictions(plan.tagged(_work(spark, sf_dir)))
    return rows.groupBy("label", grouping.entity_type(F.col("label")).alias("type")).agg(F.count("*").alias("predictions"))


def reassemble_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assembly.reassembled(_chunks(spark, sf_dir))


def incomplete_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With every document's second chunk taken away."""
    return assembly.incomplete(_chunks(spark, sf_dir).where("chunk_id <> 1")).select("doc_id", "chunks", F.col("total_chunks").cast("long").alias("total_chunks"))


def doc_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assembly.document_entities(_entities(spark, sf_dir))


def overlap_entities_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = grouping.entity_rows(plan.grouped(_work(spark, sf_dir), max_tokens=SMALL, overlap_ratio=OVERLAP))
    return assembly.without_repeats(rows).select("doc_id", "type", "start_pos", "end_pos")


# Expansion.
def _grown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expansion.expanded(_entities(spark, sf_dir))


_KEY = ("doc_id", "chunk_id", "ent_idx")


def expand_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grown(spark, sf_dir).select(*_KEY, "expand", "reason")


def expand_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grown(spark, sf_dir).select(*_KEY, "gain_left", "gain_right")


def expand_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grown(spark, sf_dir).select(*_KEY, "inner_break")


def expand_sentence_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grown(spark, sf_dir).select(*_KEY, "likely_sentence")


def expand_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grown(spark, sf_dir).select(*_KEY, "kind", "new_text", "new_start", "new_end", "changed")


# Cleaning, over all lines of the documents.
def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _work(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "text"))


def _line_query(step):
    return lambda spark, sf_dir: _lines(spark, sf_dir).select("doc_id", "line", step(F.col("text")).alias("text"))


def _after(strings, step):
    """A step over every line that stands after one of ``strings``, since the tables hold few of the characters that it is about."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        before = F.get(F.array(*map(F.lit, strings)), F.pmod(F.col("doc_id") + F.col("line"), F.lit(len(strings))).cast("int"))
        return _lines(spark, sf_dir).select("doc_id", "line", step(F.concat(before, "text")).alias("text"))

    return query


def chunk_spans_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks by the tokens of a public tokenizer, from the folder that TOKENIZER_FILES names or the package that brings them."""
    folder = os.environ.get("TOKENIZER_FILES", "")
    if folder:
        path = os.path.join(folder, "byte_bpe_50k.json")
    else:
        import public_tokenizers

        path = str(public_tokenizers.path("byte_bpe_50k.json"))
    return chunking.chunk_rows(_work(spark, sf_dir), tokens=chunking.tokenizer_tokens(path), listed=False).select(*_SPAN)


def clean_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.final_entities(_entities(spark, sf_dir)).select(*_KEY, "text", "cleaned")


# Results.
def output_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.extract(_work(spark, sf_dir))


def output_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.extract(_work(spark, sf_dir), expand=False, positions=False)


def output_no_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.extract(_work(spark, sf_dir), confidence=False)


def output_without_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third entity without a place: such are neither grown nor cleaned."""
    known = F.col("ent_idx") % 3 != 0
    rows = _entities(spark, sf_dir)
    for c in ("start_pos", "end_pos"):
        rows = rows.withColumn(c, F.when(known, F.col(c)))
    return assembly.output_rows(plan.final_entities(rows))


def entities_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.entities_by_type(_entities(spark, sf_dir))


def pipeline_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.run_stats(plan.grouped(_work(spark, sf_dir)))


def expansion_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.expansion_stats(_grown(spark, sf_dir))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _shared(spark)
    sinks.write_rows(output_rows(spark, sf_dir), path, "csv")
    return sinks.read_rows(spark, path, OUTPUT_ROW)


def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the stream twice with one checkpoint: the second run finds nothing new."""
    path = _shared(spark)
    schema = _table(spark, sf_dir, "documents").schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")
    for _ in range(2):
        docs = stream.parquet_documents(spark, f"{sf_dir}/documents.parquet*", schema)
        stream.start(docs, f"{path}/rows", f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/rows")


QUERIES = {
    "doc_count": doc_count,
    "doc_max_id": doc_max_id,
    "keyset_page": keyset_page,
    "resume_tail": resume_tail,
    "limit_docs": limit_docs,
    "text_column_fallback": text_column_fallback,
    "tokenize_offsets": tokenize_offsets,
    "tokens_per_doc": tokens_per_doc,
    "chunk_spans": chunk_spans,
    "chunk_spans_overlap": chunk_spans_overlap,
    "chunk_spans_tokenizer": chunk_spans_tokenizer,
    "chunk_text": chunk_text,
    "long_docs": long_docs,
    "tag_tokens": tag_tokens,
    "confidence_filter": confidence_filter,
    "offset_shift": offset_shift,
    "bio_groups": bio_groups,
    "bio_entities": bio_entities,
    "entity_type_map": entity_type_map,
    "reassemble_text": reassemble_text,
    "incomplete_docs": incomplete_docs,
    "doc_entities": doc_entities,
    "overlap_entities_once": overlap_entities_once,
    "expand_decision": expand_decision,
    "expand_bounds": expand_bounds,
    "expand_inner": expand_inner,
    "expand_sentence_guard": expand_sentence_guard,
    "expand_entities": expand_entities,
    "clean_nfkc": _line_query(cleaning.normalised),
    "clean_whitespace": _line_query(lambda t: cleaning.collapsed(cleaning.without_controls(t))),
    "clean_edges": _line_query(cleaning.edges),
    "clean_pairs": _line_query(cleaning.paired),
    "clean_loc_prefix": _after(oracle.PREFIXED, cleaning.without_prefix),
    "clean_compatibility": _after([a for a, _ in oracle.COMPATIBILITY], cleaning.normalised),
    "clean_controls": _after([a for a, _ in oracle.CONTROLS], cleaning.without_controls),
    "clean_entities": clean_entities,
    "output_rows": output_rows,
    "output_plain": output_plain,
    "output_no_confidence": output_no_confidence,
    "output_without_places": output_without_places,
    "entities_by_type": entities_by_type,
    "pipeline_stats": pipeline_stats,
    "expansion_stats": expansion_stats,
    "csv_roundtrip": csv_roundtrip,
    "stream_resume": stream_resume,
}

_PLACES = 'start AS start_pos, "end" AS end_pos'
_WHOLE = "doc_id, chunk_id, total_chunks, global_start, global_end, token_count"
_LINE = "SELECT doc_id, line::INT AS line, {} AS text FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, unnest(range(len(string_split(text, chr(10))))) AS line FROM documents)"
_CLEANED = f"CASE WHEN may THEN trim({oracle.collapsed('p')}) ELSE new_text END"
_FINAL = (
    "SELECT *, CASE WHEN type = 'LOC' THEN " + oracle.without_prefix("q") + " ELSE q END AS p FROM (SELECT *, "
    + oracle.paired(oracle.edges(oracle.collapsed("new_text"))) + " AS q FROM grown)"
)
_ROWS = f"SELECT doc_id, type AS entity_type, {_CLEANED} AS entity_text, confidence, new_start AS start_pos, new_end AS end_pos FROM ({_FINAL})"
_CHUNK_STATS = "count(*) FILTER (WHERE chunk_id = 0) AS documents, count(*) AS chunks, coalesce(sum(token_count), 0)::BIGINT AS tokens"
_COUNT = "coalesce(sum((type = '{}')::INT), 0)::BIGINT AS entities_{}"

ORACLE_SQL: dict[str, str] = {
    "doc_count": "SELECT count(*) AS total FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL",
    "doc_max_id": "SELECT coalesce(max(doc_id), 0)::BIGINT AS max_id FROM documents",
    "keyset_page": f"SELECT doc_id, text FROM documents WHERE doc_id > {LAST_ID} ORDER BY doc_id LIMIT {PAGE}",
    "resume_tail": f"SELECT doc_id, length(text)::INT AS n_chars FROM documents WHERE doc_id > {LAST_ID}",
    "limit_docs": f"SELECT doc_id, length(text)::INT AS n_chars FROM documents ORDER BY doc_id LIMIT {PAGE}",
    "text_column_fallback": "SELECT 'conversations' AS source, conv_id AS doc_id, role AS text FROM conversations UNION ALL SELECT 'pages', page_id, url FROM pages",
    "tokenize_offsets": oracle.with_chain("token", f"SELECT doc_id, word, {_PLACES} FROM token"),
    "tokens_per_doc": oracle.with_chain("token", "SELECT doc_id, count(tok) AS tokens FROM doc LEFT JOIN token USING (doc_id) GROUP BY doc_id"),
    "chunk_spans": oracle.with_chain("chunk", f"SELECT {_WHOLE} FROM chunk"),
    "chunk_spans_overlap": oracle.with_chain("chunk", f"SELECT {_WHOLE} FROM chunk", max_tokens=SMALL, overlap_ratio=OVERLAP),
    "chunk_text": oracle.with_chain("chunk", "SELECT doc_id, chunk_id, text FROM chunk"),
    "long_docs": oracle.with_chain("chunk", f"SELECT {_CHUNK_STATS}, count(*) FILTER (WHERE chunk_id = 0 AND total_chunks > 1) AS long_documents FROM chunk"),
    "tag_tokens": oracle.with_chain("pred", f"SELECT doc_id, chunk_id, idx, label, score, word, {_PLACES} FROM pred"),
    "confidence_filter": oracle.with_chain("kept", f"SELECT doc_id, chunk_id, idx, label, score, word, {_PLACES} FROM kept"),
    "offset_shift": oracle.with_chain("moved", f"SELECT doc_id, chunk_id, idx, {_PLACES} FROM moved"),
    "bio_groups": oracle.with_chain("member", "SELECT doc_id, chunk_id, grp, idx FROM member"),
    "bio_entities": oracle.with_chain("entity", "SELECT doc_id, chunk_id, ent_idx, text, type, confidence, start_pos, end_pos, n_tokens FROM entity"),
    "entity_type_map": oracle.with_chain("pred", "SELECT label, CASE WHEN label IN ('B-LOC', 'I-LOC', 'B-PER', 'I-PER', 'B-ORG', 'I-ORG') THEN right(label, 3) ELSE 'MISC' END AS type, count(*) AS predictions FROM pred GROUP BY label"),
    "reassemble_text": oracle.with_chain("chunk", "SELECT doc_id, string_agg(text, '' ORDER BY chunk_id) AS text, max(total_chunks) AS total_chunks FROM chunk GROUP BY doc_id"),
    "incomplete_docs": oracle.with_chain("chunk", "SELECT doc_id, count(*) AS chunks, max(total_chunks)::BIGINT AS total_chunks FROM chunk WHERE chunk_id <> 1 GROUP BY doc_id HAVING count(*) <> max(total_chunks)"),
    "doc_entities": oracle.with_chain("entity", "SELECT doc_id, string_agg(type || ':' || text, '|' ORDER BY chunk_id, ent_idx) AS entities, count(*) AS n_entities FROM entity GROUP BY doc_id"),
    "overlap_entities_once": oracle.with_chain("entity", "SELECT DISTINCT doc_id, type, start_pos, end_pos FROM entity", max_tokens=SMALL, overlap_ratio=OVERLAP),
    "expand_decision": oracle.with_chain("grown", "SELECT doc_id, chunk_id, ent_idx, expand, reason FROM grown"),
    "expand_bounds": oracle.with_chain("grown", "SELECT doc_id, chunk_id, ent_idx, length(l0)::INT AS gain_left, length(r0)::INT AS gain_right FROM grown"),
    "expand_inner": oracle.with_chain("grown", "SELECT doc_id, chunk_id, ent_idx, inner_break FROM grown"),
    "expand_sentence_guard": oracle.with_chain("grown", "SELECT doc_id, chunk_id, ent_idx, likely_sentence FROM grown"),
    "expand_entities": oracle.with_chain("grown", "SELECT doc_id, chunk_id, ent_idx, kind, new_text, new_start, new_end, changed FROM grown"),
    "clean_whitespace": _LINE.format(oracle.collapsed("text")),
    "clean_edges": _LINE.format(oracle.edges("text")),
    "clean_pairs": _LINE.format(oracle.paired("text")),
    "clean_loc_prefix": _LINE.format(oracle.without_prefix(oracle.one_of(oracle.PREFIXED) + " || text")),
    "clean_controls": _LINE.format(oracle.one_of([b for _, b in oracle.CONTROLS]) + " || text"),
    "clean_compatibility": _LINE.format(oracle.one_of([b for _, b in oracle.COMPATIBILITY]) + " || text"),
    "clean_entities": oracle.with_chain("grown", f"SELECT doc_id, chunk_id, ent_idx, {_CLEANED} AS text, {_CLEANED} <> new_text AS cleaned FROM ({_FINAL})"),
    "output_rows": oracle.with_chain("grown", _ROWS),
    "output_plain": oracle.with_chain("entity", "SELECT doc_id, type AS entity_type, text AS entity_text, confidence FROM entity"),
    "output_no_confidence": oracle.with_chain("grown", f"SELECT * EXCLUDE (confidence) FROM ({_ROWS})"),
    "output_without_places": oracle.with_chain(
        "grown",
        f"SELECT doc_id, type AS entity_type, CASE WHEN ent_idx % 3 = 0 THEN text ELSE {_CLEANED} END AS entity_text, confidence, "
        f"CASE WHEN ent_idx % 3 = 0 THEN 0 ELSE new_start END AS start_pos, CASE WHEN ent_idx % 3 = 0 THEN 0 ELSE new_end END AS end_pos FROM ({_FINAL})",
    ),
    "entities_by_type": oracle.with_chain("entity", "SELECT type AS entity_type, count(*) AS entities FROM entity GROUP BY type"),
    "pipeline_stats": oracle.with_chain(
        "entity",
        f"SELECT * FROM (SELECT {_CHUNK_STATS} FROM chunk), (SELECT count(*) AS entities, count(DISTINCT doc_id) AS documents_with_entities, "
        + ", ".join(_COUNT.format(k, k.lower()) for k in grouping.TYPES)
        + " FROM entity), (SELECT coalesce(max(doc_id), 0)::BIGINT AS last_id FROM doc)",
    ),
    "expansion_stats": oracle.with_chain(
        "grown",
        "SELECT count(*) FILTER (WHERE may) AS attempts, "
        + ", ".join(f"count(*) FILTER (WHERE changed AND kind = '{k}') AS expanded_{k}" for k in ("left", "right", "both"))
        + ", count(*) FILTER (WHERE changed) AS expanded_total, "
        + ", ".join(f"count(*) FILTER (WHERE reason = '{r}') AS rejected_{r.replace(' ', '_')}" for r in ("length", "stopword", "capital", "no room"))
        + ", round(100.0::DOUBLE * count(*) FILTER (WHERE changed) / greatest(count(*) FILTER (WHERE may), 1), 1) AS expand_percent FROM grown",
    ),
    "csv_roundtrip": oracle.with_chain("grown", _ROWS),
    "stream_resume": oracle.with_chain("grown", _ROWS),
}
