"""Logical tables of the extraction plan."""

from __future__ import annotations

SOURCE_ROW = "id BIGINT NOT NULL, content STRING"
DOCUMENT = "doc_id BIGINT, text STRING"
OUTPUT_ROW = "doc_id BIGINT, entity_type STRING, entity_text STRING, confidence DOUBLE, start_pos INT, end_pos INT"
CHECKPOINT = (
    "last_id BIGINT, processed BIGINT, stats STRUCT<total_entities: BIGINT, entities_by_type: MAP<STRING, BIGINT>, "
    "bytes_written: BIGINT, session_start: STRING, last_session: STRING, session_end: STRING>, timestamp STRING, version STRING"
)
