"""Removal of bytes covered by a repeated substring, by bucket-pointer refinement of suffix buckets.

Suffixes are bucketed by their first ``q`` bytes (q is a quarter of ``length``); a bucket with more than one
suffix is refined by the bucket identifiers of later offsets: first at q, which makes buckets of 2q bytes, and
then, reusing those, at 2q, which makes buckets of 4q. Buckets of one suffix are final and drop out at once.

At scale the identifiers of the first buckets are hashes of the bytes, so no task has to number them, and not
every suffix is entered: each window of ``length`` bytes is entered by its minimizer, the q-gram in it whose
hash is least, which equal windows share. Windows next to each other mostly share their minimizer; together
they make one *stretch*. Then:

1. Stretches are dealt out by the q-gram. Equal stretches (by a hash of their bytes) are repeats of the
   first of them. A q-gram with one stretch is final.
2. The others, one for each different stretch, fetch their bytes and are refined to buckets of ``length`` bytes.
   In a bucket all windows but the first are repeats.
3. The covered bytes of a document are the union of its repeated windows.

Hot groups: equal stretches of a task are reduced to their first before the shuffle; a q-gram with very many
different stretches (a common passage in many surroundings) is found beforehand; its stretches are dealt
out by their own hash as well, and its windows by a 128-bit hash of their bytes, again reduced in the task
first. The list of such q-grams has at most 2 * ``A`` / max(A / 1e5, HEAVY) <= 2e5 entries for A stretches. One that has fewer than
HEAVY_IN_TASK stretches among each GATHER gathered is not counted, so a task may get up to A / 75,000 of them.

Rows of a null doc_id are left out; rows that repeat an id count as one document, the one of least text;
null texts are empty. Long texts are taken in pieces that overlap, so no array grows with a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.common import one_per_id, written
from spanloom.llm.rolling import Hasher, leftmost_minima

LENGTH = 100
#: Bytes hashed at once, and stretches gathered before equal ones are reduced.
PIECE, GATHER = 1_500_000, 600_000
#: A q-gram with so many different stretches, or a hundred-thousandth of all, is dealt out by more than itself.
HEAVY, HEAVY_IN_TASK = 4096, 8

_ROW = "gram long, stretch long, doc long, at long, heavy boolean"
# ``at`` packs: the first window's start << 16 | (windows in the stretch) << 8 | kind, kind 1 for a repeat.


def _batches(columns: dict, schema: pa.Schema, size: int = 100_000) -> Iterator[pa.RecordBatch]:
    whole = pa.Table.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
    yield from whole.to_batches(size)


def _pieces(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts laid end to end, about PIECE bytes: data, starts of the parts, their documents, their offsets."""
    held, size = [], 0
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            raw = np.frombuffer(text.as_buffer(), np.uint8) if text.is_valid else np.zeros(0, np.uint8)
            for start in range(0, max(0, len(raw) - length + 1), PIECE):
                part = raw[start : start + PIECE + length - 1]
                held.append((doc, start, part))
                size += len(part)
                if size >= PIECE:
                    yield _laid(held)
                    held, size = [], 0
    if held:
        yield _laid(held)


def _laid(held: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    lengths = [len(p) for _, _, p in held]
    return np.concatenate([p for _, _, p in held]), np.r_[0, np.cumsum(lengths)], np.array([d for d, _, _ in held], np.int64), np.array([s for _, s, _ in held], np.int64)


def _stretches(data: np.ndarray, starts: np.ndarray, docs: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    q = length // 4
    hashes = Hasher(data, both=True)
    gram = hashes.all(q)
    place = leftmost_minima(gram, length - q + 1)
    window = np.arange(len(place))
    part = np.searchsorted(starts, window, side="right") - 1
    inside = window + length <= starts[part + 1]
    window, place, part = window[inside], place[inside], part[inside]
    if not len(window):
        return (np.zeros(0, np.int64),) * 4
    first = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (part[1:] != part[:-1])])
    last = np.r_[first[1:], len(window)] - 1
    lo, hi, owner = window[first], window[last], part[first]
    # The place of the q-gram in the stretch belongs to it: equal bytes entered by another occurrence are other windows.
    stretch = hashes.at(lo, hi + length, 1) + (place[first] - lo).astype(np.uint64)
    at = (lo - starts[owner] + offsets[owner]) << 16 | (hi - lo + 1) << 8
    return gram[place[first]].view(np.int64), stretch.view(np.int64), docs[owner], at


def _enter(length: int, heavy: frozenset | None):
    """Stretches of documents. With ``heavy`` None, only (gram, 0, number of different stretches, 0) of frequent q-grams and the number of all."""
    schema = pa.schema([("gram", pa.int64()), ("stretch", pa.int64()), ("doc", pa.int64()), ("at", pa.int64()), ("heavy", pa.bool_())])

    def reduce(held: list) -> Iterator[pa.RecordBatch]:
        gram, stretch, doc, at = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((at, doc, stretch, gram))
        gram, stretch, doc, at = gram[order], stretch[order], doc[order], at[order]
        first = np.r_[True, (gram[1:] != gram[:-1]) | (stretch[1:] != stretch[:-1])] if len(gram) else np.zeros(0, bool)
        if heavy is None:
            one, number = np.unique(gram[first], return_counts=True)
            often = number >= HEAVY_IN_TASK
            yield from _batches({"gram": np.r_[one[often], 0], "stretch": np.r_[np.zeros(often.sum(), np.int64), 1], "doc": np.r_[number[often], len(gram)], "at": np.zeros(often.sum() + 1, np.int64), "heavy": np.zeros(often.sum() + 1, bool)}, schema)
            return
        yield from _batches({"gram": gram, "stretch": stretch, "doc": doc, "at": at | ~first, "heavy": np.isin(gram, list(heavy)) if heavy else np.zeros(len(gram), bool)}, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for laid in _pieces(batches, length):
            held.append(_stretches(*laid, length))
            size += len(held[-1][0])
            if size >= GATHER:
                yield from reduce(held)
                held, size = [], 0
        if held:
            yield from reduce(held)

    return run


def _first_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (gram, stretch, doc, at): repeats are marked, and kept stretches are those whose q-gram has another.

    Holds one row at a time beyond a batch: the first stretch of a q-gram waits until a second one is seen.
    """
    schema = pa.schema([("gram", pa.int64()), ("doc", pa.int64()), ("at", pa.int64()), ("heavy", pa.bool_())])
    gram0, stretch0, waiting = None, None, None
    for batch in batches:
        gram, stretch, doc, at, heavy = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(5))
        sure = at & 1 == 1  # known since the task that entered them
        out = [(gram[sure], doc[sure], at[sure], heavy[sure])]
        gram, stretch, doc, at, heavy = (x[~sure] for x in (gram, stretch, doc, at, heavy))
        if len(gram):
            same_gram = np.r_[gram[0] == gram0, gram[1:] == gram[:-1]].astype(bool)
            same = same_gram & np.r_[stretch[0] == stretch0, stretch[1:] == stretch[:-1]].astype(bool)
            # A kept stretch is needed if its q-gram has another: it isn't the q-gram's first, or the next kept one is of the same.
            kept = np.flatnonzero(~same)
            needed = np.zeros(len(gram), bool)
            needed[kept] = same_gram[kept] | heavy[kept].astype(bool)  # those of a heavy q-gram are dealt out apart
            needed[kept[:-1][same_gram[kept[1:]]]] = True
            out += [(gram[same], doc[same], at[same] | 1, heavy[same]), (gram[needed], doc[needed], at[needed], heavy[needed])]
            if len(kept):
                if waiting is not None and gram[kept[0]] == waiting[0]:
                    out.append(tuple(np.array([v]) for v in waiting))
                end = kept[-1]
                waiting = None if needed[end] else (gram[end], doc[end], at[end], heavy[end])
            gram0, stretch0 = gram[-1], stretch[-1]
        cols = [np.concatenate(x) for x in zip(*out, strict=True)]
        yield from _batches(dict(zip(schema.names, cols, strict=True)), schema)


_BODY = "key long, more long, doc long, at long, body binary"


def _fetch(length: int):
    """Bytes of the stretches to be refined; of heavy q-grams the windows' hashes instead, each once a task."""
    schema = pa.schema([("key", pa.int64()), ("more", pa.int64()), ("doc", pa.int64()), ("at", pa.int64()), ("body", pa.binary())])

    def windows(held: list) -> Iterator[pa.RecordBatch]:
        key, more, doc, at = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((at, doc, more, key))
        key, more, doc, at = key[order], more[order], doc[order], at[order]
        again = np.r_[False, (key[1:] == key[:-1]) & (more[1:] == more[:-1])]
        yield from _batches({"key": key, "more": more, "doc": doc, "at": at << 16 | 1 << 8 | again, "body": pa.nulls(len(key), pa.binary())}, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, rows = [], 0, []
        for batch in batches:
            for k in range(batch.num_rows):
                doc, raw = batch.column(0)[k].as_py(), batch.column(1)[k].as_buffer()
                for s in batch.column(2)[k].as_py():
                    start, span = s["at"] >> 16, s["at"] >> 8 & 255
                    body = raw[start : start + span + length - 1].to_pybytes()
                    if s["heavy"]:
                        hashes = Hasher(np.frombuffer(body, np.uint8), both=True)
                        held.append((hashes.all(length).view(np.int64), hashes.all(length, 1).view(np.int64), np.full(span, doc, np.int64), start + np.arange(span)))
                        size += span
                    else:
                        rows.append((s["gram"], 0, doc, s["at"], body))
                if len(rows) >= 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                    rows = []
                if size >= 2_000_000:
                    yield from windows(held)
                    held, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
        if held:
            yield from windows(held)

    return run


_SPAN = pa.schema([("doc", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])


def _refined(bodies: list[bytes], doc: np.ndarray, at: np.ndarray, length: int) -> dict:
    """Repeated windows of whole buckets, refined by bucket identifiers of later offsets."""
    q = length // 4
    data = np.frombuffer(b"".join(bodies), np.uint8)
    base = np.r_[0, np.cumsum([len(b) for b in bodies])][:-1]
    span = at >> 8 & 255
    owner = np.repeat(np.arange(len(bodies)), span)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(span) - span, span)
    suffix = base[owner] + within
    _, ids = np.unique(Hasher(data).all(q), return_inverse=True)
    size = np.bincount(ids[suffix])
    alive = size[ids[suffix]] > 1
    owner, within, suffix = owner[alive], within[alive], suffix[alive]
    if len(suffix):
        # 2q: for the suffixes still in question, and at the offset where the next step looks.
        asked = np.unique(np.concatenate([suffix, suffix + 2 * q]))
        _, longer = np.unique(ids[asked] * (ids.max() + 1) + ids[asked + q], return_inverse=True)
        updated = np.full(len(data) + 1, -1, np.int64)
        updated[asked] = longer
        size = np.bincount(updated[suffix])
        alive = size[updated[suffix]] > 1
        owner, within, suffix = owner[alive], within[alive], suffix[alive]
        _, final = np.unique(updated[suffix] * (longer.max() + 1) + updated[suffix + 2 * q], return_inverse=True)
        # A length that is no multiple of four has some last bytes left to tell apart.
        for offset in range(4 * q, length, q):
            _, final = np.unique(final * (ids.max() + 1) + ids[suffix + min(offset, length - q)], return_inverse=True)
        start = (at[owner] >> 16) + within
        order = np.lexsort((start, doc[owner], final))
        final, start, who = final[order], start[order], doc[owner][order]
        again = np.r_[False, final[1:] == final[:-1]]
        start, who = start[again], who[again]
        return _merged(who, start, start + length)
    return _merged(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))


def _merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> dict:
    """Windows of equal length as their maximal runs."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    first = np.r_[True, (doc[1:] != doc[:-1]) | (start[1:] > end[:-1])] if len(doc) else np.zeros(0, bool)
    at = np.flatnonzero(first)
    return {"doc": doc[at], "start": start[at], "end": end[np.r_[at[1:], len(doc)] - 1] if len(at) else end[at]}


def _refine(length: int):
    """Rows sorted by (key, more, doc, at), a bucket's rows together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bytes]] = []
        size, last = 0, None

        def flush() -> Iterator[pa.RecordBatch]:
            yield from _batches(_refined([h[3] for h in held], np.array([h[1] for h in held], np.int64), np.array([h[2] for h in held], np.int64), length), _SPAN)

        for batch in batches:
            single = batch.filter(pa.compute.is_null(batch.column("body")))
            if single.num_rows:
                key, more, doc, at = (single.column(k).to_numpy() for k in range(4))
                again = (at & 1 == 1) | np.r_[(int(key[0]), int(more[0])) == last, (key[1:] == key[:-1]) & (more[1:] == more[:-1])].astype(bool)
                last = (int(key[-1]), int(more[-1]))
                start = at[again] >> 16
                yield from _batches(_merged(doc[again], start, start + length), _SPAN)
            many = batch.filter(pa.compute.is_valid(batch.column("body")))
            for row in zip(many.column(0).to_pylist(), many.column(2).to_pylist(), many.column(3).to_pylist(), many.column(4).to_pylist(), strict=True):
                if size >= PIECE and row[0] != held[-1][0]:
                    yield from flush()
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield from flush()

    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc, start, end): byte ranges of ``docs`` (doc_id, text; ids unique) that repeated windows cover; ranges may overlap."""
    if not 8 <= length <= 250:
        raise ValueError("length must be from 8 to 250 bytes")
    counted = docs.mapInArrow(_enter(length, None), _ROW).groupBy("gram", "stretch").agg(F.sum("doc").alias("n"))
    counted = written(counted)
    total = counted.where("stretch = 1").agg(F.sum("n")).first()[0] or 0
    most = max(HEAVY, total // 100_000)
    heavy = frozenset(r["gram"] for r in counted.where((F.col("stretch") == 0) & (F.col("n") >= most // 2)).select("gram").collect())
    entered = docs.mapInArrow(_enter(length, heavy), _ROW)
    # Repeats that the entering task has found already only pass through: they go by document.
    salt = F.when(F.col("at").bitwiseAND(F.lit(1)) == 1, F.col("doc")).when(F.col("heavy"), F.col("stretch")).otherwise(F.lit(0))
    found = written(
        entered.repartition("gram", salt).sortWithinPartitions("gram", "stretch", "doc", "at").mapInArrow(_first_buckets, "gram long, doc long, at long, heavy boolean")
        .union(entered.sparkSession.createDataFrame([], "gram long, doc long, at long, heavy boolean"))
    )
    start, span, repeat = F.shiftright("at", 16), F.shiftright("at", 8).bitwiseAND(F.lit(255)), F.col("at").bitwiseAND(F.lit(1)) == 1
    sure = found.where(repeat).select("doc", start.alias("start"), (start + span + (length - 1)).alias("end"))
    asked = found.where(~repeat).groupBy(F.col("doc").alias("doc_id")).agg(F.collect_list(F.struct("gram", "at", "heavy")).alias("asked"))
    bodies = docs.join(asked, "doc_id").select("doc_id", "text", "asked").mapInArrow(_fetch(length), _BODY)
    more = bodies.repartition("key", "more").sortWithinPartitions("key", "more", "doc", "at").mapInArrow(_refine(length), "doc long, start long, end long")
    return sure.union(written(more))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, types = ["doc_id", "kept", "n_bytes", "removed"], [pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
    for batch in batches:
        rows, size = [], 0
        for k in range(batch.num_rows):
            raw, spans = batch.column(1)[k].as_buffer(), batch.column(2)[k].as_py()
            runs: list[list[int]] = []
            for start, end in sorted((s["start"], s["end"]) for s in spans or ()):
                if runs and start <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], end)
                else:
                    runs.append([start, end])
            at, parts = 0, []
            for start, end in runs:
                parts.append(raw[at:start])
                at = end
            parts.append(raw[at:])
            rows.append((batch.column(0)[k].as_py(), b"".join(parts), raw.size, [{"start": a, "end": b} for a, b in runs]))
            size += raw.size
            if size >= 8_000_000 or k == batch.num_rows - 1:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
                rows, size = [], 0


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, kept, n_bytes, removed): the bytes that stay, the size before, and the maximal removed ranges."""
    docs = one_per_id(docs)
    spans = repeated_spans(docs, length).groupBy(F.col("doc").alias("doc_id")).agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return docs.join(spans, "doc_id", "left").select("doc_id", "text", "spans").mapInArrow(_kept, "doc_id long, kept binary, n_bytes long, removed array<struct<start:long,end:long>>")


def digest(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    out = without_repeats(docs, length)
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
