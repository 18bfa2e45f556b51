"""Tokens with exact offsets, and chunks of a bounded number of tokens.

A document stays one row until its chunks are exploded: no shuffle, no window. Offsets are code points, from 0,
ends exclusive. Running sums over arrays are taken in blocks, so their cost is linear in the text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words, runs of blanks and single other characters; together they spell the text, and all but the blanks are tokens.
PIECES = r"[\p{L}\p{N}_]+|\s+|[^\p{L}\p{N}_\s]"
TOKENS = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"
#: A token with the blanks before it; nothing in it is given back, so that many of them in a row take no stack.
_NEXT = r"(?:\s*+(?:[\p{L}\p{N}_]++|[^\p{L}\p{N}_\s]))"
_BLANKS = " \t\n\x0b\f\r"
_BLOCK = 128
#: Tokens that a model adds around each chunk, and characters of context kept on both sides of a chunk.
SPECIALS, MARGIN = 2, 31
TOKEN = "struct<word:string,start:int,end:int>"
#: What gives a text's tokens: an array of (word, start, end).
Tokens = Callable[[Column], Column]


def token_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(TOKENS))


def running_sums(numbers: Column) -> Column:
    """Array of the sums of the elements up to each one."""
    from spanloom.functions.chars import let

    def summed(values: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / _BLOCK).cast("int"))
        grow = lambda acc, n: F.array_append(acc, F.element_at(acc, -1) + n)
        within = F.transform(blocks, lambda b: F.aggregate(F.slice(values, b * _BLOCK + 1, _BLOCK), F.array(F.lit(0)), grow))

        def placed(parts: Column) -> Column:
            before = F.aggregate(parts, F.array(F.lit(0)), lambda acc, p: F.array_append(acc, F.element_at(acc, -1) + F.element_at(p, -1)))
            return let(before, lambda b: F.flatten(F.transform(parts, lambda p, k: F.transform(F.slice(p, F.lit(2), F.size(p)), lambda x: x + F.get(b, k)))))

        return F.when(F.size(values) > 0, let(within, placed)).otherwise(F.array().cast("array<int>"))

    return let(numbers, summed)


def tokens(text: Column) -> Column:
    """Array of (word, start, end)."""
    from spanloom.functions.chars import let

    # Each token with the blanks before it; blanks at the end are cut off first, as no token follows them.
    text = F.rtrim(text, F.lit(_BLANKS))
    pattern = F.lit(rf"(\s*+)({TOKENS})")
    words, gaps = F.regexp_extract_all(text, pattern, F.lit(2)), F.regexp_extract_all(text, pattern, F.lit(1))
    located = lambda w: F.zip_with(
        w,
        running_sums(F.zip_with(w, gaps, lambda x, g: F.length(x) + F.length(g))),
        lambda x, end: F.struct(x.alias("word"), (end - F.length(x)).alias("start"), end.alias("end")),
    )
    return let(words, located).cast(f"array<{TOKEN}>")


_pattern_tokens = tokens


class TokenizerFile:
    """Tokens of a tokenizer file (JSON of the tokenizers library), without special tokens: words are the characters that a token stands for.

    The file is read once per Python process. A text that the tokenizer fails on has null tokens, and the job goes on.
    """

    def __init__(self, path: str):
        self.path = path

    def encoded(self, text: str):
        """The library's encoding; none if it fails."""
        if self.path not in _LOADED:
            from tokenizers import Tokenizer

            _LOADED[self.path] = Tokenizer.from_file(self.path)
            _LOADED[self.path].no_truncation()
        try:
            return _LOADED[self.path].encode(text, add_special_tokens=False)
        except Exception:  # noqa: BLE001  one bad text doesn't end the job
            return None

    def __call__(self, text: Column) -> Column:
        @F.arrow_udf(f"array<{TOKEN}>")
        def located(texts: pa.Array) -> pa.Array:
            own = []
            for text in texts:
                t = text.as_py()
                found = None if t is None else self.encoded(t)
                own.append(pa.array([None], _TOKENS) if found is None else _listed(t, [found.offsets]))
            return pa.concat_arrays(own) if own else pa.array([], _TOKENS)

        return located(text)

    def chunks(self, rows: DataFrame, content: int, step: int, listed: bool = True) -> DataFrame:
        """Chunks of ``rows`` (doc_id, document), cut where they are encoded: a task holds one text's encoding and about ``BATCH_CHARS`` of
        chunks at a time, however many texts come at once. Without ``listed`` the column ``tokens`` is left out."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out: list[tuple] = []
            held = 0
            for batch in batches:
                for doc_id, document in zip(*(batch.column(k) for k in (0, 1))):
                    text = document.as_py()
                    found = self.encoded(text)
                    if found is None:
                        continue
                    n = len(found)
                    offsets = found.offsets if listed else None
                    total = max(-(-(n - content) // step), 0) + 1
                    for k in range(total):
                        first, stop = k * step, min(k * step + content, n)
                        low, high = (found.token_to_chars(first)[0], found.token_to_chars(stop - 1)[1]) if n else (0, 0)
                        own = text[low:high]
                        spans = (_listed(text, [offsets[first:stop]]),) if listed else ()
                        out.append((doc_id.as_py(), k, total, own, low, high, stop - first + SPECIALS, text[max(low - MARGIN, 0) : low], text[high : high + MARGIN], *spans))
                        held += len(own)
                        if held >= BATCH_CHARS or len(out) >= BATCH_ROWS:
                            yield _batch(out)
                            out, held = [], 0
                    del found, offsets
            if out:
                yield _batch(out)

        return rows.mapInArrow(run, f"{_CHUNK}, tokens array<{TOKEN}>" if listed else _CHUNK)


def _listed(text: str, spans: list[list[tuple[int, int]]]) -> pa.Array:
    """Lists of tokens at these places of a text."""
    flat = [x for own in spans for x in own]
    starts, ends = ([x[k] for x in flat] for k in (0, 1))
    found = pa.StructArray.from_arrays([pa.array([text[a:b] for a, b in flat], pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], fields=list(_TOKENS.value_type))
    return pa.ListArray.from_arrays(pa.array([0, *accumulate(map(len, spans))], pa.int32()), found).cast(_TOKENS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    arrays = [pa.array(c, t) for c, t in zip(columns, _CHUNK_TYPES)]
    names = list(_CHUNK_NAMES)
    if len(columns) > len(arrays):
        arrays.append(pa.concat_arrays(columns[-1]))
        names.append("tokens")
    return pa.RecordBatch.from_arrays(arrays, names)


def tokenizer_tokens(path: str) -> TokenizerFile:
    """Tokens of a tokenizer file."""
    return TokenizerFile(path)


#: Characters and rows of chunks that a Python task sends at once.
BATCH_CHARS, BATCH_ROWS = 1 << 20, 4096
_TOKENS = pa.list_(pa.struct([("word", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
_CHUNK_NAMES = ("doc_id", "chunk_id", "total_chunks", "text", "global_start", "global_end", "token_count", "before", "after")
_CHUNK_TYPES = (pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string())
_CHUNK = "doc_id long, chunk_id int, total_chunks int, text string, global_start int, global_end int, token_count int, before string, after string"
_LOADED: dict = {}


def failed(docs: DataFrame, tokens: Tokens = tokens) -> DataFrame:
    """(doc_id): documents whose tokens cannot be found; ``chunk_rows`` leaves them out."""
    return docs.where(F.col("text").isNotNull()).select("doc_id", tokens(F.col("text").cast("string")).alias("tokens")).where("tokens IS NULL").select("doc_id")


def stride(max_tokens: int, overlap_ratio: float) -> int:
    """Tokens that neighbouring chunks share."""
    return int(max_tokens * overlap_ratio) if overlap_ratio > 0 else 0


def chunk_rows(docs: DataFrame, max_tokens: int = 512, overlap_ratio: float = 0.0, tokens: Tokens = tokens, listed: bool = True) -> DataFrame:
    """``docs`` (doc_id, text) as chunks in order; a text without tokens is one empty chunk, one with null tokens is left out.

    Columns: doc_id, chunk_id, total_chunks, text, global_start, global_end, token_count (with the specials),
    tokens (offsets in the document), and ``before`` and ``after``, the document's text on both sides. Python makes no lists of tokens
    that are not ``listed``; the column is then missing if the tokens are a tokenizer file's.
    """
    content = max_tokens - SPECIALS
    step = content - stride(max_tokens, overlap_ratio)
    if step < 1:
        raise ValueError("chunks must advance: less overlap or more tokens are needed")
    rows = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("document"))
    if isinstance(tokens, TokenizerFile):
        return tokens.chunks(rows, content, step, listed)
    if tokens is _pattern_tokens:
        return _pattern_chunks(rows, content, step)
    rows = rows.withColumn("tokens", tokens(F.col("document")))
    total = F.when(F.size("tokens") >= 0, F.greatest(F.ceil((F.size("tokens") - content) / step), F.lit(0)).cast("int") + 1)
    # The outer form: no filter on the array is inferred, which would compute all tokens once more.
    rows = rows.withColumn("total_chunks", total).select("doc_id", "document", "tokens", "total_chunks", F.explode_outer(F.sequence(F.lit(0), F.col("total_chunks") - 1)).alias("chunk_id")).where(F.col("chunk_id").isNotNull())
    rows = rows.withColumn("tokens", F.slice("tokens", F.col("chunk_id") * step + 1, content))
    rows = rows.withColumn("global_start", F.coalesce(F.get("tokens", F.lit(0))["start"], F.lit(0)))
    rows = rows.withColumn("global_end", F.coalesce(F.try_element_at("tokens", F.lit(-1))["end"], F.lit(0)))
    from spanloom.functions.chars import cut

    doc = F.col("document")
    return rows.select(
        "doc_id",
        "chunk_id",
        "total_chunks",
        cut(doc, F.col("global_start"), F.col("global_end")).alias("text"),
        "global_start",
        "global_end",
        (F.size("tokens") + SPECIALS).alias("token_count"),
        "tokens",
        cut(doc, F.col("global_start") - MARGIN, F.col("global_start")).alias("before"),
        cut(doc, F.col("global_end"), F.col("global_end") + MARGIN).alias("after"),
    )


def _pattern_chunks(rows: DataFrame, content: int, step: int) -> DataFrame:
    """Chunks of ``rows`` (doc_id, document) by the pattern's tokens: a text is cut into blocks of ``step`` tokens with the blanks before them,
    without a list of its tokens, and a chunk is a block and as many tokens of the next ones as chunks share. Neither text nor blocks go
    through the explosion, so work grows with the text's length."""
    from spanloom.functions.chars import let

    shared, beside = content - step, -(-MARGIN // step)  # a block has a character for each token at least
    ahead = -(-shared // step) + beside
    # Blanks at the end are cut off first, as no token follows them.
    blocks = F.regexp_extract_all(F.rtrim("document", F.lit(_BLANKS)), F.lit(rf"{_NEXT}{{1,{step}}}+"), F.lit(0))
    rows = rows.select("doc_id", "document", let(blocks, lambda b: F.when(F.size(b) > 0, b).otherwise(F.array(F.lit("")))).alias("blocks"))
    rows = rows.withColumn("ends", running_sums(F.transform("blocks", lambda b: F.length(b))))
    rest = F.substring("document", F.element_at("ends", -1) + 1, F.lit(MARGIN))
    total = F.size("blocks")
    if shared:
        number = (total - 1) * step + token_count(F.element_at("blocks", -1))
        total = F.greatest(F.ceil((number - content) / step), F.lit(0)).cast("int") + 1
    rows = rows.select("doc_id", "blocks", "ends", rest.alias("rest"), total.alias("total_chunks"), *([number.alias("number")] if shared else []))

    def joined(first: Column, n: int) -> Column:
        """Blocks from a place (from 0) on; there may be fewer, but not before the first."""
        return F.coalesce(F.get("blocks", first), F.lit("")) if n == 1 else F.array_join(F.slice("blocks", F.greatest(first, F.lit(0)) + 1, F.least(first + n, F.lit(n))), "")

    def chunk(k: Column) -> Column:
        after = F.concat(joined(k + 1, ahead), "rest")
        return F.struct(
            k.alias("chunk_id"),
            F.get("blocks", k).alias("block"),
            (F.get("ends", k) - F.length(F.get("blocks", k))).alias("place"),
            F.right(joined(k - beside, beside), F.lit(MARGIN)).alias("behind"),
            (after if shared else F.left(after, F.lit(MARGIN))).alias("ahead"),
        )

    # The outer form: no filter on the array is inferred, which would compute all blocks once more.
    rows = rows.select("doc_id", "total_chunks", *(["number"] if shared else []), F.explode_outer(F.transform(F.sequence(F.lit(0), F.col("total_chunks") - 1), chunk)).alias("c"))
    rows = rows.where(F.col("c.chunk_id").isNotNull()).select("*", "c.*").withColumn("lead", F.regexp_extract("block", r"^\s*", 0))
    own = F.substring(F.col("block"), F.length("lead") + 1, F.length("block"))
    if shared:
        rows = rows.withColumn("over", F.regexp_extract("ahead", rf"^{_NEXT}{{1,{shared}}}+", 0))
        own = F.concat(own, "over")
        after = F.substring(F.col("ahead"), F.length("over") + 1, F.lit(MARGIN))
        count = F.least(F.lit(content), F.col("number") - F.col("chunk_id") * step)
    else:
        after = F.col("ahead")
        count = F.when(F.col("chunk_id") < F.col("total_chunks") - 1, F.lit(content)).otherwise(token_count(F.col("block")))
    start = F.col("place") + F.length("lead")
    rows = rows.select("doc_id", "chunk_id", "total_chunks", own.alias("text"), start.alias("global_start"), (count + SPECIALS).alias("token_count"), F.right(F.concat("behind", "lead"), F.lit(MARGIN)).alias("before"), after.alias("after"))
    moved = lambda t: F.struct(t["word"].alias("word"), (t["start"] + F.col("global_start")).alias("start"), (t["end"] + F.col("global_start")).alias("end"))
    return rows.select(
        "doc_id",
        "chunk_id",
        "total_chunks",
        "text",
        "global_start",
        (F.col("global_start") + F.length("text")).alias("global_end"),
        "token_count",
        F.transform(tokens(F.col("text")), moved).alias("tokens"),
        "before",
        "after",
    )
