"""Token counts of whole texts by a vocabulary file, without ever holding a text's ids.

Byte-pair merges never cross a pre-token, so a text has as many tokens as its pre-tokens have pieces. A
block of documents is cut into pre-tokens, and each distinct pre-token of the block keeps its frequency
per document. Those that more than ``hot`` documents of a block share are counted at once, in the block; the
others are dealt out by pre-token, each distinct one is counted once, and the products of pieces and
frequency are summed by document within the task before they go back to their block.

Null texts count as empty. Repeated ids and further columns do no harm: one row out for one row in, under a
row number of its own. The vocabulary file states how texts are cut; one whose added tokens take in blanks beside them is refused. A block is at most ``BLOCK_CHARS`` long unless one text alone is longer.
"""

from __future__ import annotations

import json
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters and documents in a block; a document's place in its block has 16 bits.
BLOCK_CHARS, BLOCK_DOCS = 32_000_000, 60_000
#: A pre-token in more documents of a block than this is counted in the block.
HOT = 64

# A normaliser and pre-tokenizer as vocabulary files state them, and one pattern that does what both do to texts of
# Latin-1 characters. It is used if the file states just these; else the library cuts every text.
_STATED = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
_LATIN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^\s\x85\xa0a-zªµºß-öø-ÿ0-9²³¹¼½¾]+")
_BEYOND_LATIN = re.compile(r"[^\x00-\x1b\x20-\xff]")  # Python's \s also has \x1c to \x1f


class PieceCounter:
    """Pre-tokens of a text as the library makes them, and the pieces of each."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        added = self.library.get_added_tokens_decoder().values()
        if self.library.pre_tokenizer is None or any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in added):
            raise ValueError(f"{path} has no pre-tokenizer, or added tokens that take what stands beside them")
        stated = json.loads(self.library.to_str())
        self.latin = all(stated[k] == v for k, v in _STATED.items())
        special = sorted((t.content for t in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None

    def pre_tokens(self, text: str) -> tuple[list[str], int]:
        """The pre-tokens, and how many special strings stand between them: each of those is one token."""
        if self.special is None or not self.special.search(text):
            return self._plain(text), 0
        parts = self.special.split(text)
        return [w for part in parts for w in self._plain(part)], len(parts) - 1

    def _plain(self, text: str) -> list[str]:
        if self.latin and not _BEYOND_LATIN.search(text):
            return _LATIN.findall(text.lower())
        normal = self.library.normalizer.normalize_str(text) if self.library.normalizer else text
        return [normal[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def pieces(self, words: list[str]) -> list[int]:
        out: list[int] = []
        for start in range(0, len(words), 4096):
            out += [len(e) for e in self.library.encode_batch_fast(words[start : start + 4096], add_special_tokens=False)]
        return out


_SCHEMA = "block string, word string, docs binary, times binary, ids binary, known binary, n_bytes binary, at binary"


def _blocks(path: str, hot: int, block_chars: int):
    """Per block: a row for the documents themselves, with what is counted already, and one for each rarer pre-token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        counter = PieceCounter(path)
        part, number = TaskContext.get().partitionId(), 0
        new: dict = {}

        def start() -> None:
            new.update(ids=[], n_bytes=[], known=[], words=[], times=[], sizes=[], chars=0, place=defaultdict(count().__next__))

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number
            n = len(new["ids"])
            if not n:
                return
            names = list(new["place"])
            known = np.array(new["known"], np.int64)
            word = np.concatenate(new["words"]) if new["words"] else np.zeros(0, np.int32)
            times = np.concatenate(new["times"]) if new["times"] else np.zeros(0, np.int64)
            doc = np.repeat(np.arange(n), new["sizes"])
            spread = np.bincount(word, minlength=len(names))
            at_once = np.flatnonzero(spread > hot)
            pieces = np.zeros(len(names), np.int64)
            pieces[at_once] = counter.pieces([names[i] for i in at_once])
            known += np.bincount(doc, weights=(pieces[word] * times).astype(float), minlength=n).astype(np.int64)
            rest = spread[word] <= hot
            order = np.argsort(word[rest], kind="stable")
            word, doc, times = word[rest][order], doc[rest][order].astype(np.uint16), times[rest][order].astype(np.uint32)
            ends = np.flatnonzero(np.r_[word[1:] != word[:-1], True]) + 1 if len(word) else np.zeros(0, int)
            begins = np.r_[0, ends[:-1]].astype(int) if len(ends) else ends
            block = f"{part}:{number}"
            number += 1
            rows = [(block, None, None, None, np.array(new["ids"], np.int64).tobytes(), known.tobytes(), np.array(new["n_bytes"], np.int64).tobytes(), None)]
            rows += [(block, names[word[a]], doc[a:b].tobytes(), _pack(times[a:b]), None, None, None, None) for a, b in zip(begins, ends, strict=True)]
            start()
            for k in range(0, len(rows), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k : k + 50_000], strict=True), [pa.string()] * 2 + [pa.binary()] * 6, strict=True)], names=[c.split()[0] for c in _SCHEMA.split(", ")])

        start()
        for batch in batches:
            for number_, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py() or ""
                words, special = counter.pre_tokens(text)
                got = Counter(words)
                new["ids"].append(number_)
                new["n_bytes"].append(len(text.encode()))
                new["known"].append(special)
                new["sizes"].append(len(got))
                new["words"].append(np.fromiter(map(new["place"].__getitem__, got), np.int32, len(got)))
                new["times"].append(np.fromiter(got.values(), np.int64, len(got)))
                new["chars"] += len(text)
                if new["chars"] >= block_chars or len(new["ids"]) >= BLOCK_DOCS:
                    yield from flush()
        yield from flush()

    return run


def _pack(times: np.ndarray) -> bytes | None:
    """Frequencies, or nothing if all are 1; one byte each unless one needs four."""
    top = times.max()
    return None if top == 1 else times.astype(np.uint8).tobytes() if top < 256 else b"\x00" + times.tobytes()


def _unpack(raw: bytes | None, n: int) -> np.ndarray:
    if raw is None:
        return np.ones(n, np.int64)
    if len(raw) == n:
        return np.frombuffer(raw, np.uint8).astype(np.int64)
    return np.frombuffer(raw[1:], np.uint32).astype(np.int64)


def _count(path: str):
    """Rows sorted by pre-token: counts each distinct one once and sums, per block, the tokens of its documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        counter = PieceCounter(path)
        last, pieces_of_last = None, 0
        names = [c.split()[0] for c in _SCHEMA.split(", ")]

        def emit(sums: dict) -> pa.RecordBatch:
            rows = []
            for block, parts in sums.items():
                doc = np.concatenate([d for d, _ in parts])
                total = np.bincount(doc, weights=np.concatenate([t for _, t in parts]).astype(float)).astype(np.int64)
                where = np.flatnonzero(total)
                rows.append((block, None, None, None, None, total[where].astype(np.uint32 if len(where) and total.max() < 2**32 else np.int64).tobytes(), None, where.astype(np.uint16).tobytes()))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.string()] * 2 + [pa.binary()] * 6, strict=True)], names=names)

        sums, held = defaultdict(list), 0
        for batch in batches:
            head = batch.filter(pa.compute.is_null(batch.column("word")))
            if head.num_rows:
                yield head
            batch = batch.filter(pa.compute.is_valid(batch.column("word")))
            words = batch.column("word").to_pylist()
            fresh = [w for k, w in enumerate(words) if w != (words[k - 1] if k else last)]
            made = iter(counter.pieces(fresh))
            for w, block, docs, times in zip(words, batch.column("block").to_pylist(), batch.column("docs").to_pylist(), batch.column("times").to_pylist(), strict=True):
                if w != last:
                    last, pieces_of_last = w, next(made)
                doc = np.frombuffer(docs, np.uint16)
                sums[block].append((doc, _unpack(times, len(doc)) * pieces_of_last))
                held += len(doc)
            if held >= 2_000_000:
                yield emit(sums)
                sums, held = defaultdict(list), 0
        if sums:
            yield emit(sums)

    return run


def _gather(batch: pa.Table) -> pa.Table:
    """One block: what was counted at once and what came back, by document."""
    head = batch.filter(pa.compute.is_valid(batch.column("ids"))).to_pylist()[0]
    total = np.frombuffer(head["known"], np.int64).copy()
    for row in batch.filter(pa.compute.is_valid(batch.column("at"))).to_pylist():
        at = np.frombuffer(row["at"], np.uint16)
        total[at] += np.frombuffer(row["known"], np.uint32 if len(row["known"]) == 4 * len(at) else np.int64).astype(np.int64)
    return pa.table({"row": np.frombuffer(head["ids"], np.int64), "n_bytes": np.frombuffer(head["n_bytes"], np.int64), "n_tokens": total})


def token_counts(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", hot: int = HOT, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) for each row of ``docs``; ``path`` names the vocabulary file. Null ids stay null."""
    null = -(2**63)
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(null)).alias("row"), F.col(text).alias("text"))
    blocks = rows.mapInArrow(_blocks(path, hot, block_chars), _SCHEMA)
    dealt = blocks.repartition(F.coalesce("word", "block")).sortWithinPartitions("word")
    back = dealt.mapInArrow(_count(path), _SCHEMA).select("block", "ids", "known", "n_bytes", "at")
    out = back.groupBy("block").applyInArrow(_gather, "row long, n_bytes long, n_tokens long")
    return out.select(F.nullif("row", F.lit(null)).alias(doc_id), "n_bytes", "n_tokens")


def digest(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    return token_counts(docs, path).withColumn("over_limit", F.col("n_tokens") > limit)
