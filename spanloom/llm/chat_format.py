"""Chat formatting into packs that hold each shared opening once.

A turn is written ``### role:\\n``, the text, then ``</turn>\\n``. Inside roles and texts a backslash goes before
every backslash, ``###`` and ``</turn>`` (and before a colon in a role), so that the marks can always be told
from text and the texts read back. Header, text and footer are encoded apart, so a turn has the same tokens in
every conversation that holds it.

Conversations are sorted by their opening turns and cut into packs of about ``pack_tokens`` tokens. In a pack
they are merged into a prefix tree: turns that conversations share up to there are one node. Nodes are
emitted depth-first, their tokens once; a node's position ids go on from its parent's, and its tokens attend
to the intervals of its ancestors and, causally, to itself. A pack is one row, bounded unless a single
conversation is longer; equal conversations, however many, spread over packs. A turn that all share is thus emitted once a pack. The
sort looks at the first ``SORTED_TURNS`` turns; what conversations share after them is one node where they meet in a pack. The turns of
one conversation are gathered in one row.

Rows of a null ``conv_id`` are left out. Turns of a conversation are ordered by (turn, role, text) with nulls
first, and repeated rows stay as turns of their own. Null roles and texts count as empty. Further columns are
passed over.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The marks of the template.
HEAD, COLON, END = "### ", ":\n", "</turn>\n"
_CONTROL = re.compile(r"\\|###|</turn>")
_CONTROL_ROLE = re.compile(r"\\|###|</turn>|:")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")

#: Tokens and conversations of a pack, about; opening turns that the sort looks at.
PACK_TOKENS, PACK_CONVERSATIONS, SORTED_TURNS = 65_536, 2_048, 16

PACK = (
    "pack string, input_ids array<int>, position_ids array<int>, "
    "nodes array<struct<start:int,body:int,foot:int,end:int,parent:int,learned:boolean,attends:array<struct<start:int,end:int>>>>, "
    "conversations array<struct<conv_id:long,leaf:int>>"
)


def escape(text: str, role: bool = False) -> str:
    return (_CONTROL_ROLE if role else _CONTROL).sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


def _library(path: str):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    library.no_truncation()
    library.no_padding()
    return library


class _Pack:
    """A prefix tree that grows by conversations and is emitted depth-first."""

    def __init__(self, library, loss_role: str):
        self.library, self.loss_role = library, loss_role
        self.children: list[dict[tuple[str, str], int]] = [{}]
        self.tokens: list[tuple[list[int], list[int], list[int]]] = [([], [], [])]
        self.leaves: list[tuple[int, int]] = []
        self.learned, self.size = [False], 0

    def add(self, conv_id: int, turns: list[tuple[str, str]]) -> None:
        at, fresh = 0, []
        for turn in turns:
            if turn not in self.children[at]:
                self.children[at][turn] = len(self.children)
                self.children.append({})
                self.learned.append(turn[0] == self.loss_role)
                fresh.append(turn)
            at = self.children[at][turn]
        parts = [s for role, text in fresh for s in (HEAD + escape(role, True) + COLON, escape(text), END)]
        ids = [e.ids for e in self.library.encode_batch_fast(parts, add_special_tokens=False)]
        self.tokens += zip(ids[::3], ids[1::3], ids[2::3], strict=True)
        self.size += sum(map(len, ids))
        self.leaves.append((conv_id, at))

    def row(self, name: str) -> tuple:
        ids: list[int] = []
        positions: list[np.ndarray] = []
        nodes: list[dict] = []
        place = {0: -1}
        stack = [(child, -1, 0, ()) for child in reversed(self.children[0].values())]
        while stack:
            node, parent, position, above = stack.pop()
            head, body, foot = self.tokens[node]
            start = len(ids)
            ids += head + body + foot
            end = len(ids)
            place[node] = len(nodes)
            nodes.append({"start": start, "body": start + len(head), "foot": end - len(foot), "end": end, "parent": parent, "learned": self.learned[node], "attends": [{"start": a, "end": b} for a, b in above]})
            positions.append(np.arange(position, position + end - start, dtype=np.int32))
            # Intervals that touch are one.
            below = (*above[:-1], (above[-1][0], end)) if above and above[-1][1] == start else (*above, (start, end))
            stack += [(child, place[node], position + end - start, below) for child in reversed(self.children[node].values())]
        return (name, np.array(ids, np.int32), np.concatenate(positions) if positions else np.zeros(0, np.int32), nodes, [{"conv_id": c, "leaf": place[leaf]} for c, leaf in self.leaves])


def _pack(path: str, pack_tokens: int, pack_conversations: int, loss_role: str, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        library, part, number = _library(path), TaskContext.get().partitionId(), 0
        pack = _Pack(library, loss_role)

        def flush() -> pa.RecordBatch:
            row = pack.row(f"{part}:{number}")
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            for row in batch.to_pylist():
                pack.add(row["conv_id"], [(t["role"], t["text"]) for t in row["turns"]])
                if pack.size >= pack_tokens or len(pack.leaves) >= pack_conversations:
                    yield flush()
                    pack, number = _Pack(library, loss_role), number + 1
        if pack.leaves:
            yield flush()

    return run


def chat_packs(conversations: DataFrame, path: str, pack_tokens: int = PACK_TOKENS, pack_conversations: int = PACK_CONVERSATIONS, loss_role: str = "assistant") -> DataFrame:
    """Packs of ``conversations`` (conv_id, turn, role, text) with the vocabulary file at ``path``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    turns = (
        conversations.where(F.col("conv_id").isNotNull())
        .groupBy(F.col("conv_id").cast("long").alias("conv_id"))
        .agg(F.array_sort(F.collect_list(F.struct(F.coalesce(F.col("turn").cast("long"), F.lit(-(2**63))).alias("turn"), text("role"), text("text")))).alias("turns"))
    )
    opening = F.array_join(F.transform(F.slice("turns", 1, SORTED_TURNS), lambda t: F.hex(F.xxhash64(t["role"], t["text"]))), "/")
    dealt = turns.withColumn("opening", opening).repartitionByRange("opening", "conv_id").sortWithinPartitions("opening", "conv_id")
    schema = to_arrow_schema(_parse_datatype_string(PACK))
    return dealt.select("conv_id", "turns").mapInArrow(_pack(path, pack_tokens, pack_conversations, loss_role, schema), PACK)


def _read(path: str):
    """Conversations of a pack, from its tokens, its mask and its tree alone."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = _library(path)
        for batch in batches:
            for pack in batch.to_pylist():
                ids = pack["input_ids"]
                spell = lambda a, b: library.decode(ids[a:b], skip_special_tokens=False) if b > a else ""
                texts = [(spell(n["start"], n["body"]), spell(n["body"], n["foot"]), spell(n["foot"], n["end"])) for n in pack["nodes"]]
                read: dict[int, tuple] = {}
                for conv in pack["conversations"]:
                    if conv["leaf"] not in read:
                        chain, at = [], conv["leaf"]
                        while at >= 0:
                            chain.append(at)
                            at = pack["nodes"][at]["parent"]
                        turns, loss, size = hashlib.sha256(), [], 0
                        for at in reversed(chain):
                            head, body, foot = texts[at]
                            if not (head.startswith(HEAD) and head.endswith(COLON) and foot == END):
                                raise ValueError("a turn without its marks")
                            role, text = unescape(head[len(HEAD) : -len(COLON)]), unescape(body)
                            turns.update(f"{role}\n{text}\n".encode())
                            size += len(head) + len(body) + len(foot)
                            if pack["nodes"][at]["learned"]:
                                loss.append(text)
                        learned = "".join(loss)
                        read[conv["leaf"]] = (len(chain), turns.hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest(), size)
                rows = [(c["conv_id"], *read[c["leaf"]]) for c in pack["conversations"]]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return run


def read_back(packs: DataFrame, path: str) -> DataFrame:
    """One row per conversation, read from the packs."""
    return packs.mapInArrow(_read(path), "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


#: A conversation whose texts hold the marks themselves.
TRICKY = r"\### Assistant: </turn> ok"


def digest(conversations: DataFrame, path: str) -> DataFrame:
    more = conversations.sparkSession.createDataFrame([(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)], "conv_id long, turn long, role string, text string")
    return read_back(chat_packs(conversations.select("conv_id", "turn", "role", "text").unionByName(more), path), path)
