import hashlib
from collections import defaultdict

import pytest

from spanloom.llm import chat_format as C

P = pytest.importorskip("public_tokenizers")
PATH = str(P.path("byte_bpe_50k.json"))


def by_hand(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


ODD = [(1, 0, "user", "a"), (1, 0, "user", "a"), (2, None, None, None), (2, 1, "as:s\\", "\\\\### <|endoftext|> 😀 \r\n é"), (None, 1, "u", "x"), (3, 0, "user", "a"), (3, 1, "assistant", ""), (4, 0, "user", "a"), (4, 1, "assistant", "\\###</turn>\n"), (-7, 0, "user", C.TRICKY), (-7, 1, "assistant", C.TRICKY)]


@pytest.mark.parametrize("tokens", [1, 60, C.PACK_TOKENS])
def test_conversations_are_read_back(spark, tokens):
    rows = ODD + [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect() if r.conv_id > 10]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: tuple(r)[1:5] for r in C.read_back(C.chat_packs(df, PATH, tokens), PATH).collect()}
    assert got == by_hand(rows)


def test_shared_turns_once_with_positions_and_intervals(spark):
    rows = [(i, t, "user", f"turn {t if t < 2 else (i, t)}") for i in range(3) for t in range(4)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1)
    (pack,) = C.chat_packs(df, PATH).collect()
    assert len(pack.nodes) == 2 + 3 * 2 and len(pack.conversations) == 3
    for n in pack.nodes:
        before = sum(a.end - a.start for a in n.attends)
        assert pack.position_ids[n.start : n.end] == list(range(before, before + n.end - n.start))
        assert all(a.end <= n.start for a in n.attends)
    leaf = pack.nodes[pack.conversations[1].leaf]
    seen = [i for a in leaf.attends for i in pack.input_ids[a.start : a.end]] + pack.input_ids[leaf.start : leaf.end]
    assert C._library(PATH).decode(seen, skip_special_tokens=False) == "".join(f"### user:\n{t}</turn>\n" for c, _, _, t in rows if c == pack.conversations[1].conv_id)


def test_escapes_are_reversible():
    for text in ["", "\\", "###", "\\###", "a</turn>\\", "\\\\</turn>###:"]:
        assert C.unescape(C.escape(text)) == text and C.unescape(C.escape(text, True)) == text
        assert "###" not in C.escape(text).replace("\\###", "")


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string, pack string")
    assert [r.conv_id for r in C.digest(df, PATH).collect()] == [-7]
