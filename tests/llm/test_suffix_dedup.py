import hashlib
import random

import pytest

from spanloom.llm import suffix_dedup as S


def by_hand(rows, length):
    seen, out = set(), {}
    for doc, text in sorted(rows):
        raw = text.encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            w = raw[p : p + length]
            if w in seen:
                gone[p : p + length] = b"\1" * length
            else:
                seen.add(w)
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def passages():
    r = random.Random(1)
    shared = "".join(r.choice("abcd é") for _ in range(130))
    rows = [(i, "".join(r.choice("xyzw ") for _ in range(r.randrange(200))) + shared[r.randrange(20) :] + "".join(r.choice("xyzw ") for _ in range(50))) for i in range(120)]
    return rows + [(900, "a" * 3000), (901, "ab" * 900), (902, "a" * 1000), (903, ""), (904, "z" * 99)]


@pytest.mark.parametrize("heavy", [4096, 2])
@pytest.mark.parametrize("length", [100, 30])
def test_removed_bytes_are_those_of_all_windows(spark, monkeypatch, heavy, length):
    monkeypatch.setattr(S, "HEAVY", heavy)
    rows = passages()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: tuple(r)[1:] for r in S.digest(df, length).collect()}
    assert got == by_hand(rows, length)


def test_short_lengths_and_pieces(spark, monkeypatch):
    r = random.Random(5)
    rows = [(i, "".join(r.choice("ab") for _ in range(60))) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {x.doc_id: tuple(x)[1:] for x in S.digest(df, 11).collect()} == by_hand(rows, 11)
    with pytest.raises(ValueError):
        S.digest(df, 400)


def test_long_texts_come_in_pieces_that_overlap(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(S, "PIECE", 1000)
    text = "".join(random.Random(6).choice("abcdefgh") for _ in range(5000))
    batch = pa.RecordBatch.from_arrays([pa.array([7]), pa.array([text])], names=["doc_id", "text"])
    windows = set()
    for data, starts, docs, offsets in S._pieces(iter([batch]), 100):
        assert len(data) <= 2200
        gram, stretch, doc, at = S._stretches(data, starts, docs, offsets, 100)
        for a in at:
            windows |= {(a >> 16) + k for k in range(a >> 8 & 255)}
    assert windows == set(range(4901))


def test_edge_rows(spark):
    df = spark.createDataFrame([(None, "a" * 200, 1), (1, None, 1), (2, "b" * 150, 1), (2, "b" * 150, 1), (2, "c" * 300, 1)], "doc_id long, text string, doc int")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in S.digest(df).collect()}
    assert got == {1: (0, 0, 0), 2: (150, 149, 1)}
    assert S.digest(df.limit(0)).count() == 0
