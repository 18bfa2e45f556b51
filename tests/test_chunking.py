import re

import pytest
from pyspark.sql import functions as F

from spanloom.operators import assembly, chunking

TEXTS = [
    "",
    "   ",
    "x",
    "\nКороткий текст",
    "А" * 1000,
    "Тест с дефисом и пробелами. Москва-река, Санкт-Петербург",
    "😀 a_b 12,5 \t\n z",
    " ".join(f"w{i}" for i in range(510)),
    " ".join(f"w{i}" for i in range(511)),
    "long text, " * 3000,
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)) + [(99, None)], "doc_id long, text string")


def test_tokens_have_exact_offsets(docs):
    for row in docs.where("text is not null").select("text", chunking.tokens(F.col("text")).alias("t")).collect():
        want = [(m[0], m.start(), m.end()) for m in re.finditer(r"\w+|[^\w\s]", row.text)]
        assert [(t.word, t.start, t.end) for t in row.t] == want


@pytest.mark.parametrize(("most", "overlap"), [(512, 0.0), (64, 0.0), (64, 0.25)])
def test_chunks_are_numbered_and_within_the_text(docs, most, overlap):
    rows = chunking.chunk_rows(docs, most, overlap).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
        assert r.text == TEXTS[r.doc_id][r.global_start : r.global_end]
        assert r.before == TEXTS[r.doc_id][max(0, r.global_start - 31) : r.global_start]
        assert r.after == TEXTS[r.doc_id][r.global_end : r.global_end + 31]
        assert r.token_count <= most
    assert sorted(by) == list(range(len(TEXTS)))
    step = most - 2 - chunking.stride(most, overlap)
    for doc, own in by.items():
        own.sort(key=lambda r: r.chunk_id)
        assert [r.chunk_id for r in own] == list(range(own[0].total_chunks))
        n = len(re.findall(r"\w+|[^\w\s]", TEXTS[doc]))
        assert own[0].total_chunks == max(0, -(-(n - (most - 2)) // step)) + 1


def test_chunks_must_advance(docs):
    with pytest.raises(ValueError):
        chunking.chunk_rows(docs, 4, 0.9)


def test_reassembly_needs_every_chunk(docs):
    chunks = chunking.chunk_rows(docs, 64)
    whole = {r.doc_id: r.text for r in assembly.reassembled(chunks).collect()}
    assert whole[4] == TEXTS[4]
    assert assembly.incomplete(chunks).count() == 0
    assert {r.doc_id for r in assembly.incomplete(chunks.where("chunk_id <> 1")).collect()} == {7, 8, 9}


def tokenizer_file():
    try:
        import public_tokenizers
    except ImportError:
        pytest.skip("no tokenizer files here")
    return str(public_tokenizers.path("byte_bpe_50k.json"))


def test_chunks_by_a_tokenizer(docs):
    from tokenizers import Tokenizer

    path = tokenizer_file()
    plain = Tokenizer.from_file(path)
    rows = chunking.chunk_rows(docs, 64, 0.25, chunking.tokenizer_tokens(path)).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
        assert r.text == TEXTS[r.doc_id][r.global_start : r.global_end] and r.token_count <= 64
    step = 62 - chunking.stride(64, 0.25)
    for doc, own in by.items():
        offsets = plain.encode(TEXTS[doc], add_special_tokens=False).offsets
        own.sort(key=lambda r: r.chunk_id)
        assert [r.chunk_id for r in own] == list(range(max(0, -(-(len(offsets) - 62) // step)) + 1))
        for r in own:
            part = offsets[r.chunk_id * step :][:62]
            assert [(t.start, t.end) for t in r.tokens] == part and r.token_count == len(part) + 2
    assert sorted(by) == list(range(len(TEXTS)))


def test_a_document_that_fails_is_left_out_and_named(docs):
    bad = lambda text: F.when(F.length(text) == 1, F.lit(None)).otherwise(chunking.tokens(text))
    assert {r.doc_id for r in chunking.chunk_rows(docs, 512, 0.0, bad).collect()} == set(range(len(TEXTS))) - {2}
    assert [r.doc_id for r in chunking.failed(docs, bad).collect()] == [2]
    assert chunking.failed(docs).count() == 0


def test_running_sums(spark):
    for n in (0, 1, 127, 128, 129, 1000):
        got = spark.range(1).select(chunking.running_sums(F.slice(F.sequence(F.lit(1), F.lit(1000)), 1, F.lit(n))).alias("s")).first().s
        assert got == [k * (k + 1) // 2 for k in range(1, n + 1)]


def test_a_small_corpus_is_dealt_out(spark):
    from spanloom.sources import tables

    assert tables.spread(spark.range(0, 10, 1, 2), 5).rdd.getNumPartitions() == 5
    assert tables.spread(spark.range(0, 10, 1, 9), 5).rdd.getNumPartitions() == 9


def test_a_tokenizer_file_holds_few_chunks_at_a_time(monkeypatch):
    import pyarrow as pa

    class Frame:
        def mapInArrow(self, run, schema):
            return run

    monkeypatch.setattr(chunking, "BATCH_ROWS", 50)
    taken = []
    given = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(["some words, " * 40] * 300)], ["doc_id", "document"])
    file = chunking.TokenizerFile(tokenizer_file())
    encoded = file.encoded
    file.encoded = lambda text: taken.append(1) or encoded(text)
    batches = file.chunks(Frame(), 62, 62, listed=False)(iter([given]))
    first = next(batches)
    assert first.num_rows == 50 and len(taken) < 50
    rest = list(batches)
    assert all(b.num_rows <= 50 for b in rest) and len({d for b in [first, *rest] for d in b["doc_id"].to_pylist()}) == 300


def test_chunks_without_listed_tokens_are_the_same(docs):
    tokens = chunking.tokenizer_tokens(tokenizer_file())
    whole = sorted(tuple(r) for r in chunking.chunk_rows(docs, 64, 0.25, tokens).drop("tokens").collect())
    assert whole == sorted(tuple(r) for r in chunking.chunk_rows(docs, 64, 0.25, tokens, listed=False).collect())
    plain = {r.doc_id: r.t for r in docs.where("text is not null").select("doc_id", tokens(F.col("text")).alias("t")).collect()}
    for r in chunking.chunk_rows(docs, 64, 0.0, tokens).collect():
        assert r.tokens == plain[r.doc_id][r.chunk_id * 62 :][:62]


@pytest.mark.parametrize(("most", "overlap"), [(512, 0.0), (8, 0.0), (12, 0.25), (12, 0.8)])
def test_blocks_give_the_chunks_that_lists_of_tokens_give(docs, most, overlap):
    listed = lambda text: chunking.tokens(text)  # noqa: E731  any other way than the pattern's own goes by lists
    ways = [chunking.chunk_rows(docs, most, overlap, *way) for way in ((), (listed,))]
    got = [sorted((r.asDict(recursive=True) for r in way.collect()), key=lambda r: (r["doc_id"], r["chunk_id"])) for way in ways]
    assert got[0] == got[1]


def test_chunks_do_not_carry_the_whole_text(docs):
    rows = chunking.chunk_rows(docs, 512)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    carried = [line for line in plan.splitlines() if "Generate explode" in line]
    assert carried and not any("document" in line or "tokens" in line for line in carried)
