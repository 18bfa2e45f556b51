import pytest

from spanloom.llm import token_counts as T

P = pytest.importorskip("public_tokenizers")
ODD = ["", None, "<|endoftext|>a<|startoftext|><|endoftext|> b", "İstanbul ﬁ ǅ x", "it's I'LL 'S '' ''s x'", "\x1c\x1da\x85b\xa0c", "a" * 5000, "½²³ 12 ٣", "日本語 テキスト", "e\u0301 é", "\x00\x01", "'ſ", "<|ENDOFTEXT|>", "the the the of"]


@pytest.mark.parametrize(("file", "hot", "block"), [("word_bpe_49k.json", 0, 10), ("word_bpe_49k.json", 1, 30), ("word_bpe_49k.json", 64, 32_000_000), ("byte_bpe_50k.json", 1, 1000)])
def test_counts_are_the_librarys(spark, file, hot, block):
    """Also where the file states another way to cut texts than the one that has a pattern of its own."""
    from tokenizers import Tokenizer

    path = str(P.path(file))
    library = Tokenizer.from_file(path)
    texts = ODD + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    df = spark.createDataFrame([(i, t, "w") for i, t in enumerate(texts)], "doc_id long, text string, word string").repartition(3)
    rows = {r.doc_id: r for r in T.token_counts(df, path, hot=hot, block_chars=block).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        assert rows[i].n_bytes == len((t or "").encode())
        assert rows[i].n_tokens == len(library.encode(t or "", add_special_tokens=False).ids)


def test_null_and_repeated_ids_and_empty_table(spark):
    path = str(P.path("word_bpe_49k.json"))
    df = spark.createDataFrame([(None, "a"), (1, "b c"), (1, "b c")], "doc_id long, text string")
    rows = T.digest(df, path).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.over_limit) for r in rows) == [(0, 1, False), (1, 2, False), (1, 2, False)]
    assert T.digest(df.limit(0), path).count() == 0


def test_a_vocabulary_whose_tokens_take_in_blanks_is_refused(tmp_path):
    from tokenizers import AddedToken, Tokenizer

    library = Tokenizer.from_file(str(P.path("word_bpe_49k.json")))
    library.add_tokens([AddedToken("xyz", lstrip=True)])
    library.save(str(tmp_path / "own.json"))
    with pytest.raises(ValueError):
        T.PieceCounter(str(tmp_path / "own.json"))
