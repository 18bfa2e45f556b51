import math
import random

import pytest
from pyspark.sql import functions as F

from spanloom.llm import language_id as L


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = L.digest(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right, rejected, n = out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count_if("rejected"), F.count("*")).first()
    assert right > 0.97 and rejected <= 0.01 * n


def test_predictions_use_the_text_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = L.train(docs)
    ask = lambda df: [tuple(r.p) for r in df.select("text", L.predict(model, F.col("text")).alias("p")).orderBy("text").collect()]
    assert ask(docs) == ask(docs.select("text", F.lit("xx").alias("lang")).repartition(3))


def test_edge_rows(spark):
    rows = [(1, None, "en"), (None, "abc the", "en"), (3, "123 !!", "fr"), (3, "", "fr"), (4, "的 日本", "xx"), (5, "word " * 300_000, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = L.digest(df).collect()
    assert len(out) == len(rows)
    assert [r.lang_pred for r in out if r.doc_id in (1, 3)] == ["und"] * 3
    assert all(0 <= r.score <= 1 for r in out)
    assert L.digest(df.limit(0)).count() == 0
    unlabelled = L.digest(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"} and {r.score for r in unlabelled} == {0.0}


def test_long_text_is_read_whole():
    words = L.Subwords(1 << 12)
    text = "ab cd. " * 200_000
    blocks = list(words.blocks([text]))
    assert len(blocks) > 1
    assert sum(len(ids) for ids, _, _ in blocks) >= 3 * len(text) * 5 // 7 - 100


def by_hand(model, text):
    """Label and score from the definition, one subword at a time."""
    run = "\0"
    for ch in text or "":
        low = ch.lower() if ch.isalpha() else "\0"
        low = low if len(low) == 1 else ch
        if low != "\0" or run[-1] != "\0":
            run += low
    run += "" if run[-1] == "\0" else "\0"
    if not any(c != "\0" for c in run):
        return L.UNKNOWN, 0.0
    mask, rows = 2**64 - 1, []
    for n in L.ORDERS:
        for k in range(len(run) - n + 1):
            h = ord(run[k]) + 1
            for j in range(1, n):
                h = (h * 0x9E3779B97F4A7C15 + ord(run[k + j]) + j + 1) & mask
            rows.append((((h ^ (h >> 29)) * 0xBF58476D1CE4E5B9 & mask) >> 33) % len(model.table))
    z = sum(model.table[r] for r in rows) / len(rows)
    z = ((z if model.linear is None else z @ model.linear) + model.bias) / model.temperature
    p = [math.exp(x - max(z)) for x in z]
    return model.labels[p.index(max(p))], max(p) / sum(p)


@pytest.mark.parametrize("languages", [3, 40])
def test_predictions_are_those_of_a_plain_computation(spark, languages):
    r = random.Random(languages)
    letters = ["".join(r.sample("abcdefghijklmnopqrstuvwxyzäéñ", 7)) for _ in range(languages)]
    word = lambda k: "".join(r.choice(letters[k]) for _ in range(r.randrange(1, 9)))
    rows = [(i, " ".join(word(i % languages) for _ in range(30)), f"l{i % languages:02}") for i in range(12 * languages)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.train(docs)
    assert model.labels == tuple(sorted({x for _, _, x in rows})) and (model.linear is None) == (languages <= L.Settings().dim)
    texts = [t for _, t, _ in rows[:20]] + ["", None, "12 !", "A", "ÄÉ x-y  z", "İstanbul ß ŉ", "的 日本", "a" * 5000]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").select("i", L.predict(model, F.col("text")).alias("p")).collect()
    for row in got:
        label, score = by_hand(model, texts[row.i])
        assert row.p.label == label and row.p.score == pytest.approx(score, abs=1e-9)
        assert row.p.rejected == (label == L.UNKNOWN or row.p.score < model.level)


def test_the_sample_is_bounded(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    seen, fit = [], L._fit
    for held in (8_000_000, 20_000):
        L._fit = lambda labels, data, s: seen.append(sum(len(ids) for ids, _, _ in data)) or fit(labels, data, s)
        try:
            L.train(docs, settings=L.Settings(held=held, epochs=1))
        finally:
            L._fit = fit
    assert seen[0] > 100_000 and seen[1] < 60_000
