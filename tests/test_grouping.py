import random
import re

import pytest
from pyspark.sql import functions as F

from spanloom.operators import grouping, tagging

P = f"array<{tagging.PREDICTION}>"


def fold(predictions):
    """The rules, one prediction at a time."""
    done, current = [], []
    for i, p in enumerate(predictions):
        kind = re.sub("^[BI]-", "", p["label"])
        first = re.sub("^[BI]-", "", current[0]["label"]) if current else None
        near = p["label"].startswith("B-") and current and p["start"] - current[-1]["end"] <= 1
        if current and p["label"] != "O" and kind == first and (p["label"].startswith("I-") or near):
            current.append(p)
            continue
        if current:
            done.append(current)
        current = [p] if p["label"] != "O" and (p["label"].startswith("B-") or i == 0) else []
    return done + [current] if current else done


def made(text):
    return [{"idx": i, "label": m[1], "score": 0.9, "word": f"w{i}", "start": int(m[2]), "end": int(m[3])} for i, m in enumerate(re.finditer(r"(\S+)\((\d+)-(\d+)\)", text))]


CASES = {
    "I-PER(0-3) I-PER(3-5)": [[0, 1]],
    "B-LOC(0-6) I-PER(7-9)": [[0]],
    "B-LOC(0-6) B-LOC(7-12)": [[0, 1]],
    "B-LOC(0-6) B-LOC(8-13)": [[0], [1]],
    "B-PER(0-3) I-PER(40-44)": [[0, 1]],
    "B-PER(0-3) O(3-4) I-PER(5-8)": [[0]],
    "B-DATE(0-4) I-DATE(5-9)": [[0, 1]],
    "": [],
}


def groups_of(spark, chunks):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(chunks)], f"n int, p {P}")
    rows = df.select("n", F.transform(grouping.groups(F.col("p")), lambda g: F.transform(g, lambda p: p["idx"])).alias("g")).collect()
    return [r.g for r in sorted(rows, key=lambda r: r.n)]


def test_listed_cases(spark):
    assert groups_of(spark, [made(c) for c in CASES]) == list(CASES.values())


def test_random_chunks(spark):
    r = random.Random(3)
    chunks = []
    for _ in range(400):
        at, own = 0, []
        for i in range(r.randrange(12)):
            at += r.randrange(4)
            own.append({"idx": i, "label": r.choice(["O", "B-LOC", "I-LOC", "B-PER", "I-PER"]), "score": 0.5, "word": "w", "start": at, "end": at + 2})
            at += 2
        chunks.append(own)
    assert groups_of(spark, chunks) == [[[p["idx"] for p in g] for g in fold(c)] for c in chunks]


def test_merged_entity(spark):
    p = [(0, "B-DATE", 0.91239, "▁Пе", 10, 12), (1, "I-DATE", 0.8, "тр", 12, 14), (2, "I-DATE", 0.95, "▁I", 15, 16)]
    row = spark.createDataFrame([(p,)], f"p {P}").select(grouping.merged(F.col("p")).alias("e")).first().e
    assert (row.text, row.type, row.confidence) == ("Петр I", "MISC", 0.8)
    assert [(x.start, x.end) for x in row.positions] == [(10, 12), (12, 14), (15, 16)]


def test_filter_is_inclusive_and_numbers_close_up(spark):
    p = [(0, "B-LOC", 0.49, "a", 0, 1), (1, "I-LOC", 0.5, "b", 2, 3)]
    df = spark.createDataFrame([(5, p)], f"global_start int, predictions {P}")
    (got,) = tagging.shifted(tagging.confident(df, 0.5)).first().predictions
    assert (got.idx, got.word, got.start, got.end) == (0, "b", 7, 8)


def test_model_backend_keeps_going(spark):
    def make():
        def tag(texts):
            if "bad" in texts:
                raise ValueError("no")
            return [[{"entity": "B-LOC", "score": 0.9, "word": t[:2], "start": 0, "end": 2}] for t in texts]

        return tag

    df = spark.createDataFrame([(1, "good"), (2, "bad")], "doc_id long, text string").coalesce(1)
    rows = {r.doc_id: r for r in tagging.from_model(df, make, batch=1).collect()}
    assert rows[1].predictions[0].word == "go" and rows[1].error is None
    assert rows[2].predictions == [] and "ValueError" in rows[2].error


@pytest.mark.parametrize("column", [None, [(0, "B-LOC", 0.9, "w", 0, 1)]])
def test_predictions_from_a_column(spark, column):
    df = spark.createDataFrame([(1, column)], f"doc_id long, given {P}")
    assert len(tagging.from_column(df, "given").first().predictions) == len(column or [])


def test_the_rule_needs_no_list_of_tokens(spark):
    from spanloom.operators import chunking

    r = random.Random(5)
    texts = ["".join(r.choice(["Мир", "Aлександрия", "дом", "x1", " ", " ", "\n", ".", "-", "É", "9A", "_", "Ǆ", "😀"]) for _ in range(r.randrange(60))) for _ in range(400)]
    chunks = chunking.chunk_rows(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 12, 0.25)
    both = [sorted((x.doc_id, x.chunk_id, x.predictions) for x in way.select("doc_id", "chunk_id", "predictions").collect()) for way in (tagging.rule(chunks), tagging.rule_of_text(chunks))]
    assert both[0] == both[1] and any(p for *_, p in both[0])
    kept = [sorted((x.doc_id, x.chunk_id, x.predictions) for x in way.select("doc_id", "chunk_id", "predictions").collect()) for way in (tagging.shifted(tagging.confident(tagging.rule(chunks), 0.5)), tagging.rule_of_text(chunks, 0.5))]
    assert kept[0] == kept[1] and any(p for *_, p in kept[0])


def test_columns_and_one_expression_fold_alike(spark):
    given = [made(c) for c in CASES]
    df = spark.createDataFrame(list(enumerate(given)), f"n int, predictions {P}")
    rows = {r.n: [[p["idx"] for p in g] for g in r.groups] for r in grouping.with_entities(df, 0).collect()}
    assert [rows[n] for n in range(len(given))] == list(CASES.values())
