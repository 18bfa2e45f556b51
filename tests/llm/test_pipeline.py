import random

import corpus_pipeline as P
import duckdb
import pandas as pd
import regex
import test_language_id
import test_minhash_dedup
import test_native_stages

from spanloom.llm import decontamination, language_id, minhash_dedup, mixing
from spanloom.llm.common import components

SF = "/root/testdata/sf0.001"


def test_each_stage_acts_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF).cache()
        seen[name] = (docs, out)
        assert name == "mixing" or out.columns == columns
        docs = out
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    assert ids(seen["lines"][1]) == ids(seen["lines"][0])
    groups = minhash_dedup.near_duplicates(seen["near_duplicates"][0]).collect()
    assert ids(seen["near_duplicates"][1]) == sorted({r.component_id for r in groups})
    before, after = seen["decontamination"]
    found = {r.doc_id for r in decontamination.overlaps(before, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert ids(after) == sorted(set(ids(before)) - found)
    assert set(ids(seen["mixing"][1])) <= set(ids(after))


def test_run_is_the_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF).cache()
    got = P.run(spark, SF)
    assert sorted(map(str, got.collect())) == sorted(map(str, docs.collect()))


def overlaps_by_hand(texts, items):
    """Documents in which an item lies at some offset with three quarters of some twelve (or all) of its words in place."""
    words = lambda x: regex.findall(r"[\p{L}\p{N}]+", (x or "").lower())
    found = set()
    for doc, text in texts:
        w = words(text)
        for item in items:
            v = words(item)
            n = min(12, len(v))
            if len(v) < 5 or doc in found:
                continue
            for start in range(-len(v) + 1, len(w)) if len(v) >= 9 else range(0, len(w) - len(v) + 1):
                same = [0 <= start + k < len(w) and w[start + k] == x for k, x in enumerate(v)]
                if any(100 * sum(same[k : k + n]) >= 75 * n for k in range(len(v) - n + 1)):
                    found.add(doc)
                    break
    return found


def by_hand(spark, rows, items):
    """The stages one after the other, each by its plain form; ``rows`` (doc_id, text, lang, source, n_chars)."""
    model = language_id.train(spark.createDataFrame(rows, COLUMNS))
    known = []
    for row in rows:
        label, score = test_language_id.by_hand(model, row[1])
        if label != language_id.UNKNOWN and score >= model.level:
            known.append(row)
    lines = test_native_stages.lines_by_hand([(k, r[1]) for k, r in enumerate(known)])
    kept = [(r[0], lines[k], r[2], r[3], len(lines[k])) for k, r in enumerate(known)]
    groups = test_minhash_dedup.by_hand([r[:2] for r in kept])
    kept = [r for r in kept if groups[r[0]][2]]
    found = overlaps_by_hand([r[:2] for r in kept], items)
    documents = pd.DataFrame([r for r in kept if r[0] not in found], columns=["doc_id", "text", "lang", "source", "n_chars"])  # noqa: F841  read by the SQL
    return duckdb.sql(mixing.ORACLE_SQL).fetchall(), dict(zip(documents.doc_id, documents.text, strict=True))


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_run_matches_the_plain_forms_of_its_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    benchmark = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    r = random.Random(8)
    short = [d.text for d in docs if 300 < len(d.text) < 1500]
    rows = [tuple(d) for d in docs if len(d.text) < 6000]
    for k, base in enumerate(short[:6]):  # near copies, a footer, passages of the benchmark, a text of no language
        words = base.split(" ")
        words[r.randrange(len(words))] = "changed"
        rows.append((10_000 + k, " ".join(words), "en", "src1", 0))
        rows.append((10_010 + k, f"{short[10 + k]}\nThe same footer on every page\nAll rights reserved", "en", "src2", 0))
        rows.append((10_020 + k, f"{test_native_stages.prose(r, 40)} {benchmark[k]} {test_native_stages.prose(r, 40)}", "en", "src3", 0))
    rows += [(10_030, "12 34 !!", "en", "src1", 0), (10_031, None, "en", "src1", 0), (10_032, "", None, None, 0)]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    want, texts = by_hand(spark, rows, benchmark)
    got = P.run(spark, str(tmp_path)).collect()
    assert sorted((x.doc_id, x.epoch, x.n_tokens) for x in got) == sorted((x[0], x[1], x[5]) for x in want)
    assert all(x.text == texts[x.doc_id] and x.n_chars == len(x.text) for x in got)
    assert not {10_030, 10_031, 10_032} & set(texts) and not set(range(10_020, 10_026)) & set(texts)
    assert sum("same footer" in t for t in texts.values()) == 0


def test_edge_tables(spark):
    """Nulls, repeated rows, an empty text and a very long one, columns of clashing names; and no rows at all."""
    same = "the same words as ever in a row"
    long = " ".join(f"the long text of many words {k % 977}" for k in range(30_000))
    rows = [(None, same, "en", "src1", 3), (1, None, "en", "src1", None), (2, same, None, None, 3), (2, same, None, None, 3), (3, "la même chose encore", "fr", "src2", 2), (4, "", "en", "src1", 0), (5, long, "en", "src1", 7)]
    names = [c for c in test_native_stages.CLASH.split() if c != "text"] + ["language", "of", "hit", "v_text", "u_text"]
    docs = spark.createDataFrame([(*r, *range(len(names))) for r in rows], COLUMNS + ", " + ", ".join(f"{c} int" for c in names))
    for frame, want in ((docs, {None, 2, 3, 5}), (docs.limit(0), set())):
        out = frame
        for name, stage in P.STAGES:
            out = stage(spark, out, SF).cache()
            if name == "mixing":
                assert set(out.columns) == {*docs.columns, "domain", "n_tokens", "epoch"}
                assert {r.doc_id for r in out.collect()} <= want
            else:
                assert out.columns == docs.columns
                assert {tuple(r[len(rows[0]) :]) for r in out.collect()} <= {tuple(range(len(names)))}
            if name == "language":
                assert sorted((r.doc_id or 0) for r in out.collect()) == ([0, 2, 2, 3, 5] if want else [])
            if name == "decontamination":
                assert {r.doc_id for r in out.collect()} == want
                assert all(r.n_chars == len(r.text) for r in out.collect())


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (9, 9), (10, 30), (20, 30), (20, 21), (21, 22), (22, 23), (23, 24), (None, 4)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 10: 10, 20: 10, 21: 10, 22: 10, 23: 10, 24: 10, 30: 10}


def test_stages_are_the_operators():
    assert [n for n, _ in P.STAGES] == ["language", "lines", "near_duplicates", "decontamination", "mixing"]
