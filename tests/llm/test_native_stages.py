"""Line templates, decontamination and mixing: against SQL and by hand."""

import random
import re
from collections import Counter
from itertools import combinations

import duckdb
import pytest

from spanloom.llm import decontamination, line_templates, mixing, registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in "documents benchmark embeddings".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = con.execute(registry.ORACLE_SQL[name])
    names = [d[0] for d in got.description]
    assert sorted(names) == columns
    want = [tuple(r[names.index(c)] for c in columns) for r in got.fetchall()]
    assert sorted(map(str, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(str, want))


@pytest.mark.parametrize("stage", [line_templates.digest, mixing.digest, lambda d: decontamination.overlaps(d, d.selectExpr("doc_id AS item_id", "text"))])
def test_native_stages_have_no_python(spark, stage):
    docs = spark.createDataFrame([(1, "a b c", "en", "src1")], "doc_id long, text string, lang string, source string")
    assert "Python" not in stage(docs)._jdf.queryExecution().toString()


def lines_by_hand(rows, least=5, steady=0.05, share=0.7, edge=6, copied=0.75, spread=0.2):
    """The rule itself over whole lines, leaf by leaf."""
    mask = lambda x: re.sub("[^ ]*[0-9][^ ]*", "<*>", x)
    texts = {text for _, text in rows}
    leaves, ends = {}, {}
    for _, text in rows:
        for line in text.split("\n"):
            if line.strip(" \t\r"):
                w = mask(line).split(" ")
                leaves.setdefault((len(w), *w[:3]), []).append(tuple(w))
    for text in texts:
        for line in text.split("\n"):
            w = line.split(" ")
            for end in (("first", *w[:edge]), ("last", *w[-edge:])):
                ends.setdefault(end, set()).add(text)
    templates = {}
    for leaf, lines in leaves.items():
        count = Counter((k, x) for w in lines for k, x in enumerate(w) if x != "<*>")
        for bound in (least, max(least, steady * len(lines))):
            for w in set(lines):
                constant = [(k, x) for k, x in enumerate(w) if count[k, x] >= bound]
                if constant and len(constant) >= share * sum(x != "<*>" for x in w):
                    templates.setdefault(" ".join(w), set()).add((leaf, *constant))
    common = lambda line: any(len(ends[e]) >= least for e in (("first", *line.split(" ")[:edge]), ("last", *line.split(" ")[-edge:])))
    near = set()
    for text in texts:
        own = [x for x in text.split("\n") if x]
        if own and sum(len(x) for x in own if common(x)) >= copied * sum(map(len, own)) and sum(map(common, own)) >= copied * len(own):
            near.add(text)
    has = {}
    for text in texts:
        for line in text.split("\n"):
            for template in templates.get(mask(line), ()):
                has.setdefault(template, set()).add(text)
    recurs = {x for x, found in has.items() if len(found - near) >= max(least, spread * len(found))}
    return {doc: "\n".join(x for x in text.split("\n") if not templates.get(mask(x), set()) & recurs) for doc, text in rows}


def prose(r, n):
    return " ".join("".join(r.choice("abcdefghijklm") for _ in range(r.randrange(2, 9))) for _ in range(n))


def test_recurring_lines_go_and_copies_stay(spark):
    r = random.Random(3)
    rows = [(i, f"{prose(r, 9)}\nCall 55{i} now to win big prizes today\n{prose(r, 4)}") for i in range(12)]
    rows += [(100 + i, "copy one two three\ncopy four five six\nAll rights reserved\nseven eight nine") for i in range(10)]
    rows += [(200 + i, f"short\nAll rights reserved\n{prose(r, 5)}") for i in range(7)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_templates.drop_templates(df).collect()}
    assert got == lines_by_hand(rows)
    assert "Call" not in got[3] and "rights" not in got[203] and "short" not in got[203] and got[104] == "copy one two three\ncopy four five six\nseven eight nine"


def test_blocks_of_lines_go_and_near_copies_keep_their_lines(spark):
    r = random.Random(5)
    footer = "Contact us for more information\nAll rights are reserved by the owner\nno part may be reproduced\nThank you for reading"
    rows = [(i, f"{prose(r, 12)}\n{prose(r, 30)}\n{footer}") for i in range(60)]
    body = [prose(r, 30) for _ in range(8)]
    for i in range(40):
        lines = [" ".join(w if r.random() > 0.02 else "edit" for w in x.split(" ")) for x in body]
        rows.append((100 + i, "\n".join(lines) + f"\n{footer}"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_templates.drop_templates(df).collect()}
    assert got == lines_by_hand(rows) == {doc: text.replace(f"\n{footer}", "") for doc, text in rows}


def test_pages_that_are_mostly_footer(spark):
    footer = "All rights are reserved by the owner of this page\nNo part of it may be copied without permission\nContact the editors with any question\nTerms and conditions apply"
    rows = [(i, f"{prose(random.Random(i), 3)}\n{prose(random.Random(100 + i), 4)}\n{footer}") for i in range(60)]
    got = line_templates.drop_templates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.text for r in got} == lines_by_hand(rows) == {doc: text.replace(f"\n{footer}", "") for doc, text in rows}


CLASH = "gone text lines row own print at hash leaf head tail size line masked digits n_lines n_dropped __gone __text __lines __print __doc_id __language n template"


def test_columns_of_any_name_stay_as_they_are(spark):
    r = random.Random(6)
    names = [c for c in CLASH.split() if c != "text"]
    rows = [(i, f"{prose(r, 9)}\nAll rights reserved", *range(i, i + len(names))) for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} long" for c in names))
    out = line_templates.drop_templates(df, counts=False)
    assert out.columns == df.columns
    assert sorted(tuple(x)[2:] for x in out.collect()) == [x[2:] for x in rows] and all("rights" not in x.text for x in out.collect())
    out = line_templates.drop_templates(df)
    assert out.columns == [c for c in df.columns if c not in ("n_lines", "n_dropped")] + ["n_lines", "n_dropped"]
    assert {(x.n_lines, x.n_dropped) for x in out.collect()} == {(2, 1)}


def test_a_field_that_varies_is_generalised(spark):
    names = "Anna Bert Carl Dora Emil Fritz Gerd Hans".split()
    r = random.Random(2)
    rows = [(i, f"{prose(r, 8)}\nThis page was last edited by {n}\n{prose(r, 8)}") for i, n in enumerate(names)]
    got = line_templates.drop_templates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all("last edited" not in r.text and r.text.count("\n") == 1 for r in got)


@pytest.mark.parametrize("n", [200, 2000])
def test_fields_stay_variable_with_more_lines(spark, n):
    r = random.Random(1)
    word = lambda kind: kind + "abcdefghijklmnopqrst"[r.randrange(20)] + "abcdefghij"[r.randrange(10)]
    rows = [(i, f"{prose(r, 8)}\nThis page was last edited by {word('n')} in {word('c')}\n{prose(r, 8)}") for i in range(n)]
    got = line_templates.drop_templates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sum("last edited" in row.text for row in got) == 0


def without_lines(spark, rows):
    import corpus_pipeline

    df = spark.createDataFrame([(k, text, len(text)) for k, text in rows], "doc_id long, text string, n_chars long")
    return {r.doc_id: r.text for r in corpus_pipeline.without_boilerplate(spark, df, SF).collect()}


def test_pipeline_counts_equal_texts_once(spark):
    page = "intro y\nAll rights reserved here\noutro y"
    rows = [(i, f"intro a{'abcdefgh'[i]} so\nAll rights reserved here\noutro {'abcdefgh'[i]}") for i in range(8)]
    got = without_lines(spark, rows + [(100 + i, page) for i in range(30)])
    assert got == {k: text.replace("All rights reserved here\n", "") for k, text in rows} | {100 + i: "intro y\noutro y" for i in range(30)}


def test_pipeline_drops_lines_of_one_or_two_tokens(spark):
    rows = [(i, f"intro a{'abcdefgh'[i]}\n版权所有未经许可\n\nmiddle {'abcdefgh'[i]}\nRead more\noutro {'abcdefgh'[i]}") for i in range(8)]
    assert without_lines(spark, rows) == {k: text.replace("版权所有未经许可\n", "").replace("Read more\n", "") for k, text in rows}


def test_pipeline_does_not_hold_fields_against_a_line(spark):
    rows = [(i, f"intro a{'abcdefgh'[i]}\nPage {i} of 10\nmiddle {'abcdefgh'[i]}\nViews: {i} Likes: 5{i}\n{i} {i} {i}\noutro {'abcdefgh'[i]}") for i in range(8)]
    assert without_lines(spark, rows) == {k: text.replace(f"Page {k} of 10\n", "").replace(f"Views: {k} Likes: 5{k}\n", "") for k, text in rows}
    got = {r.doc_id: r.text for r in line_templates.drop_templates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == lines_by_hand(rows) == without_lines(spark, rows)


def test_very_long_texts_lose_recurring_lines(spark):
    r = random.Random(9)
    long = "\n".join([prose(r, 12) if k % 3 else "All rights reserved" for k in range(60_000)] + ["x" * 1_000_000])
    rows = [(0, long)] + [(1 + k, f"{prose(r, 20)}\nAll rights reserved") for k in range(6)]
    got = {r.doc_id: r for r in line_templates.drop_templates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0].text == long.replace("All rights reserved\n", "") and got[0].n_dropped == 20_000


def test_line_edge_rows(spark):
    df = spark.createDataFrame([(1, None, 1), (None, "a b c\nf", 2), (2, "", 3), (2, "", 3)], "doc_id long, text string, hash int")
    rows = line_templates.drop_templates(df).collect()
    assert sorted((r.doc_id or 0, r.text or "-", r.hash, r.n_lines, r.n_dropped) for r in rows) == [(0, "a b c\nf", 2, 2, 0), (1, "-", 1, 0, 0), (2, "-", 3, 1, 0), (2, "-", 3, 1, 0)]
    assert line_templates.drop_templates(df.limit(0)).count() == 0


ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"


def test_overlaps_tolerate_substitutions(spark):
    w = ITEM.split()
    changed = [x if k not in (4, 11, 16) else "other" for k, x in enumerate(w)]
    docs = [(1, f"x y {ITEM.upper()}!"), (2, " ".join(changed)), (3, " ".join(w[3:16])), (4, " ".join(w[:7]) + " and more"), (5, " ".join(x if k % 2 else "no" for k, x in enumerate(w))), (6, "q alpha beta gamma, delta: five-more"), (7, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(1, ITEM), (2, "delta five more"), (3, None), (4, "gamma delta five more q")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_matched, r.n_words, r.start) for r in decontamination.overlaps(df, items).collect()}
    assert got == {(1, 1): (20, 20, 2), (2, 1): (17, 20, 0), (3, 1): (13, 20, -3)}
    assert {r.doc_id for r in decontamination.clean(df, items).collect()} == {4, 5, 6, 7}
    shuffled = decontamination.Settings(broadcast=0)
    assert {(r.doc_id, r.item_id) for r in decontamination.overlaps(df, items, shuffled).collect()} == set(got)


def substituted(n, misses):
    """All ways to replace ``misses`` of the first ``n`` words of ITEM, as documents."""
    for k, gone in enumerate(combinations(range(n), misses)):
        yield k, "before " + " ".join("other" if i in gone else w for i, w in enumerate(ITEM.split()[:n])) + " after"


def test_every_accepted_substitution_is_found(spark):
    docs = [*substituted(12, 3), (1000, " ".join("other" if k % 4 == 3 else w for k, w in enumerate(ITEM.split())))]
    items = spark.createDataFrame([(1, " ".join(ITEM.split()[:12])), (2, ITEM)], "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.n_matched for r in decontamination.overlaps(df, items).collect()}
    assert len(docs) == 221 and all(got[k, 1] == 9 for k, _ in docs[:-1]) and got[1000, 2] == 15


@pytest.mark.parametrize("n, misses", [(5, 1), (6, 1), (7, 1), (8, 2), (9, 2), (10, 2), (11, 2)])
def test_short_items_tolerate_substitutions(spark, n, misses):
    docs = list(substituted(n, misses))
    worse = [(1000 + k, text) for k, text in substituted(n, misses + 1)]
    df = spark.createDataFrame(docs + worse, "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(ITEM.split()[:n]))], "item_id long, text string")
    assert sorted(r.doc_id for r in decontamination.overlaps(df, items).collect()) == [k for k, _ in docs]


def test_scripts_without_blanks_are_cut_into_characters(spark):
    df = spark.createDataFrame([(1, "他问:中国的首都是哪里?"), (2, "中国的首都很大,也很美丽。")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "中国的首都是哪里")], "item_id long, text string")
    assert [(r.doc_id, r.n_matched, r.n_words) for r in decontamination.overlaps(df, items).collect()] == [(1, 8, 8)]


def test_long_items_and_very_long_texts(spark):
    r = random.Random(4)
    item = prose(r, 2_000)
    changed = " ".join("other" if k % 5 == 0 else w for k, w in enumerate(item.split()))
    df = spark.createDataFrame([(1, prose(r, 150_000) + " " + changed + " " + prose(r, 1000)), (2, prose(r, 1000))], "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    for bytes_ in (8_000_000, 0):
        got = [tuple(x) for x in decontamination.overlaps(df, items, decontamination.Settings(broadcast=bytes_)).collect()]
        assert got == [(1, 1, 1_600, 2_000, 150_000)]


def test_overlap_edge_rows(spark):
    items = spark.createDataFrame([(1, "a b c d e"), (2, ""), (None, "v w x y z")], "item_id long, text string")
    df = spark.createDataFrame([(1, None, 1), (None, "a b c d e f", 1), (2, "x A, b c d e", 1), (2, "x A, b c d e", 1), (3, "a b " * 30_000, 1)], "doc_id long, text string, at int")
    assert sorted((r.doc_id or 0, r.item_id) for r in decontamination.overlaps(df, items).collect()) == [(0, 1), (2, 1)]
    assert sorted(r.doc_id for r in decontamination.clean(df, items).collect()) == [1, 3]
    assert decontamination.overlaps(df, items.limit(0)).count() == 0
    assert decontamination.overlaps(df.limit(0), items).count() == 0


def test_shortage_goes_to_siblings_first(spark):
    leaves = spark.createDataFrame([("head", "en", "src1", 10), ("head", "en", "src2", 1000), ("head", "de", "src1", 1000), ("tail", "en", "src11", 5)], "domain string, lang string, source string, tokens long")
    s = mixing.Settings(share=0.2, epochs=1, weights={})
    got = {(r.domain, r.lang, r.source): r.budget for r in mixing.budgets(leaves, s).collect()}
    total = 0.2 * 2015
    assert got[("tail", "en", "src11")] == 5.0  # short: the rest goes to its only sibling
    assert got[("head", "de", "src1")] == pytest.approx((total - 5) / 2)
    assert got[("head", "en", "src1")] == 10.0  # short: made up within the language
    assert got[("head", "en", "src2")] == pytest.approx((total - 5) / 2 - 10)
    assert sum(got.values()) == pytest.approx(total)


def test_small_sources_are_repeated_in_whole_epochs(spark):
    docs = [(i, "w " * 10, "en", "src1") for i in range(5)] + [(100 + i, "w " * 10, "en", "src11") for i in range(95)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    rows = mixing.mixed(df, mixing.Settings(share=0.3, weights={})).collect()
    small = sorted((r.epoch, r.doc_id) for r in rows if r.source == "src1")
    assert {(e, d) for e, d in small if e < 3} == {(e, d) for e in range(3) for d in range(5)}
    assert sum(r.n_tokens for r in rows if r.source == "src1") == 150


def test_mixing_keeps_columns_of_any_name_and_long_texts(spark):
    names = "row __spot __whole __end __end_ __domain __lang __source __sure __before __bin __tokens domain n_tokens epoch n".split()
    rows = [(i, "w " * (300_000 if i == 3 else 10), "en", f"src{i % 2}", *range(i, i + len(names))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} long" for c in names))
    own = [c for c in df.columns if c not in ("domain", "n_tokens", "epoch")]
    got = mixing.mixed(df, mixing.Settings(weights={}))
    assert got.columns == [*own, "domain", "n_tokens", "epoch"]
    given = {r[0]: tuple(r[c] for c in own) for r in df.collect()}
    out = got.collect()
    assert out and all(tuple(r[c] for c in own) == given[r.doc_id] and r.domain == "head" for r in out)


def test_the_end_of_a_budget_among_rows_of_one_id(spark):
    rows = [(7, f"a{i} b", "en", "src1") for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = mixing.mixed(df, mixing.Settings(share=0.35, weights={})).collect()
    assert sorted(r.text for r in got) == [f"a{i} b" for i in range(4)]


def test_mixing_edge_rows(spark):
    df = spark.createDataFrame([(1, None, "en", "src1", 1), (None, "a b c", "en", None, 1), (2, "x y z", None, "src1", 1), (2, "x y z", None, "src1", 1), (3, "", "de", "q", 1)], "doc_id long, text string, lang string, source string, epoch int")
    rows = mixing.mixed(df, mixing.Settings(share=1.0)).collect()
    assert sorted((r.doc_id or 0, r.epoch, r.n_tokens) for r in rows) == [(0, 0, 3), (2, 0, 3), (2, 0, 3)]
    assert mixing.mixed(df.limit(0)).count() == 0


def test_lists_that_are_not_sent_give_the_same_lines(spark):
    r = random.Random(12)
    rows = [(i, f"{prose(r, 12)}\nAll rights reserved\n{prose(r, 9)}\nPage {i} of 20") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [sorted(map(tuple, line_templates.drop_templates(df, line_templates.Settings(most=n)).collect())) for n in (500_000, 0)]
    assert got[0] == got[1] and all(x[3] == 2 for x in got[0])
