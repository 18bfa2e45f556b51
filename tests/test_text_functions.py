import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from spanloom.functions import chars, cleaning, expansion

# (text, type, cleaned)
CLEANED = [
    ("Петербург.", "ORG", "Петербург."),
    ("Петербург.", "LOC", "Петербург"),
    ("Москва.", "ORG", "Москва"),
    ("Пушкин А. С.", "PER", "Пушкин А. С."),
    ("Пушкин А.С.", "PER", "Пушкин А.С."),
    ("«Мир", "ORG", "Мир"),
    ('"Мир', "ORG", '"Мир'),
    ('"А" и "Б"', "ORG", '"А и Б"'),
    ("г. Москва", "LOC", "Москва"),
    ("г. Москва", "ORG", "г. Москва"),
    ("г.Москва", "LOC", "г.Москва"),
    ("пос. г. Абрау,", "LOC", "Абрау"),
    ("(Крым", "LOC", "Крым"),
    ("Крым)", "LOC", "Крым"),
    ("Дом №", "ORG", "Дом No"),
    ("… Алданов…", "PER", "Алданов"),
    ("-Дюрсо-", "LOC", "Дюрсо"),
    ("д. 151.", "ORG", "д. 151."),
    ("Ростов-на-Дону", "LOC", "Ростов-на-Дону"),
    ("​Мос­ква река", "LOC", "Москва река"),
    ("((а)", "ORG", "а"),
    ("ООО “Мир„", "ORG", "ООО Мир"),
    ("", "LOC", ""),
    ("...", "LOC", ""),
]


def test_cleaning_cases(spark):
    df = spark.createDataFrame(CLEANED, "t string, k string, want string")
    rows = df.select("t", "k", "want", cleaning.cleaned(F.col("t"), F.col("k")).alias("got")).collect()
    assert [(r.t, r.k, r.got) for r in rows] == [(r.t, r.k, r.want) for r in rows]


def edges_by_hand(t):
    """Dots that belong to a word are set aside, then both ends are stripped."""
    dot = "\ue000"
    kept = re.sub(r"(?:(?<=[А-ЯA-Z])|(?<=\d)|(?<=[гГдД])|(?<=[уУ][лЛ])|(?<=[пП][рР])|(?<=[тТ][дДпП]))\.(?=\s|\Z)", dot, t)
    start = set(chars.PUNCTUATION + chars.BRACKETS)
    while kept and kept[0] in start:
        kept = kept[1:]
    kept = kept.lstrip(" ")
    while kept and kept[-1] in chars.PUNCTUATION_END + " ":
        kept = kept[:-1]
    return kept.strip("-").replace(dot, ".")


def prefix_by_hand(t):
    while True:
        before = t
        for a in chars.ABBREVIATIONS:
            if t.lower().startswith(a) and (len(t) == len(a) or t[len(a)] in " \t\n\r"):
                t = t[len(a) :].lstrip()
                break
        t = t.strip()
        t = t.strip(chars.PUNCTUATION)
        if t == before:
            return t


def paired_by_hand(t):
    for a, b in chars.PAIRS:
        if t.count(a) != t.count(b):
            t = t.replace(a, "").replace(b, "")
        elif t.count(a) > 1 and t.find(a) < t.rfind(b):
            x, y = t.find(a), t.rfind(b)
            t = t[:x] + a + t[x + 1 : y].replace(a, "").replace(b, "") + b + t[y + 1 :]
    return t


@pytest.mark.parametrize(
    ("step", "by_hand", "alphabet"),
    [
        (cleaning.edges, edges_by_hand, ["А", "а", "г", "ул", "1", ".", ".", " ", ",", "-", "(", ")", "№", "«", "Z"]),
        (cleaning.without_prefix, prefix_by_hand, ["г.", "г.о.", "пос.", "ст-ца", "с.", " ", " ", ".", "-", "Дом", "х"]),
        (cleaning.paired, paired_by_hand, ["«", "»", '"', "'", "“", "”", "(", ")", "[", "]", "а", "б"]),
    ],
)
def test_random_strings(spark, step, by_hand, alphabet):
    r = random.Random(7)
    texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(10))) for _ in range(1500)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", step(F.col("t")).alias("got")).collect()
    assert [(r.t, r.got) for r in rows if r.got != by_hand(r.t)] == []


def test_normalising_reaches_every_character_that_changes(spark):
    every = [chr(c) for c in range(0x20, 0x3000) if not 0xD800 <= c < 0xE000]
    rows = spark.createDataFrame([(t,) for t in every], "t string").select("t", cleaning.normalised(F.col("t")).alias("n")).collect()
    assert all(r.n == unicodedata.normalize("NFKC", r.t) for r in rows)


# (document, start, end, type) and (text, kind, start, end)
EXPANDED = [
    (("из Петербурга вышел", 3, 9, "LOC"), ("Петербурга", "right", 3, 13)),
    (("писал Алданов… Удивительная книга", 7, 17, "PER"), ("лданов… Уд", None, 7, 17)),
    (("из Москвы-реки", 3, 6, "LOC"), ("Москвы-реки", "right", 3, 14)),
    (("в «Мире искусства» был", 3, 7, "ORG"), ("«Мире", "left", 2, 7)),
    (("А.С.Пушкин жил", 4, 8, "PER"), ("Пушкин", "right", 4, 10)),
    (("Вернувшись домой", 0, 3, "PER"), ("Вернувшись", "right", 0, 10)),
    (("Москва рада", 0, 7, "LOC"), ("Москва ", None, 0, 7)),
    (("близ Ново(старый)града х", 5, 9, "LOC"), ("Ново", None, 5, 9)),
    (("аКрасновороноважская", 1, 3, "LOC"), ("Кр", "none", 1, 3)),
    (("в доме", 0, 1, "LOC"), ("в", None, 0, 1)),
    (("но домами", 0, 2, "ORG"), ("но", None, 0, 2)),
]


def test_expansion_cases(spark):
    rows = [(d[s:e], k, s, e, d[max(0, s - 31) : s], d[s:e], d[e : e + 31], n) for n, ((d, s, e, k), _) in enumerate(EXPANDED)]
    df = spark.createDataFrame(rows, "text string, type string, start_pos int, end_pos int, left string, inside string, right string, n int")
    got = {r.n: (r.new_text, r.kind, r.new_start, r.new_end) for r in expansion.expanded(df).collect()}
    for n, (given, want) in enumerate(EXPANDED):
        if n != 1:
            assert got[n] == want, given
    # The break inside the span takes back the right side only.
    assert got[1] == ("Алданов… Уд", "left", 6, 17)


def test_entities_of_other_types_stay(spark):
    df = spark.createDataFrame([("Ми", "MISC", 0, 2, "", "Ми", "р")], "text string, type string, start_pos int, end_pos int, left string, inside string, right string")
    row = expansion.expanded(df).first()
    assert (row.new_text, row.expand, row.reason, row.changed) == ("Ми", False, "type", False)


def test_prefixes_of_long_lines_take_one_pass(spark):
    """Marks and abbreviations inside a line are no reason for rounds over it."""
    import time

    texts = ["г. " + "слово, " * 20_000, "- " * 40_000, "г. " * 20_000 + "Москва", "Москва" + " ." * 40_000]
    start = time.perf_counter()
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(cleaning.without_prefix(F.col("t")).alias("got")).collect()
    assert [r.got for r in rows] == [("слово, " * 20_000).strip(", "), "", "Москва", "Москва"]
    assert time.perf_counter() - start < 20


def test_prefixes_where_the_ends_meet(spark):
    marks = ["г.", "г.о.", "ст-ца", "с.", "п.", " ", ",", ".", "\t", "Уфа"]
    r = random.Random(11)
    texts = ["".join(r.choice(marks) for _ in range(r.randrange(14))) for _ in range(3000)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", cleaning.without_prefix(F.col("t")).alias("got")).collect()
    assert [(r.t, r.got) for r in rows if r.got != prefix_by_hand(r.t)] == []
