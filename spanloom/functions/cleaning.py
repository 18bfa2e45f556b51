"""Cleaning of entity strings. All steps but Unicode normalisation are column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from spanloom.functions.chars import ABBREVIATIONS, BRACKETS, DOTTED, PAIRS, PUNCTUATION, PUNCTUATION_END, char_class, let

#: Stands for a dot that belongs to a word while ends are stripped; private use, so no text holds it by then.
_DOT = "\ue000"
#: Texts of these characters alone are their own compatibility form.
_STABLE = r"^[\x00-\x7F\x{AB}\x{BB}\x{C0}-\x{FF}\x{401}\x{410}-\x{44F}\x{451}–—“”„‟]*\z"


def normalised(text: Column) -> Column:
    """Unicode compatibility composition; only texts that may change reach Python."""
    @F.pandas_udf("string")
    def nfkc(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))

    return F.coalesce(nfkc(F.when(~text.rlike(_STABLE), text)), text)


def without_controls(text: Column) -> Column:
    return F.regexp_replace(text, r"[\p{Cc}\p{Cf}\p{Cn}\p{Co}\p{Cs}&&[^ \t\n\r]]", "")


def collapsed(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)[\s ]+", " ")


def edges(text: Column) -> Column:
    """Punctuation off both ends; a final dot after an initial, a number or an abbreviation stays."""
    own = rf"(?<=[А-ЯA-Z]|\p{{Nd}}|(?iu:{'|'.join(DOTTED)}))\.(?=\s|\z)"
    kept = F.regexp_replace(text, own, _DOT)
    kept = F.regexp_replace(kept, f"^{char_class(PUNCTUATION + BRACKETS)}+", "")
    kept = F.regexp_replace(kept, "^ +", "")
    kept = F.regexp_replace(kept, rf"{char_class(PUNCTUATION_END + ' ')}+\z", "")
    kept = F.regexp_replace(kept, r"^-+|-+\z", "")
    return F.replace(kept, F.lit(_DOT), F.lit("."))


def _balanced(text: Column, opens: str, closes: str) -> Column:
    without = lambda t: F.translate(t, opens + closes, "")
    count = lambda t, c: F.length(t) - F.length(F.replace(t, F.lit(c), F.lit("")))

    def fixed(t: Column) -> Column:
        first = F.instr(t, opens)
        last = F.length(t) - F.instr(F.reverse(t), closes) + 1
        middle = without(F.substring(t, first + 1, last - first - 1))
        inner = F.concat(F.substring(t, F.lit(1), first), middle, F.substring(t, last, F.length(t)))
        several = (count(t, opens) > 1) & (first < last)
        return F.when(count(t, opens) != count(t, closes), without(t)).when(several, inner).otherwise(t)

    return let(text, fixed)


def paired(text: Column) -> Column:
    """Quotes and brackets in balance: kinds whose counts differ go, and of several pairs the outermost stays."""

    def balanced(text: Column) -> Column:
        for opens, closes in PAIRS:
            text = _balanced(text, opens, closes)
        return text

    # Most strings have none of them.
    return let(text, lambda t: F.when(t.rlike(char_class("".join(PAIRS))), balanced(t)).otherwise(t))


def without_prefix(text: Column) -> Column:
    """Abbreviations of places off the start, and punctuation off both ends, until nothing changes.

    Where enough is left between them that no abbreviation could stand there, the ends know nothing of each other and each goes at once, in one
    pass. Else they go round by round, until one of them is done.
    """
    marks = char_class(PUNCTUATION)
    short = "|".join(a.replace(".", r"\.") for a in ABBREVIATIONS)
    either = rf"(?:{marks}|(?U:\s))"

    def step(t: Column) -> Column:
        t = F.regexp_replace(t, rf"(?iu)^(?:{short})(?:(?U)\s+|\z)", "")
        t = F.regexp_replace(t, r"(?U)^\s+|(?<!\s)\s+\z", "")
        return F.regexp_replace(t, rf"^{marks}+|(?<!{marks}){marks}+\z", "")

    # All rounds of one end, as long as the other is far away.
    start = rf"^(?:(?iu:(?:{short})(?:(?U:\s)++|\z))?+(?U:\s)*+{marks}*+)++"
    end = rf"(?<!{either}){either}++\z"
    # Each round but the first and the last takes an abbreviation off that stands before a blank or the end, or a
    # mark that stands beside a blank.
    turns = rf"(?iu)(?:{short})(?=(?U)\s|\z)|{marks}(?=(?U)\s)|(?<=(?U)\s){marks}"

    def ended(t: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(t, end, ""), start, "")

    def by_rounds(t: Column) -> Column:
        count = lambda side: F.regexp_count(F.regexp_extract(t, side, 0), F.lit(turns)) + 2
        return ended(F.aggregate(F.sequence(F.lit(1), F.least(count(start), count(end))), t, lambda acc, _: step(acc)))

    longest = max(map(len, ABBREVIATIONS))
    return let(text, lambda t: let(ended(t), lambda done: F.when(F.length(done) > longest, done).when(~t.rlike(rf"(?U)[^\s{marks[1:-1]}]"), F.lit("")).otherwise(by_rounds(t))))


def trimmed(text: Column) -> Column:
    return F.trim(collapsed(text))


def cleaned(text: Column, kind: Column, beginning: bool = True, unicode: bool = True) -> Column:
    """All steps. ``unicode`` may be off where texts are known to be in compatibility form."""
    out = normalised(text) if unicode else text
    out = paired(edges(collapsed(without_controls(out))))
    if beginning:
        out = F.when(kind == "LOC", without_prefix(out)).otherwise(out)
    return F.when(text == "", text).otherwise(trimmed(out))
