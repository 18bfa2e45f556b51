"""Character classes and small helpers for column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that end a word; quotes and brackets are not among them.
WORD_BREAKS = " .,!?;:…\n\r\t"
# Quotation marks of all kinds.
QUOTES = "«“„\"'»”‟"
# Brackets that are stripped from the start.
BRACKETS = "([{<)]}>"
# Punctuation that is stripped from both ends, and what goes from the end besides.
PUNCTUATION = ".,!?;:…—–-•=+@#_|\\/*$%^&~<>"
PUNCTUATION_END = PUNCTUATION + "№"
# Place-name abbreviations, in the order in which they are tried.
ABBREVIATIONS = ("г.о.", "г.п.", "с.п.", "пос.", "г.", "пгт.", "гп.", "дер.", "п.", "с.", "сл.", "ст.", "ст-ца")
# Word ends after which a final dot belongs to the word.
DOTTED = ("г", "ул", "д", "пр", "тд", "тп")
# Function words that are never expanded.
STOP_WORDS = (
    "в", "на", "с", "у", "к", "о", "об", "от", "до", "по", "за", "над", "под", "без", "для", "ради", "из", "через",
    "и", "а", "но", "же", "бы", "ли", "вот", "это", "что", "как", "так", "все", "еще", "уже", "даже", "только",
    "чтобы", "если", "потому", "поэтому",
)
# Pairs that must balance, in the order in which they are looked at.
PAIRS = ("«»", '""', "''", "“”", "„‟", "()", "[]", "{}")


def char_class(chars: str, inverted: bool = False) -> str:
    """A regular-expression class of exactly these characters, for Java and RE2 alike."""
    return f"[{'^' if inverted else ''}{''.join(f'\\x{{{ord(c):X}}}' for c in chars)}]"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def cut(text: Column, start: Column, end: Column) -> Column:
    """Characters start to end (from 0, end exclusive), clamped to the text."""
    low = F.greatest(start, F.lit(0))
    return F.substring(text, low + 1, F.greatest(end - low, F.lit(0)))
