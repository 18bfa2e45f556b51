"""Growing an entity to whole words, as column expressions over its text and what stands around it.

Inputs are columns: ``text`` (the entity), ``type``, ``start_pos``, ``end_pos``, and the document just before, inside and
just after the span (``left``, ``inside``, ``right``). A side that is empty is the document's edge.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions.chars import QUOTES, STOP_WORDS, WORD_BREAKS, char_class
from spanloom.operators.tagging import MARK

LETTER = r"^\p{L}$"


@dataclass(frozen=True)
class ExpansionConfig:
    min_token_length: int = 2
    max_search_left: int = 30
    max_search_right: int = 30
    require_capital: bool = True
    enable_stopwords: bool = True
    expand_entity_types: tuple[str, ...] = ("LOC", "PER", "ORG")
    max_sentence_ratio: float = 5.0
    max_words: int = 8
    enable_final_cleaning: bool = True
    enable_beginning_cleaning: bool = True


def eligible(config: ExpansionConfig) -> Column:
    """Entities that may change at all: of a listed type, with a place."""
    return F.col("type").isin(*config.expand_entity_types) & F.col("start_pos").isNotNull() & F.col("end_pos").isNotNull()


def decision(config: ExpansionConfig = ExpansionConfig()) -> Column:
    """(expand, reason): whether there is room on a side, and why not."""
    breaks, quotes = char_class(WORD_BREAKS), char_class(QUOTES)
    before, second = F.right("left", F.lit(1)), F.substring(F.right("left", F.lit(2)), 1, 1)
    after, last = F.left("right", F.lit(1)), F.right("inside", F.lit(1))
    opens_word = before.rlike(f"^{quotes}$") & ((F.length("left") == 1) | ((F.length("left") > 1) & second.rlike(f"^{breaks}$")))
    left = (F.length("left") > 0) & (before.rlike(LETTER) | opens_word)
    right = (F.length("right") > 0) & (after.rlike(LETTER) | after.rlike(f"^{quotes}$"))
    word = F.trim("text", F.lit(MARK))
    stopped = (F.length(word) <= max(map(len, STOP_WORDS))) & F.lower(word).isin(*STOP_WORDS)
    capital = F.lit(config.require_capital) & F.col("type").isin("LOC", "PER") & right & after.rlike(LETTER) & ~after.rlike(r"^\p{Lu}$") & last.rlike(f"^{breaks}$")
    reason = (
        F.when(F.length("text") < config.min_token_length, "length")
        .when(F.lit(config.enable_stopwords) & stopped, "stopword")
        .when(capital, "capital")
        .when(~(left | right), "no room")
    )
    return F.struct(reason.isNull().alias("expand"), reason.alias("reason"))


def _walked(config: ExpansionConfig) -> tuple[Column, Column]:
    """What is gained on both sides: up to the next word break, a limited number of characters."""
    inner = char_class(WORD_BREAKS, inverted=True)
    left = F.regexp_extract(F.right("left", F.lit(config.max_search_left)), rf"{inner}*\z", 0)
    right = F.regexp_extract(F.left("right", F.lit(config.max_search_right)), rf"^{inner}*", 0)
    return left, right


def expanded(rows: DataFrame, config: ExpansionConfig = ExpansionConfig()) -> DataFrame:
    """``rows`` with the steps of the expansion and its outcome.

    Added: expand, reason; gain_left, gain_right (characters walked); inner_break; likely_sentence; kind (left, right,
    both, none; null if not tried); new_text, new_start, new_end; changed.
    """
    d = decision(config)
    rows = rows.withColumn("__may", eligible(config)).withColumn("__d", d)
    rows = rows.withColumn("expand", F.col("__may") & F.col("__d.expand")).withColumn("reason", F.when(F.col("__may"), F.col("__d.reason")).otherwise(F.lit("type")))
    left, right = _walked(config)
    rows = rows.withColumn("__l", left).withColumn("__r", right)
    rows = rows.withColumn("gain_left", F.length("__l")).withColumn("gain_right", F.length("__r"))
    # A break inside the span, up to the whole word's last letter, takes the right side back; blanks don't count.
    whole = F.concat("__l", "inside", "__r")
    lettered = F.length(F.regexp_replace(whole, r"\P{L}+\z", "")) - F.col("gain_left")
    seen = F.substring(F.col("inside"), F.lit(1), F.greatest(F.least(F.length("inside"), lettered), F.lit(0)))
    breaks = char_class(WORD_BREAKS.replace(" ", ""))
    rows = rows.withColumn("inner_break", (F.col("gain_left") + F.col("gain_right") > 0) & seen.rlike(breaks))
    rows = rows.withColumn("__r", F.when(F.col("inner_break"), F.lit("")).otherwise(F.col("__r")))
    rows = rows.withColumn("__whole", F.concat("__l", "inside", "__r"))
    words = F.size(F.array_remove(F.split("__whole", r"\s+"), ""))
    ratio = F.when(F.length("text") > 0, F.length("__whole") / F.length("text")).otherwise(F.lit(0.0))
    rows = rows.withColumn("likely_sentence", (words > config.max_words) | (ratio > config.max_sentence_ratio) | F.col("__whole").rlike("[.!?]"))
    grew_l, grew_r = F.length("__l") > 0, F.length("__r") > 0
    kind = F.when(F.col("likely_sentence"), "none").when(grew_l & grew_r, "both").when(grew_l, "left").when(grew_r, "right").otherwise("none")
    on = F.col("expand") & ~F.col("likely_sentence")
    rows = rows.withColumn("kind", F.when(F.col("expand"), kind)).withColumn("new_text", F.when(on, F.col("__whole")).otherwise(F.col("text")))
    rows = rows.withColumn("changed", F.col("new_text") != F.col("text"))
    rows = rows.withColumn("new_start", F.when(F.col("changed"), F.col("start_pos") - F.length("__l")).otherwise(F.col("start_pos")))
    rows = rows.withColumn("new_end", F.when(F.col("changed"), F.col("end_pos") + F.length("__r")).otherwise(F.col("end_pos")))
    return rows.drop("__may", "__d", "__l", "__r", "__whole")
