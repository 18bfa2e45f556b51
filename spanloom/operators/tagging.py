"""Token predictions for chunks: backends, the score filter and the shift to document offsets.

A backend adds ``predictions`` to chunk rows: array of (idx, label, score, word, start, end), offsets within the chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A character of a word, as the tokens have it, and any other.
WORD, OTHER = r"[\p{L}\p{N}_]", r"[^\p{L}\p{N}_]"
PREDICTION = "struct<idx:int,label:string,score:double,word:string,start:int,end:int>"
#: Words longer than this are predicted in pieces, the first marked as the beginning of a word.
PIECE = 6
MARK = "▁"
# The types that the rule backend gives by length modulo 4.
RULE_TYPES = ("PER", "LOC", "ORG", "DATE")


def _kind(word: Column) -> Column:
    """The type that the rule backend gives to a capitalised word."""
    return F.element_at(F.array(*map(F.lit, RULE_TYPES)), F.length(word) % len(RULE_TYPES) + 1)


def _ruled(chunks: DataFrame, words: Column, least: float | None = None) -> DataFrame:
    """``chunks`` with the rule's predictions; ``words`` are the capitalised ones, as (word, start, before: the one that they follow, if at once).

    With ``least`` only those of that score or more are made, at their places in the document.
    """
    shift = 0 if least is None else F.col("global_start")

    def pieces(x: Column) -> Column:
        word, own = x["word"], x["kind"]
        size = lambda k: F.least(F.length(word) - k, F.lit(PIECE))
        score = lambda k: (((x["start"] + k) * 31 + size(k) * 17) % 1000) / F.lit(1000.0)
        places = F.sequence(F.lit(0), F.length(word) - 1, F.lit(PIECE))
        if least is not None:
            places = F.filter(places, lambda k: score(k) >= least)

        def piece(k: Column) -> Column:
            at = x["start"] + k + shift
            follows = (k > 0) | F.coalesce(x["before"] == own, F.lit(False))
            part = F.substring(word, k + 1, F.lit(PIECE))
            return F.struct(
                F.lit(0).alias("idx"),
                F.concat(F.when(follows, F.lit("I-")).otherwise(F.lit("B-")), own).alias("label"),
                score(k).alias("score"),
                F.when(k == 0, F.concat(F.lit(MARK), part)).otherwise(part).alias("word"),
                at.alias("start"),
                (at + size(k)).alias("end"),
            )

        return F.transform(places, piece)

    kinds = F.transform(words, lambda x: F.struct(x["word"].alias("word"), x["start"].alias("start"), _kind(x["word"]).alias("kind"), _kind(x["before"]).alias("before")))
    return chunks.withColumn("predictions", numbered(F.flatten(F.transform(kinds, pieces))))


def rule(chunks: DataFrame) -> DataFrame:
    """A deterministic backend without a model: capitalised words, typed by length, scored by place."""
    capital = lambda w: w.rlike(r"^\p{Lu}")

    def word(t: Column, i: Column) -> Column:
        before = F.get("tokens", i - 1)["word"]
        return F.struct(t["word"].alias("word"), (t["start"] - F.col("global_start")).alias("start"), F.when(capital(before), before).alias("before"))

    return _ruled(chunks, F.filter(F.transform("tokens", word), lambda x: capital(x["word"])))


#: A capitalised word, if there is one, and all up to the next one.
_PART = rf"(?:\p{{Lu}}{WORD}*+)?+(?:{OTHER}++|(?!\p{{Lu}}){WORD}++)*+"


def rule_of_text(chunks: DataFrame, least: float | None = None) -> DataFrame:
    """What ``rule`` gives for the pattern's tokens, from the text alone: words that are not capitalised are never listed. With ``least`` what
    ``confident`` and ``shifted`` make of it, at once."""
    from spanloom.operators.chunking import running_sums

    columns = chunks.columns
    # Step by step in columns of their own, as a list in a function's argument is copied whenever the function returns.
    rows = chunks.withColumn("__part", F.regexp_extract_all("text", F.lit(_PART), F.lit(0)))
    rows = rows.withColumn("__end", running_sums(F.transform("__part", lambda p: F.length(p))))
    rows = rows.withColumn("__word", F.transform("__part", lambda p: F.regexp_extract(p, rf"^\p{{Lu}}{WORD}*+", 0)))

    def word(w: Column, i: Column) -> Column:
        last, part = F.get("__word", i - 1), F.get("__part", i - 1)
        alone = (last != "") & F.substring(part, F.length(last) + 1, F.length(part)).rlike(r"^\s*+\z")
        return F.when(w != "", F.struct(w.alias("word"), (F.get("__end", i) - F.length(F.get("__part", i))).alias("start"), F.when(alone, last).alias("before")))

    words = F.filter(F.transform("__word", word), lambda w: w.isNotNull())
    return _ruled(rows, words, least).select(*columns, "predictions")


def numbered(predictions: Column) -> Column:
    """With ``idx`` counted anew from 0."""
    return F.transform(predictions, lambda p, i: F.struct(i.alias("idx"), *(p[c].alias(c) for c in ("label", "score", "word", "start", "end"))))


def from_column(chunks: DataFrame, column: str) -> DataFrame:
    """Predictions that the input brings along."""
    return chunks.withColumn("predictions", F.coalesce(F.col(column), F.array()).cast(f"array<{PREDICTION}>"))


def from_model(chunks: DataFrame, make: Callable[[], Callable[[list[str]], list[list[dict]]]], batch: int = 32) -> DataFrame:
    """Predictions of a model: ``make`` loads it once per Python worker, and what it returns tags a list of texts.

    A batch in which the model fails gets no predictions and the error's text in ``error``; the job goes on.
    """
    import pandas as pd

    from pyspark.sql.types import StructField, StructType, StringType, _parse_datatype_string

    schema = StructType([*chunks.schema.fields, StructField("predictions", _parse_datatype_string(f"array<{PREDICTION}>")), StructField("error", StringType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for frame in frames:
            found: list = []
            errors: list[str | None] = []
            for start in range(0, len(frame), batch):
                texts = frame["text"].iloc[start : start + batch].tolist()
                try:
                    got = model(texts)
                    found += [[{"idx": i, "label": p.get("label", p.get("entity")), "score": float(p["score"]), "word": p["word"], "start": int(p["start"]), "end": int(p["end"])} for i, p in enumerate(x)] for x in got]
                    errors += [None] * len(texts)
                except Exception as e:  # noqa: BLE001  one bad batch doesn't end the job
                    found += [[] for _ in texts]
                    errors += [f"{type(e).__name__}: {e}"] * len(texts)
            yield frame.assign(predictions=found, error=errors)

    return chunks.mapInPandas(run, schema)


def transformers_model(name: str, devices: list[int] | None = None, half: bool = False) -> Callable:
    """A ``make`` for :func:`from_model` around a token-classification model, if its libraries are installed.

    Of several devices a task takes the one that Spark assigned to it (``spark.task.resource.gpu.amount``), or else its own in turn.
    """
    devices = devices or [-1]

    def make():
        try:
            import torch
            from transformers import pipeline
        except ImportError as e:
            raise RuntimeError("the model backend needs the packages torch and transformers") from e
        ner = pipeline("ner", model=name, device=device_of_task(devices), aggregation_strategy=None, torch_dtype=torch.float16 if half else torch.float32)
        return lambda texts: ner(texts)

    return make


def device_of_task(devices: list[int]) -> int:
    """The device of the running task."""
    from pyspark import TaskContext

    task = TaskContext.get()
    if task is None:
        return devices[0]
    given = task.resources().get("gpu")
    return int(given.addresses[0]) if given else devices[task.partitionId() % len(devices)]


def confident(tagged: DataFrame, min_confidence: float = 0.5) -> DataFrame:
    """Only predictions of that score or more, before they are grouped; their numbers close up."""
    return tagged.withColumn("predictions", numbered(F.filter("predictions", lambda p: p["score"] >= min_confidence)))


def shifted(tagged: DataFrame) -> DataFrame:
    """Offsets in the document instead of the chunk."""
    at = F.col("global_start")
    moved = F.transform("predictions", lambda p: F.struct(p["idx"].alias("idx"), p["label"].alias("label"), p["score"].alias("score"), p["word"].alias("word"), (p["start"] + at).alias("start"), (p["end"] + at).alias("end")))
    return tagged.withColumn("predictions", moved)
