"""Predictions folded into entities, chunk by chunk, without leaving the row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.operators.tagging import MARK, PREDICTION

# The types that stay; any other label is of the last type.
TYPES = ("LOC", "PER", "ORG", "MISC")
ENTITY = "struct<text:string,type:string,confidence:double,positions:array<struct<start:int,end:int>>>"


def bare(label: Column) -> Column:
    """A label's type, without its prefix."""
    return F.when(label.startswith("B-") | label.startswith("I-"), F.substring(label, F.lit(3), F.length(label))).otherwise(label)


def entity_type(label: Column) -> Column:
    known = F.when((label.startswith("B-") | label.startswith("I-")) & bare(label).isin(*TYPES), bare(label))
    return F.coalesce(known, F.lit(TYPES[-1]))


def groups(predictions: Column) -> Column:
    """Array of groups, each an array of predictions.

    A group opens at a B- label, or at any label but O if it is the chunk's first. The next prediction goes on with
    it if it has the opener's type and is I-, however far away, or is B- at most one character after.
    Other I- labels open nothing; O closes.
    """
    from spanloom.functions.chars import let

    return let(predictions, lambda p: let(let(let(F.transform(p, _seen), _runs), _bounds), lambda b: _parts(p, b)))


def _seen(p: Column, i: Column) -> Column:
    """What the folding asks of a prediction."""
    label = F.coalesce(p["label"], F.lit("O"))
    inside, begins = label.startswith("I-"), label.startswith("B-")
    first = F.coalesce(p["idx"] == 0, F.lit(False))
    opens = (label != "O") & (begins | first)
    return F.struct(i.alias("i"), bare(label).alias("type"), inside.alias("inside"), begins.alias("begins"), opens.alias("opens"), first.alias("first"), p["start"].alias("start"), p["end"].alias("end"))


def _runs(t: Column) -> Column:
    """Where runs begin: an I- label of the type before it shares the lot of that one. A run may go on with the group before it, and else
    ends it; so no list of groups grows step by step."""
    before = lambda i: F.get(t, i - 1)
    begins = lambda x, i: (i == 0) | x["first"] | ~x["inside"] | (x["type"] != before(i)["type"])
    near = lambda x, i: x["inside"] | (x["begins"] & (x["start"] - before(i)["end"] <= 1))
    joins = lambda x, i: F.coalesce((i > 0) & (x["type"] == before(i)["type"]) & near(x, i), F.lit(False))
    return F.transform(F.filter(t, begins), lambda x: F.struct(x["i"].alias("i"), x["opens"].alias("opens"), joins(x, x["i"]).alias("joins")))


def _bounds(runs: Column) -> Column:
    """Runs that don't go on with a group."""
    return F.filter(runs, lambda x, j: ~(x["joins"] & x["opens"] & F.coalesce(F.get(runs, j - 1)["opens"], F.lit(False))))


def _parts(p: Column, bounds: Column) -> Column:
    end = lambda j: F.coalesce(F.get(bounds, j + 1)["i"], F.size(p))
    return F.filter(F.transform(bounds, lambda x, j: F.when(x["opens"], F.slice(p, x["i"] + 1, end(j) - x["i"]))), lambda g: g.isNotNull())


def merged(group: Column) -> Column:
    """One entity of a group: its words in order of place, with one blank where there is a gap."""
    from spanloom.functions.chars import let

    def entity(g: Column) -> Column:
        apart = lambda p, i: F.when(p["start"] > F.get(g, i - 1)["end"], F.lit(" ")).otherwise(F.lit(""))
        text = F.aggregate(F.transform(g, lambda p, i: F.concat(apart(p, i), F.replace(p["word"], F.lit(MARK), F.lit("")))), F.lit(""), lambda acc, w: F.concat(acc, w))
        return F.struct(
            text.alias("text"),
            entity_type(F.get(g, F.lit(0))["label"]).alias("type"),
            F.round(F.array_min(F.transform(g, lambda p: p["score"])), 4).alias("confidence"),
            F.transform(g, lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"))).alias("positions"),
        ).cast(ENTITY)

    ordered = F.transform(F.array_sort(F.transform(group, lambda p: F.struct(p["start"].alias("start"), p["idx"].alias("idx"), p.alias("p")))), lambda x: x["p"])
    return let(F.when(F.size(group) > 1, ordered).otherwise(group), entity)


def with_entities(tagged: DataFrame, shortest: int = 2) -> DataFrame:
    """Chunk rows with ``entities``, those of fewer than ``shortest`` characters left out."""
    # The steps of ``groups`` in columns of their own: a list in a function's argument is copied whenever the function returns.
    made = tagged.withColumn("__seen", F.transform("predictions", _seen))
    made = made.withColumn("__runs", _runs(F.col("__seen"))).withColumn("__bounds", _bounds(F.col("__runs")))
    made = made.withColumn("groups", _parts(F.col("predictions"), F.col("__bounds"))).drop("__seen", "__runs", "__bounds")
    return made.withColumn("entities", F.filter(F.transform("groups", merged), lambda e: F.length(e["text"]) >= shortest))


def entity_rows(grouped: DataFrame) -> DataFrame:
    """One row per entity, with the text around it: doc_id, chunk_id, ent_idx, text, type, confidence, positions,
    start_pos, end_pos, ``left`` and ``right`` (up to the margin of characters beside it) and ``inside``."""
    from spanloom.functions.chars import cut
    from spanloom.operators.chunking import MARGIN

    rows = grouped.select("doc_id", "chunk_id", "global_start", F.concat("before", "text", "after").alias("around"), F.length("before").alias("shift"), F.posexplode_outer("entities").alias("ent_idx", "e"))
    rows = rows.where(F.col("ent_idx").isNotNull())  # outer, as no filter on the array is inferred then
    rows = rows.withColumn("start_pos", F.get("e.positions", F.lit(0))["start"]).withColumn("end_pos", F.try_element_at("e.positions", F.lit(-1))["end"])
    low, high = F.col("start_pos") - F.col("global_start") + F.col("shift"), F.col("end_pos") - F.col("global_start") + F.col("shift")
    # The chunk is gone through once for all three.
    first = F.greatest(low - MARGIN, F.lit(0))
    rows = rows.withColumn("near", cut(F.col("around"), first, high + MARGIN)).withColumn("first", first)
    near, low, high = F.col("near"), low - F.col("first"), high - F.col("first")
    return rows.select("doc_id", "chunk_id", "ent_idx", "e.text", "e.type", "e.confidence", "e.positions", "start_pos", "end_pos", cut(near, low - MARGIN, low).alias("left"), cut(near, low, high).alias("inside"), cut(near, high, high + MARGIN).alias("right"))
