"""Removal of lines whose template recurs across documents, in DataFrame functions only.

A line is its tokens, what stands between single blanks; a token with a digit counts as a variable field. Lines are parsed down a
tree of fixed depth: by number of tokens, then by the first ``depth`` tokens. In a leaf a position's token is constant
if ``least`` lines or more have it there, else the position is a variable field; a line's template is its
constants and fields. With many lines a field's values pass that too, so a line has a second template, of the constants
that ``steady`` per cent or more of the leaf's lines have. Of the tokens without a digit ``share`` per cent or more must be constant.

A template recurs if ``least`` or more different texts have it that are not near copies, and they are ``spread`` per cent
or more of all different texts that have it; lines with either template recurring are dropped from all documents. A line is taken for copied if
its first or its last ``edge`` tokens, as they are, stand first or last in a line of ``least`` different texts or more; a text is a near copy if
copied lines make up ``copied`` per cent or more of its characters, and of its lines. So what distinguishes a page with a license block or a footer
from a copy is the text that it has besides, and blocks of several lines go as single lines do; copies of whole documents, which
have no text besides, are left to the operators that look for copies, but lose the footers that other pages have.
Lines of blanks part paragraphs and are never dropped.

Leaves with few lines are found first, from hashes; only the lines of the others are taken apart, and equal ones among
them are one row with a count. A line in a third of all documents makes a hot leaf only in that one join, where the
rows of a leaf need not come together, so that adaptive execution can split them; all else is partial sums.

A null text stays null and has no lines; an empty one has one empty line. Rows with equal doc_id and text get the same result;
null doc_ids are ids like others. Texts are read whole, and a row holds one text's lines at most. Further columns stay as they are, whatever
their names, but that ``n_lines`` and ``n_dropped`` are replaced where they are returned. Documents are never dropped; one
whose lines all go keeps an empty text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions.chars import let
from spanloom.llm.common import counted, written

FIELD = "<*>"


@dataclass(frozen=True)
class Settings:
    depth: int = 3
    least: int = 5
    steady: int = 5
    share: int = 70
    edge: int = 6
    copied: int = 75
    spread: int = 20
    most: int = 500_000  #: rows of a list that may be sent to all tasks; a longer one is joined by shuffle


def masked(line: Column, digits: Column) -> Column:
    """The line with every token that holds a digit as a field; ``digits`` tells whether its text holds any."""
    return F.when(digits & line.rlike("[0-9]"), F.regexp_replace(line, "[^ ]*[0-9][^ ]*", FIELD)).otherwise(line)


def tokens(line: Column) -> Column:
    return F.split(line, " ")


def _occurrences(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def _leaf(line: Column, s: Settings) -> Column:
    """The leaf of a masked line, found without taking it apart; null for lines of blanks."""
    return F.when(F.btrim(line, F.lit(" \t\r")) != "", F.xxhash64(_occurrences(line, " "), F.substring_index(line, " ", s.depth)))


def _split(docs: DataFrame, *keep: Column) -> DataFrame:
    """``keep``, at, line, masked: one row per line of each text."""
    # Exploded in the outer form: no filter on the array is inferred, which would compute it once more.
    out = docs.select(*keep, F.col("text").rlike("[0-9]").alias("digits"), F.split("text", "\n").alias("all"))
    out = out.select("*", F.posexplode_outer("all").alias("at", "line")).drop("all")
    return out.withColumn("masked", masked(F.col("line"), F.col("digits"))).drop("digits")


def _lines(docs: DataFrame, s: Settings) -> DataFrame:
    """One row per line: its leaf, the hashes of its masked form and of its ends, and its length."""
    rows = _split(docs, F.col("doc_id"), F.xxhash64("text").alias("print"))
    line = F.col("line")
    ends = (F.xxhash64(F.lit(k), F.substring_index(line, " ", k)).alias(c) for c, k in (("head", s.edge), ("tail", -s.edge)))
    return rows.select("doc_id", "print", "at", F.xxhash64("masked").alias("hash"), _leaf(F.col("masked"), s).alias("leaf"), *ends, F.length(line).alias("size"))


def _sent(rows: DataFrame, s: Settings) -> DataFrame:
    """``rows`` (one or two numbers each) as a table, sent to all tasks if they are counted to be few."""
    rows, number = counted(rows)
    return F.broadcast(rows) if number <= s.most else rows.hint("shuffle_hash")


def _templates(lines: DataFrame, docs: DataFrame, s: Settings) -> DataFrame:
    """(hash, template): both templates of the masked lines in leaves of ``least`` lines or more; ``lines`` as of ``_lines``."""
    few = _sent(lines.where(F.col("leaf").isNotNull()).groupBy("leaf").count().where(F.col("count") >= s.least).select("leaf"), s)
    rows = _split(docs.where(F.col("text").isNotNull())).select(F.col("masked").alias("line"))
    rows = rows.select("line", _leaf(F.col("line"), s).alias("leaf")).where(F.col("leaf").isNotNull()).join(few, "leaf")
    # By line alone: then the join's partitions need not stay whole.
    parsed = rows.groupBy("line").agg(F.count("*").alias("n")).select(_leaf(F.col("line"), s).alias("leaf"), "n", F.xxhash64("line").alias("hash"), tokens(F.col("line")).alias("tokens"))
    parsed = written(parsed.select("leaf", "n", "hash", F.transform("tokens", lambda t: F.xxhash64(t)).alias("tokens"), F.transform("tokens", lambda t: t == FIELD).alias("fields")))
    placed = parsed.select("leaf", "hash", "n", "fields", F.posexplode("tokens").alias("place", "token"))
    sizes = parsed.groupBy("leaf").agg(F.sum("n").alias("all"))
    constant = placed.groupBy("leaf", "place", "token").agg(F.sum("n").alias("lines")).where(F.col("lines") >= s.least)
    constant = constant.join(sizes, "leaf").select("leaf", "place", "token", F.lit(True).alias("constant"), (100 * F.col("lines") >= s.steady * F.col("all")).alias("steady"))
    known = placed.join(constant, ["leaf", "place", "token"], "left")
    for c in ("constant", "steady"):
        known = known.withColumn(c, F.coalesce(c, F.lit(False)) & ~F.get("fields", F.col("place")))
    # A template by a sum over its constants; their places are part of what is hashed.
    summed = lambda c: F.sum(F.when(F.col(c), F.xxhash64("place", "token").cast("decimal(38,0)")).otherwise(F.lit(0).cast("decimal(38,0)")))
    parts = known.groupBy("leaf", "hash").agg(
        F.count_if(~F.get("fields", F.col("place"))).alias("size"),
        *(f(c).alias(c + name) for c in ("constant", "steady") for name, f in (("_count", F.count_if), ("_sum", summed))),
    )
    each = (F.when((F.col(c + "_count") > 0) & (100 * F.col(c + "_count") >= s.share * F.col("size")), F.xxhash64("leaf", c + "_count", F.col(c + "_sum").cast("string"))) for c in ("constant", "steady"))
    template = parts.select("hash", F.explode_outer(F.array_distinct(F.array(*each))).alias("template"))
    return template.where(F.col("template").isNotNull())


def _copies(lines: DataFrame, s: Settings) -> DataFrame:
    """(print): texts that are near copies of others."""
    ends = lines.where("size > 0").select("print", "at", "size", F.explode(F.array("head", "tail")).alias("end"))
    often = _sent(ends.select("end", "print").distinct().groupBy("end").agg(F.count("*").alias("n")).where(F.col("n") >= s.least).select("end"), s)
    sums = lambda rows, name: rows.select("print", "at", "size").distinct().groupBy("print").agg(F.sum("size").alias(f"{name}_size"), F.count("*").alias(f"{name}_lines"))
    both = sums(ends.join(often, "end"), "copied").join(sums(lines.where("size > 0"), "all"), "print")
    return both.where(" AND ".join(f"100 * copied_{x} >= {s.copied} * all_{x}" for x in ("size", "lines"))).select("print")


def _recurring(lines: DataFrame, docs: DataFrame, s: Settings) -> DataFrame:
    """(hash): hashes of the masked lines whose template recurs; ``lines`` as of ``_lines``."""
    template = _sent(_templates(lines, docs, s), s)
    seen = lines.select("print", "hash").join(template, "hash").select("template", "print").distinct()
    seen = seen.join(_copies(lines, s).withColumn("copy", F.lit(True)), "print", "left")
    recurs = seen.groupBy("template").agg(F.count("*").alias("texts"), F.count_if(F.col("copy").isNull()).alias("own"))
    recurs = recurs.where((F.col("own") >= s.least) & (100 * F.col("own") >= s.spread * F.col("texts")))
    return template.join(recurs.select("template"), "template").select("hash").distinct()


def drop_templates(docs: DataFrame, settings: Settings = Settings(), counts: bool = True) -> DataFrame:
    """``docs`` with recurring lines out of ``text``; with ``counts`` the columns ``n_lines`` and ``n_dropped`` after the others."""
    lines = written(_lines(docs.where(F.col("text").isNotNull()), settings))
    gone = _sent(_recurring(lines, docs, settings), settings)
    hit = lines.select("doc_id", "print", "at", "hash").join(gone, "hash")
    hit = hit.groupBy("doc_id", "print").agg(F.collect_set("at").alias("gone"))
    # All columns travel in one, so that none has the name of another.
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64("text").alias("own"))
    out = rows.join(hit.hint("shuffle_hash"), F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("own") == F.col("print")), "left")
    text = F.col("row.text")
    # Bound by ``let``: as a column it would be put into the inner function, and the text split once a line.
    kept = let(F.split(text, "\n"), lambda every: F.transform(F.array_except(F.sequence(F.lit(0), F.size(every) - 1), F.col("gone")), lambda k: F.get(every, k)))
    columns = [c for c in docs.columns if not (counts and c.lower() in ("n_lines", "n_dropped"))]
    told = (
        F.coalesce(_occurrences(text, "\n") + 1, F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.when(F.col("gone").isNotNull(), F.size("gone")), F.lit(0)).cast("long").alias("n_dropped"),
    )
    return out.select(
        *(F.when(F.col("gone").isNull(), text).otherwise(F.array_join(kept, "\n")).alias("text") if c == "text" else F.col("row")[c].alias(c) for c in columns),
        *(told if counts else ()),
    )


def digest(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    out = drop_templates(docs.select("doc_id", "text"), settings)
    return out.select("doc_id", "n_lines", "n_dropped", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("kept_chars"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
