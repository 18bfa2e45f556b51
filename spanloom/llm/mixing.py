"""Mixing sources to target weights by a hierarchical budget, in DataFrame functions only.

The leaves of the tree are (domain, lang, source). A budget of tokens goes down it: a node gives its children
shares by their weights, but none more than its subtree can deliver (its tokens times ``epochs``); what a child
cannot take goes to its siblings by their weights. So a shortage is made up by siblings, and reaches the
node's own siblings only if the whole subtree is short, since a node's share was bounded by what its subtree holds.
The split has a closed form: with children in order of capacity by weight, those before some place are full and
the others share the rest in proportion, so it is one window over the children of a node.

A leaf takes its documents by token prefix: in every epoch they stand in an order of their own, by a seeded
hash, and epochs follow each other; a document is taken in an epoch if the tokens before it are fewer than
the leaf's budget. Sources with more budget than tokens are thus repeated, whole epochs first.

Hot leaves: the order's prefix is found by bins of the hash, so that tokens are partial sums by leaf and bin and only
the ids of the one bin where the budget ends are put in order, without their texts; a leaf, however large, is never sorted whole.

Tokens are runs of characters other than blanks, in texts of any length. Null texts have none; rows without tokens are never taken. Null
languages and sources are leaves like others. Rows that repeat an id are taken one by one, ties in the order of text. Further columns
stay as they are, but ``domain``, ``n_tokens`` and ``epoch`` are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.llm.common import counted, written

LEVELS = ("domain", "lang", "source")


@dataclass(frozen=True)
class Settings:
    share: float = 0.5  #: the budget by tokens of the input
    epochs: int = 4
    seed: str = "mix"
    #: Weights by level and value; values that aren't named have weight 1. Domains are named by the source's number.
    weights: dict = field(default_factory=lambda: {"domain": {"head": 2.0, "tail": 1.0}, "lang": {"en": 3.0, "de": 2.0, "fr": 2.0, "es": 2.0}, "source": {}})
    head: int = 10  #: sources numbered below this are of the domain "head"
    digits: int = 3  #: hexadecimal digits of a bin: 16 ** digits bins
    leaves: int = 100_000  #: leaves that may be broadcast; beyond it they are joined by shuffle


def token_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^ \t\n\r\f\x0B]++")).cast("long")


def domain(source: Column, settings: Settings) -> Column:
    number = F.try_to_number(F.regexp_extract(source, r"([0-9]{1,9})\z", 1), F.lit("999999999"))
    return F.when(number < settings.head, F.lit("head")).otherwise(F.lit("tail"))


def _weight(level: str, value: Column, settings: Settings) -> Column:
    out = F.lit(1.0)
    for name, weight in settings.weights.get(level, {}).items():
        out = F.when(value == name, F.lit(float(weight))).otherwise(out)
    return out


def _shared(rows: DataFrame, parent: list[str], budget: str, capacity: str, weight: str, out: str) -> DataFrame:
    """``rows`` with ``out``: their shares of the parent's ``budget``, none above its ``capacity``.

    In order of capacity by weight, children are full as long as the level of the rest, were it shared by weight
    among them and all after them, is no lower than their own.
    """
    order = [F.col(capacity) / F.col(weight), *(F.col(c) for c in LEVELS if c in rows.columns)]
    before = Window.partitionBy(*parent, "__one").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.partitionBy(*parent, "__one").orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy(*parent, "__one")
    out_ = rows.withColumn("__one", F.lit(1)).withColumn("__filled", F.coalesce(F.sum(capacity).over(before), F.lit(0.0))).withColumn("__left", F.sum(weight).over(onward))
    out_ = out_.withColumn("__level", (F.col(budget) - F.col("__filled")) / F.col("__left"))
    # The level stays the same from the first child on that isn't full, and is the least over all places there.
    full = F.col("__level") * F.col(weight) >= F.col(capacity)
    out_ = out_.withColumn("__level", F.min(F.when(~full, F.struct(F.col("__filled").alias("f"), F.col("__level").alias("l")))).over(every)["l"])
    shared = F.when(F.col("__level").isNull(), F.col(capacity)).otherwise(F.least(F.col(capacity), F.col("__level") * F.col(weight)))
    return out_.withColumn(out, shared).drop("__one", "__filled", "__left", "__level")


def budgets(leaves: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``leaves`` (domain, lang, source, tokens) with ``budget``, from the top of the tree down."""
    s = settings
    rows = leaves.withColumn("__capacity", F.col("tokens") * float(s.epochs))
    total = rows.agg(F.sum("tokens") * s.share)
    for depth, level in enumerate(LEVELS, 1):
        path = list(LEVELS[:depth])
        nodes = rows.groupBy(*path).agg(F.sum("__capacity").alias("__all"))
        nodes = nodes.withColumn("__weight", _weight(level, F.col(level), s))
        if depth == 1:
            nodes = nodes.withColumn("__budget", total.scalar())
        else:
            up = given.select(*(F.col(c).alias(f"__up_{c}") for c in path[:-1]), F.col("__share").alias("__budget"))  # noqa: F821
            on = [nodes[c].eqNullSafe(up[f"__up_{c}"]) for c in path[:-1]]
            nodes = nodes.join(up, on[0] if len(on) == 1 else on[0] & on[1]).drop(*(f"__up_{c}" for c in path[:-1]))
        given = _shared(nodes, path[:-1], "__budget", "__all", "__weight", "__share").select(*path, "__share")
    final = given.select(*(F.col(c).alias(f"__up_{c}") for c in LEVELS), F.col("__share").alias("budget"))
    on = [rows[c].eqNullSafe(final[f"__up_{c}"]) for c in LEVELS]
    return rows.join(final, on[0] & on[1] & on[2]).select(*leaves.columns, "budget")


def mixed(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` (doc_id, text, lang, source, ...) as taken, with columns domain, n_tokens and epoch (from 0) after the others."""
    s = settings
    own = [c for c in docs.columns if c.lower() not in ("domain", "n_tokens", "epoch")]
    # All columns travel in one, so that none has the name of another.
    base = docs.select(F.struct(*own).alias("row"), domain(F.col("source"), s).alias("domain"), "lang", "source")
    # Tokens are counted once into a narrow table, and again only for what is taken.
    rows = written(base.select("row.doc_id", *LEVELS, token_count(F.col("row.text")).alias("n_tokens")).where("n_tokens > 0"))
    spot = lambda epoch, of="doc_id": F.md5(F.concat_ws(":", F.lit(s.seed), epoch.cast("string"), F.coalesce(F.col(of).cast("string"), F.lit(""))).cast("binary"))
    leaves = budgets(rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens")), s)
    # Whole epochs, and the tokens to take of the one after them.
    whole = F.least(F.floor(F.col("budget") / F.col("tokens")), F.lit(s.epochs)).cast("int")
    leaves, number = counted(leaves.select(*(F.col(c).alias(f"__{c}") for c in LEVELS), whole.alias("__whole"), (F.col("budget") - whole * F.col("tokens")).alias("__rest")))
    leaf = [f"__{c}" for c in LEVELS]

    # Where the budget ends in that epoch: sums by bin, and running sums over the bins of a leaf.
    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        on = [left[c].eqNullSafe(right[f"__{c}"]) for c in LEVELS]
        return left.join(right, on[0] & on[1] & on[2])

    known = F.broadcast(leaves) if number <= s.leaves else leaves
    bins = joined(rows, known).withColumn("__bin", F.substring(spot(F.col("__whole")), 1, s.digits))
    bins = bins.groupBy(*leaf, "__whole", "__rest", "__bin").agg(F.sum("n_tokens").alias("__tokens"))
    before = Window.partitionBy(*leaf).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("__before", F.coalesce(F.sum("__tokens").over(before), F.lit(0)))
    # The bin in which it ends, and what is left to take there; none if the rest is nothing.
    cut = bins.where(F.col("__before") < F.col("__rest")).groupBy(*leaf, "__whole").agg(F.max(F.struct("__bin", (F.col("__rest") - F.col("__before")).alias("__take"))).alias("__cut"))
    plan = leaves.alias("p").join(cut.select(*(F.col(c).alias(f"{c}_") for c in leaf), "__cut"), (F.col("__domain").eqNullSafe(F.col("__domain_"))) & F.col("__lang").eqNullSafe(F.col("__lang_")) & F.col("__source").eqNullSafe(F.col("__source_")), "left").select(*leaf, "__whole", "__cut")
    plan = written(plan)
    few = number <= s.leaves
    # Within that bin: running sums over its ids, without their texts, up to the one id where the budget ends.
    inside = joined(rows, F.broadcast(plan) if few else plan).withColumn("__spot", spot(F.col("__whole"))).where(F.substring("__spot", 1, s.digits) == F.col("__cut.__bin"))
    inside = inside.groupBy(*leaf, "__cut", "__spot").agg(F.sum("n_tokens").alias("__tokens"))
    order = Window.partitionBy(*leaf).orderBy("__spot").rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn("__left", F.col("__cut.__take") - F.coalesce(F.sum("__tokens").over(order), F.lit(0))).where("__left > 0")
    ends = inside.groupBy(*leaf).agg(F.max(F.struct("__spot", "__left")).alias("__end"))
    ends = ends.select(*(F.col(c).alias(f"{c}_") for c in leaf), "__end")
    plan = written(plan.join(ends, F.col("__domain").eqNullSafe(F.col("__domain_")) & F.col("__lang").eqNullSafe(F.col("__lang_")) & F.col("__source").eqNullSafe(F.col("__source_")), "left").select(*leaf, "__whole", "__end"))
    at = joined(base, F.broadcast(plan) if few else plan).withColumn("__spot", spot(F.col("__whole"), "row.doc_id"))

    epochs = F.when(F.col("__whole") > 0, F.sequence(F.lit(0), F.col("__whole") - 1)).otherwise(F.array().cast("array<int>"))
    sure = F.when(F.col("__spot") < F.col("__end.__spot"), F.concat(epochs, F.array("__whole"))).otherwise(epochs)
    columns = [*(F.col("row")[c].alias(c) for c in own), "domain", "n_tokens"]
    tokens_if = lambda where: F.when(where, token_count(F.col("row.text"))).alias("n_tokens")
    taken = at.withColumn("__sure", sure).select("row", "domain", "__sure", tokens_if(F.size("__sure") > 0)).where("n_tokens > 0").select(*columns, F.explode("__sure").alias("epoch"))
    # The rows of that id, one unless ids repeat.
    last = at.select("row", *LEVELS, "__whole", "__end", tokens_if(F.col("__spot") == F.col("__end.__spot"))).where("n_tokens > 0")
    order = Window.partitionBy(*LEVELS).orderBy("row.text").rowsBetween(Window.unboundedPreceding, -1)
    last = last.withColumn("__before", F.coalesce(F.sum("n_tokens").over(order), F.lit(0))).where(F.col("__before") < F.col("__end.__left"))
    return taken.union(last.select(*columns, F.col("__whole").alias("epoch")))


def digest(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return mixed(docs.select("doc_id", "text", "lang", "source"), settings).select("doc_id", "epoch", *LEVELS, "n_tokens")


#: The same rows in SQL.
ORACLE_SQL = """
WITH RECURSIVE r AS (
  SELECT doc_id, text, lang, source, len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\r\\f\\x0b]+')) AS n_tokens,
    CASE WHEN try_cast(nullif(regexp_extract(source, '([0-9]{1,9})$', 1), '') AS BIGINT) < 10 THEN 'head' ELSE 'tail' END AS domain FROM documents),
d AS (SELECT * FROM r WHERE n_tokens > 0),
leaf AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens, sum(n_tokens) * 4.0::DOUBLE AS cap, 1.0::DOUBLE AS w FROM d GROUP BY ALL),
l2 AS (SELECT domain, lang, sum(cap) AS cap, CASE lang WHEN 'en' THEN 3.0::DOUBLE WHEN 'de' THEN 2.0 WHEN 'fr' THEN 2.0 WHEN 'es' THEN 2.0 ELSE 1.0 END AS w FROM leaf GROUP BY ALL),
l1 AS (SELECT domain, sum(cap) AS cap, CASE domain WHEN 'head' THEN 2.0::DOUBLE ELSE 1.0 END AS w FROM leaf GROUP BY ALL),
s1 AS (SELECT *, ((SELECT sum(tokens) FROM leaf) * 0.5::DOUBLE - coalesce(sum(cap) OVER b, 0)) / sum(w) OVER o AS lev, coalesce(sum(cap) OVER b, 0) AS filled FROM l1
  WINDOW b AS (ORDER BY cap / w, domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), o AS (ORDER BY cap / w, domain ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
g1 AS (SELECT domain, coalesce(least(cap, (SELECT arg_min(lev, filled) FROM s1 WHERE lev * w < cap) * w), cap) AS share FROM s1),
s2 AS (SELECT l2.*, (share - coalesce(sum(cap) OVER b, 0)) / sum(w) OVER o AS lev, coalesce(sum(cap) OVER b, 0) AS filled FROM l2 JOIN g1 USING (domain)
  WINDOW b AS (PARTITION BY domain ORDER BY cap / w, lang NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), o AS (PARTITION BY domain ORDER BY cap / w, lang NULLS FIRST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
g2 AS (SELECT domain, lang, coalesce(least(cap, (arg_min(lev, filled) FILTER (WHERE lev * w < cap) OVER (PARTITION BY domain)) * w), cap) AS share FROM s2),
s3 AS (SELECT leaf.*, (share - coalesce(sum(cap) OVER b, 0)) / sum(w) OVER o AS lev, coalesce(sum(cap) OVER b, 0) AS filled
  FROM leaf JOIN g2 ON leaf.domain = g2.domain AND leaf.lang IS NOT DISTINCT FROM g2.lang
  WINDOW b AS (PARTITION BY leaf.domain, leaf.lang ORDER BY cap / w, source NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         o AS (PARTITION BY leaf.domain, leaf.lang ORDER BY cap / w, source NULLS FIRST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
g3 AS (SELECT domain, lang, source, tokens, coalesce(least(cap, (arg_min(lev, filled) FILTER (WHERE lev * w < cap) OVER (PARTITION BY domain, lang)) * w), cap) AS budget FROM s3),
p AS (SELECT *, least(floor(budget / tokens), 4)::INT AS whole FROM g3),
e AS (SELECT d.doc_id, d.text, d.domain, d.lang, d.source, d.n_tokens, p.whole, p.budget - p.whole * p.tokens AS rest,
        md5('mix:' || p.whole || ':' || coalesce(d.doc_id::VARCHAR, '')) AS spot
      FROM d JOIN p ON d.domain = p.domain AND d.lang IS NOT DISTINCT FROM p.lang AND d.source IS NOT DISTINCT FROM p.source),
f AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY spot, doc_id, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM e)
SELECT doc_id, unnest(CASE WHEN before < rest THEN range(whole + 1) ELSE range(whole) END)::INT AS epoch, domain, lang, source, n_tokens::BIGINT AS n_tokens FROM f
"""
