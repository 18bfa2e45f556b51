"""Secret scan over a trigram index, in DataFrame functions only.

Each rule's regular expression is turned into a Boolean query over the trigrams that every match must
hold. The index is inverted: for each trigram that some query names, a posting for every text that holds it; texts are
known by their hash, so that equal texts have one posting. All postings come from one search of each text, for any of the
trigrams. A rule's query is a union of intersections of posting lists, taken by counting a text's postings for each intersection;
texts that satisfy it are the rule's candidates and are verified with the regular expression. A rule with no mandatory trigram scans
every text. Candidates are sent to all tasks if they are counted to be no more than ``most``; beyond it they are joined by hash.

Null texts count as empty. Null or repeated ids are passed over: one row out for one row in, with all columns, whatever their names,
but ``secrets``, which is replaced. Texts are read whole; trigrams are looked for in pieces of ``piece`` characters. Offsets are code points,
ends exclusive. Matches are leftmost and do not overlap within a kind.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions.chars import let
from spanloom.llm.common import counted, written

try:  # the parser's home since Python 3.11
    from re import _constants as sre_constants
    from re import _parser as sre_parser
except ImportError:  # pragma: no cover
    import sre_constants
    import sre_parse as sre_parser


@dataclass(frozen=True)
class Rule:
    """``group``'s text must have ``least`` characters or more; ``fold`` ignores the case of ASCII letters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    fold: bool = False
    base: bool = False


# The base kinds in their listed order.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18, False, True),
    Rule("hex", r"[0-9a-f]+", 0, 16, False, True),
)
# Public formats of common credentials.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("git_token", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment_key", r"[rs]k_live_[A-Za-z0-9]{24,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]*"),
)
RULES = BASE_RULES + MORE_RULES

#: A Boolean query: None is true for all, else a disjunction of conjunctions of trigrams.
Query = frozenset | None
_MOST = 64


def _trigrams(words: set[str]) -> Query:
    """All of some word's trigrams; true for all if a word is shorter than three letters."""
    if not words or any(len(w) < 3 for w in words):
        return None
    return _fewest(frozenset(frozenset(w[i : i + 3] for i in range(len(w) - 2)) for w in words))


def _fewest(q: frozenset) -> frozenset:
    return frozenset(a for a in q if not any(b < a for b in q))


def _both(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return b if a is None else a
    made = frozenset(x | y for x, y in product(a, b))
    return _fewest(made) if len(made) <= _MOST else min(a, b, key=len)


def _either(a: Query, b: Query) -> Query:
    return None if a is None or b is None else _fewest(a | b)


def trigram_query(pattern: str, fold: bool = False) -> Query:
    """Trigrams, in lower case, that the text of every match of ``pattern`` holds in some combination."""

    def parts(seq) -> Query:
        query: Query = None
        run = {""}  # the strings that the last items may have spelled
        for op, arg in seq:
            words = literal(op, arg)
            if words is not None and len(run) * len(words) <= _MOST:
                run = {a + b for a, b in product(run, words)}
                continue
            query = _both(query, _trigrams(run))
            run = words if words is not None and len(words) <= _MOST else {""}
            if words is None:
                query = _both(query, inner(op, arg))
        return _both(query, _trigrams(run))

    def literal(op, arg) -> set[str] | None:
        """All strings that this item can spell, if they are few."""
        if op is sre_constants.LITERAL:
            return {chr(arg).lower()}
        if op is sre_constants.IN and all(o is sre_constants.LITERAL for o, _ in arg) and len(arg) <= 8:
            return {chr(a).lower() for _, a in arg}
        if op is sre_constants.MAX_REPEAT and arg[1] == 1:
            one = spelled(arg[2])
            return None if one is None else one | {""} if arg[0] == 0 else one
        if op is sre_constants.SUBPATTERN:
            return spelled(arg[3])
        if op is sre_constants.BRANCH:
            each = [spelled(x) for x in arg[1]]
            return None if any(x is None for x in each) else set().union(*each)
        return None

    def spelled(seq) -> set[str] | None:
        out = {""}
        for op, arg in seq:
            words = literal(op, arg)
            if words is None or len(out) * len(words) > _MOST:
                return None
            out = {a + b for a, b in product(out, words)}
        return out

    def inner(op, arg) -> Query:
        if op is sre_constants.SUBPATTERN:
            return parts(arg[3])
        if op is sre_constants.MAX_REPEAT and arg[0] > 0:
            return parts(arg[2])
        if op is sre_constants.BRANCH:
            out = parts(arg[1][0])
            for x in arg[1][1:]:
                out = _either(out, parts(x))
            return out
        return None

    return parts(sre_parser.parse(pattern, re.IGNORECASE if fold else 0))


def _any_of(names: list[str]) -> str:
    """A pattern that stands before each of the trigrams ``names`` and takes it as its group."""
    firsts: dict[str, list[str]] = {}
    for n in names:
        firsts.setdefault(n[0], []).append(re.escape(n[1:]))
    return "(?=(" + "|".join(f"{re.escape(a)}(?:{'|'.join(rest)})" for a, rest in sorted(firsts.items())) + "))"


def _print(body: Column) -> Column:
    return F.xxhash64(body)


def trigram_index(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", piece: int = 1 << 20) -> DataFrame:
    """(trigram, print): the postings of all trigrams that some rule's query names."""
    names = sorted({t for r in rules for a in trigram_query(r.pattern, r.fold) or () for t in a})
    body = F.coalesce(F.col(text), F.lit(""))
    low = docs.select(_print(body).alias("print"), F.lower(body).alias("low"))
    size = F.length("low")
    cut = let(F.col("low"), lambda x: F.transform(F.sequence(F.lit(0), F.floor(F.length(x) / piece).cast("int")), lambda k: F.substring(x, k * piece + 1, F.lit(piece + 2))))
    low = low.select("print", F.explode_outer(F.when(size > piece, cut).otherwise(F.array("low"))).alias("low"))
    found = F.array_distinct(F.regexp_extract_all("low", F.lit(_any_of(names) if names else r"(\z\b\B)"), F.lit(1)))
    return low.select("print", F.explode(found).alias("trigram")).select("trigram", "print")


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(print, rules): bit k is set if the text is in rule k's union of intersections of posting lists."""
    needs = [(rank, part, t, len(need)) for rank, r in enumerate(rules) for part, need in enumerate(sorted(map(sorted, trigram_query(r.pattern, r.fold) or ()))) for t in need]
    if not needs:
        return index.select("print", F.lit(0).cast("long").alias("rules")).limit(0)
    each = F.array(*(F.struct(F.lit(a).alias("rank"), F.lit(b).alias("part"), F.lit(t).alias("trigram"), F.lit(n).alias("size")) for a, b, t, n in needs))
    lists = index.sparkSession.range(1).select(F.inline(each))
    met = index.distinct().join(F.broadcast(lists), "trigram").groupBy("print", "rank", "part", "size").agg(F.count("*").alias("n")).where("n = size")
    return met.groupBy("print").agg(F.bit_or(F.expr("shiftleft(1L, rank)")).alias("rules"))


def _spans(rule: Rule, rank: int, text: str) -> Column:
    """The rule's matches in ``text`` that are long enough, as (start, rank, end, kind).

    Matches and the text between them come from the same scan; their lengths add up to the offsets.
    Only matches that are kept are gathered, so short ones cost no memory.
    """
    # A maximal run of a single class that is too short holds no longer one: such rules look for long runs at once.
    pattern = rule.pattern
    if re.fullmatch(r"\[[^\]]+\]\+", pattern):
        pattern = f"{pattern[:-1]}{{{rule.least},}}"
    java = f"(?i){pattern}" if rule.fold else pattern
    t = F.col(text)
    found = F.regexp_extract_all(t, F.lit(java), F.lit(0))
    held = F.regexp_extract_all(t, F.lit(java), F.lit(rule.group)) if rule.group else found
    kind = "struct<at:long,out:array<struct<start:long,rank:int,end:long,kind:string>>>"
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,rank:int,end:long,kind:string>>").alias("out")).cast(kind)

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["whole"])
        span = F.struct(start.cast("long").alias("start"), F.lit(rank).alias("rank"), end.cast("long").alias("end"), F.lit(rule.kind).alias("kind"))
        return F.struct(end.cast("long").alias("at"), F.when(F.length(x["held"]) >= rule.least, F.array_append(acc["out"], span)).otherwise(acc["out"]).alias("out")).cast(kind)

    rows = F.arrays_zip(F.slice(F.split(t, java, -1), F.lit(1), F.size(found)).alias("gap"), found.alias("whole"), held.alias("held"))
    return F.aggregate(rows, zero, step)["out"]


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", most: int = 1_000_000) -> DataFrame:
    """``docs`` with ``secrets``: array of (start, rank, end, kind) by start, then by the rule's place."""
    if len(rules) > 62:
        raise ValueError("at most 62 rules at once")
    found, number = counted(candidates(written(trigram_index(docs, rules, text)), rules).withColumnRenamed("print", "at"))
    if number <= most:
        found = F.broadcast(found)
    own = [c for c in docs.columns if c.lower() != "secrets"]
    # All columns travel in one, so that none has the name of another.
    out = docs.select(F.struct(*own).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    out = out.withColumn("print", _print(F.col("body"))).join(found, F.col("print") == F.col("at"), "left")
    none = F.array().cast("array<struct<start:long,rank:int,end:long,kind:string>>")
    each = []
    for rank, rule in enumerate(rules):
        listed = F.coalesce(F.getbit("rules", F.lit(rank)) == 1, F.lit(False))
        here = listed if trigram_query(rule.pattern, rule.fold) else F.lit(True)
        if re.fullmatch(r"\[[^\]]+\]\+", rule.pattern):
            here &= F.col("body").rlike(f"{rule.pattern[:-1]}{{{rule.least}}}")
        each.append(F.when(here, _spans(rule, rank, "body")).otherwise(none))
    return out.select("row.*", F.array_sort(F.concat(*each)).alias("secrets"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: counts of the base kinds, their digest, and all spans."""
    found = scan(docs.select("doc_id", "text")).drop("text")
    base = F.filter("secrets", lambda s: s["rank"] < len(BASE_RULES))
    count = lambda k: F.size(F.filter("secrets", lambda s: s["rank"] == k)).cast("long")
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{r.kind}") for k, r in enumerate(BASE_RULES)),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
    )
