"""Benchmark decontamination by spaced seeds, in DataFrame functions only.

Texts are words: lower-cased runs of letters and digits, and single characters in scripts without blanks. A seed is a fixed mask over consecutive words; the
words it ignores may differ. Every window of every benchmark item and of every document is hashed under each
mask, and equal hashes are joined; each hit lays the item beside the document at one offset. It is verified
there word by word: some ``stretch`` consecutive words of the item (all of a shorter item) must agree with the
document in ``agree`` per cent of their places or more, so substitutions are tolerated and chance hits dropped.

The masks are chosen by the item's length (``stretch`` for longer ones) so that every pattern of substitutions that
the verification accepts has a hit: what is found is what comparing all items with all documents at all offsets
would find. Items of fewer than ``whole`` words must lie in the document whole; items of fewer than ``least`` words
match nothing.

Only hashes and places of windows are joined, never the words. The benchmark's windows are counted; if they take ``broadcast``
bytes or fewer they are sent to all tasks, and the words beside the item leave the stage that looks them up. Beyond it
the documents' windows are first held against a bitmap of the benchmark's hashes, of ``bits`` bits at most, those that it holds
are shuffled by hash, and the words of documents with hits are fetched by their id. Both ways give the same rows.

Null texts are empty, null item texts match nothing; null and repeated ids stay as they are, so that rows which
share a doc_id are reported as one. Texts are read whole; a document's words stand in one row. Further columns are passed over by
``overlaps`` and kept by ``clean``, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions.chars import let
from spanloom.llm.common import counted, without, written


@dataclass(frozen=True)
class Settings:
    most_masks: int = 4
    stretch: int = 12
    agree: int = 75
    least: int = 5
    whole: int = 9
    broadcast: int = 8_000_000
    bits: int = 1 << 28


#: Bytes of a row of the benchmark's windows: four fields, and what a hashed relation adds.
_ROW = 48


#: Scripts without blanks: Thai and Lao, Burmese, Khmer, kana, bopomofo and Chinese characters.
UNSPACED = r"[\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3005-\u3007\u3040-\u312F\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\uFF66-\uFF9D\x{20000}-\x{3FFFF}]"


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; each character of a script without blanks is a word."""
    text = F.coalesce(text, F.lit(""))
    text = F.when(text.rlike(UNSPACED), F.regexp_replace(text, f"({UNSPACED})", " $1 ")).otherwise(text)
    return F.array_remove(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), " "), "")


@lru_cache(maxsize=None)
def _covering(n: int, misses: int, ones: int) -> tuple[str, ...]:
    """Masks with so many ones, chosen greedily, one of which fits somewhere beside any ``misses`` of ``n`` places; 1 marks
    a word that must agree."""
    wrong = list(combinations(range(n), misses))
    hit = {}
    for mask in combinations(range(n), ones):
        if mask[0] == 0:
            spots = [{k + at for k in mask} for at in range(n - mask[-1])]
            name = "".join("01"[k in mask] for k in range(mask[-1] + 1))
            hit[name] = sum(1 << i for i, w in enumerate(wrong) if any(spot.isdisjoint(w) for spot in spots))
    left, out = (1 << len(wrong)) - 1, []
    while left:
        out.append(max(hit, key=lambda m: ((hit[m] & left).bit_count(), -len(m), m)))
        left &= ~hit[out[-1]]
    return tuple(out)


def masks(n: int, settings: Settings) -> tuple[str, ...]:
    """The masks for items of ``n`` words, or of ``stretch`` for longer ones: each overlap that is verified holds a window of
    one of them. They have as many ones as ``most_masks`` of them allow."""
    n = min(n, settings.stretch)
    misses = n * (100 - settings.agree) // 100
    return next(found for ones in range(n - misses, 0, -1) if len(found := _covering(n, misses, ones)) <= settings.most_masks)


def _seeds(hashes: str, size: str, at: Column, masks: list[str], may: list[Column] | None = None) -> Column:
    """The hash of the window at ``at`` under each mask that fits there, and that the row may use."""
    w = lambda k: F.get(F.col(hashes), at + k)
    each = []
    for number, mask in enumerate(masks):
        seen = F.xxhash64(F.lit(number), *(w(k) for k, c in enumerate(mask) if c == "1"))
        fits = at + len(mask) <= F.col(size)
        each.append(F.when(fits & may[number] if may else fits, seen))
    return F.array(*each)


def _windows(rows: DataFrame, masks: list[str], keep: list[str], may: list[Column] | None = None) -> DataFrame:
    """One row per window and mask: ``keep``, at, seed. Kept simple so that it runs as generated code."""
    last = F.col("__n") - min(map(len, masks))
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    out = rows.select(*keep, "__h", "__n", F.explode(starts).alias("at"))
    out = out.select(*keep, "__h", "__n", "at", F.explode(_seeds("__h", "__n", F.col("at"), masks, may)).alias("seed"))
    return out.where(F.col("seed").isNotNull())


def _hashed(rows: DataFrame, text: str, keep: list[str]) -> DataFrame:
    out = rows.select(*keep, words(F.col(text)).alias("__w"))
    return out.withColumn("__h", F.transform("__w", lambda w: F.xxhash64(w))).withColumn("__n", F.size("__h"))


def _beside(start: Column) -> Column:
    """The document's words that lie beside an item of ``item_n`` words which starts at ``start``."""
    return F.slice("__w", F.greatest(start, F.lit(0)) + 1, F.greatest(F.col("item_n") + F.least(start, F.lit(0)), F.lit(0)))


def _bitmap(seeds: DataFrame, bits: int) -> DataFrame:
    """One row: a bitmap of ``bits`` bits, set where a seed falls."""
    held = seeds.select(F.pmod("seed", F.lit(bits)).alias("bit")).select((F.col("bit") / 64).cast("long").alias("id"), F.expr("shiftleft(1L, cast(bit % 64 AS int))").alias("word"))
    held = seeds.sparkSession.range(bits // 64).withColumn("word", F.lit(0).cast("long")).union(held).groupBy("id").agg(F.bit_or("word").alias("word"))
    return held.agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "word"))), lambda x: x["word"]).alias("words"))


def _hits(docs: DataFrame, seeds: DataFrame, number: int, masks: list[str], s: Settings) -> DataFrame:
    """(doc_id, item, item_n, start, beside) of each hit; ``seeds`` (seed, item, item_n, item_at), ``number`` of them."""
    start = (F.col("at") - F.col("item_at")).alias("start")
    if number * _ROW <= s.broadcast:
        seen = _windows(_hashed(docs, "text", ["doc_id"]), masks, ["doc_id", "__w"])
        hits = seen.join(F.broadcast(seeds), "seed").select("doc_id", "item", "item_n", start, _beside(F.col("at") - F.col("item_at")).alias("beside"))
    else:
        rows = docs.select("doc_id", "text", F.xxhash64("text").alias("print"))
        bits = min(s.bits, 1 << max(10, (8 * number).bit_length()))
        bit = F.pmod("seed", F.lit(bits))
        held = F.getbit(F.get(_bitmap(seeds, bits).scalar(), (bit / 64).cast("int")), (bit % 64).cast("int")) == 1
        seen = _windows(_hashed(rows, "text", ["doc_id", "print"]), masks, ["doc_id", "print"]).where(held)
        found = written(seen.join(seeds, "seed").select(F.col("doc_id").alias("of"), F.col("print").alias("hit"), "item", "item_n", start).distinct())
        same = F.col("doc_id").eqNullSafe(F.col("of")) & F.col("print").eqNullSafe(F.col("hit"))
        rows = rows.dropDuplicates(["doc_id", "print"]).join(found, same)
        hits = _hashed(rows, "text", ["doc_id", "item", "item_n", "start"]).select("doc_id", "item", "item_n", "start", _beside(F.col("start")).alias("beside"))
    hits = hits.groupBy("doc_id", "item", "start", F.xxhash64("beside").alias("print")).agg(*(F.first(c).alias(c) for c in ("item_n", "beside")))
    return hits.where((F.col("item_n") >= s.whole) | (F.size("beside") == F.col("item_n")))


def overlaps(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, item_id, n_matched, n_words, start): verified overlaps, the best of each document and item.

    ``start`` is the number of the document's word beside the item's first one, and may be negative.
    """
    s = settings
    # Items of the same words are looked up once.
    named = written(_hashed(benchmark.where(F.col("text").isNotNull()), "text", ["item_id"]).where(F.col("__n") >= s.least).withColumn("item", F.xxhash64("__w")))
    items = named.groupBy("item").agg(F.first("__w").alias("item_w"), F.first("__h").alias("__h"), F.first("__n").alias("__n"))
    size = F.least(F.col("__n"), F.lit(s.stretch))
    sizes = sorted(r["size"] for r in items.select(size.alias("size")).distinct().collect()) or [s.stretch]
    used = {n: masks(n, s) for n in sizes}
    every = sorted({m for found in used.values() for m in found})
    # An item is found by the masks of its own length alone.
    may = [size.isin([n for n in sizes if m in used[n]]) for m in every]
    seeds, number = counted(_windows(items, every, ["item"], may).select("seed", "item", F.col("__n").alias("item_n"), F.col("at").alias("item_at")))
    hits = _hits(docs, seeds, number, every, s).join(items.select("item", "item_w"), "item")
    late = F.greatest(-F.col("start"), F.lit(0))
    agrees = F.transform(F.sequence(F.lit(0), F.col("item_n") - 1), lambda k: F.coalesce((F.when(k >= late, F.get(F.col("beside"), k - late)) == F.get(F.col("item_w"), k)).cast("int"), F.lit(0)))
    hits = hits.select("doc_id", "item", "start", "item_n", agrees.alias("agrees"))
    size = F.least(F.lit(s.stretch), F.col("item_n"))
    total = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)
    near = let(F.col("agrees"), lambda a: F.exists(F.sequence(F.lit(0), F.col("item_n") - size), lambda k: 100 * total(F.slice(a, k + 1, size)) >= s.agree * size))
    good = hits.where(near).select("doc_id", "item", "start", F.col("item_n").alias("n_words"), total(F.col("agrees")).alias("n_matched"))
    best = good.groupBy("doc_id", "item").agg(F.max(F.struct("n_matched", (-F.col("start")).alias("back"), "n_words")).alias("b"))
    best = best.join(named.select("item", "item_id").distinct(), "item")
    best = best.groupBy("doc_id", "item_id").agg(F.max("b").alias("b"))
    return best.select("doc_id", "item_id", F.col("b.n_matched").cast("long").alias("n_matched"), F.col("b.n_words").cast("long").alias("n_words"), (-F.col("b.back")).cast("long").alias("start"))


def clean(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` without the documents that overlap an item; rows that share a doc_id go together, null ids too."""
    return without(docs, overlaps(docs, benchmark, settings))


#: The same rows in SQL, without seeds: with a quarter of its words replaced, three consecutive words of a stretch of 9 or more still agree, and two
#: of a shorter item; all places where they do are compared word by word.
ORACLE_SQL = """
WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM benchmark WHERE text IS NOT NULL),
dp AS (SELECT doc_id, w, unnest(range(len(w))) AS p FROM d),
bp AS (SELECT item_id, w, unnest(range(len(w))) AS p FROM b WHERE len(w) >= 5),
h AS (SELECT DISTINCT doc_id, item_id, dp.p - bp.p AS start, dp.w AS w, bp.w AS iw FROM dp JOIN bp ON dp.w[dp.p + 1] = bp.w[bp.p + 1] AND dp.w[dp.p + 2] = bp.w[bp.p + 2] AND dp.w[dp.p + 3] = bp.w[bp.p + 3] WHERE len(bp.w) >= 9
      UNION SELECT DISTINCT doc_id, item_id, dp.p - bp.p AS start, dp.w, bp.w FROM dp JOIN bp ON dp.w[dp.p + 1] = bp.w[bp.p + 1] AND dp.w[dp.p + 2] = bp.w[bp.p + 2]
      WHERE len(bp.w) < 9 AND dp.p - bp.p >= 0 AND dp.p - bp.p + len(bp.w) <= len(dp.w)),
a AS (SELECT doc_id, item_id, start, len(iw) AS n,
        list_transform(range(len(iw)), lambda i: CASE WHEN start + i >= 0 AND start + i < len(w) AND w[start + i + 1] = iw[i + 1] THEN 1 ELSE 0 END) AS g FROM h),
v AS (SELECT doc_id, item_id, start, n, list_sum(g) AS m FROM a
      WHERE len(list_filter(range(n - least(12, n) + 1), lambda s: 100 * list_sum(g[s + 1 : s + least(12, n)]) >= 75 * least(12, n))) > 0)
SELECT doc_id, item_id, CAST(m AS BIGINT) AS n_matched, CAST(n AS BIGINT) AS n_words, CAST(start AS BIGINT) AS start
FROM v QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY m DESC, start) = 1
"""
