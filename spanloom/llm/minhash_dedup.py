"""Near-duplicate documents by MinHash with tensored banding, every link confirmed on the full sets.

A document's set holds its distinct runs of ``width`` words (lower-cased A-Z, split at ASCII white space); with
fewer words the whole sequence is the only one, and with none the set is empty and links with nothing. Two
documents are linked if ``100 * intersection >= 75 * union``.

Tensoring: two collections of ``tables`` band hashes of ``rows`` minhashes each are computed, and the keys of
the tables are all pairs of one band from either, so ``tables ** 2`` tables cost ``2 * tables * rows`` minhashes. A
pair of similarity 0.75 misses all of them with a chance of 2 * (1 - 0.75 ** 3) ** 20 = 3.5e-5. Keys of the
first collection that only one set has are dropped before the second one is multiplied in.

Groups: documents of one word sequence (by SHA-256) are one class, stood for by its smallest id. Of each bucket the
member that meets the most others is the pivot, and each set is first compared with the pivot that it meets most
often. A bucket whose members have met in one component is finished. Of the others, only sets stay that can still
have a link: how many of a set's shingles are in sets of other components, one count over all shingles of the sets in open buckets,
bounds what it has in common with any of them. So documents that share a frequent passage, but not most of their text, and
those too far from a group of near copies leave before they are compared with each other. The sets that stay are brought together
again by their rarest shingles, as many as any link needs one of, so that copies which differ in other places from
a large group do not meet all of it.

What is open then is compared group by group, the members outside its largest component with all members, in
tiles of ``tile`` sets and ``held`` shingles a side, where intersections are counted without a pair being
emitted; groups of the same components are compared as one. A tile gives a spanning forest of the links in it, and these
are confirmed on the sets of strings. Components come from star contraction over written tables. No bucket, class or
component is gathered in one task or capped, and nothing depends on its size.

Rows of a null doc_id are left out, rows that repeat an id count as the one with the least text, null texts are
empty; further columns are passed over. Texts are read whole, however long: a text's shingles are hashed in one piece, and
a tile holds two such pieces at least.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanloom.llm.common import components, one_per_id, spanning, written
from spanloom.llm.rolling import Hasher, U, mix


@dataclass(frozen=True)
class Settings:
    width: int = 5
    share: int = 75  #: per cent of the union that two linked sets have in common, or more
    rows: int = 3
    tables: int = 20
    step: float = 1.005  #: from a class of sizes to the next
    tile: int = 128
    held: int = 1_000_000
    seed: int = 5


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BLOCK = 400_000
_CACHE = 20_000
_SKETCH = "doc_id long, n_shingles long, words binary, a array<long>, b array<long>"


def shingle_set(text: str | bytes, width: int = 5) -> set[bytes]:
    """The set itself, as strings."""
    words = (text.encode() if isinstance(text, str) else text).lower().split()
    if len(words) < width:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)}


def _hashed(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(document, hash) of each distinct shingle of each text, sorted, and a digest of each text's word sequence."""
    data = np.frombuffer(b" ".join(texts).lower() + b" ", np.uint8)
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    blank = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.r_[True, blank].astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    doc = np.searchsorted(begins, start, side="right") - 1
    word = Hasher(data).at(start, end)
    weights = mix(np.arange(1, width + 1, dtype=np.uint64) * U(0xD6E8FEB86659FD93)) | U(1)
    count = np.bincount(doc, minlength=len(texts))
    docs, hashes = [], []
    n = len(word) - width + 1
    if n > 0:
        inside = doc[:n] == doc[width - 1 :]
        total = np.zeros(n, np.uint64)
        for j in range(width):
            total += word[j : j + n] * weights[j]
        docs.append(doc[:n][inside])
        hashes.append(mix(total + U(width))[inside])
    first = np.cumsum(count) - count
    for size in range(1, width):
        own = np.flatnonzero(count == size)
        total = np.zeros(len(own), np.uint64)
        for j in range(size):
            total += word[first[own] + j] * weights[j]
        docs.append(own)
        hashes.append(mix(total + U(size)))
    doc, h = np.concatenate(docs), np.concatenate(hashes)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    fresh = np.r_[True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])] if len(doc) else np.zeros(0, bool)
    # The words with one blank after each: equal bytes for equal sequences.
    line = ~blank | np.r_[False, ~blank[:-1]]
    packed, ends = np.where(blank, np.uint8(32), data)[line], np.cumsum(line)
    cuts = np.r_[0, ends[begins[1:] - 1]] if len(texts) else [0]
    digests = [hashlib.sha256(packed[a:b]).digest() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return doc[fresh], h[fresh], digests


def _sketch(s: Settings):
    rng = np.random.default_rng(s.seed)
    n = 2 * s.tables * s.rows
    factor = rng.integers(0, 2**63, n, dtype=np.uint64) * U(2) + U(1)
    shift = rng.integers(0, 2**63, n, dtype=np.uint64)

    def block(ids: list[int], texts: list[bytes]) -> pa.RecordBatch:
        doc, h, digests = _hashed(texts, s.width)
        size = np.bincount(doc, minlength=len(texts))
        has = np.flatnonzero(size)
        bands = np.zeros((2 * s.tables, len(texts)), np.uint64)
        if len(has):
            starts = (np.cumsum(size) - size)[has]
            for k in range(n):
                low = np.minimum.reduceat((h ^ shift[k]) * factor[k], starts)
                bands[k // s.rows, has] = mix(bands[k // s.rows, has] * U(31) + low + U(k))
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(bands[i * s.tables : (i + 1) * s.tables].T.ravel().view(np.int64)), s.tables).cast(pa.list_(pa.int64())) for i in range(2)]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(size, pa.int64()), pa.array(digests, pa.binary()), *lists], names=["doc_id", "n_shingles", "words", "a", "b"])

    return _in_blocks(block)


def _shingles(s: Settings):
    """(rep, hashes) of each document's set."""

    def block(ids: list[int], texts: list[bytes]) -> pa.RecordBatch:
        doc, h, _ = _hashed(texts, s.width)
        ends = np.cumsum(np.bincount(doc, minlength=len(texts)))
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(h.view(np.int64)))], names=["rep", "hashes"])

    return _in_blocks(block)


def _in_blocks(block):
    """``block`` over some texts of rows (doc_id, text) at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(doc_id)
                texts.append(text.as_buffer().to_pybytes())
                held += len(texts[-1])
                if held >= _BLOCK:
                    yield block(ids, texts)
                    ids, texts, held = [], [], 0
        if ids:
            yield block(ids, texts)

    return run


def _weigh(width: int):
    """Pairs (u, v, text of u, text of v) with the sizes of the intersection and the union of their sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: OrderedDict[int, set[bytes]] = OrderedDict()  # of the last few u, no more than _CACHE shingles but for the last

        for batch in batches:
            common, union = [], []
            for u, tu, tv in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if u not in kept:
                    kept[u] = shingle_set(tu.as_py(), width)
                    while len(kept) > 1 and sum(map(len, kept.values())) > _CACHE:
                        kept.popitem(last=False)
                one, other = kept[u], shingle_set(tv.as_py(), width)
                common.append(len(one & other))
                union.append(len(one) + len(other) - common[-1])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(common, pa.int64()), pa.array(union, pa.int64())], names=["u", "v", "common", "union"])

    return run


def _weighed(pairs: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """Pairs (u, v) with common and union; u, of which many pairs may share one, is looked up last."""
    v = texts.select(F.col("doc_id").alias("v"), F.col("text").alias("v_text"))
    u = texts.select(F.col("doc_id").alias("u"), F.col("text").alias("u_text"))
    rows = pairs.join(v, "v").join(u, "u").select("u", "v", "u_text", "v_text")
    return written(rows.mapInArrow(_weigh(s.width), "u long, v long, common long, union long"))


def _compared(s: Settings):
    """One tile: links (u, v) between sets of different components, as many as a spanning forest needs."""

    def run(tile: pa.Table) -> pa.Table:
        left, right = tile.column("left").to_numpy(), tile.column("right").to_numpy()
        one, other = np.flatnonzero(left), np.flatnonzero(right)
        if not len(one) or not len(other):
            return pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64())})
        rep, component = tile.column("rep").to_numpy(), tile.column("component").to_numpy()
        hashes = tile.column("hashes").combine_chunks()
        size = hashes.value_lengths().to_numpy()
        doc, (_, column) = np.repeat(np.arange(len(rep)), size), np.unique(hashes.flatten().to_numpy(), return_inverse=True)
        # Only shingles of some set on the left and another one count for intersections; they are taken some columns at a time.
        use = (np.bincount(column) > 1) & (np.bincount(column, weights=left[doc]) > 0)
        number = np.cumsum(use) - 1
        doc, column = doc[use[column]], number[column[use[column]]]
        order = np.argsort(column, kind="stable")
        doc, column = doc[order], column[order]
        common = np.zeros((len(one), len(other)))
        step = 4096
        for start in range(0, int(use.sum()), step):
            at = slice(*np.searchsorted(column, [start, start + step]))
            has = np.zeros((len(rep), step), np.float32)
            has[doc[at], column[at] - start] = 1
            common += has[one] @ has[other].T
        union = size[one][:, None] + size[other][None] - common
        linked = (100 * common >= s.share * union) & (component[one][:, None] != component[other][None])
        x, y = np.nonzero(linked)
        x, y = one[x], other[y]
        need = spanning(component, x, y)
        return pa.table({"u": rep[x[need]], "v": rep[y[need]]})

    return run


def _labelled(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """``rows`` (rep, ...) with the component of each ``rep``."""
    comp = components(edges).withColumnRenamed("id", "rep")
    return rows.join(comp, "rep", "left").withColumn("component", F.coalesce("component", "rep"))


def _open(rows: DataFrame) -> DataFrame:
    """``rows`` (key, rep, component, ...) of the buckets with several components."""
    spread = rows.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return rows.join(spread.where("low < high").select("key"), "key")


def _live(sets: DataFrame, hashes: DataFrame, s: Settings) -> DataFrame:
    """(key, rep, component, n): groups of ``sets`` (rep, component) in one of which each pair meets that may be a link.

    Two sets of different components have no more in common than either's number of shingles that sets of other components
    have too, ``shared``. A link of x and y needs (100 + share) * common >= share * (n of x + n of y), so x can only be linked to sizes
    for which it has as many shared ones. If it needs m in common with y, one of them is among all but the last m - 1 of x's shared
    shingles in an order of all shingles, by the number of sets that have them, and of y's likewise. So sets
    come together by these first ones, for each class of sizes by itself.
    """
    need = lambda n, other: F.ceil(s.share * (n + other) / (100 + s.share))
    least, most = F.ceil(F.col("n") * s.share / 100), F.floor(F.col("n") * 100 / s.share)
    of = lambda n: F.floor(F.log(n.cast("double")) / float(np.log(s.step))).cast("int")
    sizes = sets.join(hashes.select("rep", F.size("hashes").alias("n")), "rep")
    each = sets.join(hashes, "rep").select("rep", "component", F.explode_outer("hashes").alias("h"))
    spread = each.groupBy("h").agg(F.min("component").alias("lowest"), F.max("component").alias("highest"), F.count("*").alias("df"))
    held = each.join(spread.where("lowest < highest").select("h", "df"), "h")
    count = held.groupBy("rep").agg(F.count("*").alias("shared"))
    sizes = written(sizes.join(count, "rep").where(F.col("shared") >= need(F.col("n"), least)))
    ranked = held.join(sizes.drop("component"), "rep").withColumn("place", F.row_number().over(Window.partitionBy("rep").orderBy("df", "h")))
    before = lambda other: F.col("place") <= F.col("shared") - need(F.col("n"), other) + 1
    first = written(ranked.where(before(least)).select("h", "rep", "component", "n", "shared", "place", of(F.col("n")).alias("own")))
    # Of all classes that a set may be linked to, a shingle brings it only to those of sets that have it among their first ones too.
    there = first.groupBy("h").agg(F.min("component").alias("lowest"), F.max("component").alias("highest"), F.collect_set("own").alias("others"))
    there = first.join(there.where("lowest < highest").select("h", "others"), "h").withColumn("other", F.explode("others")).where(F.col("other").between(of(least), of(most)))
    # No set of a class is smaller than its ``low``.
    low = F.floor(F.pow(F.lit(float(s.step)), F.col("other")))
    groups = there.where(before(F.greatest(low, least))).select(F.xxhash64("h", F.least("own", "other"), F.greatest("own", "other")).alias("key"), "rep", "component", "n", "own", (F.col("own") != F.col("other")).alias("two"))
    groups = written(groups)
    # A group of two classes is of pairs from one and the other.
    met = groups.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min("own").alias("small"), F.max("own").alias("large"), F.first("two").alias("two"))
    return groups.drop("own", "two").join(met.where("low < high AND (small < large OR NOT two)").select("key"), "key")


def _tiles(rows: DataFrame, hashes: DataFrame, s: Settings) -> DataFrame:
    """The tiles of all groups of ``rows`` (key, rep, component, n): members outside the group's largest component beside all members."""
    rows = written(rows)
    # Groups of the same components are one, so that sets which meet in many groups are compared once.
    alike = rows.select("key", "component").distinct().groupBy("key")
    alike = alike.agg(F.count("*").alias("components"), *(F.sum(F.xxhash64(F.lit(k), "component").cast("decimal(38,0)")).alias(f"print{k}") for k in (0, 1)))
    alike = written(alike.select("key", F.xxhash64("components", F.col("print0").cast("string"), F.col("print1").cast("string")).alias("bucket")))
    rows = written(rows.join(alike, "key").select("bucket", "rep", "component", "n").distinct())
    slots = lambda m, n: F.greatest(F.ceil(m / s.tile), F.ceil(n / s.held)).cast("int")
    parts = rows.groupBy("bucket", "component").agg(F.count("*").alias("m"), F.sum("n").alias("n"))
    parts = parts.groupBy("bucket").agg(F.max(F.struct("m", "component", "n")).alias("top"), F.sum("m").alias("m"), F.sum("n").alias("n"))
    parts = parts.select("bucket", F.col("top.component").alias("top"), slots(F.col("m") - F.col("top.m"), F.col("n") - F.col("top.n")).alias("rows"), slots(F.col("m"), F.col("n")).alias("columns"))
    both = rows.join(parts, "bucket")
    # A row is on the left of the tiles of one i and on the right of those of one j; where the two meet it is sent once.
    spot = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    outer = F.col("component") != F.col("top")
    right = F.transform(every("rows"), lambda i: F.struct(i.alias("i"), spot("columns").alias("j"), (outer & (i == spot("rows"))).alias("left"), F.lit(True).alias("right")))
    left = F.transform(F.array_remove(every("columns"), spot("columns")), lambda j: F.struct(spot("rows").alias("i"), j.alias("j"), F.lit(True).alias("left"), F.lit(False).alias("right")))
    both = both.select("bucket", "rep", "component", F.explode_outer(F.when(outer, F.concat(right, left)).otherwise(right)).alias("at"))
    return both.select("bucket", "rep", "component", "at.*").join(hashes, "rep")


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each document of ``docs`` (doc_id, text)."""
    s = settings
    docs = one_per_id(docs)
    sketch = written(docs.mapInArrow(_sketch(s), _SKETCH))
    some = sketch.where("n_shingles > 0")
    classes = some.groupBy("words").agg(F.min("doc_id").alias("rep"))
    sets = written(some.join(classes.select(F.col("rep").alias("doc_id")), "doc_id").select(F.col("doc_id").alias("rep"), "a", "b"))

    # The first collection: buckets of two sets or more, and the set of each that meets the most others.
    first = sets.select("rep", F.explode("a").alias("key"))
    often = first.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    first = written(first.join(often, "key"))
    meets = first.groupBy("rep").agg(F.sum("n").alias("meets"), F.collect_list("key").alias("keys")).select("rep", "meets", F.explode("keys").alias("key"))
    pivots = meets.groupBy("key").agg(F.max(F.struct("meets", (-F.col("rep")).alias("back"))).alias("p")).select("key", (-F.col("p.back")).alias("pivot"))
    met = first.join(pivots, "key").where("rep <> pivot").groupBy("rep", "pivot").count()
    best = met.groupBy("rep").agg(F.max(F.struct("count", (-F.col("pivot")).alias("back"))).alias("p")).select((-F.col("p.back")).alias("u"), F.col("rep").alias("v"))
    texts = written(docs.join(first.select(F.col("rep").alias("doc_id")).distinct(), "doc_id"))
    alike = 100 * F.col("common") >= s.share * F.col("union")
    links = _weighed(best, texts, s).where(alike).select("u", "v")
    known = written(_labelled(first.select("rep").distinct(), links))

    # Pairs of bands, in the buckets that aren't finished, and of these the sets that may have a link.
    first = _open(first.select("key", "rep").join(known, "rep"))
    keys = first.groupBy("rep", "component").agg(F.collect_list("key").alias("keys")).join(sets.select("rep", "b"), "rep")
    tensor = keys.select("rep", "component", "b", F.explode("keys").alias("key")).select("rep", "component", "key", F.explode("b").alias("band"))
    tensor = _open(written(tensor.select(F.xxhash64("key", "band").alias("key"), "rep", "component")))
    still = written(tensor.select("rep", "component").distinct())
    hashes = written(texts.join(still.select(F.col("rep").alias("doc_id")), "doc_id").mapInArrow(_shingles(s), "rep long, hashes array<long>"))
    tiles = _tiles(_live(still, hashes, s), hashes, s)
    more = written(tiles.groupBy("bucket", "i", "j").applyInArrow(_compared(s), "u long, v long").distinct())
    links = written(links.union(_weighed(more, texts, s).where(alike).select("u", "v")))

    member = _labelled(classes, links).select("words", "component")
    ids = sketch.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("words")).alias("words"))
    out = ids.join(member, "words", "left").withColumn("component_id", F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))
