"""Language identification: averaged hashed subword embeddings under a linear softmax, trained in numpy.

A text is lower-cased, everything but letters becomes one blank, and each run of 2, 3 and 4 characters is
hashed to one of ``buckets`` rows of an embedding table. The mean of the rows goes through a linear layer and a
softmax. Stochastic gradient descent fits both on a bounded sample of labelled rows, chosen by a hash of the id: ``per_label`` rows a
language in expectation, and fewer if there are so many or so long that their counts of subwords would number more than ``held``;
every language in the labels is learned. Another part of the sample sets the temperature and the
level below which a prediction is rejected. Every text is then read whole by executors, in pieces if it is long.

Null texts and texts with no letter get ``und`` and score 0, and so does every text if nothing was labelled.
Rows with a null language or id are never learned from. One row out for one row in, with the columns named below only; ids may repeat.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.llm.common import written

UNKNOWN = "und"
ORDERS = (2, 3, 4)
#: Characters hashed at once.
_BLOCK = 50_000


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 15
    dim: int = 16
    per_label: int = 400  #: the bound of the sample: rows a language, in expectation
    held: int = 8_000_000  #: the bound of what the sample's rows hold: (subword, count) pairs, in expectation
    epochs: int = 12
    rate: float = 2.0
    rejected: float = 0.001  #: the share of rightly labelled rows that may fall below the level
    level: float = 0.4  #: the level is never above this
    seed: int = 7


@dataclass(frozen=True)
class Model:
    labels: tuple[str, ...]
    table: np.ndarray  #: buckets x labels: the embedding already multiplied by the linear layer; or, with many labels, not yet
    linear: np.ndarray | None
    bias: np.ndarray
    temperature: float
    level: float


class Subwords:
    """Hashed subwords of texts, many texts at a time."""

    def __init__(self, buckets: int):
        fold = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                fold[c] = ord(low) if len(low) == 1 else c
        self.fold, self.buckets = fold, np.uint64(buckets)

    def blocks(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For pieces of the texts: hashes, the text of each hash, and the texts that have a letter."""
        held, size = [], 0
        for k, text in enumerate(texts):
            for start in range(0, len(text), _BLOCK):
                piece = text[max(0, start - max(ORDERS)) : start + _BLOCK]
                held.append((k, piece))
                size += len(piece)
                if size >= _BLOCK:
                    yield self._hashed(held)
                    held, size = [], 0
        if held:
            yield self._hashed(held)

    def _hashed(self, pieces: list[tuple[int, str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        code = np.concatenate([np.frombuffer(f"\0{p}\0".encode("utf-32-le", "replace"), np.uint32) for _, p in pieces])
        owner = np.repeat(np.array([k for k, _ in pieces], np.int32), [len(p) + 2 for _, p in pieces])
        c = self.fold[code]
        letter = np.unique(owner[c > 0])
        keep = (c > 0) | np.r_[True, c[:-1] > 0]  # one blank for any run of others
        keep[np.cumsum([0] + [len(p) + 2 for _, p in pieces[:-1]])] = True  # and one before each piece, whatever stands before it
        c, owner = c[keep].astype(np.uint64), owner[keep]
        out, who = [], []
        h = c + np.uint64(1)
        for n in range(2, max(ORDERS) + 1):
            h = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + c[n - 1 :] + np.uint64(n)
            if n in ORDERS:
                mixed = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                same = owner[: len(h)] == owner[n - 1 :]
                out.append(((mixed >> np.uint64(33)) % self.buckets)[same].astype(np.int32))
                who.append(owner[: len(h)][same])
        return np.concatenate(out), np.concatenate(who), letter


_SUBWORDS: dict[int, Subwords] = {}


def _subwords(buckets: int) -> Subwords:
    if buckets not in _SUBWORDS:
        _SUBWORDS[buckets] = Subwords(buckets)
    return _SUBWORDS[buckets]


def _features(buckets: int):
    """Per text: its hashed subwords and their counts, at most ``buckets`` of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label, text, spot in zip(*(batch.column(c).to_pylist() for c in ("label", "text", "spot")), strict=True):
                total = np.zeros(buckets, np.int64)
                for ids, _, _ in _subwords(buckets).blocks([text or ""]):
                    total += np.bincount(ids, minlength=buckets)
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array([label]), pa.array([spot]), pa.array([at], pa.list_(pa.int32())), pa.array([total[at]], pa.list_(pa.int32()))], names=["label", "spot", "ids", "times"])

    return run


def train(docs: DataFrame, label: str = "lang", text: str = "text", key: str = "doc_id", settings: Settings = Settings()) -> Model:
    """Fit on labelled rows of ``docs``; only the number of rows by label and the features of the bounded sample come to the driver."""
    s = settings
    rows = docs.where(F.col(label).isNotNull() & F.col(key).isNotNull()).select(F.col(label).alias("label"), F.col(text).alias("text"), F.col(key).alias("key"))
    share = [(r["label"], min(1.0, s.per_label / r["count"])) for r in rows.groupBy("label").count().collect()]
    if not share:
        return Model((), np.zeros((s.buckets, 0)), None, np.zeros(0), 1.0, 0.0)
    spot = F.pmod(F.xxhash64(F.lit(s.seed), "key"), F.lit(1 << 30)) / float(1 << 30)
    shares = rows.sparkSession.createDataFrame(share, "label string, share double")
    drawn = rows.join(F.broadcast(shares) if len(share) <= 100_000 else shares, "label").where(spot < F.col("share"))
    # A narrow table, of which no more than the bound is sent on.
    drawn = written(drawn.select("label", "text", (spot / F.col("share")).alias("spot")).mapInArrow(_features(s.buckets), "label string, spot double, ids array<int>, times array<int>"))
    pairs = drawn.agg(F.sum(F.size("ids"))).first()[0] or 0
    got = drawn.where(F.col("spot") * pairs < s.held).select("label", "ids", "times").toArrow()
    labels = tuple(sorted(x for x, _ in share))
    place = {x: k for k, x in enumerate(labels)}
    data = []
    for batch in got.to_batches():
        for y, i, t in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            ids, times = i.values.to_numpy(), t.values.to_numpy().astype(np.float32)
            if len(ids):
                data.append((ids, times / times.sum(), place[y]))
    data.sort(key=lambda x: (x[2], len(x[0]), x[0].tobytes(), x[1].tobytes()))
    return _fit(labels, data, s)


def _fit(labels: tuple[str, ...], data: list, s: Settings) -> Model:
    rng = np.random.default_rng(s.seed)
    order = rng.permutation(len(data))
    held = {int(k) for k in order[: len(data) // 5]} if len(data) >= 50 else set()
    fit = [x for k, x in enumerate(data) if k not in held]
    embed = rng.normal(0, 1 / s.dim, (s.buckets, s.dim))
    linear, bias = np.zeros((s.dim, len(labels))), np.zeros(len(labels))
    steps, step = max(1, s.epochs * len(fit)), 0
    weight = len(fit) / (len(labels) * np.maximum(1, np.bincount([y for _, _, y in fit], minlength=len(labels))))
    for _ in range(s.epochs):
        for k in rng.permutation(len(fit)):
            ids, share, y = fit[k]
            rate = s.rate * (1 - step / steps) * min(weight[y], 10.0)
            step += 1
            mean = share @ embed[ids]
            z = mean @ linear + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = linear @ p
            linear -= rate * np.outer(mean, p)
            bias -= 0.05 * rate * p
            embed[ids] -= rate * np.outer(share, back)
    many = len(labels) > s.dim
    table = embed if many else embed @ linear
    check = [data[k] for k in sorted(held)] or fit
    z = np.array([(share @ table[ids] @ linear if many else share @ table[ids]) + bias for ids, share, _ in check]).reshape(-1, len(labels))
    y = np.array([y for _, _, y in check], int)
    best = min(np.geomspace(0.25, 8, 41), key=lambda t: -np.log(_softmax(z / t)[np.arange(len(y)), y] + 1e-12).sum())
    p = _softmax(z / best)
    right = p.max(1)[p.argmax(1) == y] if len(y) else np.zeros(0)
    level = min(s.level, float(np.quantile(right, s.rejected))) if len(right) else 0.0
    return Model(labels, table, linear if many else None, bias, float(best), level)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True)) if z.size else z
    return e / e.sum(1, keepdims=True) if z.size else z


def _predict(model: Model):
    def run(texts: pa.Array) -> pa.Array:
        rows = [t or "" for t in texts.to_pylist()]
        k = model.table.shape[1]
        total, times, letters = np.zeros((len(rows), k)), np.zeros(len(rows)), np.zeros(len(rows), bool)
        if k:
            for ids, owner, letter in _subwords(len(model.table)).blocks(rows):
                letters[letter] = True
                times += np.bincount(owner, minlength=len(rows))
                for j in range(k):
                    total[:, j] += np.bincount(owner, weights=model.table[ids, j], minlength=len(rows))
        if k and len(rows):
            mean = total / np.maximum(times, 1)[:, None]
            p = _softmax(((mean if model.linear is None else mean @ model.linear) + model.bias) / model.temperature)
            top = p.argmax(1)
            label = [model.labels[j] if ok else UNKNOWN for j, ok in zip(top, letters, strict=True)]
            score = np.where(letters, p.max(1), 0.0)
        else:
            label, score = [UNKNOWN] * len(rows), np.zeros(len(rows))
        return pa.StructArray.from_arrays([pa.array(label, pa.string()), pa.array(score, pa.float64()), pa.array(~letters | (score < model.level))], ["label", "score", "rejected"])

    return run


def predict(model: Model, text: Column) -> Column:
    """(label, score, rejected) of each text."""
    from pyspark.sql.functions import arrow_udf

    run = _predict(model)

    @arrow_udf("label string, score double, rejected boolean")
    def language(texts: pa.Array) -> pa.Array:
        return run(texts)

    return language(text)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def digest(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Learn from the rows that are not held out, then predict every row."""
    model = train(docs.where(~held_out(F.col("doc_id"))), settings=settings)
    out = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predict(model, F.col("text")).alias("p"))
    return out.select("doc_id", "held_out", F.col("p.label").alias("lang_pred"), F.col("p.score").alias("score"), F.col("p.rejected").alias("rejected"))
