"""Toxicity: a factorization machine over hashed terms.

A document is the set of its distinct terms: words without surrounding
punctuation and the first five bytes of longer words, each hashed to a bucket.
The score is sigmoid(b + sum w_i + sum over pairs <v_i, v_j>), so two terms that
are harmless alone can be toxic together.

The model is fitted on at most ``max_train`` labelled rows and ``max_terms`` terms
(the rows with the smallest hash of their id, so the choice is the same on every
run); every document is scored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import free_name, staged, text_of, words_of

BUCKET_BITS = 20
STEM = 5
MARKS = b".,;:!?\"'()[]{}<>*_-"
# What the model may be fitted on, documented bounds: rows, and terms of all of them (4 bytes each).
MAX_TRAIN, MAX_TERMS = 20_000, 4_000_000
# Buckets of fewer training rows get neither weight nor factors, whatever their labels.
LEAST = 3
# A weight's score, pull on the factors, largest factors, and factors that count as grown.
BOUND, PAIR_DECAY, LARGEST, GROWN = 4.0, 0.02, 2.0, 0.1
# Ranges of the hash that are counted to find where the choice of rows ends.
RANGE_BITS = 12
THRESHOLD = 0.3


def terms(text: str) -> np.ndarray:
    """Sorted buckets of a text's distinct terms."""
    found = {w.strip(MARKS) for w in set(words_of(text))}
    found |= {b"\0" + w[:STEM] for w in found if len(w) > STEM}
    found.discard(b"")
    mask = (1 << BUCKET_BITS) - 1
    return np.unique(np.array([zlib.crc32(w) & mask for w in found], np.int32))


@dataclass
class Model:
    """``place`` gives a bucket's row in w and v; buckets without one have weight 0."""

    bias: float
    buckets: np.ndarray
    w: np.ndarray
    v: np.ndarray

    def table(self) -> np.ndarray:
        place = np.full(1 << BUCKET_BITS, -1, np.int32)
        place[self.buckets] = np.arange(len(self.buckets))
        return place

    def scores(self, docs: list[np.ndarray], place: np.ndarray) -> np.ndarray:
        row = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        col = place[np.concatenate(docs)] if docs else np.zeros(0, np.int32)
        known = col >= 0
        return _sigmoid(_raw(self.bias, self.w, self.v, row[known], col[known], len(docs))[0])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _raw(bias, w, v, row, col, n) -> tuple[np.ndarray, np.ndarray]:
    """Value before the sigmoid, and the sum of factors of each document."""
    total = bias + np.bincount(row, w[col], n)
    sums = np.stack([np.bincount(row, v[col, f], n) for f in range(v.shape[1])], axis=1)
    squares = np.bincount(row, (v[col] ** 2).sum(axis=1), n)
    return total + ((sums**2).sum(axis=1) - squares) / 2, sums


class _Sample:
    """Occurrences of buckets in the training rows, by row and by bucket."""

    def __init__(self, docs: list[np.ndarray], least: int):
        every = np.concatenate(docs)
        seen = np.bincount(every, minlength=1 << BUCKET_BITS)
        self.buckets = np.nonzero(seen >= least)[0]
        place = np.full(1 << BUCKET_BITS, -1, np.int32)
        place[self.buckets] = np.arange(len(self.buckets))
        col, row = place[every], np.repeat(np.arange(len(docs), dtype=np.int32), [len(d) for d in docs])
        self.n, self.row, self.col = len(docs), row[col >= 0], col[col >= 0]
        self.seen = seen[self.buckets]
        sizes = np.bincount(self.row, minlength=self.n)
        self._filled = np.nonzero(sizes)[0]
        self._row_starts = (np.cumsum(sizes) - sizes)[self._filled]
        self._by_bucket = self.row[np.argsort(self.col, kind="stable")]
        self._bucket_starts = np.cumsum(self.seen) - self.seen

    def rows(self, values: np.ndarray) -> np.ndarray:
        """Sums of the buckets' values in each row."""
        out = np.zeros((self.n, *values.shape[1:]), np.float32)
        if len(self._filled):
            out[self._filled] = np.add.reduceat(values[self.col], self._row_starts, axis=0)
        return out

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sums of the rows' values over the rows each bucket is in."""
        if not len(self.seen):
            return np.zeros((0, *values.shape[1:]), np.float32)
        return np.add.reduceat(values[self._by_bucket], self._bucket_starts, axis=0)

    def scores(self, raw: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """By how many standard errors the loss still falls with each bucket's weight."""
        rest = _sigmoid(raw) - labels
        share = self.seen / self.n
        slope = self.sums(rest.astype(np.float32)) - share * rest.sum()
        return np.abs(slope) / np.sqrt(np.maximum(self.seen * (1 - share) * rest.var(), 1e-9))


def _descend(bias, w, v, row, col, labels, rounds, decay=1e-4, rate=0.1) -> tuple[float, np.ndarray, np.ndarray]:
    """Full-batch Adam on the logistic loss."""
    n = len(labels)
    params = [np.array([bias]), w, v]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, rounds + 1):
        bias, w, v = params
        raw, sums = _raw(bias[0], w, v, row, col, n)
        slope = (_sigmoid(raw) - labels) / n
        grad_v = np.stack(
            [np.bincount(col, slope[row] * (sums[row, f] - v[col, f]), len(w)) for f in range(v.shape[1])], axis=1
        )
        grads = [np.array([slope.sum()]), np.bincount(col, slope[row], len(w)) + decay * w, grad_v + decay * v]
        for k, g in enumerate(grads):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g**2
            params[k] = params[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return float(params[0][0]), params[1], params[2]


def _grown_factors(sample: _Sample, raw: np.ndarray, labels: np.ndarray, v: np.ndarray, rounds: int) -> np.ndarray:
    """Factors of all buckets after gradient steps on what ``raw`` leaves unexplained.

    They begin close to zero and are pulled back all the time, so only those grow
    whose pairs lower the loss, whatever their terms do alone.
    """
    # Frequent terms tell least apart and would dominate the steps.
    x = np.sqrt(1 - sample.seen / (sample.n + 1)).astype(np.float32)
    most = np.ones(len(x), np.float32)
    for _ in range(6):
        most = x * sample.sums(sample.rows(x * (most / max(np.linalg.norm(most), 1e-9)))) / sample.n
    step = 1 / (0.33 * max(float(np.linalg.norm(most)), 1e-9))
    v, moved, bias = v.astype(np.float32), np.zeros(v.shape, np.float32), 0.0
    for _ in range(rounds):
        scaled = x[:, None] * v
        sums, squares = sample.rows(scaled), sample.rows((scaled**2).sum(axis=1))
        slope = (_sigmoid(raw + bias + ((sums**2).sum(axis=1) - squares) / 2) - labels) / sample.n
        slope = slope.astype(np.float32)
        found = sample.sums(np.concatenate([slope[:, None], slope[:, None] * sums], axis=1))
        grad = x[:, None] * found[:, 1:] - (x * x)[:, None] * found[:, :1] * v
        moved = 0.9 * moved + grad + PAIR_DECAY * v
        v = v - step * moved
        v *= np.minimum(1, LARGEST / np.maximum(np.linalg.norm(v, axis=1), 1e-9))[:, None]
        bias -= 4 * float(slope.sum())
    return (x[:, None] * v).astype(float)


def train(
    docs: list[np.ndarray], labels: np.ndarray, factors: int = 4, rounds: int = 150, pair_rounds: int = 40, least: int = LEAST
) -> Model:
    """Fit the logistic loss with a weight and factors for every bucket of the sample.

    A weight is held at zero until its score (slope of the loss in standard errors,
    under the model so far) reaches BOUND, as a penalty of that size would hold it.
    The factors of all buckets are free but for a steady pull to zero; those that
    grow against it join with their weights. So terms that say nothing alone still
    enter by their pairs. Without labels of both kinds the score is the share of
    toxic labels (0 without any).
    """
    n, toxic = len(labels), int(labels.sum())
    if toxic in (0, n):
        bias = 40.0 if n and toxic else -40.0
        return Model(bias, np.zeros(0, np.int64), np.zeros(0), np.zeros((0, factors)))
    sample = _Sample(docs, least)
    m = len(sample.buckets)
    rng = np.random.default_rng(7)
    bias, w, v = math.log(toxic / (n - toxic)), np.zeros(m), rng.normal(0, 0.01, (m, factors))
    free = np.zeros(m, bool)

    def fitted(rounds: int) -> np.ndarray:
        nonlocal bias
        at = np.nonzero(free)[0]
        place = np.full(m, -1, np.int32)
        place[at] = np.arange(len(at))
        col = place[sample.col]
        row, col = sample.row[col >= 0], col[col >= 0]
        bias, w[at], v[at] = _descend(bias, w[at], v[at], row, col, labels, rounds)
        return _raw(bias, w[at], v[at], row, col, n)[0]

    free |= sample.scores(np.full(n, bias), labels) >= BOUND
    raw = fitted(rounds // 2)
    grown = _grown_factors(sample, raw, labels, rng.normal(0, 0.01, (m, factors)), pair_rounds)
    joining = (np.linalg.norm(grown, axis=1) >= GROWN) & ~free
    v[joining] = grown[joining]
    free |= joining
    raw = fitted(rounds // 2)
    free |= sample.scores(raw, labels) >= BOUND
    fitted(rounds)
    at = np.nonzero(free)[0]
    return Model(bias, sample.buckets[at], w[at], v[at])


def _last_range(known: DataFrame, wanted: int) -> int:
    """The hash range in which the ``wanted`` smallest hashes end; at most 2 ** RANGE_BITS counts are read."""
    counts = known.groupBy(F.shiftright("h", 64 - RANGE_BITS).alias("r")).count()
    total = 0
    for row in sorted(counts.collect()):
        total += row["count"]
        if total >= wanted:
            return row["r"]
    return 1 << RANGE_BITS


def fit(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column | None = None,
    max_train: int = MAX_TRAIN,
    max_terms: int = MAX_TERMS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Model:
    """Model learnt from the labelled rows among ``docs`` for which ``usable`` holds.

    A document with several labels is toxic if one of them says so; null labels
    and null ids are left out. Repeated rows of a labelled document all count; null
    texts count as empty. Without labels, or in an empty table, every score is 0.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.where(usable) if usable is not None else known
    known = known.groupBy(id_col).agg(F.max(label_col).cast("int").alias("label"))
    known = known.select(F.col(id_col).alias("id"), "label").withColumn("h", F.xxhash64("id"))
    # At most max_train narrow rows, so the broadcast is bounded; only those up to
    # the range that holds the last one are sorted.
    within = known.where(F.shiftright("h", 64 - RANGE_BITS) <= _last_range(known, max_train))
    chosen = within.orderBy("h", "id").limit(max_train).select("id", "label", "h")
    picked = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).join(F.broadcast(chosen), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [terms(t.as_py()) for t in batch.column(1)]
            sizes = pa.array([len(f) for f in found], pa.int64())
            cells = [batch.column(0), pa.array([f.tobytes() for f in found], pa.binary()), sizes, *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(cells, ["id", "terms", "size", "label", "h"])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, terms binary, size bigint, label int, h bigint"
    # Written, so that only rows within the bounds come to the driver: first their sizes, then their terms.
    rows = staged(picked.select("id", "text", "label", "h").mapInArrow(run, schema), "labelled")
    order = Window.orderBy("h", "id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Repeated rows of a document may be more than the documents chosen.
    sizes = rows.select("h", "id", "size").orderBy("h", "id", "size").limit(max_train)
    fitting = sizes.withColumn("total", F.sum("size").over(order)).where(F.col("total") <= max_terms)
    last = fitting.agg(F.max(F.struct("h", "id", "size"))).first()[0]
    if last is None:
        return train([], np.zeros(0))
    ends = {"h": "bigint", "id": kind, "size": "bigint"}
    within = rows.where(F.struct(*ends) <= F.struct(*[F.lit(last[c]).cast(t).alias(c) for c, t in ends.items()]))
    table = within.orderBy("h", "id", "size").limit(max_train).select("terms", "label").toArrow()
    found = [np.frombuffer(b, np.int32) for b in table.column("terms").to_pylist()]
    return train(found, np.array(table.column("label").to_pylist(), float))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with two more columns at the end: tox_score in 0..1 and tox_predicted (1 from the threshold on).

    Null texts count as empty; they get the score of a document without terms.
    Where ``docs`` has a column of one of these names, the new one gets an
    underscore after its name.
    """
    names = [free_name(docs, n) for n in ("tox_score", "tox_predicted")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = model.table()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            scores = model.scores([terms(t.as_py() or "") for t in texts], place)
            found = (scores >= THRESHOLD).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores), pa.array(found)],
                [*batch.schema.names, *names],
            )

    more = [T.StructField(n, t) for n, t in zip(names, (T.DoubleType(), T.IntegerType()), strict=True)]
    schema = T.StructType([*docs.schema.fields, *more])
    return docs.mapInArrow(run, schema)
