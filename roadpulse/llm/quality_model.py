"""Quality scores from random Fourier features of document statistics.

Statistics of a text (shares of characters by kind, repeated words and lines, word lengths) are standardised and mapped
by cos(Wx + b) to ``FEATURES`` features whose inner products approximate a Gaussian kernel. Each partition of labelled
rows sums its part of the normal equations, the parts are added by Spark, and the driver solves a ridge system of
fixed size. Raw scores are then calibrated by isotonic regression on their histogram of ``BINS`` bins.

All labelled rows outside the held-out fold are used, so nothing is sampled. What reaches the driver has a fixed size:
moments of the statistics, one matrix, one histogram. Null and empty texts have all statistics 0 and are scored like any
other. Repeated rows get the same score. Without labelled rows the score is 0. Labels, language, source and id are no
inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import slices, stored, text_buffers
from roadpulse.llm.toxicity import fold
from roadpulse.llm.words import Words

FEATURES = 192
WIDTH = 3.0
RIDGE = 1e-3
BINS = 1024
STATISTICS = (
    "log_words", "word_length", "word_spread", "symbols", "upper", "digits", "marks", "exclaims", "bars", "foreign",
    "distinct_words", "same_as_last", "repeated_lines", "log_lines",
)

_KINDS = np.zeros((7, 256), bool)
for _k, _characters in enumerate(("#*$%&|<>", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".,;:?", "!", "|")):
    _KINDS[_k, [ord(c) for c in _characters]] = True
_KINDS[6, 128:] = True


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` for each text."""
    data, offsets = text_buffers(texts)
    n = len(texts)
    words = Words(data, offsets)
    size = np.maximum(np.diff(offsets), 1)
    shares = []
    for kind in _KINDS:
        total = np.zeros(len(data) + 1, np.int64)
        np.cumsum(kind[data], out=total[1:])
        shares.append(np.diff(total[offsets]) / size)
    counts = np.diff(words.first)
    some = np.maximum(counts, 1)
    row = np.repeat(np.arange(n), counts)
    length = words.ends - words.starts
    mean = np.bincount(row, length, n) / some
    spread = np.sqrt(np.maximum(np.bincount(row, length.astype(float) ** 2, n) / some - mean**2, 0))
    order = np.lexsort((words.hashes, row))
    h, r = words.hashes[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    distinct = np.bincount(r[new], minlength=n) / some
    same = np.zeros(len(row), bool)
    same[1:] = (words.hashes[1:] == words.hashes[:-1]) & (row[1:] == row[:-1])
    lines, repeated = np.zeros(n), np.zeros(n)
    if len(row):
        # a line begins at a word before which a line feed stands
        feeds = np.zeros(len(data) + 1, np.int64)
        np.cumsum(data == 10, out=feeds[1:])
        line = feeds[words.starts]
        begin = np.ones(len(row), bool)
        begin[1:] = (line[1:] != line[:-1]) | (row[1:] != row[:-1])
        at = np.flatnonzero(begin)
        key, of = words.spans(at, np.append(at[1:], len(row))), row[at]
        order = np.lexsort((key, of))
        again = (key[order][1:] == key[order][:-1]) & (of[order][1:] == of[order][:-1])
        lines, repeated = np.bincount(of, minlength=n), np.bincount(of[order][1:][again], minlength=n)
    columns = [
        np.log1p(counts), mean, spread, *[np.sqrt(s) for s in shares], distinct, np.sqrt(np.bincount(row, same, n) / some),
        repeated / np.maximum(lines, 1), np.log1p(lines),
    ]
    return np.stack(columns, 1).astype(float)


def described(documents: DataFrame) -> DataFrame:
    """doc_id and ``x``, the statistics of each document."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            x = statistics(batch.column("text"))
            values = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), values], ["doc_id", "x"])

    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, x array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(STATISTICS))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    steps: np.ndarray  # raw scores at which the calibrated score changes
    levels: np.ndarray

    def lifted(self, x: np.ndarray) -> np.ndarray:
        random = np.random.default_rng(11)
        w = random.normal(0, 1 / WIDTH, (len(STATISTICS), FEATURES))
        b = random.uniform(0, 2 * np.pi, FEATURES)
        z = np.sqrt(2 / FEATURES) * np.cos((x - self.mean) / self.scale @ w + b)
        return np.concatenate([z, np.ones((len(x), 1))], 1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.lifted(x) @ self.weight

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        if not len(self.steps):
            return np.zeros(len(raw))
        return np.clip(np.interp(raw, self.steps, self.levels), 0, 1)


def isotonic(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted non-decreasing least-squares fit by pooling neighbours that are out of order."""
    pools: list[list[float]] = []
    for v, w in zip(value, weight, strict=True):
        pools.append([v, w, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            v2, w2, n2 = pools.pop()
            v1, w1, n1 = pools.pop()
            pools.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.concatenate([np.full(int(n), v) for v, _, n in pools])


def fit(found: DataFrame, labels: DataFrame) -> Model:
    """Learn from ``described`` rows with a quality label outside fold 0."""
    labels = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (fold(F.col("doc_id")) != 0))
    labels = labels.groupBy("doc_id").agg(F.max(F.col("quality").cast("double")).alias("y"))
    rows = stored(found.join(labels, "doc_id").select("x", "y"), "quality-rows")
    p = len(STATISTICS)
    parts = [f(F.col("x")[k]).alias(f"{n}{k}") for k in range(p) for n, f in (("m", F.avg), ("s", F.stddev_pop))]
    moments = rows.agg(F.count("*").alias("n"), *parts).first()
    model = Model(np.zeros(p), np.ones(p), np.zeros(FEATURES + 1), np.empty(0), np.empty(0))
    if not moments["n"]:
        return model
    model.mean = np.array([moments[f"m{k}"] for k in range(p)])
    model.scale = np.maximum(np.array([moments[f"s{k}"] for k in range(p)]), 1e-6)
    d = FEATURES + 1

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d + 1))
        for batch in batches:
            z = model.lifted(_matrix(batch.column("x")))
            total[:, :d] += z.T @ z
            total[:, d] += z.T @ batch.column("y").to_numpy(zero_copy_only=False)
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], ["i", "j", "v"])

    total = np.zeros((d, d + 1))
    for r in rows.mapInArrow(equations, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        total[r["i"], r["j"]] = r["v"]
    model.weight = np.linalg.solve(total[:, :d] + RIDGE * moments["n"] / FEATURES * np.eye(d), total[:, d])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b = np.clip((model.raw(_matrix(batch.column("x"))) + 0.5) / 2 * BINS, 0, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(b), batch.column("y")], ["b", "y"])

    bins = rows.mapInArrow(binned, "b int, y double").groupBy("b").agg(F.count("*").alias("n"), F.avg("y").alias("y")).collect()
    bins.sort(key=lambda r: r["b"])
    model.steps = (np.array([r["b"] for r in bins]) + 0.5) / BINS * 2 - 0.5
    model.levels = isotonic(np.array([r["y"] for r in bins]), np.array([float(r["n"]) for r in bins]))
    return model


def score(found: DataFrame, model: Model) -> DataFrame:
    """doc_id and ``score`` (0 to 1) of ``described`` rows."""
    kind = found.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                scores = model.calibrated(model.raw(_matrix(batch.column("x"))))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    return found.select("doc_id", "x").mapInArrow(run, f"doc_id {kind}, score double")
