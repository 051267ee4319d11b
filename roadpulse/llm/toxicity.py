"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents (P) and documents of unknown kind (U, drawn from all) train linear numpy classifiers under the
class-prior-corrected logistic risk  pi R_P+ + max(0, R_U- - pi R_P-): U holds toxic texts as well, so their share pi of
the risk of calling P clean is taken off again, and where that term turns negative (the classifier has begun to learn U
by heart) its gradient is reversed instead. Non-toxic labels serve only to estimate pi.

Features of a text are the 64-bit hashes of its distinct lower-cased words and of their beginnings of 4, 5 and 6 bytes;
a classifier keeps those that, by P, U and pi, are in toxic texts more often than not, at most the ``FEATURES`` whose
share in P exceeds that in U most clearly. ``CLASSIFIERS`` of them are trained, one
Spark task each, on all of the P sample and on U samples of their own; a score is the mean of their probabilities.

Bounds, the same at every size: ``POSITIVES`` confirmed rows, ``UNLABELLED`` rows a classifier, ``FEATURES`` weights.
Null and empty texts have no feature and get the score of the bias alone. Repeated rows get the same score. Without
confirmed rows there is nothing to learn: the score is 0. Labels, language, source and id are no inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import slices, text_buffers
from roadpulse.llm.words import _ODD, Words, _powers, mixed

POSITIVES = 2000
UNLABELLED = 3000
CLASSIFIERS = 3
FEATURES = 8192
BEGINNINGS = (4, 5, 6)
#: A feature is kept if it is in so many P texts at least.
LEAST_TEXTS = 3
EPOCHS, RATE, DECAY = 300, 0.5, 2e-4
Model = list[tuple[np.ndarray, np.ndarray, float]]


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text modulo 5; fold 0 is held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of every word and word beginning, with repetitions."""
    data, offsets = text_buffers(texts)
    words = Words(data, offsets, lower=True)
    row = np.repeat(np.arange(len(texts)), np.diff(words.first))
    found = [words.hashes]
    total, inverse = words.totals(), _powers(_ODD, len(data) + 1)[1]
    for k in BEGINNINGS:
        end = np.minimum(words.starts + k, words.ends)
        found.append(mixed((total[end] - total[words.starts]) * inverse[words.starts] + np.uint64(1000 + k)))
    return np.tile(row, len(found)), np.concatenate(found)


def _distinct(texts: pa.Array) -> list[np.ndarray]:
    row, feature = features(texts)
    order = np.lexsort((feature, row))
    row, feature = row[order], feature[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (feature[1:] != feature[:-1])
    row, feature = row[new], feature[new]
    return np.split(feature.view(np.int64), np.searchsorted(row, np.arange(1, len(texts))))


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> tuple[np.ndarray, np.ndarray, float]:
    """(sorted features, weights, bias) that minimise the non-negative risk by gradient steps with momentum."""

    def counted(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(np.concatenate(sets) if sets else np.empty(0, np.int64), return_counts=True)

    keys, in_p = counted(positive)
    keys, in_p = keys[in_p >= LEAST_TEXTS], in_p[in_p >= LEAST_TEXTS]
    seen, n_seen = counted(unlabelled)
    at = np.searchsorted(seen, keys)
    at[at == len(seen)] = 0
    in_u = np.where(seen[at] == keys, n_seen[at], 0) if len(seen) else np.zeros(len(keys))
    share_p, share_u = in_p / max(len(positive), 1), in_u / max(len(unlabelled), 1)
    # share in P above what P's own part of U explains, in standard errors
    lift = (share_p - share_u) / np.sqrt(share_p / max(len(positive), 1) + share_u / max(len(unlabelled), 1) + 1e-9)
    best = np.sort(np.argsort(-lift, kind="stable")[:FEATURES])
    best = best[(lift[best] > 2) & (2 * prior * share_p[best] > share_u[best])]
    keys = keys[best]

    def matrix(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        rows, cols = [], []
        for r, s in enumerate(sets):
            at = np.searchsorted(keys, s)
            at = at[(at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] == s)] if len(keys) else at[:0]
            rows.append(np.full(len(at), r)), cols.append(at)
        return np.concatenate(rows).astype(np.int64), np.concatenate(cols).astype(np.int64)

    (p_row, p_col), (u_row, u_col) = matrix(positive), matrix(unlabelled)
    n_p, n_u = len(positive), len(unlabelled)
    weight, bias = np.zeros(len(keys)), float(np.log(prior / (1 - prior)))
    speed, turn = np.zeros(len(keys)), 0.0
    for _ in range(EPOCHS):
        z_p = np.bincount(p_row, weight[p_col], n_p) + bias
        z_u = np.bincount(u_row, weight[u_col], n_u) + bias
        s_p, s_u = 1 / (1 + np.exp(-z_p)), 1 / (1 + np.exp(-z_u))
        negative = np.logaddexp(0, z_u).mean() - prior * np.logaddexp(0, z_p).mean()
        up = prior * (s_p - 1) / n_p  # of pi R_P+
        down_p, down_u = -prior * s_p / n_p, s_u / n_u  # of R_U- - pi R_P-
        if negative < 0:
            up, down_p, down_u = 0 * up, -down_p, -down_u
        g_p, g_u = up + down_p, down_u
        slope = np.bincount(p_col, g_p[p_row], len(keys)) + np.bincount(u_col, g_u[u_row], len(keys)) + DECAY * weight
        # features differ in how often they occur, so each has its own step
        scale = np.maximum((in_p[best] / n_p * prior + in_u[best] / n_u), 1e-3)
        speed = 0.9 * speed - RATE * slope / scale
        turn = 0.9 * turn - RATE * (g_p.sum() + g_u.sum())
        weight, bias = weight + 0.1 * speed, bias + 0.1 * turn
    return keys, weight, bias


def fit(documents: DataFrame, labels: DataFrame) -> Model:
    """Classifiers learnt from labelled and unlabelled rows outside fold 0."""
    labels = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 0))
    count = labels.where(F.col("toxic").isNotNull()).agg(F.count("*").alias("n"), F.sum("toxic").alias("k")).first()
    if not count["n"] or not count["k"]:
        return []
    prior = min(max(count["k"] / count["n"], 1e-4), 0.9)
    mixing = F.xxhash64("doc_id", F.lit(7))
    confirmed = labels.where("toxic = 1").select("doc_id").distinct().orderBy(mixing, "doc_id").limit(POSITIVES)
    every = documents.select("doc_id").where(F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 0))
    drawn = every.distinct().orderBy(mixing, "doc_id").limit(UNLABELLED * CLASSIFIERS)
    drawn = drawn.withColumn("k", F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(CLASSIFIERS)).cast("int"))
    everyone = F.explode(F.sequence(F.lit(0), F.lit(CLASSIFIERS - 1))).alias("k")
    # at most POSITIVES * CLASSIFIERS + UNLABELLED * CLASSIFIERS rows of an id and two numbers
    chosen = confirmed.select("doc_id", everyone, F.lit(1).alias("kind")).unionByName(drawn.withColumn("kind", F.lit(0)))
    chosen = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "text").agg(
        F.collect_set(F.struct("k", "kind")).alias("uses")
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = pa.array(_distinct(batch.column("text")), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("uses"), sets], ["doc_id", "uses", "features"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    sets = chosen.mapInArrow(hashed, f"doc_id {kind}, uses array<struct<k:int,kind:int>>, features array<long>")
    sets = sets.select("doc_id", F.explode("uses").alias("use"), "features").select("doc_id", "use.k", "use.kind", "features")

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["kind", "doc_id"])
        keys, weight, bias = train(rows.features[rows.kind == 1].tolist(), rows.features[rows.kind == 0].tolist(), prior)
        return pd.DataFrame({"keys": [keys], "weights": [weight], "bias": [bias]})

    rows = sets.groupBy("k").applyInPandas(learn, "keys array<long>, weights array<double>, bias double").collect()
    return [(np.array(r["keys"], np.int64), np.array(r["weights"]), r["bias"]) for r in rows]


def scores(texts: pa.Array, model: Model) -> np.ndarray:
    n, out = len(texts), np.zeros(len(texts))
    row, feature = features(texts)
    feature = feature.view(np.int64)
    for keys, weight, bias in model:
        z = np.full(n, bias)
        if len(keys):
            at = np.minimum(np.searchsorted(keys, feature), len(keys) - 1)
            hit = keys[at] == feature
            pair = np.unique(row[hit] * len(keys) + at[hit])
            z += np.bincount(pair // len(keys), weight[pair % len(keys)], n)
        out += 1 / (1 + np.exp(-z)) / len(model)
    return out


def kept(documents: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """The rows of ``documents`` that score less than ``limit``, all columns as they are."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield batch.filter(pa.array(scores(batch.column("text"), model) < limit))

    return documents.mapInArrow(run, fields)


def score(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id and ``score`` (0 to 1) of every document."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = pa.array(scores(batch.column("text"), model))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), found], ["doc_id", "score"])

    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
