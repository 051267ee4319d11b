"""Hard negatives for contrastive training, by segment summary filtering.

A vector is cut into segments, and each segment is summed up by its mean and deviation. Over a segment of length L the
inner product of two vectors is L (m m' + c) with a covariance c between -d d' and d d', so the products of the means plus
or minus the products of the deviations bound the score. Two segments bound it roughly, four, eight and sixteen better:
a pair goes on to the next level only while its bounds still meet what the anchor is looking for, and to exact scoring
only after the last. What an anchor looks for narrows while rows pass: at least the score of its last positive or negative
so far, at most the upper end of its band. A level that lately let most pairs through is left out for a while; that costs
or saves time and never changes the result.

Rows are written once as blocks of ``BLOCK`` vectors with the summaries of their finest level. Anchors are dealt into
batches of about ``ANCHORS``, the only thing that is broadcast (``ANCHORS`` x vector length numbers, whatever the table
has). For each batch the blocks stream past it twice, for positives and then for the negatives of those: nothing but the
best few of each anchor and task is shuffled. Work is anchors x rows, as the anchors are a fixed share of the rows.

Scores are integers and exact: products are taken in single precision where norms show that it holds them (2 ** 24), else
in double precision; products of norms from 2 ** 53 on end the job. Ties go to the smaller id. Rows with a null id, label
or vector or a null component take no part; shorter vectors count as filled up with zeros. Rows that repeat an id are rows
of their own, but never each other's positives or negatives. Without anchors, positives or negatives the result is empty.
Other columns are dropped.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import shared_folder, stored

BLOCK, ANCHORS = 4096, 16384
#: Anchors scored at once against a block.
CHUNK = 512
#: Segments of the levels, coarse to fine; each divides the next.
LEVELS = (2, 4, 8, 16)
#: Above this share of pairs a level is worked out for all pairs at once, and is left out for a while if it lets more through.
DENSE, USELESS, RETRY = 0.0625, 0.7, 16


class Summaries:
    """Means and deviations of the segments of each row, times the root of the segment length: their squares add up to the norm."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray, levels: tuple[int, ...] = LEVELS):
        self.at = {levels[-1]: (mean, deviation)}
        for level in levels[-2::-1]:
            fine = mean.reshape(len(mean), level, -1)
            square = (fine**2 + deviation.reshape(fine.shape) ** 2).sum(2)
            mean = fine.sum(2) / np.sqrt(fine.shape[2])
            deviation = np.sqrt(np.maximum(square - mean**2, 0))
            self.at[level] = (mean, deviation)
        self.norm = float(np.sqrt((mean**2 + deviation**2).sum(1).max(initial=0)))

    @classmethod
    def measured(cls, x: np.ndarray, levels: tuple[int, ...] = LEVELS) -> Summaries:
        wide = np.zeros((len(x), levels[-1], -(-x.shape[1] // levels[-1])))
        wide.reshape(len(x), -1)[:, : x.shape[1]] = x
        root = np.sqrt(wide.shape[2])
        return cls(wide.mean(2) * root, wide.std(2) * root, levels)

    def take(self, rows) -> Summaries:
        out = object.__new__(Summaries)
        out.at, out.norm = {k: (m[rows], d[rows]) for k, (m, d) in self.at.items()}, self.norm
        return out


class Filter:
    """Pairs of anchors and rows whose score may lie in an interval, level by level, then exactly."""

    def __init__(self, levels: tuple[int, ...] = LEVELS):
        self.levels = levels
        self.passed = dict.fromkeys(levels, 0.0)
        self.turn = 0

    def pairs(self, a, a_sum: Summaries, r, r_sum: Summaries, low: np.ndarray, high: np.ndarray):
        """(anchor, row, score) of all pairs with low[anchor] <= score <= high[anchor]."""
        size = a_sum.norm * r_sum.norm
        if size >= 1 << 53:
            raise ValueError("inner products beyond 2 ** 53")
        # scores are integers, so a half covers the rounding of the bounds of all but huge ones
        slack = 0.5 + 1e-7 * size
        self.turn += 1
        total = len(a) * len(r)
        i = j = None  # all pairs
        for level in self.levels:
            if self.passed[level] > USELESS and self.turn % RETRY:
                continue
            (am, ad), (rm, rd) = a_sum.at[level], r_sum.at[level]
            before = total if i is None else len(i)
            if i is None:
                mean, spread = am @ rm.T, ad @ rd.T
                i, j = np.nonzero((mean + spread >= low[:, None] - slack) & (mean - spread <= high[:, None] + slack))
            else:
                mean, spread = np.einsum("ij,ij->i", am[i], rm[j]), np.einsum("ij,ij->i", ad[i], rd[j])
                on = (mean + spread >= low[i] - slack) & (mean - spread <= high[i] + slack)
                i, j = i[on], j[on]
            self.passed[level] = 0.5 * self.passed[level] + 0.5 * (len(i) / max(1, before))
            if not len(i):
                return i, j, np.empty(0, np.int64)
            if len(i) > DENSE * total:
                i = j = None
        if i is None:
            kind = np.float32 if size < 1 << 24 else np.float64  # either holds all sums on the way exactly
            scores = a.astype(kind) @ r.astype(kind).T
            i, j = np.nonzero((scores >= low[:, None]) & (scores <= high[:, None]))
            return i, j, scores[i, j].astype(np.int64)
        scores = np.empty(len(i), np.int64)
        for at in range(0, len(i), 1 << 16):
            to = at + (1 << 16)
            scores[at:to] = np.einsum("ij,ij->i", a[i[at:to]].astype(np.int64), r[j[at:to]].astype(np.int64))
        on = (scores >= low[i]) & (scores <= high[i])
        return i[on], j[on], scores[on]


class Best:
    """The ``k`` best (score, then smaller id) of each of ``n`` slots."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.slot, self.score, self.id = (np.empty(0, np.int64) for _ in range(3))
        #: score and id of the last of a full slot; before it is full, everything is better
        self.last, self.last_id = np.full(n, -np.inf), np.full(n, np.iinfo(np.int64).max)

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        better = (score > self.last[slot]) | (score == self.last[slot]) & (ids < self.last_id[slot])
        if not better.any():
            return
        slot = np.concatenate([self.slot, slot[better]])
        score = np.concatenate([self.score, score[better]])
        ids = np.concatenate([self.id, ids[better]])
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        begin = np.flatnonzero(np.diff(slot, prepend=-1))
        rank = np.arange(len(slot)) - np.repeat(begin, np.diff(begin, append=len(slot)))
        keep = rank < self.k
        self.slot, self.score, self.id = slot[keep], score[keep], ids[keep]
        full = rank == self.k - 1
        self.last[slot[full]], self.last_id[slot[full]] = score[full], ids[full]


class Batch:
    """Anchors in memory: sorted by label, with their summaries."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        order = np.lexsort((ids, labels))
        self.ids, self.labels, self.x = ids[order], labels[order], x[order]
        self.sums = Summaries.measured(self.x)
        self.chunk = CHUNK

    def chunks(self) -> Iterator[tuple[int, np.ndarray]]:
        """(label, anchors) with up to ``chunk`` anchors each."""
        begin = np.flatnonzero(np.diff(self.labels, prepend=self.labels[:1] - 1))
        for a, b in zip(begin, [*begin[1:], len(self.labels)]):
            for at in range(a, b, self.chunk):
                yield self.labels[a], np.arange(at, min(at + self.chunk, b))


_PACKED = "n int, bytes int, ids binary, labels binary, x binary, mean binary, deviation binary"


def packed(rows: DataFrame, width: int) -> DataFrame:
    """Blocks of about ``BLOCK`` rows (id, label, v), sorted by id, with the finest summaries; all as bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        n = 0
        for batch in batches:
            held.append(unpack(batch, width))
            n += batch.num_rows
            if n >= BLOCK:
                yield flush(held)
                held, n = [], 0
        if n:
            yield flush(held)

    def flush(held) -> pa.RecordBatch:
        ids, labels, x = (np.concatenate(part) for part in zip(*held))
        order = np.argsort(ids, kind="stable")
        ids, labels, x = ids[order], labels[order], x[order]
        mean, deviation = Summaries.measured(x).at[LEVELS[-1]]
        narrow = np.int32 if np.abs(x).max(initial=0) < 1 << 31 else np.int64
        data = {"ids": ids, "labels": labels, "x": x.astype(narrow), "mean": mean, "deviation": deviation}
        sizes = {"n": pa.array([len(ids)], pa.int32()), "bytes": pa.array([np.dtype(narrow).itemsize], pa.int32())}
        return pa.RecordBatch.from_pydict(sizes | {k: [v.tobytes()] for k, v in data.items()})

    return rows.select("id", "label", "v").mapInArrow(work, _PACKED)


def unpack(batch, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, labels and integer vectors of Arrow rows (id, label, v)."""
    lists = batch["v"].combine_chunks() if isinstance(batch["v"], pa.ChunkedArray) else batch["v"]
    size = np.asarray(lists.value_lengths())
    x = np.zeros((len(lists), width), np.int64)
    place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    x[np.repeat(np.arange(len(size)), size), place] = lists.flatten().to_numpy()
    return batch["id"].to_numpy(), batch["label"].to_numpy(), x


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, Summaries]]:
    """ids, labels, vectors and summaries of each block, sorted by (label, id)."""
    for batch in batches:
        for i in range(batch.num_rows):
            kinds = {"ids": "i8", "labels": "i8", "x": f"i{batch['bytes'][i].as_py()}", "mean": "f8", "deviation": "f8"}
            ids, labels, *wide = (np.frombuffer(batch[c][i].as_py(), kind) for c, kind in kinds.items())
            order = np.argsort(labels, kind="stable")
            x, mean, deviation = (w.reshape(len(ids), -1)[order] for w in wide)
            yield ids[order], labels[order], x, Summaries(mean, deviation)


def positives(rows: DataFrame, batch, k: int) -> DataFrame:
    """anchor (its place in the batch), id, score: the ``k`` best rows of the anchor's label that each task saw."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Batch = batch.value
        found, sieve = Best(len(held.ids), k), Filter()
        for ids, labels, x, sums in blocks(batches):
            for label, own in held.chunks():
                a, b = np.searchsorted(labels, label, "left"), np.searchsorted(labels, label, "right")
                if a == b:
                    continue
                i, j, score = sieve.pairs(held.x[own], held.sums.take(own), x[a:b], sums.take(slice(a, b)), found.last[own], np.full(len(own), np.inf))
                other = held.ids[own[i]] != ids[a + j]
                found.add(own[i[other]], score[other], ids[a + j[other]])
        yield pa.RecordBatch.from_pydict({"anchor": found.slot, "id": found.id, "score": found.score})

    return rows.mapInArrow(work, "anchor long, id long, score long")


def negatives(rows: DataFrame, batch, wanted, k: int) -> DataFrame:
    """slot, id, score: the ``k`` best rows of other labels inside the band of each slot that each task saw.

    ``wanted`` has, sorted by anchor, the anchor and the inclusive band of every slot.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Batch = batch.value
        anchor, low, high = wanted.value
        found, sieve = Best(len(anchor), k), Filter()
        first = np.searchsorted(anchor, np.arange(len(held.ids) + 1))
        for ids, labels, x, sums in blocks(batches):
            for label, every in held.chunks():
                own = every[first[every + 1] > first[every]]
                a, b = np.searchsorted(labels, label, "left"), np.searchsorted(labels, label, "right")
                others = np.concatenate([np.arange(a), np.arange(b, len(ids))])
                if not len(own) or not len(others):
                    continue
                begin, end = first[own[0]], first[own[-1] + 1]
                least = np.minimum.reduceat(np.maximum(low[begin:end], found.last[begin:end]), first[own] - begin)
                most = np.maximum.reduceat(high[begin:end], first[own] - begin)
                i, j, score = sieve.pairs(held.x[own], held.sums.take(own), x[others], sums.take(others), least, most)
                apart = held.ids[own[i]] != ids[others[j]]
                i, j, score = i[apart], j[apart], score[apart]
                n = (first[own + 1] - first[own])[i]
                slot = np.repeat(first[own][i], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                score, j = np.repeat(score, n), np.repeat(j, n)
                on = (score >= low[slot]) & (score <= high[slot])
                found.add(slot[on], score[on], ids[others[j[on]]])
        yield pa.RecordBatch.from_pydict({"slot": found.slot, "id": found.id, "score": found.score})

    return rows.mapInArrow(work, "slot long, id long, score long")


def _ranked(found: DataFrame, by: str, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    n_positives: int = 5,
    n_negatives: int = 3,
    band: tuple[int, int] = (50, 95),
    id_column: str = "vec_id",
    label_column: str = "label",
    vector_column: str = "embedding",
    anchors: int = ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Ids and labels are integers, vectors arrays of integers, ``is_anchor`` a condition on the id. ``band`` gives the
    least and the largest score of a negative in hundredths of the positive's.
    """
    spark = vectors.sparkSession
    given = vectors.select(
        F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("long").alias("label"),
        F.col(vector_column).cast("array<long>").alias("v"), is_anchor.alias("asks"),
    )
    whole = F.col("id").isNotNull() & F.col("label").isNotNull() & F.forall("v", lambda x: x.isNotNull())
    rows = stored(given.where(whole), "negatives-rows")
    size = rows.agg(F.max(F.size("v")).alias("width"), F.count_if("asks").alias("asking")).first()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not size["asking"]:
        return spark.createDataFrame([], schema)
    width = max(1, size["width"])
    data = stored(packed(rows, width), "negatives-blocks")
    n_batches = -(-size["asking"] // anchors)
    place = F.pmod(F.xxhash64("id", "label", "v"), F.lit(n_batches))
    asking = stored(rows.where("asks").select("id", "label", "v", place.alias("batch")).repartition("batch").sortWithinPartitions("batch"), "negatives-anchors")
    out = f"{shared_folder(spark)}/negatives-found-{uuid.uuid4().hex}"
    for number in range(n_batches):
        asked = asking.where(F.col("batch") == number).select("id", "label", "v").toArrow()
        if not asked.num_rows:
            continue
        held = Batch(*unpack(asked, width))
        batch = spark.sparkContext.broadcast(held)
        near = _ranked(positives(data, batch, n_positives), "anchor", n_positives).toArrow()
        anchor, ids, score = (near[c].to_numpy() for c in ("anchor", "id", "score"))
        order = np.lexsort((ids, -score, anchor))
        anchor, ids, score = anchor[order], ids[order], score[order]
        low, high = -(-band[0] * score // 100), band[1] * score // 100
        wanted = spark.sparkContext.broadcast((anchor, low, high))
        found = _ranked(negatives(data, batch, wanted, n_negatives), "slot", n_negatives)
        slots = pa.table({"slot": np.arange(len(anchor)), "anchor_id": held.ids[anchor], "positive_id": ids, "positive_score": score})
        named = found.join(F.broadcast(spark.createDataFrame(slots)), "slot")
        named = named.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        named.write.mode("append").parquet(out)
        batch.unpersist()
        wanted.unpersist()
    return spark.read.schema(schema).parquet(out)
