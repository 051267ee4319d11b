"""Approximate nearest neighbours by a hash-prefix forest, for the largest inner product.

Vectors are unit length or nearly so for hashing: a tree gives every vector a string of ``BITS`` signs of random
projections. A tree is the sorted array of its strings. A query descends each tree to its longest common prefix, then
all trees ascend together, one bit at a time, until the entries that share the prefix length in any tree are
``share`` of the block at least; these candidates are scored exactly, in double precision, on the original vectors.

Rows are dealt into blocks of about ``BLOCK`` vectors and each block is a forest of its own; the stated queries are dealt
into blocks too and meet every block of rows once. The best ``k`` of each meeting are merged to the best ``k`` of all.
A block's arrays are built where they are used, so a task holds one block and one batch of queries, nothing else.

``share`` sets recall against work. Without structure in the vectors (uniform directions) neighbours are hardly nearer
than others and a large share is needed; for clustered embeddings a few hundredths are enough.

Vectors that are null, zero, of another length than the most frequent one, or hold null or non-finite components take
no part. Equal vectors have equal strings and scores; ties go to the smaller id. Repeated ids are entries of their own.
An empty table, or one without queries, gives an empty result. Other columns are dropped.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import stored

TREES, BITS = 64, 32
BLOCK, QUERY_BLOCK = 16384, 2048
SHARE = 0.55


def valid(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``id`` and ``v`` (array of double) of the vectors that take part."""
    rows = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).cast("array<double>").alias("v"))
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)
    return rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & good)


class Forest:
    """Sorted arrays of the hash strings of one block."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES, seed: int = 5):
        self.vectors = vectors
        self.planes = np.random.default_rng(seed).normal(size=(vectors.shape[1], trees * BITS))
        strings = self.strings(vectors)
        self.order = np.argsort(strings, axis=0, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, 0)

    def strings(self, vectors: np.ndarray) -> np.ndarray:
        signs = (vectors @ self.planes > 0).reshape(len(vectors), -1, BITS)
        return signs @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))

    def candidates(self, queries: np.ndarray, least: int):
        """For each query, the entries reached when all trees have ascended until at least ``least`` are found."""
        strings = self.strings(queries)
        trees = strings.shape[1]
        shape = (BITS + 1, trees, len(queries))
        low, high = np.zeros(shape, np.int32), np.zeros(shape, np.int32)
        for t in range(trees):
            column = self.sorted[:, t]
            for length in range(BITS + 1):
                rest = BITS - length
                begin = (strings[:, t] >> rest) << rest
                low[length, t] = np.searchsorted(column, begin, "left")
                high[length, t] = np.searchsorted(column, begin + (1 << rest), "left")
        reached = (high - low).sum(1)  # entries by prefix length and query, an entry once for each tree
        n = len(self.vectors)
        for q in range(len(queries)):
            length = int(np.flatnonzero(reached[:, q] >= least)[-1]) if (reached[:, q] >= least).any() else 0
            seen = np.zeros(n, bool)
            while True:
                for t in range(trees):
                    seen[self.order[low[length, t, q] : high[length, t, q], t]] = True
                if length == 0 or np.count_nonzero(seen) >= least:
                    break
                length -= 1
            yield np.flatnonzero(seen)


def search(
    vectors: DataFrame,
    is_query: Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = 20,
    share: float = SHARE,
    trees: int = TREES,
) -> DataFrame:
    """query_id, ``rank`` (from 1), the neighbour's id and ``score`` for the rows for which ``is_query`` holds.

    ``is_query`` is a condition on the id column.
    """
    kind = vectors.schema[id_column].dataType.simpleString()
    rows = stored(valid(vectors, id_column, vector_column), "ann-vectors")
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    width = length["n"] if length else 1
    rows = rows.where(F.size("v") == width).withColumn("row", F.monotonically_increasing_id())
    blocks = -(-(length["count"] if length else 0) // BLOCK) or 1
    queries = rows.withColumnRenamed("id", id_column).where(is_query).withColumnRenamed(id_column, "id")
    batches = -(-queries.count() // QUERY_BLOCK) or 1

    def everywhere(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    block, batch = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"), F.pmod(F.xxhash64("row", F.lit(1)), F.lit(batches)).cast("int")
    left = rows.select("id", "v", "row", block.alias("block"), everywhere(batches).alias("batch"))
    # names and expressions of their own: both sides come from one table
    right = queries.select(
        F.col("id").alias("q_id"), F.col("v").alias("q_v"), F.col("row").alias("q_row"), everywhere(blocks).alias("q_block"), batch.alias("q_batch")
    )

    def meet(entries: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(entries) and len(asked):
            entries = entries.sort_values(["id", "row"], ignore_index=True)
            x, q = np.stack(entries["v"].to_numpy()), np.stack(asked["q_v"].to_numpy())
            ids, row = entries["id"].to_numpy(), entries["row"].to_numpy()
            forest = Forest(x, trees)
            for i, found in enumerate(forest.candidates(q, min(len(x), max(k + 1, int(np.ceil(share * len(x))))))):
                found = found[row[found] != asked["q_row"].iat[i]]
                score = (x[found] * q[i]).sum(1)
                best = np.lexsort((ids[found], -score))[:k]
                out.append(pd.DataFrame({"asked": asked["q_row"].iat[i], "query_id": asked["q_id"].iat[i], "id": ids[found][best], "score": score[best]}))
        return pd.concat(out) if out else pd.DataFrame({"asked": [], "query_id": [], "id": [], "score": []})

    met = left.groupBy("block", "batch").cogroup(right.groupBy("q_block", "q_batch"))
    found = met.applyInPandas(meet, f"asked long, query_id {kind}, id {kind}, score double")
    rank = F.row_number().over(Window.partitionBy("asked").orderBy(F.desc("score"), "id"))
    found = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_column), "score")
