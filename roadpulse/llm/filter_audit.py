"""Filter interaction audit: what each filter removes, wherever it stands in the order of filters.

Whether a row fails a filter does not depend on the order, so the rows of a part are described by a contingency table
with one axis of length two for each filter: 0 passes, 1 fails. Everything the audit asks for is a contraction of that
tensor: along each axis a selector takes those that pass (1, 0), those that fail (0, 1) or all (1, 1). All orders and
steps are one ``einsum`` over a matrix of selectors.

The tensors are counted by one grouped aggregation, combined before it is shuffled; a part has 2 ** filters cells at
most, so a source with a third of all rows is no larger a group than any other. Texts are not shuffled: copies meet by
their SHA-256, with their ids only. Which row of a text is the first is found by joining on (digest, id), keys that no
two different rows share, so a text with a third of all rows is spread like any other.

A null text counts as empty, a null source as ''. A row without an id is never counted as a copy, makes none of others,
and has no labels. Rows that repeat the smallest id of a text are all first. Of several labels of one id the largest
count. An empty table has no parts and gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import stored

#: Fails: too short, too few different words, too many capitals, symbols, a copy of an earlier row.
NAMES = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 50, 65, 5


def failures(text: Column) -> dict[str, Column]:
    """The conditions that a text alone decides."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    capitals = F.octet_length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT * F.size(words),
        "C": 100 * capitals > MOST_CAPITALS * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def flagged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: part, a boolean for each filter, good and toxic."""
    text = docs.select(
        F.col("doc_id").alias("id"), F.coalesce("source", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text")
    )
    own = failures(F.col("text"))
    slim = text.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), *[c.alias(n) for n, c in own.items()])
    rows = stored(slim, "audit-flags")
    first = rows.where("id IS NOT NULL").groupBy(F.col("digest").alias("digest_of_first")).agg(F.min("id").alias("first"))
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("label_id")).agg(F.max("quality").alias("label_quality"), F.max("toxic").alias("label_toxic"))
    named = (
        rows.where("id IS NOT NULL")
        .join(first, (F.col("digest") == F.col("digest_of_first")) & (F.col("id") == F.col("first")), "left")
        .join(known, F.col("id") == F.col("label_id"), "left")
    )
    is_one = {"good": F.coalesce(F.col("label_quality") == 1, F.lit(False)), "toxic": F.coalesce(F.col("label_toxic") == 1, F.lit(False))}
    tail = named.select("part", *own, F.col("first").isNull().alias("E"), *[c.alias(n) for n, c in is_one.items()])
    never = F.lit(False)
    nameless = rows.where("id IS NULL").select("part", *own, never.alias("E"), never.alias("good"), never.alias("toxic"))
    return tail.unionByName(nameless)


def tensors(rows: DataFrame, names: Sequence[str], measures: Mapping[str, Column], part: str = "part") -> DataFrame:
    """The counted cells of each part: ``cell`` has the first filter as its highest bit, then a sum for each measure."""
    bit = [F.col(n).cast("int") * (1 << len(names) - 1 - i) for i, n in enumerate(names)]
    cell = reduce(Column.__add__, bit)
    return rows.groupBy(part, cell.alias("cell")).agg(*[F.sum(m).cast("long").alias(n) for n, m in measures.items()])


def selectors(n: int) -> tuple[list[tuple[int, ...]], dict[str, np.ndarray]]:
    """All orders of ``n`` axes, and for each step of each order the selector of every axis (steps x axes x 2)."""
    orders = list(permutations(range(n)))
    passes, fails, every = np.array([1, 0]), np.array([0, 1]), np.array([1, 1])
    shape = (len(orders) * n, n, 2)
    out = {k: np.empty(shape, np.int64) for k in ("kept", "removed", "failing", "unique")}
    for i, order in enumerate(orders):
        for step, axis in enumerate(order):
            at = i * n + step
            before = set(order[:step])
            for a in range(n):
                earlier = passes if a in before else every
                out["kept"][at, a] = passes if a in before or a == axis else every
                out["removed"][at, a] = fails if a == axis else earlier
                out["failing"][at, a] = fails if a == axis else every
                out["unique"][at, a] = fails if a == axis else passes
    return orders, out


def contracted(tensor: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Sums over the cells that each row of selectors picks; ``tensor`` has measures first, the result steps first."""
    n = chosen.shape[1]
    operands: list = [tensor, [n + 1, *range(n)]]
    for a in range(n):
        operands += [chosen[:, a, :], [n, a]]
    return np.einsum(*operands, [n, n + 1], optimize="greedy")


def audit(docs: DataFrame, labels: DataFrame, names: str = NAMES) -> DataFrame:
    """For every part, order of filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    rows = flagged(docs, labels)
    measures = {"n": F.lit(1), "good": F.col("good").cast("int"), "toxic": F.col("toxic").cast("int")}
    counted = tensors(rows, names, measures)
    n, summed = len(names), list(measures)

    def steps(found: pd.DataFrame) -> pd.DataFrame:
        flat = np.zeros((len(summed), 1 << n), np.int64)
        flat[:, found["cell"].to_numpy()] = found[summed].to_numpy().T
        tensor = flat.reshape(len(summed), *[2] * n)
        orders, chosen = selectors(n)
        removed = contracted(tensor, chosen["removed"])
        axis = np.array(orders).reshape(-1)
        shapley = np.zeros(n, np.int64)
        np.add.at(shapley, axis, removed[:, 0])
        return pd.DataFrame(
            {
                "part": found["part"].iat[0],
                "filter_order": np.repeat(["".join(names[a] for a in order) for order in orders], n),
                "step": np.tile(np.arange(1, n + 1, dtype=np.int32), len(orders)),
                "kept": contracted(tensor[:1], chosen["kept"])[:, 0],
                "removed": removed[:, 0],
                "redundant": contracted(tensor[:1], chosen["failing"])[:, 0] - removed[:, 0],
                "unique_fails": contracted(tensor[:1], chosen["unique"])[:, 0],
                "good_lost": removed[:, 1],
                "toxic_lost": removed[:, 2],
                "shapley": shapley[axis],
            }
        )

    kinds = "kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"
    return counted.groupBy("part").applyInPandas(steps, f"part string, filter_order string, step int, {kinds}")
