"""Positions, running totals and exact quantiles, of whole tables or inside groups, without a one-task window."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.session import cut


def running_total(
    df: DataFrame, order: Sequence[str], weight: Column | None = None, name: str = "running", by: Sequence[str] = ()
) -> DataFrame:
    """Running sum of ``weight`` (default 1; a struct is summed field by field) in a total order, of the table or of each group ``by``.

    Rows are range-partitioned by group and order and the placement written out, so that both uses of it agree. Each
    partition is summed on its own and shifted by what lies before it. A group that fills many partitions is in many
    tasks; of the groups in a partition only the first can have begun in an earlier one, so the shifts are one row per
    partition however many groups there are.
    """
    w = F.lit(1).cast("bigint") if weight is None else weight
    placed = cut(df.withColumn("_w", w).repartitionByRange(*by, *order).withColumn("_p", F.spark_partition_id()))
    kind = placed.schema["_w"].dataType
    fields = [f.name for f in kind] if isinstance(kind, T.StructType) else []
    parts = [F.col("_w")[f] for f in fields] or [F.col("_w")]

    def together(values: Sequence[Column]) -> Column:
        return F.struct(*[v.alias(f) for v, f in zip(values, fields)]) if fields else values[0]

    n = range(len(parts))
    totals = placed.groupBy(*by, "_p").agg(*[F.sum(w).alias(f"_t{k}") for k, w in enumerate(parts)])
    before = Window.partitionBy(*by).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select(
        F.col("_p").alias("_q"), *[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)],
        *[F.sum(f"_t{k}").over(before).alias(f"_s{k}") for k in n], F.count(F.lit(1)).over(before).alias("_parts"),
    )
    shifts = shifts.where("_parts > 0").drop("_parts")
    on = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate(by)], F.col("_p") == F.col("_q"))
    inner = Window.partitionBy("_p", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.join(F.broadcast(shifts), on, "left")
    running = [F.sum(w).over(inner) + F.coalesce(F.col(f"_s{k}"), F.lit(0)) for k, w in enumerate(parts)]
    return summed.withColumn(name, together(running)).select(*[c for c in df.columns if c != name], name)


def grouped_quantiles(df: DataFrame, by: Sequence[str], value: str, levels: Mapping[str, float]) -> DataFrame:
    """Exact quantiles (linear between neighbours) of a column in each group: the group and a column per level.

    Equal values are counted first, so a value in a third of all rows is one row; running counts inside the groups then
    locate the two neighbours of each level. No task holds more than a range of (group, value), and no buffer grows with
    a group. Groups without a value have null quantiles.
    """
    counts = df.groupBy(*by, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    run = running_total(counts.where("_v IS NOT NULL"), ["_v"], F.col("_n"), "_upto", by)
    held = run.groupBy(*by).agg(F.max("_upto").alias("_total"))
    sized = held.select("_total", *[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)])
    on = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate(by)])
    located = run.join(sized, on)
    cells = []
    for name, p in levels.items():
        rank = (F.col("_total") - 1) * F.lit(float(p))
        for side, at in (("a", F.floor(rank)), ("b", F.ceil(rank))):
            here = (at >= F.col("_upto") - F.col("_n")) & (at < F.col("_upto"))
            cells.append(F.max(F.when(here, F.col("_v"))).alias(f"{name}_{side}"))
        cells.append(F.max(rank - F.floor(rank)).alias(f"{name}_f"))
    found = located.groupBy(*by).agg(*cells)
    between = [(F.col(f"{q}_a") + (F.col(f"{q}_b") - F.col(f"{q}_a")) * F.col(f"{q}_f")).alias(q) for q in levels]
    empty = counts.groupBy(*by).agg(F.count("_v").alias("_values")).where("_values = 0")
    nulls = [F.lit(None).cast("double").alias(q) for q in levels]
    return found.select(*by, *between).unionByName(empty.select(*by, *nulls))
