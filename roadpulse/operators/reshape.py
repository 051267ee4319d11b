"""Unions, joins of many frames, long/wide forms, ordering, key sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.operators.ranks import running_total


def union(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames by column name, missing columns null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct(df: DataFrame, subset: Sequence[str] | None = None, order: Sequence[str] = ()) -> DataFrame:
    """Distinct rows, or the first row per subset in a stated order (aggregate, combined map-side)."""
    if subset is None:
        return df.distinct()
    rest = [c for c in df.columns if c not in subset]
    ranked = [*order, *[c for c in rest if c not in order]]
    if not ranked:
        return df.select(*subset).distinct()
    return df.groupBy(*subset).agg(F.min(F.struct(*ranked)).alias("_row")).select(*subset, "_row.*")


def merge_all(frames: Sequence[DataFrame], keys: Sequence[str], how: str = "inner") -> DataFrame:
    return reduce(lambda a, b: a.join(b, list(keys), how), frames)


def full_join(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    return a.join(b, list(on), "full")


def align(frames: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Column-wise concatenation on a shared key."""
    return merge_all(frames, on, "full")


def to_long(df: DataFrame, columns: Sequence[str], ids: Sequence[str], variable: str = "measure", value: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(columns), variable, value)


def to_wide(df: DataFrame, ids: Sequence[str], key: str, value: str, names: Sequence[str], fn=F.avg) -> DataFrame:
    """One column per name; the names are stated, which saves a pass over the data."""
    return df.groupBy(*ids).pivot(key, list(names)).agg(fn(value))


def tag_measure(df: DataFrame, tci: Sequence[str], renames: Mapping[str, str] | None = None, measure: str = "measure") -> DataFrame:
    """``type`` TCI or TCP by measure name, then measures renamed."""
    out = df.withColumn("type", F.when(F.col(measure).isin(list(tci)), "TCI").otherwise("TCP"))
    return out.replace(dict(renames), subset=[measure]) if renames else out


def split_label(df: DataFrame, column: str, names: Sequence[str], sep: str = "_") -> DataFrame:
    """``shift_c3.0_w14`` into columns."""
    bits = F.split(F.col(column), sep)
    return df.withColumns({n: F.get(bits, F.lit(i)) for i, n in enumerate(names)})


def order_entities(df: DataFrame, entity: str, value: str, time: str, by: str = "mean") -> DataFrame:
    """Entities numbered by mean, median, max, min or last value."""
    stats = {
        "mean": F.avg(value), "median": F.percentile(value, 0.5), "max": F.max(value), "min": F.min(value),
        "last": F.max_by(value, time),
    }
    scores = df.where(F.col(value).isNotNull()).groupBy(entity).agg(stats[by].alias("score"))
    return running_total(scores, ["score", entity], name="position")


def key_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys only in a."""
    return a.select(key).subtract(b.select(key))


def key_intersection(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).intersect(b.select(key))


def upsert(current: DataFrame, changed: DataFrame, key: str, columns: Sequence[str], add_new: bool = False) -> DataFrame:
    """Non-null changed values replace current ones by key; optionally new keys are added."""
    new = changed.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    merged = current.join(new, key, "left").select(
        *[F.coalesce(f"_{c}", c).alias(c) if c in columns else F.col(c) for c in current.columns]
    )
    if not add_new:
        return merged
    fresh = changed.join(current.select(key), key, "left_anti")
    return merged.unionByName(fresh.select(*[c for c in current.columns if c in fresh.columns]), allowMissingColumns=True)


def compare_runs(runs: Mapping[str, DataFrame], keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Value columns of several runs side by side, suffixed by run name.

    One union and one aggregate, so the shuffle count does not grow with the runs.
    """
    tagged = union([df.select(*keys, *values, F.lit(name).alias("_run")) for name, df in runs.items()])
    cells = [
        F.max(F.when(F.col("_run") == name, F.col(v))).alias(f"{v}_{name}") for name in runs for v in values
    ]
    everywhere = F.countDistinct("_run") == len(runs)
    return tagged.groupBy(*keys).agg(everywhere.alias("_all"), *cells).where("_all").drop("_all")
