"""Checks on products: presence, counts, duplicates, publication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def missing_regions(meta: DataFrame, product: DataFrame, key: str = "region_slug") -> DataFrame:
    """Regions of the dimension without a row in the product."""
    return meta.select(key).distinct().join(product.select(key).distinct(), key, "left_anti")


def all_regions_present(meta: DataFrame, products: Mapping[str, DataFrame], key: str = "region_slug") -> DataFrame:
    """(product, region) pairs that are missing, over several products."""
    parts = [missing_regions(meta, p, key).select(F.lit(n).alias("product"), key) for n, p in products.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def peek(df: DataFrame, n: int = 10) -> DataFrame:
    return df.limit(n)


def tables_exist(spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet", n: int = 10) -> DataFrame:
    """Whether each product can be read, and how many of its first n rows came back: one union of aggregates."""

    def probe(name: str, path: str) -> DataFrame:
        try:
            first, readable = spark.read.format(fmt).load(path).select(F.lit(1).alias("_one")).limit(n), True
        except AnalysisException:
            first, readable = spark.range(0).select(F.lit(1).alias("_one")), False
        return first.agg(F.count("_one").cast("int").alias("n_rows")).select(F.lit(name).alias("product"), F.lit(readable).alias("readable"), "n_rows")

    return reduce(DataFrame.unionByName, [probe(name, path) for name, path in paths.items()])


def exact_duplicates(jams: DataFrame, date: str, ignore: Sequence[str] = ()) -> DataFrame:
    """Rows per day beyond the first of each group of equal rows."""
    payload = [c for c in jams.columns if c not in ignore]
    groups = jams.groupBy(*payload).agg(F.count(F.lit(1)).alias("_n"))
    return groups.groupBy(date).agg(
        F.sum("_n").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"), F.sum(F.col("_n") - 1).alias("n_duplicates")
    )


def count_histogram(df: DataFrame, date: str = "date", key: str = "region_slug") -> DataFrame:
    """Regions per date, then dates per number of regions."""
    per_date = df.groupBy(date).agg(F.countDistinct(key).alias("regions"))
    return per_date.groupBy("regions").agg(F.count(F.lit(1)).alias("n"))


def rows_histogram(df: DataFrame, key: str = "region_slug") -> DataFrame:
    """Rows per region, then regions per row count."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_count")).groupBy("n_count").agg(F.count(F.lit(1)).alias("n"))


def coverage(df: DataFrame, key: str = "region_slug", date: str = "date", value: str = "tcp") -> DataFrame:
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_obs"), F.min(date).alias("min_date"), F.max(date).alias("max_date"),
        F.countDistinct(date).alias("n_dates"), F.min(value).alias("min_value"), F.avg(value).alias("mean_value"),
        F.max(value).alias("max_value"),
    )


def published(df: DataFrame, flag: str = "dashboard") -> DataFrame:
    return df.where(F.upper(F.col(flag).cast("string")) == "TRUE")


def extreme_regions(df: DataFrame, limit: float = 200, value: str = "tcp", key: str = "region_slug") -> DataFrame:
    """Published regions with a change above the limit."""
    return published(df).where(F.col(value) > limit).select(key).distinct()


def sync_publication(weekly: DataFrame, daily: DataFrame, key: str = "region_slug", flag: str = "dashboard") -> DataFrame:
    """Weekly rows stay published only for regions published daily."""
    shown = published(daily, flag).select(key).distinct().withColumn("_shown", F.lit(True))
    joined = weekly.join(shown, key, "left")
    return joined.withColumn(flag, F.when(F.col("_shown"), F.col(flag)).otherwise("FALSE")).drop("_shown")


def published_counts(df: DataFrame, key: str = "region_slug", flag: str = "dashboard") -> DataFrame:
    return df.groupBy(flag).agg(F.countDistinct(key).alias("n_regions"))


def duplicate_days(df: DataFrame, keys: Sequence[str] = ("region_slug", "date")) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def overlapping_slices(manifest: DataFrame, key: str = "region_slug", slug: str = "date_slug") -> DataFrame:
    """Date slices that cover days of a coarser slice of the same region, i.e. those to remove.

    Slices are months (``year2020month03``), Monday weeks (``year2020week35``) or days
    (``year2020month03day09``). Each is expanded to its days; on a day covered more than once the
    coarsest slice stays.
    """
    pattern = r"year(\d{4})(?:month(\d{2}))?(?:week(\d{2}))?(?:day(\d{2}))?"
    part = {n: F.nullif(F.regexp_extract(F.col(slug), pattern, i), F.lit("")).cast("int") for i, n in enumerate(["y", "m", "w", "d"], 1)}
    year_start = F.make_date(part["y"], F.lit(1), F.lit(1))
    first_monday = F.date_add(year_start, F.pmod(F.lit(7) - F.weekday(year_start), F.lit(7)).cast("int"))
    month_start = F.make_date(part["y"], part["m"], F.lit(1))
    week_start = F.date_add(first_monday, ((part["w"] - 1) * 7).cast("int"))
    week_end = F.date_add(week_start, 6)
    day = F.date_add(month_start, (F.coalesce(part["d"], F.lit(1)) - 1).cast("int"))
    first = F.when(part["w"].isNotNull(), F.greatest(week_start, year_start)).when(part["d"].isNotNull(), day).otherwise(month_start)
    last = (
        F.when(part["w"].isNotNull(), F.least(week_end, F.make_date(part["y"], F.lit(12), F.lit(31))))
        .when(part["d"].isNotNull(), day)
        .otherwise(F.last_day(month_start))
    )
    grain = F.when(part["w"].isNotNull(), 2).when(part["d"].isNotNull(), 3).otherwise(1)
    days = manifest.select(key, slug, grain.alias("_grain"), first.alias("_first"), last.alias("_last")).select(
        key, slug, "_grain", F.explode(F.sequence("_first", "_last")).alias("_day")
    )
    best = days.groupBy(key, "_day").agg(F.min("_grain").alias("_best"), F.count(F.lit(1)).alias("_n"))
    clash = best.where("_n > 1").select(key, "_day", "_best")
    return days.join(clash, [key, "_day"]).where("_grain > _best").select(key, slug).distinct()
