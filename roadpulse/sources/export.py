"""Publication exports and stored history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.operators.dq import published
from roadpulse.sources.io import spread

# Columns dropped from every export and from the public one, per table.
OVERALL_DROP = {
    "daily": ("region_shapefile_wkt",),
    "weekly": ("region_shapefile_wkt",),
    "metadata": ("region_shapefile_binary", "area"),
}
PUBLIC_DROP = {
    "daily": ("observed", "expected_2020", "dashboard"),
    "weekly": ("observed", "expected_2020", "dashboard"),
    "metadata": (
        "daily_mean", "weekly_mean", "daily_std", "weekly_std", "daily_osm_ratio", "weekly_osm_ratio", "dashboard", "rerun",
        "feed_code", "partner_code", "country_name_eng", "n_days", "daily_mean_weekend", "daily_std_weekend",
        "daily_mean_weekday", "daily_std_weekday",
    ),
}
PRIVATE_DROP = {"weekly": ("max_year",)}


def hide_regions(df: DataFrame, hidden: Sequence[str], key: str = "region_slug") -> DataFrame:
    """Hidden regions keep their rows but lose the change and their publication flag."""
    test = F.col(key).isin(list(hidden))
    changes = {}
    if "tcp" in df.columns:
        changes["tcp"] = F.when(~test, F.col("tcp"))
    if "dashboard" in df.columns:
        changes["dashboard"] = F.when(test, F.lit("FALSE")).otherwise(F.col("dashboard").cast("string"))
    return df.withColumns(changes) if changes else df


def private_public(
    df: DataFrame, table: str, hidden: Sequence[str] = (), overall_drop: Sequence[str] | None = None,
    public_drop: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """All rows for internal use, and published rows without sensitive columns."""
    overall = OVERALL_DROP.get(table, ()) if overall_drop is None else overall_drop
    sensitive = PUBLIC_DROP.get(table, ()) if public_drop is None else public_drop
    shown = hide_regions(df, hidden).drop(*overall)
    return shown.drop(*PRIVATE_DROP.get(table, ())), published(shown).drop(*sensitive)


def write_private_public(df: DataFrame, path: str, table: str, hidden: Sequence[str] = (), **drops) -> None:
    """Two header CSV datasets: ``path/private/table`` and ``path/public/table``."""
    private, public = private_public(df, table, hidden, **drops)
    for name, out in (("private", private), ("public", public)):
        out.write.mode("overwrite").option("header", True).csv(f"{path}/{name}/{table}")


def per_day(df: DataFrame, path: str, sep: str = "|") -> None:
    """Delimited files per region and day."""
    by = ["region_slug", "year", "month", "day"]
    spread(df, by).write.mode("overwrite").partitionBy(*by).option("sep", sep).option("header", True).csv(path)


def sample(df: DataFrame, path: str, region: str | None = None, day: str | None = None, key: str = "region_slug", date: str = "datetime") -> None:
    """One region and day as a single CSV file (a small extract for inspection)."""
    rows = df
    if region is not None:
        rows = rows.where(F.col(key) == region)
    if day is not None:
        rows = rows.where(F.col(date) == day)
    rows.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def extend_history(stored: DataFrame, new: DataFrame, date: str = "date") -> DataFrame:
    """Stored rows, and new rows later than the last stored date."""
    last = stored.agg(F.max(date)).scalar()
    later = new.where(F.col(date) > F.coalesce(last, F.lit("0001-01-01").cast("date")))
    return stored.unionByName(later.select(*stored.columns))
