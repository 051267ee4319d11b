"""Comparison with external mobility series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadpulse.functions.timefn import iso_dow

DRIVEN_COLUMNS = {
    "country": "date string, country string, pc_driven_miles double",
    "city": "date string, city string, country string, pc_driven_miles double",
}
REPORT_SCHEMA = (
    "country_region_code string, country_region string, sub_region_1 string, sub_region_2 string, metro_area string, "
    "date date, transit_stations_percent_change_from_baseline double, workplaces_percent_change_from_baseline double"
)


def read_driven_km(spark: SparkSession, path: str, level: str = "country", countries: Sequence[str] = ()) -> DataFrame:
    """Driven-distance CSV: month-name dates, fractions turned into a level around 100."""
    raw = spark.read.option("header", True).option("enforceSchema", True).schema(DRIVEN_COLUMNS[level]).csv(path)
    kept = raw.where(F.col("country").isin(list(countries))) if countries else raw
    return kept.withColumn("date", F.to_date("date", "MMM d, yyyy")).withColumn(
        "pc_driven_miles", 100 * (F.col("pc_driven_miles") + 1)
    )


def read_report(spark: SparkSession, path: str, level: str = "country", codes: Sequence[str] = ()) -> DataFrame:
    """Regional mobility report CSV; country rows have no sub-region, city rows have one."""
    raw = spark.read.option("header", True).schema(REPORT_SCHEMA).csv(path)
    if codes:
        raw = raw.where(F.col("country_region_code").isin(list(codes)))
    if level == "country":
        rows = raw.where(F.col("sub_region_1").isNull() & F.col("metro_area").isNull())
    else:
        rows = raw.where(F.col("sub_region_1").isNotNull()).fillna("None", ["sub_region_2", "metro_area"])
    return rows.withColumns(
        {
            "transit": F.col("transit_stations_percent_change_from_baseline") + 100,
            "workplace": F.col("workplaces_percent_change_from_baseline") + 100,
        }
    ).drop("transit_stations_percent_change_from_baseline", "workplaces_percent_change_from_baseline")


def rebase(df: DataFrame, keys: Sequence[str], values: Sequence[str], window: tuple[str, str], date: str = "date") -> DataFrame:
    """Percent change of a level against the same day of week in the base week."""
    dated = df.withColumn("dow", iso_dow(F.col(date)))
    inside = F.col(date).between(*[F.lit(d).cast("date") for d in window])
    base = dated.where(inside).select(*keys, "dow", *[F.col(v).alias(f"{v}_baseline") for v in values])
    joined = dated.join(base, [*keys, "dow"])
    changes = {v: 100 * F.try_divide(F.col(v) - F.col(f"{v}_baseline"), F.col(f"{v}_baseline")) for v in values}
    return joined.withColumns(changes).drop(*[f"{v}_baseline" for v in values])


def rescale(df: DataFrame, window: tuple[str, str], keys: Sequence[str] = ("region_slug", "measure"), date: str = "date") -> DataFrame:
    """Value in percent of minus the window mean, per region and measure."""
    inside = F.col(date).between(*[F.lit(d).cast("date") for d in window])
    # a series has one row a day; a window reads the input once, and the moving mean after it keeps its exchange
    mean = F.avg(F.when(inside, F.col("value"))).over(Window.partitionBy(*keys))
    return df.withColumn("mean_val", mean).withColumn(
        "value_rescaled", F.try_divide(-100 * F.col("value"), F.col("mean_val"))
    )


def smooth(df: DataFrame, n: int = 7, keys: Sequence[str] = ("region_slug", "measure"), date: str = "date", value: str = "value_rescaled") -> DataFrame:
    """Trailing mean of n rows with a full window."""
    frame = Window.partitionBy(*keys).orderBy(date).rowsBetween(-(n - 1), 0)
    return df.withColumn(f"{value}_ma", F.when(F.count(value).over(frame) == n, F.avg(value).over(frame)))


def missing_share(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Share of missing values and number of regions with data, per provider column."""
    cells = [
        F.struct(
            F.lit(m).alias("measure"),
            F.avg(F.col(m).isNull().cast("double")).alias("missing"),
            F.countDistinct(F.when(F.col(m).isNotNull(), F.col("region_slug"))).alias("regions"),
        )
        for m in measures
    ]
    return df.agg(F.array(*cells).alias("_rows")).select(F.inline("_rows"))


def combine_country(dash: DataFrame, driven: DataFrame, report: DataFrame) -> DataFrame:
    """Index, driven distance (by country name) and mobility report (by ISO code) per date."""
    d = driven.select(F.col("country").alias("country_name"), "date", "pc_driven_miles")
    g = report.select(F.col("country_region_code").alias("country_iso_code"), "date", "transit", "workplace")
    return (
        dash.select("region_slug", "country_name", "country_iso_code", "date", "tcp")
        .join(d, ["country_name", "date"], "left")
        .join(g, ["country_iso_code", "date"], "left")
    )


def combine_city(dash: DataFrame, driven: DataFrame, report: DataFrame, names: DataFrame) -> DataFrame:
    """As above per city; ``names`` maps the region names of the three providers."""

    def tagged(df: DataFrame, tag: str, keep: Sequence[str]) -> DataFrame:
        return df.select(*[F.col(c).alias(f"{c}__{tag}") for c in keep])

    left = tagged(dash, "dash", ["region_slug", "country_name", "country_iso_code", "date", "tcp"])
    second = tagged(driven, "km", ["country", "city", "date", "pc_driven_miles"])
    places = ["country_region_code", "country_region", "sub_region_1", "sub_region_2"]
    third = tagged(report, "mob", [*places, "date", "transit", "workplace"])
    joined = left.join(names, "region_slug__dash")
    joined = joined.join(second.withColumnRenamed("date__km", "date__dash"), ["country__km", "city__km", "date__dash"], "left")
    joined = joined.join(
        third.withColumnRenamed("date__mob", "date__dash"), [*[f"{p}__mob" for p in places], "date__dash"], "left"
    )
    return joined.select(
        "country_iso_code__dash", "country_name__dash", "region_slug__dash", "date__dash", "tcp__dash",
        "pc_driven_miles__km", "transit__mob", "workplace__mob",
    )


def rename_measures(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.replace(dict(names), subset=["measure"])
