"""Region dimension: shapes, lengths of road, variation and approval."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions import geo, text
from roadpulse.operators import filters, reshape, simplify, spatial, stats, tci
from roadpulse.operators.spatial import Quad
from roadpulse.session import cut
from roadpulse.sources import calendars

# Road classes that count, and the zone rename.
ROAD_CLASSES = ("motorway", "trunk", "primary", "secondary", "tertiary", "unclassified", "residential")
ZONE_NAMES = {"America/Punta_Arenas": "America/Santiago"}
VARIATION_LIMIT = 0.5
LENGTH_RATIO = 0.1


def from_geojson(features: DataFrame, region_type: str, fields: Mapping[str, str] | None = None) -> DataFrame:
    """Region rows from GeoJSON features (``io.read_geojson``).

    ``fields`` maps our columns to feature properties.
    """
    names = {
        "region_name": "name", "country_iso": "iso_code", "country_name": "country", "population": "population",
        "timezone": "timezone", **(fields or {}),
    }
    columns = [F.try_element_at("properties", F.lit(v)).alias(k) for k, v in names.items()]
    rows = features.select(*columns, F.lit(region_type).alias("region_type"), "region_shapefile_wkt")
    return rows.withColumn("region_slug", text.slug(F.col("region_name"), region_type))


def import_shapes(
    shapes: DataFrame, population: DataFrame, constants: Mapping[str, str], prefix: str = "", max_chars: int = 200_000
) -> DataFrame:
    """Named shapes joined to a census on upper-cased accent-free names, with constant columns.

    ``shapes`` has region_name and region_shapefile_wkt, ``population`` has region_name and
    population; shapes whose text is longer than ``max_chars`` lose vertices until they fit, their neighbours the same ones.
    """

    def key(name: str) -> Column:
        return F.upper(text.strip_accents(F.trim(F.col(name))))

    census = population.select(key("region_name").alias("_key"), F.col("population").cast("string").alias("population"))
    # rows get a number of their own, since names may repeat
    rows = cut(shapes.withColumn("_row", F.monotonically_increasing_id()))
    fitted = simplify.shrink(rows, max_chars + 1, key="_row")
    named = rows.drop("region_shapefile_wkt").join(fitted, "_row").drop("_row").withColumn("_key", key("region_name"))
    out = named.join(census, "_key", "left").drop("_key")
    out = out.withColumns({name: F.lit(value) for name, value in constants.items()})
    return out.withColumn("region_slug", text.slug(F.col("region_name"), prefix or None))


def prepare(meta: DataFrame, zones: DataFrame, grid: Quad = Quad(), resolution: int = 8, wkt: str = "region_shapefile_wkt") -> DataFrame:
    """Add the timezone of the zone polygon holding the third vertex of each shape."""
    point = F.get(geo.polygon_points(geo.parse_polygon(F.col(wkt))), F.lit(2))
    placed = meta.select("region_slug", point["x"].alias("px"), point["y"].alias("py"))
    pairs = spatial.point_join(placed, zones, "px", "py", "zone", "zone_wkt", grid, resolution)
    zone = spatial.first_match(pairs, ["region_slug"], "zone").replace(ZONE_NAMES, subset=["zone"])
    return meta.drop("timezone").join(zone.withColumnRenamed("zone", "timezone"), "region_slug", "left")


def length_by_region(
    roads: DataFrame, regions: DataFrame, classes: Sequence[str] = ROAD_CLASSES, grid: Quad = Quad(), resolution: int = 12,
    row: Sequence[str] = ("road_id",),
) -> DataFrame:
    """Road length per region over accepted classes; a road counts in each region it meets."""
    accepted = roads.where(F.col("road_class").isin(list(classes)))
    pairs = spatial.join_polygons(accepted, regions, grid=grid, resolution=resolution).dropDuplicates([*row, "region_slug"])
    return pairs.groupBy("region_slug").agg(F.sum("length").alias("osm_length"))


def osm_length(meta: DataFrame, current: DataFrame, roads: DataFrame, selected: Sequence[str] | None = None, **options) -> DataFrame:
    """Lengths recomputed for new or changed shapes and for ``rerun='TRUE'``, kept for the rest."""
    wkt = "region_shapefile_wkt"
    chosen = meta.where(F.col("region_slug").isin(list(selected))) if selected else meta
    done = current.where(F.col("osm_length").isNotNull())
    fresh = filters.skip_done(chosen, done).select("region_slug", wkt)
    forced = meta.where(F.col("rerun") == "TRUE").select("region_slug", wkt)
    todo = fresh.unionByName(forced).distinct()
    lengths = todo.join(length_by_region(roads, todo, **options), "region_slug", "left").fillna(0.0, ["osm_length"])
    return reshape.upsert(
        current.select("region_slug", wkt, "osm_length"), lengths, "region_slug", [wkt, "osm_length"], add_new=True
    )


def ready(prepared: DataFrame, lengths: DataFrame, codes: DataFrame) -> DataFrame:
    """Dimension with road length and country codes (inner joins)."""
    meta = prepared.join(lengths.select("region_slug", "osm_length"), "region_slug")
    names = codes.select("iso2_code", "partner_code", "feed_code", "country_name_eng")
    return meta.join(names, names["iso2_code"] == meta["country_iso"]).drop("iso2_code")


def with_variation(
    variation_stats: DataFrame, meta: DataFrame, variation: float = VARIATION_LIMIT, ratio: float = LENGTH_RATIO
) -> DataFrame:
    """All regions with their statistics, ratios to road length, and the two approvals."""
    joined = meta.join(variation_stats, "region_slug", "left")
    length = F.col("osm_length").cast("double")

    def per_length(column: Column) -> Column:
        return F.try_divide(column, length)

    daily = per_length(F.col("daily_mean"))
    weekly = per_length(F.col("weekly_mean") / 7)

    def passes(cv: str, value: Column) -> Column:
        return F.coalesce((F.col(cv) <= variation) & (value >= ratio), F.lit(False))

    return joined.withColumns(
        {
            "daily_osm_ratio": daily,
            "weekend_osm_ratio": per_length(F.col("daily_mean_weekend")),
            "weekday_osm_ratio": per_length(F.col("daily_mean_weekday")),
            "weekly_osm_ratio": weekly,
            "daily_approved": passes("daily_coef_var", daily),
            "weekly_approved": passes("weekly_coef_var", weekly),
        }
    )


def variation(
    analysis: DataFrame, meta: DataFrame, limit: float = VARIATION_LIMIT, ratio: float = LENGTH_RATIO, compat: bool = False,
    wkt: str = "region_shapefile_wkt",
) -> DataFrame:
    """Metadata with area, daily and weekly variation and approvals."""
    both = stats.daily_variation(analysis, compat=compat).join(stats.weekly_variation(analysis), "region_slug")
    shaped = meta.withColumn("area", geo.area(geo.parse_polygon(F.col(wkt))))
    return with_variation(both, shaped, limit, ratio)


def analysis_daily(
    jams: DataFrame,
    regions: DataFrame,
    calendar: DataFrame,
    first: str | dt.date,
    last: str | dt.date,
    sampled: Mapping[str, Sequence[str]] | None = None,
    minutes: int = 5,
    grid: Quad = Quad(),
    resolution: int = 12,
    wide: Sequence[str] = (),
    ts: str = "ts",
) -> DataFrame:
    """Deduplicated daily length of every region over a year, padded from a calendar.

    ``regions`` has region_slug, feed_code and region_shapefile_wkt. Jams are matched by country
    code and shape; regions named in ``wide`` take all jams without either test. ``sampled`` maps
    a region to its own list of ``YYYYMMDD`` days, which replace the year.
    """
    sampled = dict(sampled or {})
    good = filters.quality(jams)
    local = regions.where(~F.col("region_slug").isin(list(wide))) if wide else regions
    pairs = spatial.join_polygons(good, local, grid=grid, resolution=resolution)
    codes = local.select("region_slug", F.col("feed_code").alias("_code"))
    pairs = pairs.join(codes, "region_slug").where(F.col("country") == F.col("_code")).drop("_code")

    def asked(date: Column) -> Column:
        """Days that count for the region of the row."""
        keep = ~F.col("region_slug").isin(list(sampled)) & date.between(F.lit(first).cast("date"), F.lit(last).cast("date"))
        for slug, days in sampled.items():
            keep = keep | ((F.col("region_slug") == slug) & F.date_format(date, "yyyyMMdd").isin(list(days)))
        return keep

    daily = tci.analysis_daily(tci.dedup_slot(pairs.where(asked(F.to_date(ts))), ts=ts, minutes=minutes), ts)
    if wide:
        # slots lie inside days, so the whole feed is deduplicated and summed once and its days are given to every wide region
        whole = tci.analysis_daily(tci.dedup_slot(good, ts=ts, minutes=minutes, within=()), ts, within=())
        given = whole.select(F.explode(F.array(*[F.lit(s) for s in wide])).alias("region_slug"), "*")
        daily = daily.unionByName(given.where(asked(F.make_date("year", "month", "day"))))
    return calendars.pad_calendar(daily, calendar, sampled=list(sampled))


def reliability(
    daily_cv: DataFrame, weekly_cv: DataFrame, cells: DataFrame, daily_limit: float = 0.6, weekly_limit: float = 0.5, ratio: float = 0.1
) -> DataFrame:
    """Cells with variation and road length: ``osm_index`` and the two reliability flags."""
    joined = cells.join(daily_cv, "grid_id", "left").join(weekly_cv, "grid_id", "left")
    index = F.try_divide(F.col("daily_mean"), F.col("osm_length").cast("double"))
    out = joined.withColumn("osm_index", index)

    def reliable(cv: str, limit: float) -> Column:
        return F.coalesce((F.col(cv) < limit) & (F.col("osm_index") > ratio), F.lit(False))

    return out.withColumn("daily_reliable", reliable("daily_coef_var", daily_limit)).withColumn(
        "weekly_reliable", reliable("weekly_coef_var", weekly_limit)
    )
