"""Cells of a region and the allocation of congestion among them by length of overlap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions import geo
from roadpulse.operators import ranks
from roadpulse.operators.spatial import Quad, cell_id, centre_cells, edge_cells, line_cells, parent_id, polygon_index
from roadpulse.session import broadcast_if_small

TIME = ("year", "month", "day", "hour", "dow")
MAX_CELLS = 1_000_000
CITY_RESOLUTION = 10  # fixed value: the level recorded for whole-city cells


def batch(df: DataFrame, size: int = 100, by: Sequence[str] = ("region_slug",), major: str = "ix", minor: str = "iy", name: str = "group") -> DataFrame:
    """0-based batches of ``size`` rows per group in (major, minor) order.

    A region with most of the rows is numbered in many tasks (``ranks.running_total``), whatever its majors.
    """
    placed = ranks.running_total(df, [major, minor], name="_place", by=by)
    return placed.withColumn(name, F.floor((F.col("_place") - 1) / F.lit(size)).cast("int")).drop("_place")


def _cells(shapes: DataFrame, grid: Quad, resolution: int, keys: Sequence[str]) -> DataFrame:
    """Centre-in-polygon cells of ``parts``; the cell of the first vertex where there is none."""
    edged = shapes.withColumn("edges", geo.polygon_edges(F.col("parts")))
    found = centre_cells(edged, grid, resolution, keys, "edges")
    first = F.get(geo.polygon_points(F.col("parts")), F.lit(0))
    lone = shapes.join(found.select(*keys).distinct(), list(keys), "left_anti").select(
        *keys, grid.ix(first["x"], resolution).alias("ix"), grid.iy(first["y"], resolution).alias("iy")
    )
    return found.unionByName(lone)


def _cell_wkt(grid: Quad, resolution: int) -> Column:
    return geo.polygon_to_wkt(geo.box_polygon(*grid.box(F.col("ix"), F.col("iy"), resolution)))


def cover(
    regions: DataFrame, resolution: int, parent_resolution: int, grid: Quad = Quad(), factor: float = 1.1,
    key: str = "region_slug", wkt: str = "region_shapefile_wkt", largest: bool = False, size: int = 100,
) -> DataFrame:
    """Cells of each region (scaled by ``factor``): id, resolution, wkt, id_parent, group."""
    parts = geo.parse_polygon(F.col(wkt))
    parts = geo.largest_part(parts) if largest else parts
    shapes = regions.select(key, geo.scale(parts, factor).alias("parts"))
    cells = batch(_cells(shapes, grid, resolution, [key]), size, [key])
    up = resolution - parent_resolution
    return cells.select(
        key,
        cell_id(resolution, F.col("ix"), F.col("iy")).alias("id"),
        F.lit(resolution).alias("resolution"),
        _cell_wkt(grid, resolution).alias("wkt"),
        cell_id(parent_resolution, F.shiftright("ix", up), F.shiftright("iy", up)).alias("id_parent"),
        "group",
    )


def region_resolutions(regions: DataFrame, coarse: int = 7, fine: int = 8, **options) -> DataFrame:
    """Fine cells with their coarse parent, and coarse cells as their own parent."""
    return cover(regions, fine, coarse, **options).unionByName(cover(regions, coarse, coarse, **options))


def city_cells(
    cities: DataFrame, countries: DataFrame, coarse: int = 3, grid: Quad = Quad(), key: str = "region_slug",
    city: str = "region_name", wkt: str = "region_shapefile_wkt",
) -> DataFrame:
    """Whole cities (convex hulls) under the coarse cells they hold, and the country's coarse cells."""
    hull = geo.convex_hull(geo.polygon_points(geo.parse_polygon(F.col(wkt))))
    shapes = cities.select(key, F.col(city).alias("id"), hull.alias("parts"))
    under = _cells(shapes, grid, coarse, [key, "id"]).join(
        shapes.select(key, "id", geo.polygon_to_wkt(F.col("parts")).alias("wkt")), [key, "id"]
    )
    rows = batch(under.withColumn("_place_key", F.concat_ws("|", F.col("ix").cast("string"), F.col("iy").cast("string"))), 100, [key], "id", "_place_key")
    cities_part = rows.select(
        key, "id", F.lit(CITY_RESOLUTION).alias("resolution"), "wkt",
        cell_id(coarse, F.col("ix"), F.col("iy")).alias("id_parent"), "group",
    )
    return cities_part.unionByName(
        cover(countries, coarse, coarse, grid, key=key, wkt=wkt, largest=True)
    )


def shares(rows: DataFrame, grid: Quad, resolution: int, line: str = "line") -> DataFrame:
    """line, ix, iy, ``share``: what part of each distinct line lies in each cell it runs through; parts add up to 1.

    The one table that every allocation of the same lines is made of: a report, an hour or a day of a line needs no
    geometry any more. A line of no length has all of itself in the cell that holds it.
    """
    pieces = edge_cells(_pieces(rows.select(line).distinct()), "_e", grid, resolution)
    part = F.col("_due") * geo.box_share(F.col("_e"), *grid.box(F.col("ix"), F.col("iy"), resolution))
    return pieces.withColumn("_part", part).where("_part > 0").groupBy(line, "ix", "iy").agg(F.sum("_part").alias("share"))


def assign_coarse(
    segments: DataFrame, cells: DataFrame, grid: Quad, resolution: int, line: str = "line", key: str = "region_slug",
    parts: DataFrame | None = None, finer: int = 0,
) -> DataFrame:
    """Segments paired with the coarse cells of their region they run through.

    The cells of a distinct line come from arithmetic, or from ``parts``, its ``shares`` in cells ``finer`` levels down;
    they join segments by line, an exchange in which Spark splits hot lines. A segment crossing k cells gives k rows.
    """
    if parts is None:
        found = segments.select(line).distinct().withColumn("_c", F.explode(line_cells(geo.parse_line(F.col(line)), grid, resolution)))
        ids = found.select(line, cell_id(resolution, F.col("_c")["ix"], F.col("_c")["iy"]).alias("id_parent"))
    else:
        ids = parts.select(line, cell_id(resolution, F.shiftright("ix", finer), F.shiftright("iy", finer)).alias("id_parent")).distinct()
    known = cells.where(F.col("resolution") == resolution).select(key, F.col("id").alias("id_parent")).distinct()
    return segments.join(ids, line).join(broadcast_if_small(known, MAX_CELLS), [key, "id_parent"])


def _pieces(lines: DataFrame, line: str = "line") -> DataFrame:
    """One row per straight piece of a line, with the share of the line it is due in full."""
    path = geo.parse_line(F.col(line))
    measured = lines.withColumn("_edges", geo.edges(path)).withColumn("_length", geo.line_length(path))
    pieces = measured.withColumn("_n", F.size("_edges")).withColumn("_e", F.explode("_edges")).drop("_edges")
    due = F.when(F.col("_length") > 0, geo.segment_length(F.col("_e")) / F.nullif("_length", F.lit(0.0))).otherwise(1 / F.col("_n"))
    return pieces.withColumn("_due", due).drop("_n", "_length")


def allocate(
    coarse: DataFrame, cells: DataFrame, grid: Quad, resolution: int, line: str = "line", key: str = "region_slug",
    value: str = "tci", time: Sequence[str] = TIME, parts: DataFrame | None = None,
) -> DataFrame:
    """Value per fine cell: sum of value x share of the line inside. ``parts`` has the ``shares``, if they are known."""
    table = shares(coarse, grid, resolution, line) if parts is None else parts
    placed = coarse.select(key, "id_parent", line, value, *time).join(table, line).withColumn("grid_id", cell_id(resolution, F.col("ix"), F.col("iy")))
    parent = F.get(F.split("id_parent", "-"), F.lit(0)).cast("int")
    placed = placed.withColumn("_v", F.col(value) * F.col("share")).where(F.col("_v") > 0).where(F.col("id_parent") == _parent_of(F.col("grid_id"), parent))
    known = cells.where(F.col("resolution") == resolution).select(key, F.col("id").alias("grid_id")).distinct()
    inside = placed.join(broadcast_if_small(known, MAX_CELLS), [key, "grid_id"], "left_semi")
    return inside.groupBy(key, "grid_id", *time).agg(F.sum("_v").alias(value))


def _parent_of(cell: Column, resolution: Column) -> Column:
    bits = F.split(cell, "-")
    up = F.get(bits, F.lit(0)).cast("int") - resolution
    ix, iy = F.get(bits, F.lit(1)).cast("bigint"), F.get(bits, F.lit(2)).cast("bigint")
    right = lambda v: F.call_function("shiftright", v, up)
    return F.concat_ws("-", resolution.cast("string"), right(ix).cast("string"), right(iy).cast("string"))


def city_shares(
    rows: DataFrame, cells: DataFrame, grid: Quad, tile_resolution: int, line: str = "line", key: str = "region_slug"
) -> DataFrame:
    """line, region, id, id_parent, ``share``: what part of each distinct line lies in each city under each coarse cell.

    Hulls are keyed by small tiles, so lines meet only the cities of the tiles they cross. In a
    tile wholly inside a hull the piece counts fully; elsewhere it is cut by the hull's edges.
    """
    cities = cells.where(F.col("resolution") == CITY_RESOLUTION).select(key, "id", "id_parent", "wkt").distinct()
    shapes = cities.select(key, "id", "wkt").distinct()
    hulls = shapes.withColumn("_hull", geo.polygon_edges(geo.parse_polygon(F.col("wkt")))).select(key, "id", "_hull")
    index = (
        polygon_index(shapes, grid, tile_resolution, [key, "id"], "wkt")
        .select(key, "id", "ix", "iy", (F.size("edges") == 0).alias("_full"))
        .join(hulls, [key, "id"])
    )
    pieces = edge_cells(_pieces(rows.select(line).distinct(), line), "_e", grid, tile_resolution)
    e = F.col("_e")
    box = grid.box(F.col("ix"), F.col("iy"), tile_resolution)
    part = geo.box_share(e, *box)
    inside = F.when(F.col("_full"), F.lit(1.0)).otherwise(geo.convex_share(_cut_to_box(e, box), F.col("_hull")))
    index = broadcast_if_small(index, MAX_CELLS)
    placed = pieces.withColumn("_part", part).where("_part > 0").join(index, ["ix", "iy"])
    found = placed.withColumn("_part", F.col("_due") * F.col("_part") * inside).where("_part > 0")
    found = found.groupBy(line, key, "id").agg(F.sum("_part").alias("share"))
    return found.join(broadcast_if_small(cities.select(key, "id", "id_parent"), MAX_CELLS), [key, "id"])


def allocate_cities(
    coarse: DataFrame, cells: DataFrame, grid: Quad, tile_resolution: int, line: str = "line", key: str = "region_slug",
    value: str = "tci", time: Sequence[str] = TIME, parts: DataFrame | None = None,
) -> DataFrame:
    """Value per convex city under the same coarse cell, by length inside the hull; ``parts`` has the ``city_shares``."""
    table = city_shares(coarse, cells, grid, tile_resolution, line, key) if parts is None else parts
    placed = coarse.select(key, "id_parent", line, value, *time).join(table, [line, key, "id_parent"])
    return (
        placed.withColumn("_v", F.col(value) * F.col("share"))
        .where("_v > 0")
        .groupBy(key, F.col("id").alias("grid_id"), *time)
        .agg(F.sum("_v").alias(value))
    )


def _cut_to_box(e: Column, box: Sequence[Column]) -> Column:
    """The piece of a segment inside a box."""
    ex0, ex1 = geo._interval(e["x1"], e["x2"], box[0], box[2])
    ey0, ey1 = geo._interval(e["y1"], e["y2"], box[1], box[3])
    low = F.greatest(F.lit(0.0), ex0, ey0)
    high = F.greatest(low, F.least(F.lit(1.0), ex1, ey1))
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    return F.struct(
        (e["x1"] + dx * low).alias("x1"), (e["y1"] + dy * low).alias("y1"),
        (e["x1"] + dx * high).alias("x2"), (e["y1"] + dy * high).alias("y2"),
    )


__all__ = [
    "allocate", "allocate_cities", "assign_coarse", "batch", "city_cells", "city_shares", "cover", "parent_id", "region_resolutions", "shares",
]
