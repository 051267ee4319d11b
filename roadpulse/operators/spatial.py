"""Quad cells and the cell-keyed spatial join.

Spark has no spatial join strategy, so both sides are keyed by the cells they touch, joined on
the integer cell, and tested exactly inside the cell. A polygon is reduced to one row per cell:
whether the cell centre is inside it, and the few ring edges that pass through the cell. The exact
test therefore costs the edges of one cell, never those of a whole country.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions import geo
from roadpulse.session import cut

BROADCAST_EDGES = 500_000
SALTS = 32


@dataclass(frozen=True)
class Quad:
    """Square root cell; level r has 2**r cells a side."""

    x0: float = -180.0
    y0: float = -180.0
    size: float = 360.0

    def width(self, resolution: int) -> float:
        return self.size / 2**resolution

    def ix(self, x: Column, resolution: int) -> Column:
        return F.floor((x - F.lit(self.x0)) / F.lit(self.width(resolution)))

    def iy(self, y: Column, resolution: int) -> Column:
        return F.floor((y - F.lit(self.y0)) / F.lit(self.width(resolution)))

    def left(self, ix: Column, resolution: int) -> Column:
        return F.lit(self.x0) + ix * F.lit(self.width(resolution))

    def bottom(self, iy: Column, resolution: int) -> Column:
        return F.lit(self.y0) + iy * F.lit(self.width(resolution))

    def box(self, ix: Column, iy: Column, resolution: int) -> tuple[Column, Column, Column, Column]:
        return (
            self.left(ix, resolution),
            self.bottom(iy, resolution),
            self.left(ix + 1, resolution),
            self.bottom(iy + 1, resolution),
        )


class Lattice:
    """Rectangular cells given by columns (origin and cell sizes); the level argument is unused."""

    def __init__(self, x0: Column, y0: Column, dx: Column, dy: Column):
        self.x0, self.y0, self.dx, self.dy = x0, y0, dx, dy

    def ix(self, x: Column, resolution: int = 0) -> Column:
        return F.floor((x - self.x0) / self.dx)

    def iy(self, y: Column, resolution: int = 0) -> Column:
        return F.floor((y - self.y0) / self.dy)

    def box(self, ix: Column, iy: Column, resolution: int = 0) -> tuple[Column, Column, Column, Column]:
        return (
            self.x0 + ix * self.dx,
            self.y0 + iy * self.dy,
            self.x0 + (ix + 1) * self.dx,
            self.y0 + (iy + 1) * self.dy,
        )


def cell_id(resolution: int, ix: Column, iy: Column) -> Column:
    return F.concat_ws("-", F.lit(resolution), ix.cast("string"), iy.cast("string"))


def parent_id(cell: Column, resolution: int) -> Column:
    """Ancestor of a cell at a coarser level."""
    bits = F.split(cell, "-")
    up = F.get(bits, F.lit(0)).cast("int") - F.lit(resolution)
    ix, iy = F.get(bits, F.lit(1)).cast("bigint"), F.get(bits, F.lit(2)).cast("bigint")
    return cell_id(resolution, F.call_function("shiftright", ix, up), F.call_function("shiftright", iy, up))


LOW = 0xFFFFFFFF
#: Widening of the crossed interval of a row, for the rounding of its ends.
SLACK = 1e-12


def _code(ix: Column, iy: Column) -> Column:
    """Both cell numbers in one, so that copies are removed by hashing numbers and not by comparing structs."""
    return F.shiftleft(ix.cast("bigint"), 32).bitwiseOR(iy.cast("bigint").bitwiseAND(F.lit(LOW)))


def _cell(code: Column) -> Column:
    return F.struct(F.shiftright(code, 32).alias("ix"), F.shiftright(F.shiftleft(code, 32), 32).alias("iy"))


def _span(first: Column, last: Column, to: Column | None) -> Column:
    """Whole numbers from first to last, inside 0 to ``to`` if given; empty if there are none."""
    if to is not None:
        first, last = F.greatest(first, F.lit(0).cast("bigint")), F.least(last, to)
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))


def crossed(e: Column, grid: Quad | Lattice, resolution: int = 0, to: tuple[Column, Column] | None = None) -> Column:
    """Codes of the cells an edge runs through, row by row: ``array<bigint>`` without copies.

    In each row of cells the edge covers one interval, so the cost is the cells found and not those
    of its bounding box. ``to`` limits cells to 0..to in both directions before any is listed.
    """
    last_x, last_y = to or (None, None)
    slope = (e["x2"] - e["x1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0))
    low_x, high_x = F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])
    low_y, high_y = F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])
    slack = (F.abs(e["x1"]) + F.abs(e["x2"])) * SLACK

    def row(j: Column) -> Column:
        _, bottom, _, top = grid.box(F.lit(0), j, resolution)
        a = e["x1"] + (F.greatest(bottom, low_y) - e["y1"]) * slope
        b = e["x1"] + (F.least(top, high_y) - e["y1"]) * slope
        left = F.greatest(F.coalesce(F.least(a, b) - slack, low_x), low_x)
        right = F.least(F.coalesce(F.greatest(a, b) + slack, high_x), high_x)
        return F.transform(_span(grid.ix(left, resolution), grid.ix(right, resolution), last_x), lambda i: _code(i, j))

    return F.flatten(F.transform(_span(grid.iy(low_y, resolution), grid.iy(high_y, resolution), last_y), row))


def edge_cells(df: DataFrame, edge: str, grid: Quad, resolution: int) -> DataFrame:
    """One row per cell an edge column passes, as ``ix``, ``iy``."""
    found = df.withColumn("_code", F.explode(crossed(F.col(edge), grid, resolution)))
    cell = _cell(F.col("_code"))
    return found.withColumn("ix", cell["ix"]).withColumn("iy", cell["iy"]).drop("_code")


def line_cells(path: Column, grid: Quad | Lattice, resolution: int = 0, to: tuple[Column, Column] | None = None) -> Column:
    """Distinct half-open cells a line runs through, as ``array<struct<ix,iy>>`` inside the row."""

    def of_edge(e: Column) -> Column:
        inside = F.filter(
            crossed(e, grid, resolution, to),
            lambda c: geo.box_share(e, *grid.box(_cell(c)["ix"], _cell(c)["iy"], resolution)) > 0,
        )
        return inside

    return F.transform(F.array_distinct(F.flatten(F.transform(geo.edges(path), of_edge))), _cell)


def near_cells(edges: Column, grid: Quad, resolution: int) -> Column:
    """Distinct cells a line's edges pass, ``array<struct<ix,iy>>`` in the row.

    Cells that only the rounding of an interval adds may be among them; every cell that holds a
    point of the line is there.
    """
    return F.transform(F.array_distinct(F.flatten(F.transform(edges, lambda e: crossed(e, grid, resolution)))), _cell)


def centre_runs(polygons: DataFrame, grid: Quad, resolution: int, keys: Sequence[str], edges: str) -> DataFrame:
    """Runs of cells in a row, ``start`` to ``stop``, whose centres are inside a polygon, by scan lines.

    Each edge is cut by the rows of cell centres it spans; per (polygon, row) the sorted crossings
    bound the inside runs. Cost: edges x rows spanned, whatever the area.
    """
    width = F.lit(grid.width(resolution))
    e = F.col("e")
    low, high = F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])
    first = F.ceil((low - F.lit(grid.y0)) / width - F.lit(0.5))
    last = F.ceil((high - F.lit(grid.y0)) / width - F.lit(0.5)) - 1
    rows = (
        polygons.select(*keys, F.explode(edges).alias("e"))
        .where(e["y1"] != e["y2"])
        .withColumn("first", first)
        .withColumn("last", last)
        .where("first <= last")
        .withColumn("iy", F.explode(F.sequence("first", "last")))
    )
    y = F.lit(grid.y0) + (F.col("iy") + F.lit(0.5)) * width
    at = e["x1"] + (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"])
    runs = (
        rows.select(*keys, "iy", at.alias("at"))
        .groupBy(*keys, "iy")
        .agg(F.array_sort(F.collect_list("at")).alias("xs"))
        .withColumn("pair", F.explode(F.expr("sequence(0, size(xs) - 2, 2)")))
        .select(*keys, "iy", F.get("xs", F.col("pair")).alias("a"), F.get("xs", F.col("pair") + 1).alias("b"))
    )
    start = F.ceil((F.col("a") - F.lit(grid.x0)) / width - F.lit(0.5))
    stop = F.ceil((F.col("b") - F.lit(grid.x0)) / width - F.lit(0.5)) - 1
    return runs.select(*keys, "iy", start.alias("start"), stop.alias("stop")).where("start <= stop")


def centre_cells(polygons: DataFrame, grid: Quad, resolution: int, keys: Sequence[str], edges: str) -> DataFrame:
    """Cells whose centre is inside a polygon: the runs, cell by cell."""
    runs = centre_runs(polygons, grid, resolution, keys, edges)
    return runs.select(*keys, F.explode(F.sequence("start", "stop")).alias("ix"), "iy")


def _no_edges() -> Column:
    return F.slice(F.array(F.struct(*[F.lit(0.0).alias(c) for c in ("x1", "y1", "x2", "y2")])), 1, 0)


def polygon_index(
    regions: DataFrame,
    grid: Quad,
    resolution: int,
    key: str | Sequence[str] = "region_slug",
    wkt: str = "region_shapefile_wkt",
) -> DataFrame:
    """Per (polygon, cell): ``centre`` flag and the ring edges passing through the cell."""
    keys = [key] if isinstance(key, str) else list(key)
    shapes = regions.select(*keys, geo.polygon_edges(geo.parse_polygon(F.col(wkt))).alias("edges"))
    border = (
        edge_cells(shapes.select(*keys, F.explode("edges").alias("e")), "e", grid, resolution)
        .groupBy(*keys, "ix", "iy")
        .agg(F.collect_list("e").alias("edges"))
    )
    inside = centre_cells(shapes, grid, resolution, keys, "edges").withColumn("centre", F.lit(True))
    return border.join(inside, [*keys, "ix", "iy"], "full").select(
        *keys,
        "ix",
        "iy",
        F.coalesce("centre", F.lit(False)).alias("centre"),
        F.coalesce("edges", _no_edges()).alias("edges"),
    )


def _ancestor(i: Column, up: Column) -> Column:
    return F.call_function("shiftright", i.cast("bigint"), up.cast("int"))


def levelled_index(
    regions: DataFrame,
    grid: Quad,
    resolution: int,
    key: str | Sequence[str] = "region_slug",
    wkt: str = "region_shapefile_wkt",
) -> DataFrame:
    """As ``polygon_index``, with the cells inside a polygon merged upwards: ``level``, ``ix``, ``iy``, ``centre``, ``edges``.

    Cells that ring edges pass are at ``resolution``. The rest of a polygon is covered by the largest cells without an
    edge: children of a cell that holds a piece of the border and do not themselves. They are found from the border
    alone, so the index grows with the outline and not with the area.
    """
    keys = [key] if isinstance(key, str) else list(key)
    shapes = regions.select(*keys, geo.polygon_edges(geo.parse_polygon(F.col(wkt))).alias("edges"))
    border = (
        edge_cells(shapes.select(*keys, F.explode("edges").alias("e")), "e", grid, resolution)
        .groupBy(*keys, "ix", "iy")
        .agg(F.collect_list("e").alias("edges"))
    )
    up = F.lit(resolution) - F.col("level")
    touched = (
        border.select(*keys, "ix", "iy", F.explode(F.sequence(F.lit(0), F.lit(resolution))).alias("level"))
        .select(*keys, "level", _ancestor(F.col("ix"), up).alias("ix"), _ancestor(F.col("iy"), up).alias("iy"))
        .distinct()
    )
    corners = F.array(*[F.struct((2 * F.col("ix") + a).alias("ix"), (2 * F.col("iy") + b).alias("iy")) for a in (0, 1) for b in (0, 1)])
    children = touched.where(F.col("level") < resolution).select(*keys, (F.col("level") + 1).alias("level"), F.inline(corners))
    # a polygon larger than the root cell has cells of level 0 without a parent
    span = touched.where("level = 0").groupBy(*keys).agg(*[f(c).alias(f"{c}_{n}") for c in ("ix", "iy") for n, f in (("a", F.min), ("b", F.max))])
    roots = span.select(*keys, F.lit(0).alias("level"), F.explode(F.sequence("ix_a", "ix_b")).alias("ix"), "iy_a", "iy_b").select(
        *keys, "level", "ix", F.explode(F.sequence("iy_a", "iy_b")).alias("iy")
    )
    empty = children.unionByName(roots).join(touched, [*keys, "level", "ix", "iy"], "left_anti").withColumn("edges", _no_edges())
    cells = border.select(*keys, F.lit(resolution).alias("level"), "ix", "iy", "edges").unionByName(empty)
    # a cell without an edge is inside if any of its smallest cells is: the one in its corner is looked up in the runs
    runs = centre_runs(shapes, grid, resolution, keys, "edges").groupBy(*keys, F.col("iy").alias("_y")).agg(
        F.collect_list(F.struct("start", "stop")).alias("_runs")
    )
    x = F.call_function("shiftleft", F.col("ix"), up)
    held = cells.withColumn("_y", F.call_function("shiftleft", F.col("iy"), up)).join(runs, [*keys, "_y"], "left")
    inside = F.coalesce(F.exists("_runs", lambda r: x.between(r["start"], r["stop"])), F.lit(False))
    return held.select(*keys, "level", "ix", "iy", inside.alias("centre"), "edges").where(F.col("centre") | (F.size("edges") > 0))


def inside_by_cell(x: Column, y: Column, cx: Column, cy: Column, centre: Column, edges: Column) -> Column:
    """Even-odd state of a point from that of its cell centre.

    The path centre -> (cx, y) -> (x, y) stays in the cell, so only the cell's own edges can change
    the state. Crossings are half-open, as in the ray test.
    """

    def flips(e: Column) -> Column:
        across_x = (e["x1"] > cx) != (e["x2"] > cx)
        at_y = e["y1"] + (e["y2"] - e["y1"]) * (cx - e["x1"]) / F.nullif(e["x2"] - e["x1"], F.lit(0.0))
        vertical = across_x & (at_y > F.least(cy, y)) & (at_y <= F.greatest(cy, y))
        across_y = (e["y1"] > y) != (e["y2"] > y)
        at_x = e["x1"] + (e["x2"] - e["x1"]) * (y - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0))
        level = across_y & (at_x > F.least(cx, x)) & (at_x <= F.greatest(cx, x))
        return F.coalesce(vertical, F.lit(False)) != F.coalesce(level, F.lit(False))

    return F.aggregate(edges, centre, lambda state, e: state != flips(e))


def clip_boxes(df: DataFrame, parts: str, box: Column) -> DataFrame:
    """``df`` with the polygon column ``parts`` cut to a box ``struct<x0,y0,x1,y1>`` of its row, a side at a time."""
    out = df.withColumn("_box", box)
    for axis, side, keep_low in (("x", "x0", False), ("x", "x1", True), ("y", "y0", False), ("y", "y1", True)):
        out = out.withColumn(parts, geo.clip_side(F.col(parts), axis, F.col("_box")[side], keep_low))
    return out.drop("_box")


def line_polygons(
    lines: DataFrame,
    regions: DataFrame,
    line: str = "line",
    key: str = "region_slug",
    wkt: str = "region_shapefile_wkt",
    grid: Quad = Quad(),
    resolution: int = 12,
    max_edges: int = BROADCAST_EDGES,
) -> DataFrame:
    """Distinct pairs of a distinct line and a polygon it meets.

    A line is carried once per cell near it (one or two for a jam) and once per coarser level in use. It meets a polygon
    if its first vertex is inside, tested in that vertex's cell or found in a larger cell that is inside whole, or if it
    crosses a ring edge, found in a cell both pass.

    The cells of the polygons are written once; they are broadcast while their edge total is at most ``max_edges``; above
    that both sides shuffle by cell, hot cells being spread over salts.
    """
    index = cut(levelled_index(regions, grid, resolution, key, wkt))
    size = index.agg(F.sum(F.size("edges") + 1).alias("n"), F.collect_set("level").alias("levels")).first()
    held, coarse = size["n"] or 0, sorted(set(size["levels"]) - {resolution})
    found = lines.select(line).distinct().withColumn("_edges", geo.edges(geo.parse_line(F.col(line))))
    box = geo.bbox(F.flatten(F.transform("_edges", lambda e: F.array(*[F.struct(e[f"x{k}"].alias("x"), e[f"y{k}"].alias("y")) for k in (1, 2)]))))
    # most lines stay inside one cell: plain comparisons find it, and only the others are walked cell by cell
    ends = found.withColumn("_b", box)
    left, right = grid.ix(F.col("_b.x0"), resolution), grid.ix(F.col("_b.x1"), resolution)
    low, high = grid.iy(F.col("_b.y0"), resolution), grid.iy(F.col("_b.y1"), resolution)
    single = F.array(F.struct(left.alias("ix"), low.alias("iy")))
    cells = F.when((left == right) & (low == high), single).otherwise(near_cells(F.col("_edges"), grid, resolution))
    start = F.get("_edges", F.lit(0))
    sx, sy = grid.ix(start["x1"], resolution), grid.iy(start["y1"], resolution)
    fine = F.transform(cells, lambda c: F.struct(F.lit(resolution).alias("level"), c["ix"].alias("ix"), c["iy"].alias("iy")))
    above = [
        F.struct(F.lit(n).alias("level"), _ancestor(sx, F.lit(resolution - n)).alias("ix"), _ancestor(sy, F.lit(resolution - n)).alias("iy"))
        for n in coarse
    ]
    looked = F.concat(fine, F.array(*above)) if above else fine
    pieces = ends.select(line, "_edges", F.explode(looked).alias("_c")).select(line, "_edges", "_c.*")
    on = ["level", "ix", "iy"]
    if held <= max_edges:
        index = F.broadcast(index)
    else:
        salts = F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))
        pieces = pieces.withColumn("_salt", F.pmod(F.xxhash64(line), F.lit(SALTS)))
        index = index.withColumn("_salt", F.explode(salts))
        on = [*on, "_salt"]
    ix, iy, first = F.col("ix"), F.col("iy"), F.get("_edges", F.lit(0))
    x, y = first["x1"], first["y1"]
    x0, y0, x1, y1 = grid.box(ix, iy, resolution)
    own = (F.col("level") < resolution) | ((grid.ix(x, resolution) == ix) & (grid.iy(y, resolution) == iy))
    within = inside_by_cell(x, y, (x0 + x1) / 2, (y0 + y1) / 2, F.col("centre"), F.col("edges"))
    crossing = (F.size("edges") > 0) & F.exists(
        "_edges", lambda s: F.exists("edges", lambda r: geo.segments_meet(s, r))
    )
    return pieces.join(index, on).where((own & within) | crossing).select(line, key).distinct()


def join_polygons(
    rows: DataFrame, regions: DataFrame, line: str = "line", key: str = "region_slug", pairs: DataFrame | None = None, **options
) -> DataFrame:
    """Rows paired with every polygon their line meets, each pair once.

    A feed repeats its lines, one of them perhaps in a third of all rows: each is tested once, or not at all if ``pairs``
    has its polygons already (``lines.dictionary``). The join back is by line, an exchange in which Spark splits hot lines.
    """
    known = line_polygons(rows, regions, line, key, **options) if pairs is None else pairs
    return rows.join(known, line)


def candidates(
    lines: DataFrame, regions: DataFrame, row: str, line: str = "line", key: str = "region_slug", wkt: str = "region_shapefile_wkt",
    grid: Quad = Quad(), resolution: int = 12,
) -> DataFrame:
    """(row, polygon) pairs that share a cell: the coarse step for a predicate of one's own."""
    index = polygon_index(regions, grid, resolution, key, wkt).select(key, "ix", "iy")
    near = lines.select(row, F.explode(near_cells(geo.edges(geo.parse_line(F.col(line))), grid, resolution)).alias("_c"))
    return near.select(row, "_c.ix", "_c.iy").join(index, ["ix", "iy"]).select(row, key).distinct()


def first_match(pairs: DataFrame, row: Sequence[str], choice: str) -> DataFrame:
    """Keep the smallest ``choice`` per row."""
    return pairs.groupBy(*row).agg(F.min(choice).alias(choice))


def point_join(
    points: DataFrame,
    polygons: DataFrame,
    x: str,
    y: str,
    key: str,
    wkt: str,
    grid: Quad = Quad(),
    resolution: int = 8,
    max_edges: int = BROADCAST_EDGES,
) -> DataFrame:
    """Points paired with the polygons that hold them (even-odd); above ``max_edges`` rows of a hot cell are spread over salts."""
    columns = points.columns
    index = cut(polygon_index(polygons, grid, resolution, key, wkt))
    held = index.agg(F.sum(F.size("edges") + 1).alias("n")).first()["n"] or 0
    placed = points.withColumn("ix", grid.ix(F.col(x), resolution)).withColumn("iy", grid.iy(F.col(y), resolution))
    on = ["ix", "iy"]
    if held <= max_edges:
        index = F.broadcast(index)
    else:
        placed = placed.withColumn("_salt", F.pmod(F.xxhash64(*columns), F.lit(SALTS)))
        index = index.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
        on = [*on, "_salt"]
    x0, y0, x1, y1 = grid.box(F.col("ix"), F.col("iy"), resolution)
    within = inside_by_cell(F.col(x), F.col(y), (x0 + x1) / 2, (y0 + y1) / 2, F.col("centre"), F.col("edges"))
    return placed.join(index, on).where(within).select(*columns, key)

