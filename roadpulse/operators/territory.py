"""Density split of territories of any shape, by any measure of its lines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions import geo
from roadpulse.operators import spatial
from roadpulse.operators.spatial import Quad
from roadpulse.session import broadcast_if_small, cut

#: Pieces of one level that may be broadcast.
MAX_PIECES = 20_000


def halves(pieces: DataFrame, parts: str = "parts") -> DataFrame:
    """Every piece cut in two across the longer side of its box (across y when square), as ``half`` 0 and 1.

    The box is that of the piece as it is, so pieces of a ragged territory are cut through their own middle. Halves
    without area are left out.
    """
    boxed = pieces.withColumn("_box", geo.bbox(geo.polygon_points(F.col(parts))))
    box = F.col("_box")
    tall = box["y1"] - box["y0"] >= box["x1"] - box["x0"]
    middle = {c: box[f"{c}0"] + (box[f"{c}1"] - box[f"{c}0"]) / 2 for c in "xy"}
    for name, low in (("_low", True), ("_high", False)):
        side = {c: geo.clip_side(F.col(parts), c, middle[c], low) for c in "xy"}
        boxed = boxed.withColumn(name, F.when(tall, side["y"]).otherwise(side["x"]))
    kept = [c for c in pieces.columns if c != parts]
    both = boxed.select(*kept, F.posexplode(F.array("_low", "_high")).alias("half", parts))
    return both.where(F.size(parts) > 0)


def cell_sums(lines: DataFrame, grid: Quad, resolution: int) -> DataFrame:
    """Weight of the lines near each coarse cell; a line counts in every cell it passes."""
    near = lines.select("weight", F.explode(spatial.near_cells(geo.edges(F.col("path")), grid, resolution)).alias("c"))
    return near.groupBy("c.ix", "c.iy").agg(F.sum("weight").alias("weight"))


def bounds(pieces: DataFrame, sums: DataFrame, grid: Quad, resolution: int) -> DataFrame:
    """root, piece, ``upto``: what the lines of a piece weigh at most, from the coarse cells it meets."""
    boxed = pieces.select("root", "piece", geo.polygon_edges(F.col("parts")).alias("es"), geo.bbox(geo.polygon_points(F.col("parts"))).alias("b"))
    xs = F.sequence(grid.ix(F.col("b.x0"), resolution), grid.ix(F.col("b.x1"), resolution))
    ys = F.sequence(grid.iy(F.col("b.y0"), resolution), grid.iy(F.col("b.y1"), resolution))
    cells = boxed.select("root", "piece", "es", F.explode(xs).alias("ix"), ys.alias("ys")).withColumn("iy", F.explode("ys")).drop("ys")
    x0, y0, x1, y1 = grid.box(F.col("ix"), F.col("iy"), resolution)
    cell = F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"))
    met = cells.join(sums, ["ix", "iy"]).where(geo.box_meets(F.col("es"), cell))
    return met.groupBy("root", "piece").agg(F.sum("weight").alias("upto"))


def split(
    roots: DataFrame,
    lines: DataFrame,
    weight: Column,
    dense: Callable[[Column], Column],
    max_depth: int = 10,
    window: float | None = None,
    grid: Quad = Quad(),
    resolution: int = 6,
    wkt: str = "wkt",
    line: str = "line_wkt",
) -> DataFrame:
    """Territories halved until no piece is too dense: root, piece, depth, part, ``value``, ``lines``, ``geo_id``.

    ``roots`` has a polygon per ``root``: concave, with holes, in several members, as it comes. ``weight`` is what a row of
    ``lines`` counts (jams, 1, kilometres), ``dense`` decides on the sum over all lines that meet a piece; it must not turn
    from true to false as the sum grows. ``piece`` is the path of halves from the root.

    A level at a time: the state is the table of open pieces and that of the lines near each, both written out. A piece
    hands its lines on to its halves by a join, so a line is tested against the pieces around it only and nothing is ever
    counted anew from the whole table. With ``window``, a piece whose coarse cells weigh more than ``window`` times what is
    too dense is cut without looking at its lines; pieces in between and below are counted exactly.

    A piece that is never cut stays one shape; others give a row for each of their members.
    """
    held = lines.select(F.monotonically_increasing_id().alias("id"), geo.parse_line(F.col(line)).alias("path"), weight.alias("weight"))
    held = cut(held.withColumn("box", geo.bbox(F.col("path"))).withColumn("text", geo.line_to_wkt(F.col("path"))))
    sums = cut(cell_sums(held, grid, resolution)) if window else None
    given = roots.select("root", F.col(wkt).alias("wkt"))
    pieces = cut(given.select("root", F.lit("").alias("piece"), geo.parse_polygon(F.col("wkt")).alias("parts")))
    near = spatial.candidates(held.select("id", "text"), given, "id", "text", "root", "wkt", grid, resolution)
    members = cut(near.join(held, "id").select("root", F.lit("").alias("piece"), "id", "path", "box", "weight"))
    finished: list[DataFrame] = []
    for depth in range(max_depth + 1):
        if window and depth < max_depth:
            judged = pieces.join(bounds(pieces, sums, grid, resolution), ["root", "piece"], "left")
            judged = judged.withColumn("sure", F.coalesce(dense(F.col("upto") / window), F.lit(False))).drop("upto")
        else:
            judged = pieces.withColumn("sure", F.lit(False))
        judged = cut(judged)
        asked = broadcast_if_small(judged.where("NOT sure").select("root", "piece", "parts"), MAX_PIECES)
        met = members.join(asked, ["root", "piece"]).where(geo.intersects(F.col("path"), F.col("parts")))
        exact = met.groupBy("root", "piece").agg(F.sum("weight").alias("value"), F.count(F.lit(1)).alias("lines"))
        counted = judged.join(exact, ["root", "piece"], "left").fillna(0, ["value", "lines"]).withColumn("depth", F.lit(depth))
        final = ~F.col("sure") & (~dense(F.col("value")) | (F.col("depth") == max_depth))
        # the verdict is written too: ``dense`` may hold a subquery, which every later job would run again
        counted = cut(counted.withColumn("final", final))
        finished.append(counted.where("final"))
        going = counted.where("NOT final").select("root", "piece", "parts")
        if going.isEmpty():
            break
        children = cut(halves(going).withColumn("child", F.concat("piece", F.col("half").cast("string"))))
        boxes = children.select("root", "piece", "child", geo.bbox(geo.polygon_points(F.col("parts"))).alias("around"))
        inherited = members.join(broadcast_if_small(boxes, MAX_PIECES), ["root", "piece"]).where(geo.boxes_overlap(F.col("box"), F.col("around")))
        members = cut(inherited.select("root", F.col("child").alias("piece"), "id", "path", "box", "weight"))
        pieces = children.select("root", F.col("child").alias("piece"), "parts")
    out = finished[0]
    for level in finished[1:]:
        out = out.unionByName(level)
    shapes = F.when(F.col("depth") == 0, F.array("parts")).otherwise(F.transform("parts", lambda p: F.array(p)))
    tiles = out.select("root", "piece", "depth", "value", "lines", F.posexplode(shapes).alias("part", "shape"))
    return tiles.withColumn("geo_id", geo.polygon_to_wkt(F.col("shape"))).drop("shape")
