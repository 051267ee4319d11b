"""Density-balanced partitions of a territory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.functions import geo
from roadpulse.operators import outlines, ranks, spatial, territory
from roadpulse.operators.spatial import Lattice, Quad, cell_id, line_cells
from roadpulse.session import broadcast_if_small, cut

MISSING = "(MISSING)"
BUCKETS = 4096
MAX_TILES = 100_000


# -- lines and cells ----------------------------------------------------------------------


def split_groups(df: DataFrame, n: int, key: str = "line_wkt") -> DataFrame:
    """n groups of equal size (to one row).

    Rows are numbered inside hash buckets and shifted by the running bucket counts; no task sees
    more than one bucket.
    """
    bucketed = df.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(BUCKETS)))
    counts = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = counts.select(
        "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(everything).alias("_total")
    )
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(key)) - 1
    numbered = bucketed.withColumn("_place", place).join(F.broadcast(offsets), "_bucket")
    group = F.floor((F.col("_before") + F.col("_place")) * n / F.col("_total")) + 1
    return numbered.withColumn("split", group.cast("int")).drop("_bucket", "_place", "_before", "_total")


def line_to_cell(lines: DataFrame, cells: DataFrame, grid: Quad, resolution: int, line: str = "line_wkt", count: str = "count_lines") -> DataFrame:
    """First cell (in cell order) each line runs through, '(MISSING)' if none.

    ``cells`` holds ix, iy of the cover.
    """
    touched = lines.withColumn("_c", F.explode_outer(line_cells(geo.parse_line(F.col(line)), grid, resolution)))
    keyed = touched.withColumn("ix", F.col("_c")["ix"]).withColumn("iy", F.col("_c")["iy"])
    known = broadcast_if_small(cells.select("ix", "iy").distinct().withColumn("_in", F.lit(True)), MAX_TILES)
    order = F.when(F.col("_in"), F.struct("ix", "iy"))
    first = keyed.join(known, ["ix", "iy"], "left").groupBy(line).agg(F.min(order).alias("_f"), F.first(count).alias(count))
    cell = F.when(F.col("_f").isNotNull(), cell_id(resolution, F.col("_f")["ix"], F.col("_f")["iy"]))
    return first.select(line, count, F.coalesce(cell, F.lit(MISSING)).alias("cell"))


def first_tile(pairs: DataFrame, line: str = "line_wkt", tile: str = "geo_id", order: str | None = None) -> DataFrame:
    """One tile per line: the first in order."""
    return pairs.groupBy(line).agg(F.min_by(tile, F.struct(order or tile, tile)).alias(tile))


def distribution(df: DataFrame, by: str, count: str = "count_lines", bp: str | None = None) -> DataFrame:
    """Lines and jams per cell."""
    extra = [F.max(bp).alias(bp)] if bp else []
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("lines"), F.sum(count).alias("jams"), *extra)


def top_cells(dist: DataFrame, k: int = 6, by: str = "cell", value: str = "lines") -> DataFrame:
    """The k densest cells, numbered from 1."""
    top = dist.where(F.col(by) != MISSING).orderBy(F.desc(value), by).limit(k)
    return top.withColumn("bp", F.row_number().over(Window.orderBy(F.desc(value), by)))


def refine(coarse: DataFrame, top: DataFrame, grid: Quad, finer: int, line: str = "line_wkt") -> DataFrame:
    """Lines of the densest cells get their first finer cell inside that cell, others keep theirs."""
    marked = coarse.join(F.broadcast(top.select("cell", "bp")), "cell", "left")
    own = F.split("cell", "-")
    up = (F.lit(finer) - F.get(own, F.lit(0)).cast("int")).alias("up")

    def inside(c: Column) -> Column:
        parent = [F.call_function("shiftright", c[i], up) for i in ("ix", "iy")]
        return (parent[0] == F.get(own, F.lit(1)).cast("bigint")) & (parent[1] == F.get(own, F.lit(2)).cast("bigint"))

    first = F.array_min(F.filter(line_cells(geo.parse_line(F.col(line)), grid, finer), inside))
    fine = F.when(F.col("bp").isNotNull(), cell_id(finer, first["ix"], first["iy"]))
    return marked.withColumn("cell_r", F.coalesce(fine, F.col("cell")))


def attach_counts(assigned: DataFrame, counts: DataFrame, line: str = "line_wkt") -> DataFrame:
    """Every line with its count, assigned or not."""
    return assigned.join(counts, line, "right")


def latest_split(levels: Sequence[DataFrame], names: Sequence[str]) -> DataFrame:
    """Chain of splits; the final polygon is the deepest one present.

    Each level maps ``names[i - 1]`` to ``names[i]``; the first has only ``names[0]``.
    """
    out = levels[0]
    for level, parent in zip(levels[1:], names):
        out = out.join(level, parent, "left")
    return out.withColumn("polygon_final", F.coalesce(*[F.col(n) for n in reversed(names)]))


# -- katana -------------------------------------------------------------------------------


def _schedule(box: Column, depth: int) -> Column:
    """Axis cut at each depth (1 = y) for a box halved across its longer side."""
    start = F.struct(
        (box["x1"] - box["x0"]).alias("w"), (box["y1"] - box["y0"]).alias("h"), F.slice(F.array(F.lit(0)), 1, 0).alias("axes")
    )

    def halve(s: Column, _: Column) -> Column:
        tall = s["h"] >= s["w"]
        return F.struct(
            F.when(tall, s["w"]).otherwise(s["w"] / 2).alias("w"),
            F.when(tall, s["h"] / 2).otherwise(s["h"]).alias("h"),
            F.concat(s["axes"], F.array(F.when(tall, 1).otherwise(0))).alias("axes"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), start, halve)["axes"]


def _cuts(axes: Column, depth: Column, axis: int) -> Column:
    """How many of the first ``depth`` cuts go across one axis."""
    return F.size(F.filter(F.slice(axes, F.lit(1), depth), lambda a: a == axis))


def _pow2(n: Column) -> Column:
    return F.pow(F.lit(2.0), n)


def _down(value: Column, bits: Column) -> Column:
    return F.call_function("shiftright", value, bits.cast("int"))


def plan_roots(roots: DataFrame, max_depth: int, root: str = "root") -> DataFrame:
    """Roots with the cut order and leaf size used by every step of ``katana``."""
    box = F.struct("x0", "y0", "x1", "y1")
    planned = roots.select(root, "x0", "y0", "x1", "y1", _schedule(box, max_depth).alias("axes"))
    full = F.lit(max_depth)
    nx, ny = _cuts(F.col("axes"), full, 0), _cuts(F.col("axes"), full, 1)
    return planned.withColumns(
        {
            "nx": nx, "ny": ny,
            "dx": (F.col("x1") - F.col("x0")) / _pow2(nx),
            "dy": (F.col("y1") - F.col("y0")) / _pow2(ny),
        }
    )


def katana(
    roots: DataFrame,
    lines: DataFrame,
    max_share: float = 0.01,
    max_depth: int = 10,
    mode: str = "owner",
    total: float | None = None,
    root: str = "root",
    line: str = "line_wkt",
    count: str = "count_lines",
    digits: int = 4,
) -> DataFrame:
    """Boxes halved across their longer side until each holds at most ``max_share`` of the jams.

    ``roots`` has a box per root (x0, y0, x1, y1), ``lines`` the root each line belongs to.
    ``owner`` counts a line in the one tile of its first vertex; ``touch`` in every tile it runs
    through. The share is rounded to ``digits`` before the comparison.

    Halving is uniform inside a root, so a tile is (depth, ix, iy) and its ancestors are bit
    shifts. Counts of all tiles of all depths come from one pass: lines are summed per leaf, leaf
    sums are rolled up, and a tile is final when its parent is too dense and it is not (or it is at
    the last depth). No driver loop, and nothing but leaf sums is shuffled.
    """
    planned = plan_roots(roots, max_depth, root)
    small = broadcast_if_small(planned, MAX_TILES)
    path = geo.parse_line(F.col(line))
    joined = lines.join(small, root)
    lattice = Lattice(F.col("x0"), F.col("y0"), F.col("dx"), F.col("dy"))
    last_x, last_y = _pow2(F.col("nx")).cast("bigint") - 1, _pow2(F.col("ny")).cast("bigint") - 1
    depths = F.sequence(F.lit(0), F.lit(max_depth))

    def ancestors(ix: Column, iy: Column) -> Column:
        return F.transform(
            depths,
            lambda d: F.struct(
                d.alias("depth"),
                _down(ix, F.col("nx") - _cuts(F.col("axes"), d, 0)).alias("ix"),
                _down(iy, F.col("ny") - _cuts(F.col("axes"), d, 1)).alias("iy"),
            ),
        )

    if mode == "owner":
        point = F.get(path, F.lit(0))
        placed = joined.withColumn("_p", point).where(
            F.col("_p.x").between(F.col("x0"), F.col("x1")) & F.col("_p.y").between(F.col("y0"), F.col("y1"))
        )
        leaves = (
            placed.groupBy(
                root,
                F.least(lattice.ix(F.col("_p.x")), last_x).alias("ix"),
                F.least(lattice.iy(F.col("_p.y")), last_y).alias("iy"),
            )
            .agg(F.sum(count).alias("jams"), F.count(F.lit(1)).alias("lines"))
            .join(small, root)
        )
        rows = leaves.select(root, F.explode(ancestors(F.col("ix"), F.col("iy"))).alias("t"), "jams", "lines")
    elif mode == "touch":
        cells = line_cells(path, lattice, to=(last_x, last_y))
        tiles = F.array_distinct(F.flatten(F.transform(cells, lambda c: ancestors(c["ix"], c["iy"]))))
        rows = joined.select(root, F.explode(tiles).alias("t"), F.col(count).alias("jams"), F.lit(1).alias("lines"))
    else:
        raise ValueError("mode is 'owner' or 'touch'")

    nodes = rows.groupBy(root, "t.depth", "t.ix", "t.iy").agg(F.sum("jams").alias("jams"), F.sum("lines").alias("lines"))
    whole = lines.agg(F.sum(count).cast("double")).scalar() if total is None else F.lit(float(total))

    def dense(share: str = "share_jams") -> Column:
        return F.round(share, digits) > max_share

    counted = nodes.withColumn("share_jams", F.col("jams") / whole)
    parents = counted.where(dense() & (F.col("depth") < max_depth)).join(small, root)
    axis = F.get(F.col("axes"), F.col("depth"))
    half = F.transform(
        F.array(F.lit(0), F.lit(1)),
        lambda b: F.struct(
            (F.col("depth") + 1).alias("depth"),
            F.when(axis == 1, F.col("ix")).otherwise(F.col("ix") * 2 + b).alias("ix"),
            F.when(axis == 1, F.col("iy") * 2 + b).otherwise(F.col("iy")).alias("iy"),
        ),
    )
    children = parents.select(root, F.explode(half).alias("t")).select(root, "t.*")
    tops = planned.select(root, F.lit(0).alias("depth"), F.lit(0).cast("bigint").alias("ix"), F.lit(0).cast("bigint").alias("iy"))
    found = (
        children.unionByName(tops)
        .join(counted, [root, "depth", "ix", "iy"], "left")
        .fillna(0, ["jams", "lines"])
        .fillna(0.0, ["share_jams"])
        .where(~dense() | (F.col("depth") == max_depth))
        .join(small, root)
    )
    width = (F.col("x1") - F.col("x0")) / _pow2(_cuts(F.col("axes"), F.col("depth"), 0))
    height = (F.col("y1") - F.col("y0")) / _pow2(_cuts(F.col("axes"), F.col("depth"), 1))
    left, low = F.col("x0") + F.col("ix") * width, F.col("y0") + F.col("iy") * height
    # the same sum that the next tile begins with, so that common sides are equal to the last bit
    right, high = F.col("x0") + (F.col("ix") + 1) * width, F.col("y0") + (F.col("iy") + 1) * height
    tiles = found.select(
        root, "depth", "ix", "iy", left.alias("bx0"), low.alias("by0"), right.alias("bx1"), high.alias("by1"),
        "lines", "jams", "share_jams",
    )
    wkt = geo.polygon_to_wkt(geo.box_polygon(F.col("bx0"), F.col("by0"), F.col("bx1"), F.col("by1")))
    return tiles.withColumn("geo_id", wkt)


def katana_area(shapes: DataFrame, max_km2: float, max_depth: int = 250, key: str = "region_slug", wkt: str = "region_shapefile_wkt") -> DataFrame:
    """Shapes halved until each piece is at most ``max_km2``; pieces numbered per shape.

    A level at a time: small pieces are final, the others are cut in two. The state is the piece
    table only, written to the checkpoint folder at each level. ``fits`` is false for pieces that
    are still too large at ``max_depth``.
    """
    work = shapes.select(key, geo.parse_polygon(F.col(wkt)).alias("parts"))
    finished: list[DataFrame] = []
    for depth in range(max_depth + 1):
        sized = cut(work.withColumn("km2", geo.area_km2(F.col("parts"))).withColumn("depth", F.lit(depth)))
        large = F.col("km2") > max_km2
        finished.append(sized.where(~large) if depth < max_depth else sized)
        if depth == max_depth or sized.where(large).isEmpty():
            break
        work = territory.halves(sized.where(large).select(key, "parts")).select(key, "parts")
    out = finished[0]
    for level in finished[1:]:
        out = out.unionByName(level)
    text = out.withColumn("wkt", geo.polygon_to_wkt(F.col("parts"))).drop("parts").withColumn("fits", F.col("km2") <= max_km2)
    return text.withColumn("part", F.row_number().over(Window.partitionBy(key).orderBy("depth", "wkt")))


# -- assignment ---------------------------------------------------------------------------


def tile_index(tiles: DataFrame, grid: Quad, resolution: int, tile: str = "geo_id") -> DataFrame:
    """Tile boxes keyed by the cells they overlap; tiles are disjoint, so cells x borders rows."""
    xs = F.sequence(grid.ix(F.col("bx0"), resolution), grid.ix(F.col("bx1"), resolution))
    ys = F.sequence(grid.iy(F.col("by0"), resolution), grid.iy(F.col("by1"), resolution))
    return (
        tiles.select(tile, "bx0", "by0", "bx1", "by1", F.explode(xs).alias("ix"), ys.alias("_ys"))
        .withColumn("iy", F.explode("_ys"))
        .drop("_ys")
    )


def assign(rows: DataFrame, tiles: DataFrame, grid: Quad, resolution: int, line: str = "line_wkt", tile: str = "geo_id", keep_all: bool = True) -> DataFrame:
    """The tile of each line's first vertex (half-open boxes, so at most one)."""
    index = broadcast_if_small(tile_index(tiles, grid, resolution, tile), 10 * MAX_TILES)
    point = F.get(geo.parse_line(F.col(line)), F.lit(0))
    placed = rows.withColumn("_p", point)
    px, py = F.col("_p.x"), F.col("_p.y")
    on = (
        (grid.ix(px, resolution) == F.col("ix"))
        & (grid.iy(py, resolution) == F.col("iy"))
        & (px >= F.col("bx0")) & (px < F.col("bx1")) & (py >= F.col("by0")) & (py < F.col("by1"))
    )
    joined = placed.join(index, on, "left" if keep_all else "inner")
    return joined.select(*rows.columns, tile)


def touching(rows: DataFrame, tiles: DataFrame, grid: Quad, resolution: int, line: str = "line_wkt", tile: str = "geo_id") -> DataFrame:
    """All (line, tile) pairs that share a part of the line."""
    index = broadcast_if_small(tile_index(tiles, grid, resolution, tile), 10 * MAX_TILES)
    cells = rows.select(line).withColumn("_path", geo.parse_line(F.col(line)))
    cells = cells.withColumn("_c", F.explode(line_cells(F.col("_path"), grid, resolution)))
    cells = cells.withColumn("ix", F.col("_c.ix")).withColumn("iy", F.col("_c.iy"))
    box = [F.col(c) for c in ("bx0", "by0", "bx1", "by1")]
    hit = F.exists(geo.edges(F.col("_path")), lambda e: geo.box_share(e, *box) > 0)
    return cells.join(index, ["ix", "iy"]).where(hit).select(line, tile).distinct()


def ratios(dist: DataFrame, total: float | None = None, unit: float = 0.01) -> DataFrame:
    """Share of all jams and its ratio to ``unit``."""
    whole = F.lit(float(total)) if total is not None else dist.agg(F.sum("jams").cast("double")).scalar()
    return dist.withColumn("share_jams", F.col("jams") / whole).withColumn("ratio", F.col("share_jams") / unit)


def redo(
    tiles: DataFrame, lines: DataFrame, ratio_min: float, max_share: float, max_depth: int, grid: Quad, resolution: int,
    total: float | None = None, mode: str = "owner",
) -> DataFrame:
    """Tiles with more than ``ratio_min`` percent of the jams are cut again; the deepest tile is final.

    The tile table (bounded, see ``pack``) is used several times and therefore written out once.
    """
    tiles = cut(tiles)
    again = ratios(tiles, total).where(F.col("ratio") > ratio_min)
    roots = again.select(F.col("geo_id").alias("root"), F.col("bx0").alias("x0"), F.col("by0").alias("y0"), F.col("bx1").alias("x1"), F.col("by1").alias("y1"))
    boxes = again.select("geo_id", "bx0", "by0", "bx1", "by1")
    held = assign(lines, boxes, grid, resolution, keep_all=False).withColumnRenamed("geo_id", "root")
    whole = total if total is not None else lines.agg(F.sum("count_lines").alias("t")).first()["t"]
    split = katana(roots, held, max_share, max_depth, mode, whole).select(
        F.col("root").alias("polygon_1"), "bx0", "by0", "bx1", "by1", "lines", "jams", "share_jams", "geo_id"
    )
    kept = tiles.join(again.select("geo_id"), "geo_id", "left_anti").select(
        F.col("geo_id").alias("polygon_1"), "bx0", "by0", "bx1", "by1", "lines", "jams", "share_jams", "geo_id"
    )
    return kept.unionByName(split)


# -- packing ------------------------------------------------------------------------------


def _following(rows: DataFrame) -> DataFrame:
    """For each asking row (``i`` set, ``j`` null) the least ``j`` behind it in order of (v, j first), as ``next``.

    Rows are range-partitioned; a partition is looked through on its own, and what lies behind it
    comes from a table of one row per partition.
    """
    placed = cut(rows.withColumn("asks", F.col("i").isNotNull()).repartitionByRange("v", "asks").withColumn("p", F.spark_partition_id()))
    behind = Window.partitionBy("p").orderBy("v", "asks").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    later = Window.orderBy("p").rowsBetween(1, Window.unboundedFollowing)
    heads = placed.groupBy("p").agg(F.min("j").alias("m")).select("p", F.min("m").over(later).alias("rest"))
    found = placed.withColumn("near", F.min("j").over(behind)).where("asks")
    return found.join(F.broadcast(heads), "p").select("i", F.coalesce("near", "rest").alias("next"))


def pack(dist: DataFrame, max_value: float = 0.016, tile: str = "geo_id", share: str = "share_jams") -> DataFrame:
    """Next-fit groups in (tile, share) order, ids padded to two digits.

    A group takes rows while its sum stays at most ``max_value``; a row of at least that much is a
    group of its own if it opens one. Where a group begins tells where the next one does: at the
    first row whose running total is too far. That row is found for every row at once; the rows that
    begin a group are those reached from the first, by jumps of 1, 2, 4, ... groups. Sums are exact
    decimals, and no task holds the table.
    """
    exact = F.col(share).cast("decimal(28,15)")
    limit = F.lit(max_value).cast("decimal(28,15)")
    placed = ranks.running_total(dist.select(tile, share), [tile, share], F.struct(exact.alias("s"), F.lit(1).cast("bigint").alias("n")), "total")
    rows = cut(placed.select(tile, share, F.col("total.n").alias("i"), F.col("total.s").alias("sum")))
    own = F.col(share).cast("decimal(28,15)")
    full = rows.where(own >= limit).select("i", (F.col("i") + 1).alias("next"))
    asking = rows.where(own < limit).select((F.col("sum") - own + limit).alias("v"), "i", F.lit(None).cast("bigint").alias("j"))
    keys = rows.select(F.col("sum").alias("v"), F.lit(None).cast("bigint").alias("i"), F.col("i").alias("j"))
    last = rows.agg(F.max("i").alias("n"))
    jumps = _following(asking.unionByName(keys)).unionByName(full.join(F.broadcast(last), F.col("next") <= F.col("n")).select("i", "next"))
    jumps = cut(jumps.where("next IS NOT NULL"))
    starts = cut(rows.where("i = 1").select("i"))
    while not (step := jumps.join(starts, "i")).isEmpty():
        starts = cut(starts.unionByName(step.select(F.col("next").alias("i"))))
        jumps = cut(jumps.alias("a").join(jumps.alias("b"), F.col("a.next") == F.col("b.i")).select("a.i", "b.next"))
    opened = rows.join(starts.withColumn("opens", F.lit(1).cast("bigint")), "i", "left")
    grouped = ranks.running_total(opened, ["i"], F.coalesce("opens", F.lit(0).cast("bigint")), "g")
    number = F.col("g").cast("string")
    return grouped.select(tile, share, F.when(F.col("g") < 100, F.lpad(number, 2, "0")).otherwise(number).alias("group"))


def multipolygon(df: DataFrame, group: str = "group", tile: str = "geo_id", share: str = "share_jams") -> DataFrame:
    """Members of each group as one MULTIPOLYGON text, with their total share."""
    member = F.regexp_replace(F.col(tile), r"^POLYGON\s*", "")
    text = F.concat(F.lit("MULTIPOLYGON ("), F.array_join(F.array_sort(F.collect_list(member)), ", "), F.lit(")"))
    return df.groupBy(group).agg(text.alias("geo_partition_wkt"), F.sum(share).alias(share))


def complement(cover: DataFrame, tiles: DataFrame, tile: str = "geo_id", group: str = "999") -> DataFrame:
    """Tiles of the same cover that are in no group, as the catch-all group with share 0."""
    return cover.join(tiles.select(tile), tile, "left_anti").withColumn("group", F.lit(group)).withColumn("share_jams", F.lit(0.0))


def geo_partitions(dist: DataFrame, max_value: float = 0.016, extent: DataFrame | None = None, other: str = "999") -> DataFrame:
    """Packed groups of tiles (geo_id, share_jams and the box) as outlines, a row for each ring, with the group's share.

    With ``extent`` (boxes that hold all tiles) what the tiles leave of it is the catch-all group ``other`` with share 0.
    """
    packed = cut(pack(dist, max_value).select("geo_id", "group").join(dist, "geo_id"))
    shares = packed.groupBy("group").agg(F.sum("share_jams").alias("share_jams"))
    found = outlines.outlines(packed.select("group", *outlines.BOX)).join(shares, "group")
    if extent is None:
        return found
    rest = outlines.difference(extent, packed, other).withColumn("share_jams", F.lit(0.0))
    return found.unionByName(rest)


def partition_raw(jams: DataFrame, tiles: DataFrame, grid: Quad, resolution: int, line: str = "line", other: str = "999") -> DataFrame:
    """Raw rows with the partition of the tile holding their first vertex (``other`` if none).

    ``tiles`` has geo_id, group and the tile boxes. Write with partitionBy(date, geo_partition_id).
    """
    boxes = tiles.select(F.col("group").alias("geo_partition_id"), "bx0", "by0", "bx1", "by1")
    placed = assign(jams, boxes, grid, resolution, line, "geo_partition_id")
    return placed.fillna(other, ["geo_partition_id"])


def prune(
    regions: DataFrame, tiles: DataFrame, grid: Quad, resolution: int, key: str = "region_slug", wkt: str = "region_shapefile_wkt",
    margin: float = 0.0,
) -> DataFrame:
    """Partitions whose tiles meet each region: the filter for the partitioned raw table.

    Rows are stored by first vertex, so a line reaching into a region may start outside it;
    ``margin`` widens the tiles by the longest line to be found.
    """
    wide = tiles.select(
        F.col("group").alias("geo_partition_id"),
        (F.col("bx0") - margin).alias("bx0"), (F.col("by0") - margin).alias("by0"),
        (F.col("bx1") + margin).alias("bx1"), (F.col("by1") + margin).alias("by1"),
    )
    index = spatial.polygon_index(regions, grid, resolution, key, wkt).select(key, "ix", "iy")
    boxes = tile_index(wide, grid, resolution, "geo_partition_id")
    candidates = index.join(boxes, ["ix", "iy"]).select(key, "geo_partition_id", "bx0", "by0", "bx1", "by1").distinct()
    shapes = regions.select(key, geo.polygon_edges(geo.parse_polygon(F.col(wkt))).alias("_edges"))
    box = F.struct(*[F.col(f"b{c}").alias(c) for c in ("x0", "y0", "x1", "y1")])
    met = candidates.join(shapes, key).where(geo.box_meets(F.col("_edges"), box))
    return met.select(key, "geo_partition_id").distinct()
