"""Geometry, spatial joins, grids and tiles."""

import math
import random

import pytest
from pyspark.sql import functions as F

from roadpulse.functions import geo
from roadpulse.operators import density, grid, spatial, territory
from roadpulse.operators.spatial import Quad
from roadpulse.plans import regions

GRID = Quad(0.0, 0.0, 16.0)  # level 4 has unit cells


def lines(spark, texts):
    return spark.createDataFrame(list(texts.items()), "id string, line string")


def test_parse_and_print(spark):
    text = 'MULTIPOLYGON (((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1)), ((9 9, 10 9, 10 10, 9 9)))'
    df = spark.createDataFrame([(text,), (f'"{text}"',)], "t string").select(geo.parse_polygon(F.col("t")).alias("p"))
    for r in df.select(
        F.size("p").alias("n"), geo.area(F.col("p")).alias("a"), geo.valid(F.col("p")).alias("v"),
        geo.area(geo.largest_part(F.col("p"))).alias("big"), geo.polygon_to_wkt(F.col("p")).alias("w"),
    ).collect():
        assert (r["n"], r["a"], r["v"], r["big"]) == (2, 15.5, True, 15.0)
        assert r["w"].replace(".0", "") == text


def test_invalid_shapes(spark):
    df = spark.createDataFrame([("POLYGON ((0 0, 1 0, x 1, 0 0))",), ("POLYGON ((0 0, 1 0, 1 1, 0 2))",), ("rubbish",)], "t string")
    assert [r[0] for r in df.select(geo.valid(geo.parse_polygon(F.col("t")))).collect()] == [False, False, False]


def test_segments_and_cells(spark):
    texts = {
        "inside": "LINESTRING (1.2 1.2, 1.8 1.8)",
        "two": "LINESTRING (1.5 1.5, 2.5 1.5)",
        "three": "LINESTRING (1.5 1.5, 2.5 1.5, 2.5 2.5)",
        "border": "LINESTRING (2 1.2, 2 1.8)",
        "corner": "LINESTRING (1.5 2.5, 2.5 1.5)",
        "point": "LINESTRING (3 3, 3 3)",
    }
    df = lines(spark, texts)
    cells = {r["id"]: sorted((c["ix"], c["iy"]) for c in r["c"]) for r in
             df.select("id", spatial.line_cells(geo.parse_line(F.col("line")), GRID, 4).alias("c")).collect()}
    assert cells["inside"] == [(1, 1)]
    assert cells["two"] == [(1, 1), (2, 1)]
    assert cells["three"] == [(1, 1), (2, 1), (2, 2)]
    assert cells["border"] == [(2, 1)]  # half-open: one owner
    assert cells["corner"] == [(1, 2), (2, 1)]
    assert cells["point"] == [(3, 3)]


def test_allocation_keeps_the_total(spark):
    rng = random.Random(7)
    data = []
    for i in range(200):
        pts = [(rng.uniform(1, 14), rng.uniform(1, 14))]
        for _ in range(rng.randint(1, 4)):
            x, y = pts[-1]
            pts.append((min(14.5, max(1, x + rng.uniform(-2, 2))), min(14.5, max(1, y + rng.uniform(-2, 2)))))
        if i % 20 == 0:
            pts = [(3.0, 4.0), (3.0, 4.0)]
        data.append(("r", "LINESTRING (" + ", ".join(f"{x:.3f} {y:.3f}" for x, y in pts) + ")", 2020, 1, 1, i % 24, 1, 10))
    hours = spark.createDataFrame(data, "region_slug string, line string, year int, month int, day int, hour int, dow int, tci long")
    meta = spark.createDataFrame([("r", "POLYGON ((0 0, 15.5 0, 15.5 15.5, 0 15.5, 0 0))")], "region_slug string, region_shapefile_wkt string")
    cells = grid.region_resolutions(meta, 3, 5, grid=GRID)
    coarse = grid.assign_coarse(hours, cells, GRID, 3)
    total = grid.allocate(coarse, cells, GRID, 5).agg(F.sum("tci")).first()[0]
    assert math.isclose(total, 2000.0, rel_tol=1e-9)


def test_cover_of_a_tiny_shape_is_the_cell_of_its_first_vertex(spark, rows):
    meta = spark.createDataFrame([("t", "POLYGON ((3.1 3.1, 3.2 3.1, 3.2 3.2, 3.1 3.1))")], "region_slug string, region_shapefile_wkt string")
    assert rows(grid.cover(meta, 4, 2, GRID), "id", "id_parent", "group") == [("4-3-3", "2-0-0", 0)]


def star(spikes, cx, cy, inner, outer):
    pts = []
    for k in range(2 * spikes):
        r = outer if k % 2 == 0 else inner
        a = math.pi * k / spikes
        pts.append((cx + r * math.cos(a), cy + r * math.sin(a)))
    pts.append(pts[0])
    return pts


def inside(x, y, ring):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        if (y1 > y) != (y2 > y) and x < x1 + (x2 - x1) * (y - y1) / (y2 - y1):
            odd = not odd
    return odd


def test_point_join_equals_brute_force(spark):
    rng = random.Random(3)
    rings = {"a": star(9, 6, 6, 2, 5.5), "b": star(5, 10, 9, 1.5, 5)}
    shapes = spark.createDataFrame(
        [(k, "POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in ring) + "))") for k, ring in rings.items()], "zone string, zone_wkt string")
    pts = [(i, rng.uniform(0, 16), rng.uniform(0, 16)) for i in range(3000)]
    got = spatial.point_join(spark.createDataFrame(pts, "i int, x double, y double"), shapes, "x", "y", "zone", "zone_wkt", GRID, 4)
    want = {(i, k) for i, x, y in pts for k, ring in rings.items() if inside(x, y, ring)}
    assert {(r["i"], r["zone"]) for r in got.collect()} == want


def test_points_join_the_same_when_shapes_are_not_broadcast(spark):
    shapes = spark.createDataFrame([("a", "POLYGON ((1 1, 9 2, 7 9, 4 5, 1 1))"), ("b", "POLYGON ((3 0, 12 0, 12 12, 3 0))")], "zone string, zone_wkt string")
    rng = random.Random(8)
    pts = [(i, 4.5, 3.5) for i in range(300)] + [(1000 + i, rng.uniform(0, 16), rng.uniform(0, 16)) for i in range(600)]
    df = spark.createDataFrame(pts, "i int, x double, y double")
    one, two = ({(r["i"], r["zone"]) for r in spatial.point_join(df, shapes, "x", "y", "zone", "zone_wkt", GRID, 4, max_edges=m).collect()} for m in (10**6, 0))
    assert one == two and len(one) > 300


def _covered(index, resolution):
    """(polygon, fine cell) -> centre flag of an index with levels, and the number of times a fine cell is covered."""
    flags, times = {}, {}
    for r in index.collect():
        up = resolution - r["level"]
        for ix in range(r["ix"] << up, (r["ix"] + 1) << up):
            for iy in range(r["iy"] << up, (r["iy"] + 1) << up):
                flags[r["region_slug"], ix, iy] = (r["centre"], sorted(tuple(e) for e in r["edges"]))
                times[r["region_slug"], ix, iy] = times.get((r["region_slug"], ix, iy), 0) + 1
    return flags, times


def test_levelled_index_covers_the_cells_of_the_flat_one(spark):
    shapes = {
        "star": "POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in star(7, 8, 8, 2, 7)) + "))",
        "holed": "POLYGON ((0.3 0.4, 15.2 0.3, 15.6 15.5, 0.2 15.1, 0.3 0.4), (5 5, 11 5.5, 10.5 11, 5 5))",
        "beyond": "POLYGON ((-20.5 -21, 50.2 -20, 49 52, -19 50.5, -20.5 -21))",  # larger than the root cell
        "tiny": "POLYGON ((3.1 3.1, 3.2 3.1, 3.2 3.2, 3.1 3.1))",
    }
    df = spark.createDataFrame(list(shapes.items()), "region_slug string, region_shapefile_wkt string")
    flat = {(r["region_slug"], r["ix"], r["iy"]): (r["centre"], sorted(tuple(e) for e in r["edges"])) for r in spatial.polygon_index(df, GRID, 5).collect()}
    flags, times = _covered(spatial.levelled_index(df, GRID, 5), 5)
    assert flags == flat and set(times.values()) == {1}


def test_levelled_index_grows_with_the_border(spark):
    ring = [(-55 + 9 * math.cos(2 * math.pi * k / 60), -12 + 9 * math.sin(2 * math.pi * k / 60)) for k in range(60)]
    text = "POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in [*ring, ring[0]]) + "))"
    df = spark.createDataFrame([("a", text)], "region_slug string, region_shapefile_wkt string")
    count = [F.count_if(F.size("edges") > 0), F.count(F.lit(1))]
    (b12, n12), (b14, n14) = (spatial.levelled_index(df, spatial.Quad(), level).agg(*count).first() for level in (12, 14))
    # about one inner cell for each cell of the border; the area has some 500,000 cells at the finer level
    assert 3000 < b14 and n14 < 2.1 * b14 and n12 < 2.1 * b12
    assert n14 < 4.5 * n12


def test_join_is_the_same_when_shapes_are_not_broadcast(spark, rows):
    rng = random.Random(5)
    ring = star(8, 8, 8, 2, 7)
    shapes = spark.createDataFrame([("s", "POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in ring) + "))")], "region_slug string, region_shapefile_wkt string")
    hot = {f"h{i}": "LINESTRING (8.1 8.1, 8.2 8.2)" for i in range(300)}  # one cell with most rows
    rest = {f"r{i}": f"LINESTRING ({rng.uniform(0, 15)!r} {rng.uniform(0, 15)!r}, {rng.uniform(0, 15)!r} {rng.uniform(0, 15)!r})" for i in range(200)}
    df = lines(spark, {**hot, **rest})
    one = spatial.join_polygons(df, shapes, grid=GRID, resolution=4)
    two = spatial.join_polygons(df, shapes, grid=GRID, resolution=4, max_edges=0)
    exact = df.where(geo.intersects(geo.parse_line(F.col("line")), geo.parse_polygon(F.lit(shapes.first()["region_shapefile_wkt"]))))
    assert rows(one, "id") == rows(two, "id") == rows(exact, "id")


def test_hull_contains_every_point_and_is_convex(spark):
    rng = random.Random(11)
    pts = [(rng.uniform(0, 10), rng.uniform(0, 10)) for _ in range(60)]
    df = spark.createDataFrame([([{"x": x, "y": y} for x, y in pts],)], "p array<struct<x:double,y:double>>")
    ring = [(p["x"], p["y"]) for p in df.select(geo.convex_hull(F.col("p")).alias("h")).first()["h"][0][0]]
    assert ring[0] == ring[-1] and set(ring) <= set(pts)
    for (ax, ay), (bx, by) in zip(ring, ring[1:]):
        assert all((bx - ax) * (y - ay) - (by - ay) * (x - ax) >= -1e-9 for x, y in pts)


def test_clip_polygon_pieces_add_up(spark):
    ring = star(7, 5, 5, 1.5, 4.7)
    text = "POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in ring) + "))"
    df = spark.createDataFrame([(text,)], "t string").select(geo.parse_polygon(F.col("t")).alias("p"))
    halves = territory.halves(df.withColumnRenamed("p", "parts")).select(geo.area(F.col("parts")).alias("a"))
    assert math.isclose(sum(r["a"] for r in halves.collect()), df.select(geo.area(F.col("p"))).first()[0], rel_tol=1e-9)


def _pixels(inside, box, n):
    """Pixel centres of a shape inside a box, and how many pieces they form (pixels that share a corner are one)."""
    x0, y0, x1, y1 = box
    on = {(i, j) for i in range(n) for j in range(n) if inside(x0 + (i + 0.5) * (x1 - x0) / n, y0 + (j + 0.5) * (y1 - y0) / n)}
    left, pieces = set(on), 0
    while left:
        size, todo = 0, [left.pop()]
        while todo:
            i, j = todo.pop()
            size += 1
            for near in ((i + a, j + b) for a in (-1, 0, 1) for b in (-1, 0, 1)):
                if near in left:
                    left.remove(near)
                    todo.append(near)
        pieces += size > 4  # the tip of a spike may fall apart into pixels
    return len(on) * (x1 - x0) * (y1 - y0) / n / n, pieces


def _even_odd(rings):
    def inside(x, y):
        hits = 0
        for ring in rings:
            for (ax, ay), (bx, by) in zip(ring, ring[1:]):
                hits += (ay > y) != (by > y) and x < ax + (bx - ax) * (y - ay) / (by - ay)
        return hits % 2 == 1

    return inside


def _rings_text(rings):
    return ", ".join("(" + ", ".join(f"{x!r} {y!r}" for x, y in r) + ")" for r in rings)


def test_clip_gives_the_pieces_a_pixel_count_finds(spark):
    comb = [(0.0, 0.0), (10.0, 0.0), (10.0, 2.0), (2.0, 2.0), (2.0, 4.0), (10.0, 4.0), (10.0, 6.0), (2.0, 6.0), (2.0, 8.0), (10.0, 8.0), (10.0, 10.0), (0.0, 10.0), (0.0, 0.0)]
    hole = [(4.0, 4.4), (8.0, 4.4), (8.0, 5.6), (4.0, 5.6), (4.0, 4.4)]
    shapes = [[comb], [comb, hole], [comb[::-1], hole], *([star(k, 5.0, 5.0, 2.6, 5.0)] for k in range(5, 15)), [star(9, 5.0, 5.0, 3.0, 5.0), star(5, 5.0, 5.0, 0.6, 1.2)]]
    boxes = [(-1.0, -1.0, 11.0, 11.0), (3.0, 0.0, 12.0, 10.0), (5.0, 1.0, 7.0, 9.0), (1.0, 3.0, 6.0, 5.0), (0.3, 0.2, 4.7, 9.6), (20.0, 0.0, 30.0, 10.0)]
    rows = [(k, f"POLYGON ({_rings_text(s)})", *b) for k, s in enumerate(shapes) for b in boxes]
    df = spark.createDataFrame(rows, "k int, t string, x0 double, y0 double, x1 double, y1 double").withColumn("parts", geo.parse_polygon(F.col("t")))
    cut = spatial.clip_boxes(df, "parts", F.struct("x0", "y0", "x1", "y1")).select("*", geo.area(F.col("parts")).alias("a"), F.size("parts").alias("n"), geo.valid(F.col("parts")).alias("ok"))
    for r in cut.collect():
        box = (r["x0"], r["y0"], r["x1"], r["y1"])
        area, pieces = _pixels(_even_odd(shapes[r["k"]]), box, 120)
        assert abs(r["a"] - area) < 0.02 * (box[2] - box[0]) * (box[3] - box[1]), (r["k"], box)
        assert r["n"] == pieces and (r["ok"] or not r["n"]), (r["k"], box)


def _recursion(rings, lines, most, depth):
    """Boxes of the final pieces of a shape, by pixels of 1/8 that the shape with right angles covers whole."""
    inside, n = _even_odd(rings), 80
    every = {(i, j) for i in range(n) for j in range(n) if inside((i + 0.5) / 8, (j + 0.5) / 8)}

    def cut(held, d):
        xs, ys = [i for i, _ in held], [j for _, j in held]
        x0, y0, x1, y1 = min(xs) / 8, min(ys) / 8, (max(xs) + 1) / 8, (max(ys) + 1) / 8
        count = sum((int(x * 8), int(y * 8)) in held for x, y in lines)
        if count <= most or d == depth:
            return [(d, x0, y0, x1, y1, count, len(held) / 64)]
        out = []
        for low in (True, False):
            half = {(i, j) for i, j in held if ((j + 0.5) / 8 < (y0 + y1) / 2 if y1 - y0 >= x1 - x0 else (i + 0.5) / 8 < (x0 + x1) / 2) == low}
            out += cut(half, d + 1) if half else []
        return out

    return sorted(cut(every, 0))


@pytest.mark.parametrize("window", [None, 1000.0])
def test_territory_with_a_hole(spark, window):
    r = random.Random(4)
    shell = [(0.0, 0.0), (8.0, 0.0), (8.0, 2.0), (2.0, 2.0), (2.0, 6.0), (8.0, 6.0), (8.0, 8.0), (0.0, 8.0), (0.0, 0.0)]
    hole = [(0.5, 3.0), (1.5, 3.0), (1.5, 5.0), (0.5, 5.0), (0.5, 3.0)]
    points = [(r.uniform(0, 9), r.choice([r.uniform(0, 2), r.uniform(0, 9)])) for _ in range(300)]
    lines = spark.createDataFrame([(f"LINESTRING ({x!r} {y!r}, {x!r} {y!r})",) for x, y in points], "line_wkt string")
    roots = spark.createDataFrame([("a", f"POLYGON ({_rings_text([shell, hole])})"), ("empty", "POLYGON ((40 40, 41 40, 41 41, 40 40))")], "root string, wkt string")
    found = territory.split(roots, lines, F.lit(1), lambda v: v > 12, 4, window, Quad(0.0, 0.0, 64.0), 5)
    parts = found.withColumn("parts", geo.parse_polygon(F.col("geo_id"))).withColumn("b", geo.bbox(geo.polygon_points(F.col("parts"))))
    whole = parts.groupBy("root", "piece", "depth", "lines").agg(*[f(f"b.{c}").alias(c) for c, f in (("x0", F.min), ("y0", F.min), ("x1", F.max), ("y1", F.max))], F.sum(geo.area(F.col("parts"))).alias("a"))
    got = sorted(tuple(x[c] for c in ("depth", "x0", "y0", "x1", "y1", "lines", "a")) for x in whole.where("root = 'a'").collect())
    assert got == _recursion([shell, hole], points, 12, 4)
    assert [(x["depth"], x["lines"]) for x in found.where("root = 'empty'").collect()] == [(0, 0)]
    assert parts.where(~geo.valid(F.col("parts"))).count() == 0


def test_shrink_to_text(spark):
    ring = star(60, 5, 5, 4.0, 4.7)
    text = "POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in ring) + "))"
    df = spark.createDataFrame([(text,)], "t string").select(geo.parse_polygon(F.col("t")).alias("p"))
    out = df.select(geo.shrink_to_text(F.col("p"), 900, 0.05).alias("s")).first()["s"]
    assert len(out) < 900 < len(text)
    area = df.select(geo.area(geo.parse_polygon(F.lit(out))), geo.area(F.col("p"))).first()
    assert abs(area[0] - area[1]) / area[1] < 0.1


# -- tiles --------------------------------------------------------------------------------


def pack(spark, shares, limit):
    df = spark.createDataFrame([(f"t{i:02d}", s) for i, s in enumerate(shares)], "geo_id string, share_jams double")
    return [r["group"] for r in density.pack(df, limit).orderBy("geo_id").collect()]


def test_packing(spark):
    assert pack(spark, [0.01, 0.01, 0.02, 0.001, 0.015], 0.016) == ["01", "02", "03", "04", "04"]
    assert pack(spark, [0.016, 0.0, 0.0], 0.016) == ["01", "02", "02"]  # a full row stays alone
    assert pack(spark, [0.004, 0.004, 0.004, 0.004, 0.004], 0.016) == ["01"] * 4 + ["02"]


def hot_lines(spark):
    rng = random.Random(1)
    data = [("LINESTRING (1.1 1.1, 1.2 1.2)", 400)]
    data += [(f"LINESTRING ({rng.uniform(0, 8):.4f} {rng.uniform(0, 8):.4f}, {rng.uniform(0, 8):.4f} {rng.uniform(0, 8):.4f})", 1) for _ in range(300)]
    return spark.createDataFrame(data, "line_wkt string, count_lines long").withColumn("root", F.lit("a"))


def test_tiles_are_disjoint_cover_and_small_or_deepest(spark):
    root = spark.createDataFrame([("a", 0.0, 0.0, 8.0, 8.0)], "root string, x0 double, y0 double, x1 double, y1 double")
    tiles = density.katana(root, hot_lines(spark), 0.05, 7).collect()
    assert math.isclose(sum((t["bx1"] - t["bx0"]) * (t["by1"] - t["by0"]) for t in tiles), 64.0)
    assert sum(t["jams"] for t in tiles) == 700
    assert all(round(t["share_jams"], 4) <= 0.05 or t["depth"] == 7 for t in tiles)
    assert max(t["share_jams"] for t in tiles) > 0.5  # the hot line ends in one tile at the last depth
    for a in tiles:
        for b in tiles:
            if a is not b:
                assert min(a["bx1"], b["bx1"]) <= max(a["bx0"], b["bx0"]) or min(a["by1"], b["by1"]) <= max(a["by0"], b["by0"])


def test_touch_mode_counts_a_line_in_each_tile(spark):
    root = spark.createDataFrame([("a", 0.0, 0.0, 8.0, 8.0)], "root string, x0 double, y0 double, x1 double, y1 double")
    line = spark.createDataFrame([("LINESTRING (1 1, 7 1)", 10)], "line_wkt string, count_lines long").withColumn("root", F.lit("a"))
    tiles = density.katana(root, line, 0.5, 2, mode="touch").where("jams > 0").collect()
    assert sorted((t["bx0"], t["jams"]) for t in tiles) == [(0.0, 10), (4.0, 10)]


def test_groups_of_equal_size(spark):
    sizes = density.split_groups(hot_lines(spark), 7).groupBy("split").count().collect()
    assert len(sizes) == 7 and max(r["count"] for r in sizes) - min(r["count"] for r in sizes) <= 1


def test_batches_in_order(spark):
    df = spark.range(1050).select(F.lit("r").alias("region_slug"), (F.col("id") % 3).alias("ix"), F.floor(F.col("id") / 3).alias("iy"))
    got = grid.batch(df, 100).orderBy("ix", "iy").collect()
    assert [r["group"] for r in got] == [i // 100 for i in range(1050)]


def test_area_splitting(spark):
    meta = spark.createDataFrame([("r", "POLYGON ((0 0, 4 0, 4 1, 0 1, 0 0))")], "region_slug string, region_shapefile_wkt string")
    pieces = density.katana_area(meta, 15_000, 10)
    assert pieces.where("km2 > 15000").count() == 0
    assert [r["part"] for r in pieces.orderBy("part").collect()] == list(range(1, pieces.count() + 1))


def test_cells_of_a_line_across_the_map(spark):
    grid = spatial.Quad()
    texts = {"long": "LINESTRING (0 0, 101.3 -77.7, 30 30)", "back": "LINESTRING (-170 -170, 170 171)", "flat": "LINESTRING (-100 5, 100 5)",
             "steep": "LINESTRING (7 -100, 7 100)"}
    df = lines(spark, texts)
    path = geo.parse_line(F.col("line"))
    coarse = {r["id"]: {(c["ix"], c["iy"]) for c in r["c"]} for r in df.select("id", spatial.line_cells(path, grid, 6).alias("c")).collect()}
    near = {r["id"]: {(c["ix"], c["iy"]) for c in r["c"]} for r in df.select("id", spatial.near_cells(geo.edges(path), grid, 6).alias("c")).collect()}
    for name, text in texts.items():
        points = [tuple(map(float, p.split())) for p in text[12:-1].split(",")]
        seen = set()
        for (x0, y0), (x1, y1) in zip(points, points[1:]):
            for k in range(20001):
                x, y = x0 + (x1 - x0) * k / 20000, y0 + (y1 - y0) * k / 20000
                seen.add((int((x + 180) // 5.625), int((y + 180) // 5.625)))
        assert len(seen - coarse[name]) <= 3 and seen <= near[name]  # a last point on a border belongs to no run
        assert len(near[name]) <= len(seen) + 4
    # the default level of the join: cells grow with the length, not with the box
    fine = df.select(F.size(spatial.near_cells(geo.edges(path), grid, 12)).alias("n")).agg(F.max("n")).first()[0]
    assert 4096 < fine < 20000


def test_index_rows_hold_edges_of_their_cell(spark):
    grid = spatial.Quad()
    shape = "POLYGON ((-20 -30, 55 -12.5, 40.25 44, -3 9, -20 -30))"
    index = spatial.polygon_index(spark.createDataFrame([("a", shape)], "region_slug string, region_shapefile_wkt string"), grid, 8)
    width, n = 360 / 256, 0
    for r in index.collect():
        left, low = -180 + r["ix"] * width, -180 + r["iy"] * width
        for e in r["edges"]:
            n += 1
            # the edge clipped to the closed cell is not empty
            t0, t1 = 0.0, 1.0
            for p, q, a, b in ((e["x1"], e["x2"], left, left + width), (e["y1"], e["y2"], low, low + width)):
                if p != q:
                    lo, hi = sorted(((a - p) / (q - p), (b - p) / (q - p)))
                    t0, t1 = max(t0, lo), min(t1, hi)
                else:
                    assert a <= p <= b
            assert t0 <= t1 + 1e-9
    assert n > 100


def test_refined_cells_stay_inside_their_parent(spark):
    # the line's first fine cell lies outside its dense coarse cell
    df = lines(spark, {"a": "LINESTRING (1.9 0.2, 2.1 0.2, 2.9 1.9)"}).select(F.col("line").alias("line_wkt"), F.lit(1).alias("count_lines"))
    coarse = df.withColumn("cell", F.lit("4-2-1"))
    top = spark.createDataFrame([("4-2-1", 1)], "cell string, bp int")
    fine = density.refine(coarse, top, GRID, 5).first()["cell_r"]
    assert fine.split("-")[0] == "5" and [int(v) // 2 for v in fine.split("-")[1:]] == [2, 1]


def test_long_outlines_are_shortened_not_dropped(spark):
    import math

    ring = [(10 + 3 * math.cos(2 * math.pi * k / 9000), 10 + 3 * math.sin(2 * math.pi * k / 9000)) for k in range(9000)]
    text = "POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in [*ring, ring[0]]) + "))"
    assert len(text) > 200_000
    df = spark.createDataFrame([("a", text), ("b", "POLYGON ((0 0, 1 0, 1 1, 0 0))")], "region_name string, region_shapefile_wkt string")
    census = spark.createDataFrame([("A", 1)], "region_name string, population int")
    got = {r["region_name"]: r["region_shapefile_wkt"] for r in regions.import_shapes(df, census, {}).collect()}
    assert len(got["a"]) <= 200_000 and got["b"] == "POLYGON ((0 0, 1 0, 1 1, 0 0))"
    small = df.select(F.length(geo.shrink_to_text(geo.parse_polygon(F.col("region_shapefile_wkt")), 60, 0.001)).alias("n"))
    assert max(r["n"] for r in small.collect()) < 60


def test_packing_of_many_tiles(spark):
    r = random.Random(11)
    shares = [round(r.choice([0.0, 0.001, 0.004, 0.02]) * r.random(), 9) for _ in range(4000)]
    groups, held, shut = [], 0, True
    for s in (round(v * 10**9) for v in shares):
        fresh = shut or held + s > 16 * 10**6
        groups.append((groups[-1] if groups else 0) + fresh)
        held, shut = (s, s >= 16 * 10**6) if fresh else (held + s, False)
    df = spark.createDataFrame([(f"t{i:05d}", s) for i, s in enumerate(shares)], "geo_id string, share_jams double")
    got = [int(row["group"]) for row in density.pack(df, 0.016).orderBy("geo_id").collect()]
    assert got == groups
