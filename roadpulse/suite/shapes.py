"""Geometry (GEO), spatial joins (JN-06..08) and grids (GRD)."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse.functions import geo
from roadpulse.operators import filters, grid, simplify, spatial, stats
from roadpulse.plans import index, regions
from roadpulse.plans import lines as dictionary
from roadpulse.session import cut, new_path
from roadpulse.suite import views
from roadpulse.suite.registry import query, rounded, texts

# Triangles over the three points of each jam line; a second member is shifted by one in x.
_TRI = "(x0 * y1 - x1 * y0 + x1 * y2 - x2 * y1 + x2 * y0 - x0 * y2)"
_TRI2 = "(x0 * y1 - (x1 + 1) * y0 + (x1 + 1) * y2 - (x2 + 2) * y1 + (x2 + 2) * y0 - x0 * y2)"


def _triangles(spark, sf):
    path = geo.parse_line(F.col("line"))
    return views.jams(spark, sf).select("event_id", F.array(F.array(geo.close_ring(path))).alias("parts"), path.alias("path"))


def _pairs(df):
    """Triangle and its shifted twin as one multipolygon."""
    twin = F.transform(
        F.get(F.get("parts", F.lit(0)), F.lit(0)),
        lambda p, i: F.struct((p["x"] + F.when(i == 3, 0).otherwise(i)).alias("x"), p["y"].alias("y")),
    )
    return df.withColumn("multi", F.concat("parts", F.array(F.array(twin))))


_N = {k: f"({k})::decimal(12,2)::double" for k in ("x0", "y0", "x1", "y1", "x2", "y2")}


@query("geo01_parse_wkt", "jams", """
SELECT event_id, unnest([0, 1, 2]) AS i, unnest([x0, x1, x2]) AS x, unnest([y0, y1, y2]) AS y FROM jams""")
def _(spark, sf):
    df = views.jams(spark, sf).select("event_id", F.posexplode(geo.parse_line(F.col("line"))).alias("i", "p"))
    return df.select("event_id", "i", "p.x", "p.y")


@query("geo01_parse_polygon", "shape_edges", """
SELECT region_slug, round(ex1, 6) AS x, round(ey1, 6) AS y, count(*) AS n FROM shape_edges GROUP BY ALL""")
def _(spark, sf):
    parts = geo.parse_polygon(F.col("region_shapefile_wkt"))
    df = views.meta(spark, sf).select("region_slug", F.explode(geo.polygon_edges(parts)).alias("e"))
    return df.groupBy("region_slug", F.round("e.x1", 6).alias("x"), F.round("e.y1", 6).alias("y")).agg(F.count(F.lit(1)).alias("n"))


@query("geo02_to_wkt", "jams", """
SELECT event_id, 'LINESTRING (' || x0::varchar || ' ' || y0::varchar || ', ' || x1::varchar || ' ' || y1::varchar || ', '
  || x2::varchar || ' ' || y2::varchar || ')' AS line,
  'POLYGON ((' || x0::varchar || ' ' || y0::varchar || ', ' || x1::varchar || ' ' || y1::varchar || ', '
  || x2::varchar || ' ' || y2::varchar || CASE WHEN x0 <> x2 OR y0 <> y2 THEN ', ' || x0::varchar || ' ' || y0::varchar ELSE '' END || '))' AS polygon
FROM jams""")
def _(spark, sf):
    return _triangles(spark, sf).select(
        "event_id", geo.line_to_wkt(F.col("path")).alias("line"), geo.polygon_to_wkt(F.col("parts")).alias("polygon")
    )


@query("geo03_bbox", "jams", """
SELECT event_id, least(x0, x1, x2) AS x0, least(y0, y1, y2) AS y0, greatest(x0, x1, x2) AS x1, greatest(y0, y1, y2) AS y1 FROM jams""")
def _(spark, sf):
    return _triangles(spark, sf).select("event_id", geo.bbox(F.col("path")).alias("b")).select("event_id", "b.*")


@query("geo04_intersects", "jam_regions", """
SELECT event_id, met AS region_slug FROM jam_regions""")
def _(spark, sf):
    """Each distinct line is tested once and joined back to its reports."""
    rows, meta = views.jams(spark, sf).select("event_id", "line").where("event_id IS NOT NULL"), views.meta(spark, sf)
    shapes = meta.select("region_slug", geo.parse_polygon(F.col("region_shapefile_wkt")).alias("parts"))
    near = spatial.candidates(rows.select("line").distinct(), meta, "line", grid=views.GRID, resolution=5).join(shapes, "region_slug")
    met = near.where(geo.intersects(geo.parse_line(F.col("line")), F.col("parts"))).select("line", "region_slug")
    return spatial.join_polygons(rows, meta, pairs=met).select("event_id", "region_slug")


@query("geo05_line_length", "jams", """
SELECT event_id, round(sqrt((x1 - x0) ** 2 + (y1 - y0) ** 2) + sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2), 6) AS length FROM jams""")
def _(spark, sf):
    return rounded(_triangles(spark, sf).select("event_id", geo.line_length(F.col("path")).alias("length")))


def _axis(a, b, low, high, less="<"):
    enter = f"CASE WHEN {a} = {b} THEN CASE WHEN {a} >= {low} AND {a} {less} {high} THEN 0.0 ELSE 2.0 END ELSE least(({low} - {a}) / ({b} - {a}), ({high} - {a}) / ({b} - {a})) END"
    leave = f"CASE WHEN {a} = {b} THEN CASE WHEN {a} >= {low} AND {a} {less} {high} THEN 1.0 ELSE -1.0 END ELSE greatest(({low} - {a}) / ({b} - {a}), ({high} - {a}) / ({b} - {a})) END"
    return enter, leave


def share_sql(x0: str, y0: str, x1: str, y1: str, less: str = "<") -> str:
    ex, lx = _axis("px", "qx", x0, x1, less)
    ey, ly = _axis("py", "qy", y0, y1, less)
    return f"greatest(0.0, least(1.0, {lx}, {ly}) - greatest(0.0, {ex}, {ey}))"


@query("geo06_clip_length", "pieces", f"""
SELECT event_id, round(sum(sqrt((qx - px) ** 2 + (qy - py) ** 2) * {share_sql('2.5', '2.5', '7.5', '7.5')}), 6) AS inside
FROM pieces GROUP BY event_id""")
def _(spark, sf):
    box = F.struct(*[F.lit(v).alias(k) for k, v in (("x0", 2.5), ("y0", 2.5), ("x1", 7.5), ("y1", 7.5))])
    return rounded(_triangles(spark, sf).select("event_id", geo.clip_length(F.col("path"), box).alias("inside")))


@query("geo07_area", "jams shape_edges", f"""
SELECT event_id::varchar AS id, round(abs({_TRI}) / 2, 6) AS area FROM jams
UNION ALL SELECT region_slug, CASE WHEN region_slug = 'signup' THEN 11.7 + 0.64 WHEN region_slug = 'view' THEN 11.7 - 0.6 ELSE 11.7 END
FROM (SELECT DISTINCT region_slug FROM shape_edges)""")
def _(spark, sf):
    shapes = views.meta(spark, sf).select(
        F.col("region_slug").alias("id"), geo.area(geo.parse_polygon(F.col("region_shapefile_wkt"))).alias("area")
    )
    jams = _triangles(spark, sf).select(F.col("event_id").cast("string").alias("id"), geo.area(F.col("parts")).alias("area"))
    return rounded(jams.unionByName(shapes))


@query("geo08_area_km2", "jams", """
with m as (SELECT event_id, radians(x0) * 6378137 AS x0, radians(x1) * 6378137 AS x1, radians(x2) * 6378137 AS x2,
  ln(tan(radians(y0) / 2 + pi() / 4)) * 6378137 AS y0, ln(tan(radians(y1) / 2 + pi() / 4)) * 6378137 AS y1,
  ln(tan(radians(y2) / 2 + pi() / 4)) * 6378137 AS y2 FROM jams)
SELECT event_id, round(abs((x0 * y1 - x1 * y0) + (x1 * y2 - x2 * y1) + (x2 * y0 - x0 * y2)) / 2 / 1e6, 3) AS km2 FROM m""")
def _(spark, sf):
    return rounded(_triangles(spark, sf).select("event_id", geo.area_km2(F.col("parts")).alias("km2")), 3)


@query("geo09_largest_part", "jams", f"""
SELECT event_id, round(greatest(abs({_TRI}), abs({_TRI2})) / 2, 6) AS area FROM jams""")
def _(spark, sf):
    df = _pairs(_triangles(spark, sf).where(F.get("path", F.lit(0)) != F.get("path", F.lit(2))))
    lone = _triangles(spark, sf).where(F.get("path", F.lit(0)) == F.get("path", F.lit(2)))
    # a line ending where it began closes by itself: its ring has three points, the twin is built from four
    twin = lone.withColumn("parts", F.array(F.array(F.concat("path", F.slice("path", 1, 1)))))
    both = df.unionByName(_pairs(twin))
    return rounded(both.select("event_id", geo.area(geo.largest_part(F.col("multi"))).alias("area")))


@query("geo10_scale", "jams", """
with b as (SELECT *, (least(x0, x1, x2) + greatest(x0, x1, x2)) / 2 AS cx, (least(y0, y1, y2) + greatest(y0, y1, y2)) / 2 AS cy FROM jams)
SELECT event_id, round(cx + (x1 - cx) * 1.1, 6) AS x1, round(cy + (y1 - cy) * 1.1, 6) AS y1 FROM b""")
def _(spark, sf):
    df = _triangles(spark, sf).select("event_id", F.get(geo.polygon_points(geo.scale(F.col("parts"), 1.1)), F.lit(1)).alias("p"))
    return rounded(df.select("event_id", F.col("p.x").alias("x1"), F.col("p.y").alias("y1")))


@query("geo11_convex_hull", "jams shape_edges", f"""
with pts as (SELECT DISTINCT region_slug, ex1 AS x, ey1 AS y FROM shape_edges),
h as (
  SELECT a.region_slug, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS yy FROM pts a JOIN pts b ON a.region_slug = b.region_slug
  WHERE (a.x <> b.x OR a.y <> b.y) AND NOT EXISTS (
    SELECT 1 FROM pts c WHERE c.region_slug = a.region_slug AND (
      round((b.x - a.x) * (c.y - a.y) - (b.y - a.y) * (c.x - a.x), 9) < 0
      OR (round((b.x - a.x) * (c.y - a.y) - (b.y - a.y) * (c.x - a.x), 9) = 0
          AND round((c.x - a.x) * (c.x - b.x) + (c.y - a.y) * (c.y - b.y), 9) > 0))))
SELECT region_slug AS id, round(sum(ax * yy - bx * ay) / 2, 6) AS area FROM h GROUP BY 1
UNION ALL SELECT event_id::varchar, round(abs({_TRI}) / 2, 6) FROM jams""")
def _(spark, sf):
    def hull(points):
        return geo.area(geo.convex_hull(points)).alias("area")

    shapes = views.meta(spark, sf).select(
        F.col("region_slug").alias("id"), hull(geo.polygon_points(geo.parse_polygon(F.col("region_shapefile_wkt"))))
    )
    jams = _triangles(spark, sf).select(F.col("event_id").cast("string").alias("id"), hull(F.col("path")))
    return rounded(jams.unionByName(shapes))


@query("geo12_shrink_to_text", "jams", """
SELECT event_id, true AS fits, length('POLYGON ((' || x0::varchar || ' ' || y0::varchar || ', ' || x1::varchar || ' ' || y1::varchar || ', '
  || x2::varchar || ' ' || y2::varchar || CASE WHEN x0 <> x2 OR y0 <> y2 THEN ', ' || x0::varchar || ' ' || y0::varchar ELSE '' END || '))') < 62 AS kept FROM jams""")
def _(spark, sf):
    """Short texts stay as they are, longer ones are shortened until they fit."""
    text = geo.shrink_to_text(F.col("parts"), max_chars=62, step=0.05)
    df = _triangles(spark, sf).select("event_id", text.alias("t"), geo.polygon_to_wkt(F.col("parts")).alias("w"))
    return df.select("event_id", (F.length("t") < 62).alias("fits"), (F.col("t") == F.col("w")).alias("kept"))


@query("geo12_shared_outline", "", """
SELECT 5 * (max(p_partkey) + 1.0)::double AS area, 12::bigint AS unpaired, true AS fits, count(*) > 1000 AS thinned FROM part""")
def _(spark, sf):
    """Five strips with ragged common borders, shortened: edges inside still pair up, so the strips fill their frame."""
    part = views.table(spark, sf, "part")
    top = part.agg(F.max("p_partkey").cast("double") + 1).scalar()
    inner = part.select(
        F.col("p_partkey").cast("double").alias("y"), (F.col("p_partkey") % 4 + 1).alias("b"), ((F.col("p_size") - 25) / 200).cast("double").alias("off")
    ).select("b", (F.col("b") + F.col("off")).alias("x"), "y")
    ends = spark.range(6).select(F.col("id").alias("b"), F.col("id").cast("double").alias("x"), F.explode(F.array(F.lit(0.0), top)).alias("y"))
    path = F.transform(F.array_sort(F.collect_list(F.struct("y", "x"))), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    borders = cut(inner.unionByName(ends).groupBy("b").agg(path.alias("path")))
    left, right = borders.select("b", F.col("path").alias("up")), borders.select((F.col("b") - 1).alias("b"), F.col("path").alias("down"))
    ring = geo.close_ring(F.concat("down", F.reverse("up")))
    strips = left.join(right, "b").select(F.col("b").cast("string").alias("region_slug"), geo.polygon_to_wkt(F.array(F.array(ring))).alias("region_shapefile_wkt"))
    short = cut(simplify.shrink(strips, 3000, 0.001))
    parts = geo.parse_polygon(F.col("region_shapefile_wkt"))
    edges = short.select(F.explode(geo.polygon_edges(parts)).alias("e")).select("e.*")
    back = edges.select(F.col("x2").alias("x1"), F.col("y2").alias("y1"), F.col("x1").alias("x2"), F.col("y1").alias("y2"))
    unpaired = edges.join(back, ["x1", "y1", "x2", "y2"], "left_anti").agg(F.count(F.lit(1)).alias("unpaired"))
    sizes = short.agg(
        F.sum(geo.area(parts)).alias("area"), F.every(F.length("region_shapefile_wkt") < 3000).alias("fits"), F.sum(geo.vertex_count(parts)).alias("n")
    )
    points = borders.agg(F.sum(F.size("path")).alias("points"))
    both = sizes.join(F.broadcast(unpaired)).join(F.broadcast(points))  # one row each
    return rounded(both.select("area", "unpaired", "fits", (F.col("n") < F.col("points")).alias("thinned")))


@query("geo13_valid", "jams meta", """
SELECT event_id::varchar AS id, x0 <> x2 OR y0 <> y2 AS valid, CASE WHEN x0 <> x2 OR y0 <> y2 THEN 4 ELSE 3 END AS vertices FROM jams
UNION ALL SELECT region_slug, true, CASE WHEN region_slug IN ('signup', 'view') THEN 11 ELSE 6 END FROM meta
UNION ALL SELECT region_slug || '_cut', false, CASE WHEN region_slug IN ('signup', 'view') THEN 5 ELSE 6 END FROM meta""")
def _(spark, sf):
    meta = views.meta(spark, sf).select(F.col("region_slug").alias("id"), F.col("region_shapefile_wkt").alias("wkt"))
    broken = meta.select(
        F.concat("id", F.lit("_cut")).alias("id"),
        F.when(F.col("id").isin("signup", "view"), F.lit("POLYGON ((0 0, 1 0, 1 1, 0 1, 0 5))")).otherwise(
            F.replace("wkt", F.lit(" 4, "), F.lit(" four, "))
        ).alias("wkt"),
    )
    parsed = meta.unionByName(broken).select("id", geo.parse_polygon(F.col("wkt")).alias("parts"))
    jams = _triangles(spark, sf).select(F.col("event_id").cast("string").alias("id"), "parts")
    return jams.unionByName(parsed).select(
        "id", geo.valid(F.col("parts")).alias("valid"), geo.vertex_count(F.col("parts")).alias("vertices")
    )


@query("geo14_split_box", "jams", """
with b as (SELECT event_id, least(x0, x1, x2) AS l, least(y0, y1, y2) AS b, greatest(x0, x1, x2) AS r, greatest(y0, y1, y2) AS t FROM jams)
SELECT event_id, unnest([0, 1]) AS i,
  unnest(CASE WHEN t - b >= r - l THEN [l, l] ELSE [l, round(l + (r - l) / 2, 6)] END) AS x0,
  unnest(CASE WHEN t - b >= r - l THEN [b, round(b + (t - b) / 2, 6)] ELSE [b, b] END) AS y0,
  unnest(CASE WHEN t - b >= r - l THEN [r, r] ELSE [round(l + (r - l) / 2, 6), r] END) AS x1,
  unnest(CASE WHEN t - b >= r - l THEN [round(b + (t - b) / 2, 6), t] ELSE [t, t] END) AS y1 FROM b""")
def _(spark, sf):
    df = _triangles(spark, sf).select("event_id", F.posexplode(geo.split_box(geo.bbox(F.col("path")))).alias("i", "b"))
    return rounded(df.select("event_id", "i", "b.*"))


@query("geo15_clip_polygon", "jams shape_edges", f"""
SELECT event_id::varchar AS id, round(abs({_TRI}) / 2, 6) AS area FROM jams
UNION ALL SELECT region_slug, CASE WHEN region_slug = 'signup' THEN 11.7 + 0.64 WHEN region_slug = 'view' THEN 11.7 - 0.6 ELSE 11.7 END
FROM (SELECT DISTINCT region_slug FROM shape_edges)""")
def _(spark, sf):
    """Areas of the four quadrants about (4.9, 5.2) add up to the whole. Each distinct line is cut once."""
    shapes = views.meta(spark, sf).select(
        F.col("region_slug").alias("id"), geo.parse_polygon(F.col("region_shapefile_wkt")).alias("parts")
    )
    rows = views.jams(spark, sf).select(F.col("event_id").cast("string").alias("id"), "line")
    lines = rows.select("line").distinct().withColumn("parts", F.array(F.array(geo.close_ring(geo.parse_line(F.col("line"))))))
    areas = _quartered(lines, "line").withColumnRenamed("line", "_line")
    reports = rows.join(areas, F.col("line").eqNullSafe(F.col("_line"))).select("id", "area")
    return rounded(reports.unionByName(_quartered(shapes, "id")).groupBy("id").agg(F.sum("area").alias("area")))


def _quartered(shapes, key):
    """Sum of the areas of the quadrants of all shapes of a key."""
    far = 100.0
    quarters = [(-far, -far, 4.9, 5.2), (4.9, -far, far, 5.2), (-far, 5.2, 4.9, far), (4.9, 5.2, far, far)]
    every = shapes.withColumn("q", F.explode(F.array(*[F.array(*map(F.lit, q)) for q in quarters])))
    cut = spatial.clip_boxes(every, "parts", F.struct(*[F.col("q")[i].alias(k) for i, k in enumerate(("x0", "y0", "x1", "y1"))]))
    return cut.groupBy(key).agg(F.sum(geo.area(F.col("parts"))).alias("area"))


def _zones(spark, sf):
    """One vertical band per nation key below 8, named like a zone."""
    key = F.col("n_nationkey")
    low, high = (key * 1.25 - 1).cast("double"), (key * 1.25 + 0.25).cast("double")
    name = F.when(key == 3, "America/Punta_Arenas").otherwise(F.concat(F.lit("Zone/"), key.cast("string")))
    wkt = geo.polygon_to_wkt(geo.box_polygon(low, F.lit(-50.0), high, F.lit(50.0)))
    return views.table(spark, sf, "nation").select(name.alias("zone"), wkt.alias("zone_wkt"))


@query("geo17_point_zone", "meta", """
SELECT m.region_slug, CASE WHEN n_nationkey = 3 THEN 'America/Santiago' ELSE 'Zone/' || n_nationkey END AS timezone
FROM (SELECT ['click', 'error', 'purchase', 'signup', 'view'][r_regionkey + 1] AS region_slug, r_regionkey * 2 + 1.8 AS px FROM region) m
LEFT JOIN nation ON px >= n_nationkey * 1.25 - 1 AND px < n_nationkey * 1.25 + 0.25""")
def _(spark, sf):
    df = regions.prepare(views.meta(spark, sf), _zones(spark, sf), views.GRID, 5)
    return df.select("region_slug", "timezone")


def roads(spark, sf):
    """Jam lines as roads, event type as class (two classes do not count)."""
    kind = (
        F.when(F.col("region_slug") == "click", "motorway").when(F.col("region_slug") == "error", "primary")
        .when(F.col("region_slug") == "purchase", "residential").when(F.col("region_slug") == "signup", "footway")
        .otherwise("steps")
    )
    return views.jams(spark, sf).select(F.col("event_id").alias("road_id"), kind.alias("road_class"), "length", "line")


@query("geo18_road_length", "jam_regions jams", """
SELECT met AS region_slug, round(sum(length), 4) AS osm_length FROM jam_regions JOIN jams USING (event_id)
WHERE region_slug IN ('click', 'error', 'purchase') GROUP BY 1""")
def _(spark, sf):
    return rounded(regions.length_by_region(roads(spark, sf), views.meta(spark, sf), grid=views.GRID, resolution=6), 4)


# -- spatial joins ------------------------------------------------------------------------


def _lines(spark, sf):
    return views.jams(spark, sf).select("event_id", "line")


@query("jn06_join_regions", "jam_regions", "SELECT event_id, met AS region_slug FROM jam_regions")
def _(spark, sf):
    df = spatial.join_polygons(_lines(spark, sf), views.meta(spark, sf), grid=views.GRID, resolution=6)
    return df.select("event_id", "region_slug")


@query("jn06_join_regions_shuffled", "jam_regions", "SELECT event_id, met AS region_slug FROM jam_regions")
def _(spark, sf):
    """The path taken when the shapes are too large to broadcast."""
    df = spatial.join_polygons(_lines(spark, sf), views.meta(spark, sf), grid=views.GRID, resolution=6, max_edges=0)
    return df.select("event_id", "region_slug")


@query("jn06_assign_by_line", "jam_regions", "SELECT event_id, met AS region_slug FROM jam_regions")
def _(spark, sf):
    """Through the stored table of lines: half of the feed first, then all of it, which tests only the rest."""
    path, rows, meta = new_path(spark, "lines"), _lines(spark, sf), views.meta(spark, sf)
    options = {"grid": views.GRID, "resolution": 6}
    dictionary.update(spark, path, rows.where("event_id % 2 = 0"), meta, **options)
    known = dictionary.update(spark, path, rows, meta, **options)
    return spatial.join_polygons(rows, meta, pairs=known).select("event_id", "region_slug")


_CELLS = """
c as (SELECT p.*, i AS ix, j AS iy FROM pieces p,
  unnest(generate_series(floor((least(px, qx) + 8) / {w})::bigint, floor((greatest(px, qx) + 8) / {w})::bigint)) AS a(i),
  unnest(generate_series(floor((least(py, qy) + 8) / {w})::bigint, floor((greatest(py, qy) + 8) / {w})::bigint)) AS b(j))"""


def _share(w: str) -> str:
    return share_sql(f"(-8 + ix * {w})", f"(-8 + iy * {w})", f"(-8 + (ix + 1) * {w})", f"(-8 + (iy + 1) * {w})")


# centre-in-polygon cover of the scaled region shapes
_COVER = """
sc as (SELECT region_slug, (min(ex1) + max(ex1)) / 2 AS cx, (min(ey1) + max(ey1)) / 2 AS cy FROM shape_edges GROUP BY 1),
se as (SELECT region_slug, cx + (ex1 - cx) * 1.1 AS x1, cy + (ey1 - cy) * 1.1 AS y1, cx + (ex2 - cx) * 1.1 AS x2,
  cy + (ey2 - cy) * 1.1 AS y2 FROM shape_edges JOIN sc USING (region_slug)),
cand{n} as (SELECT region_slug, i AS ix, j AS iy, -8 + (i + 0.5) * {w} AS gx, -8 + (j + 0.5) * {w} AS gy
  FROM (SELECT DISTINCT region_slug FROM shape_edges), unnest(generate_series(0, {k})) AS a(i), unnest(generate_series(0, {k})) AS b(j)),
cov{n} as (SELECT region_slug, ix, iy FROM cand{n} JOIN se USING (region_slug)
  WHERE (y1 > gy) <> (y2 > gy) AND gx < x1 + (x2 - x1) * (gy - y1) / nullif(y2 - y1, 0)
  GROUP BY 1, 2, 3 HAVING count(*) % 2 = 1)"""


def _cover_sql(n: int, w: str, k: int, first: bool = True) -> str:
    text = _COVER.format(n=n, w=w, k=k)
    return text if first else text[text.index("cand"):]


@query("grd01_cover", "shape_edges", f"""
with {_cover_sql(6, '0.5', 63)}
SELECT region_slug, '6-' || ix || '-' || iy AS id, 6 AS resolution, '4-' || (ix // 4) || '-' || (iy // 4) AS id_parent,
  ((row_number() OVER (PARTITION BY region_slug ORDER BY ix, iy) - 1) // 100)::int AS "group" FROM cov6""")
def _(spark, sf):
    return grid.cover(views.meta(spark, sf), 6, 4, views.GRID).drop("wkt")


@query("grd02_parent", "shape_edges", f"""
with {_cover_sql(6, '0.5', 63)}
SELECT DISTINCT region_slug, '3-' || (ix // 8) || '-' || (iy // 8) AS up FROM cov6""")
def _(spark, sf):
    cells = grid.cover(views.meta(spark, sf), 6, 4, views.GRID)
    return cells.select("region_slug", spatial.parent_id(F.col("id"), 3).alias("up")).distinct()


@query("grd03_region_resolutions", "shape_edges", f"""
with {_cover_sql(6, '0.5', 63)}, {_cover_sql(5, '1.0', 31, False)}
SELECT region_slug, '6-' || ix || '-' || iy AS id, 6 AS resolution, '5-' || (ix // 2) || '-' || (iy // 2) AS id_parent FROM cov6
UNION ALL SELECT region_slug, '5-' || ix || '-' || iy, 5, '5-' || ix || '-' || iy FROM cov5""")
def _(spark, sf):
    return grid.region_resolutions(views.meta(spark, sf), 5, 6, grid=views.GRID).drop("wkt", "group")


@query("wn08_grid_batch", "jams", """
SELECT event_id, region_slug, ((row_number() OVER (PARTITION BY region_slug ORDER BY level, event_id) - 1) // 100)::int AS "group" FROM jams""")
def _(spark, sf):
    df = views.jams(spark, sf).select("event_id", "region_slug", "level")
    return grid.batch(df, 100, ["region_slug"], "level", "event_id").drop("level")


def _cities(spark, sf):
    """One box city per nation under its region's slug."""
    key = F.col("n_nationkey")
    x, y = (key % 5) * 2.0 + 0.1, F.floor(key / 5) * 2.0 - 0.2
    wkt = geo.polygon_to_wkt(geo.box_polygon(x.cast("double"), y.cast("double"), (x + 1.5).cast("double"), (y + 1.5).cast("double")))
    return views.table(spark, sf, "nation").select(
        views._pick(F.col("n_regionkey"), views.SLUGS).alias("region_slug"), F.col("n_name").alias("region_name"),
        wkt.alias("region_shapefile_wkt"),
    )


_CITY = """
city as (SELECT ['click', 'error', 'purchase', 'signup', 'view'][n_regionkey + 1] AS slug, n_name AS id,
  (n_nationkey % 5) * 2.0 + 0.1 AS cx, (n_nationkey // 5) * 2.0 - 0.2 AS cy FROM nation),
up as (
  SELECT slug, id, i AS ix, j AS iy FROM city, unnest(generate_series(0, 31)) AS a(i), unnest(generate_series(0, 31)) AS b(j)
  WHERE -8 + (i + 0.5) >= cx AND -8 + (i + 0.5) < cx + 1.5 AND -8 + (j + 0.5) >= cy AND -8 + (j + 0.5) < cy + 1.5),
cc as (SELECT slug, id, ix, iy FROM up UNION ALL
  SELECT slug, id, floor(cx + 8)::bigint, floor(cy + 8)::bigint FROM city WHERE id NOT IN (SELECT id FROM up))"""

_BIG = """
big as (SELECT region_slug, ex1, ey1, ex2, ey2 FROM shape_edges WHERE NOT (region_slug = 'signup' AND ey1 >= 9.5)),
bs as (SELECT region_slug, (min(ex1) + max(ex1)) / 2 AS cx, (min(ey1) + max(ey1)) / 2 AS cy FROM big GROUP BY 1),
be as (SELECT region_slug, cx + (ex1 - cx) * 1.1 AS x1, cy + (ey1 - cy) * 1.1 AS y1, cx + (ex2 - cx) * 1.1 AS x2,
  cy + (ey2 - cy) * 1.1 AS y2 FROM big JOIN bs USING (region_slug)),
bcov as (SELECT region_slug, i AS ix, j AS iy FROM be, unnest(generate_series(0, 31)) AS a(i), unnest(generate_series(0, 31)) AS b(j)
  WHERE (y1 > -7.5 + j) <> (y2 > -7.5 + j) AND -7.5 + i < x1 + (x2 - x1) * (-7.5 + j - y1) / nullif(y2 - y1, 0)
  GROUP BY 1, 2, 3 HAVING count(*) % 2 = 1)"""


@query("grd04_city_cells", "shape_edges", f"""
with {_CITY}, {_BIG}
SELECT slug AS region_slug, id, 10 AS resolution, '5-' || ix || '-' || iy AS id_parent FROM cc
UNION ALL SELECT region_slug, '5-' || ix || '-' || iy, 5, '5-' || ix || '-' || iy FROM bcov""")
def _(spark, sf):
    return grid.city_cells(_cities(spark, sf), views.meta(spark, sf), 5, views.GRID).drop("wkt", "group")


_HOUR = "year, month, day, hour, dow"


@query("jn07_assign_coarse", "pieces hours shape_edges", f"""
with {_cover_sql(5, '1.0', 31)}, {_CELLS.format(w='1.0')},
t as (SELECT DISTINCT line, ix, iy FROM c WHERE {_share('1.0')} > 0)
SELECT h.*, '5-' || t.ix || '-' || t.iy AS id_parent FROM hours h JOIN t ON h.line = t.line
JOIN cov5 v ON v.region_slug = h.region_slug AND v.ix = t.ix AND v.iy = t.iy""")
def _(spark, sf):
    cells = grid.region_resolutions(views.meta(spark, sf), 5, 6, grid=views.GRID)
    return grid.assign_coarse(views.hours(spark, sf), cells, views.GRID, 5)


@query("grd05_coarse_join", "pieces hours shape_edges", f"""
with {_cover_sql(5, '1.0', 31)}, {_CELLS.format(w='1.0')},
t as (SELECT DISTINCT line, ix, iy FROM c WHERE {_share('1.0')} > 0)
SELECT h.region_slug, '5-' || t.ix || '-' || t.iy AS id_parent, count(*) AS n_segments, sum(tci)::bigint AS tci FROM hours h JOIN t ON h.line = t.line
JOIN cov5 v ON v.region_slug = h.region_slug AND v.ix = t.ix AND v.iy = t.iy GROUP BY 1, 2""")
def _(spark, sf):
    cells = grid.cover(views.meta(spark, sf), 5, 5, views.GRID)
    coarse = grid.assign_coarse(views.hours(spark, sf), cells, views.GRID, 5)
    return coarse.groupBy("region_slug", "id_parent").agg(F.count(F.lit(1)).alias("n_segments"), F.sum("tci").alias("tci"))


def _cells(spark, sf):
    """The resolution table, written out as in production since several joins read it."""
    return cut(grid.region_resolutions(views.meta(spark, sf), 5, 6, grid=views.GRID))


def _parts(hours):
    """The share table of the lines, written out as in production since every allocation is made of it."""
    return cut(grid.shares(hours, views.GRID, 6))


def _grid_tci(spark, sf, hours=None, cells=None, parts=None):
    cells = _cells(spark, sf) if cells is None else cells
    hours = views.hours(spark, sf) if hours is None else hours
    parts = _parts(hours) if parts is None else parts
    coarse = grid.assign_coarse(hours, cells, views.GRID, 5, parts=parts, finer=1)
    return grid.allocate(coarse, cells, views.GRID, 6, parts=parts)


_ALLOC = f"""
{_cover_sql(6, '0.5', 63)}, {_cover_sql(5, '1.0', 31, False)}, {_CELLS.format(w='0.5')},
len as (SELECT line, sum(sqrt((qx - px) ** 2 + (qy - py) ** 2)) AS total FROM (SELECT DISTINCT line, piece, px, py, qx, qy FROM pieces) GROUP BY 1),
sh as (
  SELECT c.line, ix, iy, sum(CASE WHEN total > 0 THEN sqrt((qx - px) ** 2 + (qy - py) ** 2) / total ELSE 0.5 END * {_share('0.5')}) AS f
  FROM (SELECT DISTINCT line, piece, px, py, qx, qy, ix, iy FROM c) c JOIN len ON c.line = len.line GROUP BY 1, 2, 3),
alloc as (
  SELECT h.region_slug, '6-' || sh.ix || '-' || sh.iy AS grid_id, {_HOUR}, sum(tci * f) AS tci
  FROM hours h JOIN sh ON h.line = sh.line JOIN cov6 v ON v.region_slug = h.region_slug AND v.ix = sh.ix AND v.iy = sh.iy
  JOIN cov5 u ON u.region_slug = h.region_slug AND u.ix = sh.ix // 2 AND u.iy = sh.iy // 2
  WHERE f > 0 GROUP BY ALL HAVING sum(tci * f) > 0)"""


@query("grd06_grid_tci", "pieces hours shape_edges", f"""
with {_ALLOC} SELECT region_slug, grid_id, {_HOUR}, round(tci, 6) AS tci FROM alloc""")
def _(spark, sf):
    return rounded(_grid_tci(spark, sf))


@query("jn08_allocate", "pieces hours shape_edges", f"""
with {_ALLOC} SELECT region_slug, grid_id, round(sum(tci), 4) AS tci FROM alloc GROUP BY ALL""")
def _(spark, sf):
    cells = _cells(spark, sf)
    coarse = grid.assign_coarse(views.hours(spark, sf), cells, views.GRID, 5)
    return rounded(grid.allocate(coarse, cells, views.GRID, 6, time=()), 4)


_CITY_ALLOC = f"""
{_CITY}, {_BIG},
len as (SELECT line, sum(sqrt((qx - px) ** 2 + (qy - py) ** 2)) AS total FROM (SELECT DISTINCT line, piece, px, py, qx, qy FROM pieces) GROUP BY 1),
{_CELLS.format(w='1.0')},
tc as (SELECT DISTINCT line, ix, iy FROM c WHERE {_share('1.0')} > 0),
co as (SELECT h.*, tc.ix, tc.iy FROM hours h JOIN tc ON h.line = tc.line
  JOIN bcov v ON v.region_slug = h.region_slug AND v.ix = tc.ix AND v.iy = tc.iy),
sh as (
  SELECT slug, id, p.line, sum(CASE WHEN total > 0 THEN sqrt((qx - px) ** 2 + (qy - py) ** 2) / total ELSE 0.5 END
    * {share_sql('cx', 'cy', '(cx + 1.5)', '(cy + 1.5)', '<=')}) AS f
  FROM city, (SELECT DISTINCT line, piece, px, py, qx, qy FROM pieces) p JOIN len ON p.line = len.line GROUP BY 1, 2, 3)
SELECT co.region_slug, cc.id AS grid_id, {_HOUR}, round(sum(tci * f), 5) AS tci
FROM co JOIN cc ON cc.slug = co.region_slug AND cc.ix = co.ix AND cc.iy = co.iy
JOIN sh ON sh.slug = cc.slug AND sh.id = cc.id AND sh.line = co.line WHERE f > 1e-9 AND tci > 0 GROUP BY ALL"""


def city_tci(spark, sf, hours=None):
    cells = cut(grid.city_cells(_cities(spark, sf), views.meta(spark, sf), 5, views.GRID))
    coarse = grid.assign_coarse(views.hours(spark, sf) if hours is None else hours, cells, views.GRID, 5)
    return grid.allocate_cities(coarse, cells, views.GRID, 6).where("tci > 1e-9")


@query("grd06_city_tci", "pieces hours shape_edges", f"with {_CITY_ALLOC}")
def _(spark, sf):
    return rounded(city_tci(spark, sf), 5)


# -- cell indices -------------------------------------------------------------------------

def _grid_split(last, start):
    return f"""
gb as (SELECT * FROM alloc WHERE make_date(year, month, day) <= DATE '{last}'),
gd as (SELECT * FROM alloc WHERE make_date(year, month, day) >= DATE '{start}')"""


_GRID_SPLIT = _grid_split(views.BASE_END, views.START)
#: Cells seldom have the same hour and day of week twice in the small tables, so the hourly index takes a longer baseline.
_LONG_BASE = ("2024-01-15", "2024-01-16")


def _split(spark, sf, last=views.BASE_END, start=views.START):
    hours, cells = views.hours(spark, sf), _cells(spark, sf)
    base = filters.between_dates(hours, views.BASE_START, last)
    parts = _parts(hours)
    return _grid_tci(spark, sf, filters.on_or_after(hours, start), cells, parts), _grid_tci(spark, sf, base, cells, parts)


@query("idx05_cities_daily", "pieces hours shape_edges", f"""
with {_ALLOC}, {_GRID_SPLIT},
h as (SELECT region_slug, grid_id, dow, avg(s) AS e FROM (
  SELECT region_slug, grid_id, month, day, dow, sum(tci) AS s FROM gb GROUP BY ALL) GROUP BY ALL),
d as (SELECT region_slug, grid_id, month, day, dow, sum(tci) AS tci FROM gd GROUP BY ALL)
SELECT d.region_slug, d.grid_id, d.month, d.day, d.dow, round(tci, 6) AS tci, round(e, 6) AS expected_2020,
  round((tci / e - 1) * 100, 4) AS tci_perc_change
FROM d JOIN h ON d.region_slug = h.region_slug AND d.grid_id = h.grid_id AND d.dow = h.dow""")
def _(spark, sf):
    df = index.cities_daily(*_split(spark, sf))
    return rounded(rounded(df, 4, ("tci_perc_change",)))


@query("idx06_cities_weekly", "pieces hours shape_edges", f"""
with {_ALLOC}, {_GRID_SPLIT},
h as (SELECT region_slug, grid_id, sum(m) AS e FROM (SELECT region_slug, grid_id, dow, avg(s) AS m FROM (
  SELECT region_slug, grid_id, month, day, dow, sum(tci) AS s FROM gb GROUP BY ALL) GROUP BY ALL) GROUP BY ALL),
d as (SELECT region_slug, grid_id, week(make_date(year, month, day))::int AS week_number, min_by(month, dow) AS min_month,
  min_by(day, dow) AS min_day, max_by(month, dow) AS max_month, max_by(day, dow) AS max_day, sum(tci) AS tci FROM gd GROUP BY 1, 2, 3)
SELECT d.* REPLACE (round(tci, 6) AS tci), round(e, 6) AS expected_2020, round((d.tci / e - 1) * 100, 4) AS tci_perc_change
FROM d JOIN h ON d.region_slug = h.region_slug AND d.grid_id = h.grid_id""")
def _(spark, sf):
    df = index.cities_weekly(*_split(spark, sf))
    return rounded(rounded(df, 4, ("tci_perc_change",)))


@query("idx07_cities_hourly", "pieces hours shape_edges meta", f"""
with {_ALLOC}, {_grid_split(*_LONG_BASE)},
h as (SELECT region_slug, grid_id, hour, dow, avg(tci) AS e FROM gb GROUP BY ALL)
SELECT m.timezone, strftime(make_timestamp(d.year, d.month, d.day, d.hour, 0, 0) - INTERVAL 1 HOUR *
    CASE m.region_slug WHEN 'click' THEN 3 WHEN 'error' THEN 6 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 5 END, '%Y-%m-%d %H:%M:%S') AS timestamp_local,
  strftime(make_timestamp(d.year, d.month, d.day, d.hour, 0, 0), '%Y-%m-%d %H:%M:%S') AS timestamp,
  d.region_slug, d.grid_id, d.month, d.day, d.hour, d.dow, round(tci, 6) AS tci, round(e, 6) AS expected_2020,
  round((tci / e - 1) * 100, 2) AS tci_perc_change
FROM gd d JOIN h ON d.region_slug = h.region_slug AND d.grid_id = h.grid_id AND d.dow = h.dow AND d.hour = h.hour
JOIN meta m ON m.region_slug = d.region_slug""")
def _(spark, sf):
    df = index.cities_hourly(*_split(spark, sf, *_LONG_BASE), views.meta(spark, sf)).drop("last_updated_utc")
    return rounded(rounded(texts(df), 2, ("tci_perc_change",)))


@query("idx08_grid_hourly", "pieces hours shape_edges meta", f"""
with {_ALLOC}
SELECT m.timezone, strftime(make_timestamp(d.year, d.month, d.day, d.hour, 0, 0) - INTERVAL 1 HOUR *
    CASE m.region_slug WHEN 'click' THEN 3 WHEN 'error' THEN 6 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 5 END, '%Y-%m-%d %H:%M:%S') AS timestamp_local,
  strftime(make_timestamp(d.year, d.month, d.day, d.hour, 0, 0), '%Y-%m-%d %H:%M:%S') AS timestamp,
  d.grid_id, d.month, d.day, d.hour, d.dow, round(tci, 6) AS tci, d.region_slug, d.year
FROM alloc d JOIN meta m ON m.region_slug = d.region_slug""")
def _(spark, sf):
    return rounded(texts(index.grid_hourly(_grid_tci(spark, sf), views.meta(spark, sf)).drop("last_updated_utc")))


@query("reg05_reliability", "pieces hours shape_edges", f"""
with {_ALLOC},
dd as (SELECT grid_id, avg(v) AS dm, stddev_pop(v) / avg(v) AS dc FROM (SELECT grid_id, day, sum(tci) AS v FROM alloc GROUP BY ALL) GROUP BY ALL),
ww as (SELECT grid_id, stddev_pop(v) / avg(v) AS wc FROM (
  SELECT grid_id, w, avg(d) AS v FROM (SELECT grid_id, week(make_date(year, month, day)) AS w, day, sum(tci) AS d FROM alloc GROUP BY ALL)
  GROUP BY ALL HAVING count(*) >= 1) GROUP BY ALL),
cells as (SELECT DISTINCT grid_id, 150.0 AS osm_length FROM alloc)
SELECT cells.grid_id, round(dm / osm_length, 6) AS osm_index, coalesce(dc < 0.9 AND dm / osm_length > 0.1, false) AS daily_reliable,
  coalesce(wc < 0.5 AND dm / osm_length > 0.1, false) AS weekly_reliable
FROM cells LEFT JOIN dd USING (grid_id) LEFT JOIN ww USING (grid_id)""")
def _(spark, sf):
    tci = _grid_tci(spark, sf)
    cells = tci.select("grid_id").distinct().withColumn("osm_length", F.lit(150.0))
    daily, weekly = stats.grid_variation(tci, "daily"), stats.grid_variation(tci, "weekly", full_weeks=False)
    df = regions.reliability(daily, weekly, cells, daily_limit=0.9)
    return rounded(df.select("grid_id", "osm_index", "daily_reliable", "weekly_reliable"))
