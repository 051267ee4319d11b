"""Density partitions (DEN), packing (WN-09), complements (GEO-16)."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse.functions import geo
from roadpulse.operators import density, outlines, stats, territory
from roadpulse.session import cut
from roadpulse.suite import views
from roadpulse.suite.registry import query, rounded
from roadpulse.suite.shapes import _CELLS, _share, share_sql

LINES = """lines as (
  SELECT line AS line_wkt, count(*) AS count_lines, any_value(x0) AS x, any_value(y0) AS y FROM jams GROUP BY 1)"""
EXTENT = (0.0, 0.0, 10.0, 10.0)


def lines(spark, sf):
    return stats.line_counts(views.jams(spark, sf))


def extent(spark, sf):
    """The territory to split: a parameter of the splitting, one box."""
    return spark.range(1).select(
        F.lit("all").alias("root"), *[F.lit(v).alias(k) for k, v in zip(("x0", "y0", "x1", "y1"), EXTENT)]
    )


def tiles(spark, sf, share=0.01, depth=10, mode="owner"):
    held = lines(spark, sf).withColumn("root", F.lit("all"))
    return density.katana(extent(spark, sf), held, share, depth, mode)


def stored(spark, sf):
    """The tile table, written out as in production since several steps read it."""
    return cut(tiles(spark, sf))


# Independent form of the splitting: top-down, each box counted on its own.
KATANA = """
tot as (SELECT sum(count_lines) AS total FROM lines),
k(depth, x0, y0, x1, y1, jams, n) as (
  SELECT 0, 0.0::double, 0.0::double, 10.0::double, 10.0::double, sum(count_lines)::bigint, count(*) FROM lines
  WHERE x >= 0 AND x <= 10 AND y >= 0 AND y <= 10
  UNION ALL
  SELECT h.depth + 1, hx0, hy0, hx1, hy1, coalesce(sum(l.count_lines), 0)::bigint, count(l.count_lines)
  FROM (SELECT depth, CASE WHEN y1 - y0 >= x1 - x0 THEN x0 ELSE x0 + b * (x1 - x0) / 2 END AS hx0,
    CASE WHEN y1 - y0 >= x1 - x0 THEN y0 + b * (y1 - y0) / 2 ELSE y0 END AS hy0,
    CASE WHEN y1 - y0 >= x1 - x0 THEN x1 ELSE x0 + (b + 1) * (x1 - x0) / 2 END AS hx1,
    CASE WHEN y1 - y0 >= x1 - x0 THEN y0 + (b + 1) * (y1 - y0) / 2 ELSE y1 END AS hy1
    FROM k, tot, (VALUES (0), (1)) AS s(b) WHERE round(jams / total, 4) > {share} AND depth < {depth}) h
  LEFT JOIN lines l ON l.x >= hx0 AND l.x < hx1 AND l.y >= hy0 AND l.y < hy1
  GROUP BY ALL),
final as (SELECT k.*, jams / total AS share FROM k, tot WHERE round(jams / total, 4) <= {share} OR depth = {depth})"""


def _katana(share, depth):
    return f"with recursive {LINES}, {KATANA.format(share=share, depth=depth)}"


@query("den05_katana", "jams", f"""
{_katana(0.01, 10)}
SELECT depth, x0, y0, x1, y1, n AS lines, jams, round(share, 6) AS share_jams FROM final""")
def _(spark, sf):
    df = tiles(spark, sf)
    return rounded(df.select(
        "depth", F.col("bx0").alias("x0"), F.col("by0").alias("y0"), F.col("bx1").alias("x1"), F.col("by1").alias("y1"),
        "lines", "jams", "share_jams"))


@query("den05_katana_touch", "jams pieces", f"""
with recursive {LINES},
lp as (SELECT DISTINCT p.line, px, py, qx, qy, count_lines FROM pieces p JOIN lines l ON l.line_wkt = p.line),
tot as (SELECT sum(count_lines) AS total FROM lines),
axes as (SELECT d, (d + 1) // 2 AS ny, d // 2 AS nx FROM unnest(generate_series(0, 6)) AS t(d)),
boxes as (
  SELECT d, i, j, i * 10.0 / 2 ** nx AS x0, j * 10.0 / 2 ** ny AS y0, (i + 1) * 10.0 / 2 ** nx AS x1, (j + 1) * 10.0 / 2 ** ny AS y1
  FROM axes, unnest(generate_series(0, (2 ** nx)::bigint - 1)) AS a(i), unnest(generate_series(0, (2 ** ny)::bigint - 1)) AS b(j)),
node as (
  SELECT d, i, j, x0, y0, x1, y1, coalesce(sum(count_lines), 0)::bigint AS jams, count(count_lines) AS n FROM (
    SELECT DISTINCT d, i, j, x0, y0, x1, y1, line, count_lines FROM boxes LEFT JOIN lp ON {share_sql('x0', 'y0', 'x1', 'y1')} > 0) GROUP BY ALL),
dense as (SELECT node.*, round(jams / total, 4) > 0.05 AS big, jams / total AS share FROM node, tot)
SELECT c.d::int AS depth, c.x0, c.y0, c.x1, c.y1, c.n AS lines, c.jams, round(c.share, 6) AS share_jams
FROM dense c LEFT JOIN dense p ON p.d = c.d - 1
  AND p.i = CASE WHEN c.d % 2 = 0 THEN c.i // 2 ELSE c.i END AND p.j = CASE WHEN c.d % 2 = 1 THEN c.j // 2 ELSE c.j END
WHERE (c.d = 0 OR p.big) AND (NOT c.big OR c.d = 6)""")
def _(spark, sf):
    df = tiles(spark, sf, 0.05, 6, "touch")
    return rounded(df.select(
        "depth", F.col("bx0").alias("x0"), F.col("by0").alias("y0"), F.col("bx1").alias("x1"), F.col("by1").alias("y1"),
        "lines", "jams", "share_jams"))


# Two territories with right angles: a concave one with a hole that the cuts run through, and one of two members.
TERRITORY = {
    "bay": "POLYGON ((0 0, 7 0, 7 3, 3 3, 3 6, 7 6, 7 10, 0 10, 0 0), (0.5 4, 2 4, 2 5.25, 0.5 5.25, 0.5 4))",
    "isles": "MULTIPOLYGON (((7.5 0, 10 0, 10 4, 7.5 4, 7.5 0)), ((8 5, 10 5, 10 10, 8 10, 8 5)))",
}
#: The same as boxes that touch each other.
_BOXES = {
    "bay": [(0, 0, 7, 3), (0, 3, 3, 4), (0, 4, 0.5, 5.25), (2, 4, 3, 5.25), (0, 5.25, 3, 6), (0, 6, 7, 10)],
    "isles": [(7.5, 0, 10, 4), (8, 5, 10, 10)],
}


def _territory_sql(weight, dense, depth):
    """All halves of all pieces as lists of boxes, each counted on its own against every line; then the first not too dense."""
    roots = ", ".join(
        f"('{k}', [{', '.join('{' + ', '.join(f"'{n}': {v}::double" for n, v in zip(('a', 'b', 'c', 'd'), box)) + '}' for box in boxes)}])" for k, boxes in _BOXES.items()
    )
    ends = {n: f"list_{f}(list_transform(q, lambda r: r.{n}))" for n, f in (("a", "min"), ("b", "min"), ("c", "max"), ("d", "max"))}
    interval = {
        axis: (
            f"CASE WHEN p{axis} = q{axis} THEN (CASE WHEN p{axis} BETWEEN r.{lo} AND r.{hi} THEN 0 ELSE 2 END) ELSE least((r.{lo} - p{axis}) / (q{axis} - p{axis}), (r.{hi} - p{axis}) / (q{axis} - p{axis})) END",
            f"CASE WHEN p{axis} = q{axis} THEN 1 ELSE greatest((r.{lo} - p{axis}) / (q{axis} - p{axis}), (r.{hi} - p{axis}) / (q{axis} - p{axis})) END",
        )
        for axis, lo, hi in (("x", "a", "c"), ("y", "b", "d"))
    }
    meets = f"greatest(0, {interval['x'][0]}, {interval['y'][0]}) <= least(1, {interval['x'][1]}, {interval['y'][1]})"
    return f"""
with recursive {LINES},
seg as (SELECT line, px, py, qx, qy FROM pieces GROUP BY ALL),
measured as (SELECT line_wkt, count_lines, sum(sqrt((qx - px) ** 2 + (qy - py) ** 2)) AS len FROM lines JOIN seg ON line = line_wkt GROUP BY ALL),
tot as (SELECT sum(count_lines) AS total FROM lines),
tree(root, piece, depth, q) as (
  SELECT root, '', 0, q FROM (VALUES {roots}) AS t(root, q)
  UNION ALL
  SELECT root, piece || b, depth + 1, list_filter(list_transform(q, lambda r: CASE WHEN tall
      THEN {{'a': r.a, 'b': CASE WHEN b = 0 THEN r.b ELSE greatest(r.b, my) END, 'c': r.c, 'd': CASE WHEN b = 0 THEN least(r.d, my) ELSE r.d END}}
      ELSE {{'a': CASE WHEN b = 0 THEN r.a ELSE greatest(r.a, mx) END, 'b': r.b, 'c': CASE WHEN b = 0 THEN least(r.c, mx) ELSE r.c END, 'd': r.d}} END),
    lambda r: r.c > r.a AND r.d > r.b)
  FROM (SELECT *, y1 - y0 >= x1 - x0 AS tall, x0 + (x1 - x0) / 2 AS mx, y0 + (y1 - y0) / 2 AS my
    FROM (SELECT *, {ends['a']} AS x0, {ends['b']} AS y0, {ends['c']} AS x1, {ends['d']} AS y1 FROM tree WHERE depth < {depth} AND len(q) > 0)), (VALUES (0), (1)) AS s(b)),
node as (SELECT * FROM tree WHERE len(q) > 0),
met as (SELECT DISTINCT root, piece, line FROM (SELECT root, piece, unnest(q) AS r FROM node), seg WHERE {meets}),
sums as (SELECT root, piece, sum({weight}) AS value, count(*) AS n FROM met JOIN measured ON line_wkt = line GROUP BY 1, 2),
judged as (SELECT node.*, coalesce(value, 0) AS value, coalesce(n, 0) AS n, {dense.format(v="coalesce(value, 0)")} AS dense
  FROM node LEFT JOIN sums USING (root, piece), tot)
SELECT root, piece, depth::int AS depth, round({ends['a']}, 6) AS x0, round({ends['b']}, 6) AS y0, round({ends['c']}, 6) AS x1, round({ends['d']}, 6) AS y1,
  round(list_sum(list_transform(q, lambda r: (r.c - r.a) * (r.d - r.b))), 6) AS area, n::bigint AS lines, round(value, 6)::double AS value
FROM judged j WHERE (NOT dense OR depth = {depth})
  AND NOT EXISTS (SELECT 1 FROM judged u WHERE u.root = j.root AND u.depth < j.depth AND starts_with(j.piece, u.piece) AND NOT u.dense)"""


def _territory(spark, held, weight, dense, depth, **options):
    roots = spark.createDataFrame(list(TERRITORY.items()), "root string, wkt string")
    found = territory.split(roots, held, weight, dense, depth, grid=views.GRID, **options)
    parts = found.withColumn("parts", geo.parse_polygon(F.col("geo_id"))).withColumn("b", geo.bbox(geo.polygon_points(F.col("parts"))))
    whole = parts.groupBy("root", "piece", "depth", "lines", "value").agg(
        F.min("b.x0").alias("x0"), F.min("b.y0").alias("y0"), F.max("b.x1").alias("x1"), F.max("b.y1").alias("y1"), F.sum(geo.area(F.col("parts"))).alias("area")
    )
    return rounded(whole.withColumn("value", F.col("value").cast("double")))


@query("den05_territory", "jams pieces", _territory_sql("count_lines", "round({v} / total, 4) > 0.05", 5))
def _(spark, sf):
    held = cut(lines(spark, sf))  # the total is asked for at every level
    total = held.agg(F.sum("count_lines")).scalar()
    return _territory(spark, held, F.col("count_lines"), lambda v: F.round(v / total, 4) > 0.05, 5)


@query("den05_lines_two_stage", "jams pieces", _territory_sql("1", "{v} > 90", 5))
def _(spark, sf):
    """At most ninety lines a piece; pieces that clearly hold more are cut by the sums of coarse cells."""
    return _territory(spark, lines(spark, sf), F.lit(1), lambda v: v > 90, 5, window=40.0, resolution=8)


@query("den05_length", "jams pieces", _territory_sql("len", "{v} > 60", 5))
def _(spark, sf):
    return _territory(spark, lines(spark, sf), geo.line_length(geo.parse_line(F.col("line_wkt"))), lambda v: v > 60, 5)


@query("den01_line_counts", "jams", f"""
SELECT line AS line_wkt, count(*) AS count_lines FROM jams WHERE datetime BETWEEN '20240105' AND '20240120' GROUP BY 1""")
def _(spark, sf):
    from roadpulse.sources import io

    days = [f"202401{d:02d}" for d in range(5, 21)]
    return stats.line_counts(io.on_days(views.jams(spark, sf), days))


_CELL5 = f"""
{LINES}, {_CELLS.format(w='2.0')},
t as (SELECT DISTINCT line, ix, iy FROM c WHERE {_share('2.0')} > 0 AND ix BETWEEN 4 AND 7),
lc as (
  SELECT line_wkt, count_lines, coalesce('4-' || f.ix || '-' || f.iy, '(MISSING)') AS cell
  FROM lines LEFT JOIN (SELECT line, min((ix, iy)) AS m, (min((ix, iy)))[1] AS ix, (min((ix, iy)))[2] AS iy FROM t GROUP BY 1) f
  ON f.line = line_wkt)"""


def _cover(spark, sf):
    """Cells of level 4 in columns 4 to 7 that hold a line start."""
    start = F.get(geo.parse_line(F.col("line_wkt")), F.lit(0))
    cells = lines(spark, sf).select(views.GRID.ix(start["x"], 4).alias("ix"), views.GRID.iy(start["y"], 4).alias("iy"))
    rows = cells.agg(F.min("iy").alias("a"), F.max("iy").alias("b"))
    return rows.select(F.explode(F.expr("sequence(4L, 7L)")).alias("ix"), "a", "b").select(
        "ix", F.explode(F.sequence(F.col("a") - 2, F.col("b") + 2)).alias("iy")
    )


def _coarse(spark, sf):
    return density.line_to_cell(lines(spark, sf), _cover(spark, sf), views.GRID, 4)


@query("den02_line_to_cell", "jams pieces", f"with {_CELL5} SELECT * FROM lc")
def _(spark, sf):
    return _coarse(spark, sf)


@query("ag14_distribution", "jams pieces", f"""
with {_CELL5} SELECT cell, count(*) AS lines, sum(count_lines)::bigint AS jams FROM lc GROUP BY 1""")
def _(spark, sf):
    return density.distribution(_coarse(spark, sf), "cell")


_TOP = f"""{_CELL5},
top as (SELECT cell, count(*) AS lines, sum(count_lines)::bigint AS jams FROM lc WHERE cell <> '(MISSING)' GROUP BY 1
  ORDER BY lines DESC, cell LIMIT 6)"""


@query("srt01_top_cells", "jams pieces", f"""
with {_TOP} SELECT *, row_number() OVER (ORDER BY lines DESC, cell)::int AS bp FROM top""")
def _(spark, sf):
    return density.top_cells(density.distribution(_coarse(spark, sf), "cell"), 6)


@query("den03_refine", "jams pieces", f"""
with {_TOP}, {_CELLS.format(w='1.0').replace('c as', 'c5 as')},
f as (SELECT line, min((ix, iy)) AS m FROM (SELECT line, ix, iy FROM c5 WHERE {_share('1.0')} > 0) JOIN lc ON line_wkt = line
  WHERE cell = '4-' || floor(ix / 2)::bigint || '-' || floor(iy / 2)::bigint GROUP BY 1)
SELECT lc.line_wkt, lc.count_lines, lc.cell, CASE WHEN top.cell IS NOT NULL THEN '5-' || f.m[1] || '-' || f.m[2] ELSE lc.cell END AS cell_r
FROM lc LEFT JOIN top ON top.cell = lc.cell LEFT JOIN f ON f.line = lc.line_wkt""")
def _(spark, sf):
    coarse = _coarse(spark, sf)
    top = density.top_cells(density.distribution(coarse, "cell"), 6)
    return density.refine(coarse, top, views.GRID, 5).drop("bp")


@query("den04_split_groups", "jams", f"""
with {LINES}, n as (SELECT count(*) AS n FROM lines)
SELECT g::int AS split, (ceil(g * n / 6.0) - ceil((g - 1) * n / 6.0))::bigint AS size FROM n, unnest(generate_series(1, 6)) AS s(g)""")
def _(spark, sf):
    return density.split_groups(lines(spark, sf), 6).groupBy("split").agg(F.count(F.lit(1)).alias("size"))


@query("den06_katana_area", "shape_edges", """
SELECT region_slug, (CASE WHEN region_slug = 'signup' THEN 11.7 + 0.64 WHEN region_slug = 'view' THEN 11.7 - 0.6 ELSE 11.7 END)::double AS area,
  true AS small, true AS numbered FROM (SELECT DISTINCT region_slug FROM shape_edges)""")
def _(spark, sf):
    pieces = density.katana_area(views.meta(spark, sf), 20_000, 20).withColumn("parts", geo.parse_polygon(F.col("wkt")))
    df = pieces.groupBy("region_slug").agg(
        F.sum(geo.area(F.col("parts"))).alias("area"), F.every(F.col("km2") <= 20_000).alias("small"),
        (F.max("part") == F.count(F.lit(1))).alias("numbered"),
    )
    return rounded(df)


_ASSIGN = f"""
{_katana(0.01, 10)},
asg as (SELECT l.line_wkt, l.count_lines, f.x0, f.y0, f.x1, f.y1, 'POLYGON ((' || f.x0 || ' ' || f.y0 || ', ' || f.x1 || ' ' || f.y0
  || ', ' || f.x1 || ' ' || f.y1 || ', ' || f.x0 || ' ' || f.y1 || ', ' || f.x0 || ' ' || f.y0 || '))' AS geo_id
  FROM lines l LEFT JOIN final f ON l.x >= f.x0 AND l.x < f.x1 AND l.y >= f.y0 AND l.y < f.y1)"""


@query("den07_assign", "jams", f"{_ASSIGN} SELECT line_wkt, count_lines, geo_id FROM asg")
def _(spark, sf):
    return density.assign(lines(spark, sf), stored(spark, sf), views.GRID, 6)


@query("den07_distribution", "jams", f"""
{_ASSIGN} SELECT geo_id, count(*) AS lines, sum(count_lines)::bigint AS jams FROM asg GROUP BY 1""")
def _(spark, sf):
    return density.distribution(density.assign(lines(spark, sf), stored(spark, sf), views.GRID, 6), "geo_id")


_TOUCH_SQL = f"""
{_ASSIGN}, fin as (SELECT *, 'POLYGON ((' || x0 || ' ' || y0 || ', ' || x1 || ' ' || y0
  || ', ' || x1 || ' ' || y1 || ', ' || x0 || ' ' || y1 || ', ' || x0 || ' ' || y0 || '))' AS geo_id FROM final),
tp as (SELECT DISTINCT line, geo_id FROM (SELECT DISTINCT line, px, py, qx, qy FROM pieces), fin WHERE {{share}} > 0)"""


def _touch_sql():
    return _TOUCH_SQL.replace("{share}", share_sql("fin.x0", "fin.y0", "fin.x1", "fin.y1"))


@query("ag15_first_tile", "jams pieces", f"{_touch_sql()} SELECT line AS line_wkt, min(geo_id) AS geo_id FROM tp GROUP BY 1")
def _(spark, sf):
    return density.first_tile(density.touching(lines(spark, sf), stored(spark, sf), views.GRID, 6))


@query("jn15_attach_counts", "jams pieces", f"""
{_touch_sql()}, ft as (SELECT line AS line_wkt, min(geo_id) AS geo_id FROM tp GROUP BY 1)
SELECT l.line_wkt, ft.geo_id, l.count_lines FROM ft RIGHT JOIN lines l ON l.line_wkt = ft.line_wkt""")
def _(spark, sf):
    counts = lines(spark, sf)
    return density.attach_counts(density.first_tile(density.touching(counts, stored(spark, sf), views.GRID, 6)), counts)


def _redo(spark, sf):
    return density.redo(tiles(spark, sf, 0.05, 4), lines(spark, sf), 5.0, 0.02, 3, views.GRID, 6)


_REDO = """
k2(depth, x0, y0, x1, y1, jams) as (
  SELECT 0, x0, y0, x1, y1, jams FROM final WHERE share / 0.01 > 5.0
  UNION ALL
  SELECT h.depth + 1, hx0, hy0, hx1, hy1, coalesce(sum(l.count_lines), 0)::bigint
  FROM (SELECT depth, CASE WHEN y1 - y0 >= x1 - x0 THEN x0 ELSE x0 + b * (x1 - x0) / 2 END AS hx0,
    CASE WHEN y1 - y0 >= x1 - x0 THEN y0 + b * (y1 - y0) / 2 ELSE y0 END AS hy0,
    CASE WHEN y1 - y0 >= x1 - x0 THEN x1 ELSE x0 + (b + 1) * (x1 - x0) / 2 END AS hx1,
    CASE WHEN y1 - y0 >= x1 - x0 THEN y0 + (b + 1) * (y1 - y0) / 2 ELSE y1 END AS hy1
    FROM k2, tot, (VALUES (0), (1)) AS s(b) WHERE round(jams / total, 4) > 0.02 AND depth < 3) h
  LEFT JOIN lines l ON l.x >= hx0 AND l.x < hx1 AND l.y >= hy0 AND l.y < hy1
  GROUP BY ALL)"""


@query("den08_redo", "jams", f"""
{_katana(0.05, 4)}, {_REDO}
SELECT x0, y0, x1, y1, jams, round(share, 6) AS share_jams FROM final WHERE share / 0.01 <= 5.0
UNION ALL SELECT x0, y0, x1, y1, jams, round(jams / total, 6) FROM k2, tot WHERE round(jams / total, 4) <= 0.02 OR depth = 3""")
def _(spark, sf):
    df = _redo(spark, sf)
    return rounded(df.select(
        F.col("bx0").alias("x0"), F.col("by0").alias("y0"), F.col("bx1").alias("x1"), F.col("by1").alias("y1"), "jams", "share_jams"))


@query("jn16_latest_split", "jams", f"""
{_katana(0.05, 4)}, {_REDO},
f as (SELECT x0, y0, x1, y1, jams FROM final WHERE share / 0.01 <= 5.0
  UNION ALL SELECT x0, y0, x1, y1, jams FROM k2, tot WHERE round(jams / total, 4) <= 0.02 OR depth = 3)
SELECT 'POLYGON ((' || x0 || ' ' || y0 || ', ' || x1 || ' ' || y0 || ', ' || x1 || ' ' || y1 || ', ' || x0 || ' ' || y1 || ', '
  || x0 || ' ' || y0 || '))' AS polygon_final, jams FROM f""")
def _(spark, sf):
    first = tiles(spark, sf, 0.05, 4).select(F.col("geo_id").alias("polygon_1"), "jams")
    second = _redo(spark, sf).where("polygon_1 <> geo_id").select("polygon_1", F.col("geo_id").alias("polygon_2"), F.col("jams").alias("jams_2"))
    out = density.latest_split([first, second], ["polygon_1", "polygon_2"])
    return out.select("polygon_final", F.coalesce("jams_2", "jams").alias("jams"))


# Next-fit as a row-by-row recursion.
_PACK = """
srt as (SELECT geo_id, share, row_number() OVER (ORDER BY geo_id, share) AS i FROM dist),
p(i, g, held, shut) as (
  SELECT 1::bigint, 1, share, share >= {m} FROM srt WHERE i = 1
  UNION ALL
  SELECT s.i, CASE WHEN shut OR held + share > {m} THEN g + 1 ELSE g END,
    CASE WHEN shut OR held + share > {m} THEN share ELSE held + share END,
    CASE WHEN shut OR held + share > {m} THEN share >= {m} ELSE false END
  FROM p JOIN srt s ON s.i = p.i + 1),
grp as (SELECT geo_id, share, CASE WHEN g < 10 THEN '0' || g ELSE g::varchar END AS "group" FROM p JOIN srt USING (i))"""

_DIST = f"""
{_ASSIGN}, dist as (SELECT 'POLYGON ((' || x0 || ' ' || y0 || ', ' || x1 || ' ' || y0
  || ', ' || x1 || ' ' || y1 || ', ' || x0 || ' ' || y1 || ', ' || x0 || ' ' || y0 || '))' AS geo_id, jams / total AS share
  FROM k, tot WHERE round(jams / total, 4) <= 0.01 OR depth = 10)"""


@query("wn09_pack", "jams", f"""
{_DIST}, {_PACK.format(m=0.016)} SELECT geo_id, round(share, 8) AS share_jams, "group" FROM grp""")
def _(spark, sf):
    return rounded(density.pack(tiles(spark, sf)), 8)


@query("ag16_multipolygon", "jams", f"""
{_DIST}, {_PACK.format(m=0.016)}
SELECT "group", 'MULTIPOLYGON (' || string_agg(replace(geo_id, 'POLYGON ', ''), ', ' ORDER BY replace(geo_id, 'POLYGON ', '')) || ')' AS geo_partition_wkt,
  round(sum(share), 8) AS share_jams FROM grp GROUP BY 1""")
def _(spark, sf):
    return rounded(density.multipolygon(density.pack(tiles(spark, sf))), 8)


def _dense(df):
    return df.where("share_jams >= 0.008")


@query("geo16_complement", "jams", f"""
{_katana(0.01, 10)} SELECT x0, y0, x1, y1, '999' AS "group", 0.0::double AS share_jams FROM final WHERE share < 0.008""")
def _(spark, sf):
    cover = stored(spark, sf)
    df = density.complement(cover, _dense(cover))
    return df.select(
        F.col("bx0").alias("x0"), F.col("by0").alias("y0"), F.col("bx1").alias("x1"), F.col("by1").alias("y1"), "group", "share_jams")


def _outline_sql(boxes: str) -> str:
    """Area, length and corners of the border of each group of ``boxes`` (grp, x0, y0, x1, y1), by pairs of boxes and by
    looking into the four directions around every corner of a box."""
    seen = ", ".join(
        f"bool_or(b.x0 < px {dx} 1e-6 AND px {dx} 1e-6 < b.x1 AND b.y0 < py {dy} 1e-6 AND py {dy} 1e-6 < b.y1) AS q{k}"
        for k, (dx, dy) in enumerate((("+", "+"), ("-", "+"), ("-", "-"), ("+", "-")))
    )
    along = "greatest(0, least(a.{h}, b.{h}) - greatest(a.{l}, b.{l}))"
    return f"""
bx as ({boxes}),
touch as (SELECT a.grp, sum(CASE WHEN a.x1 = b.x0 THEN {along.format(l='y0', h='y1')} ELSE 0 END + CASE WHEN a.y1 = b.y0 THEN {along.format(l='x0', h='x1')} ELSE 0 END) AS len
  FROM bx a JOIN bx b ON a.grp = b.grp GROUP BY 1),
pt as (SELECT DISTINCT grp, unnest([x0, x0, x1, x1]) AS px, unnest([y0, y1, y0, y1]) AS py FROM bx),
q as (SELECT p.grp, px, py, {seen} FROM pt p JOIN bx b ON b.grp = p.grp AND px BETWEEN b.x0 AND b.x1 AND py BETWEEN b.y0 AND b.y1 GROUP BY 1, 2, 3),
cn as (SELECT grp, sum(CASE WHEN q0::int + q1::int + q2::int + q3::int IN (1, 3) THEN 1 WHEN q0 = q2 AND q1 = q3 AND q0 <> q1 THEN 2 ELSE 0 END)::bigint AS corners
  FROM q GROUP BY 1),
ol as (SELECT bx.grp AS "group", round(sum((x1 - x0) * (y1 - y0)), 6) AS area, round(sum(2 * (x1 - x0 + y1 - y0)) - 2 * any_value(touch.len), 6) AS length,
  any_value(corners) AS corners FROM bx JOIN touch ON touch.grp = bx.grp JOIN cn ON cn.grp = bx.grp GROUP BY 1)"""


def _outlined(found):
    """Area, length and corners from the texts of the rings."""
    ring = F.get(F.get(geo.parse_polygon(F.col("wkt")), F.lit(0)), F.lit(0))
    size = F.abs(geo.signed_area(ring)) * F.when(F.col("hole"), -1).otherwise(1)
    return rounded(found.groupBy("group").agg(
        F.sum(size).alias("area"), F.sum(geo.line_length(ring)).alias("length"), F.sum(F.size(ring) - 1).alias("corners")))


def _boxed(spark, sf):
    """The extent as a box to cut tiles out of."""
    return extent(spark, sf).select(*[F.col(c).alias(f"b{c}") for c in ("x0", "y0", "x1", "y1")])


@query("ag16_dissolve", "jams", f"""
{_DIST}, {_PACK.format(m=0.016)},
{_outline_sql("SELECT g.\"group\" AS grp, x0, y0, x1, y1 FROM grp g JOIN (SELECT DISTINCT geo_id, x0, y0, x1, y1 FROM (SELECT *, 'POLYGON ((' || x0 || ' ' || y0 || ', ' || x1 || ' ' || y0 || ', ' || x1 || ' ' || y1 || ', ' || x0 || ' ' || y1 || ', ' || x0 || ' ' || y0 || '))' AS geo_id FROM final)) t ON t.geo_id = g.geo_id")}
SELECT * FROM ol""")
def _(spark, sf):
    """Groups of tiles as outlines: no side between two tiles of a group is left."""
    return _outlined(outlines.outlines(_grouped(spark, sf)))


@query("geo16_difference", "jams", f"""
{_katana(0.01, 10)}, {_outline_sql("SELECT '999' AS grp, x0, y0, x1, y1 FROM final WHERE share < 0.008")}
SELECT * FROM ol""")
def _(spark, sf):
    """The extent without its dense tiles."""
    return _outlined(outlines.difference(_boxed(spark, sf), _dense(stored(spark, sf))))


@query("den09_geo_partitions", "jams", f"""
{_ASSIGN}, dist as (SELECT 'POLYGON ((' || x0 || ' ' || y0 || ', ' || x1 || ' ' || y0
  || ', ' || x1 || ' ' || y1 || ', ' || x0 || ' ' || y1 || ', ' || x0 || ' ' || y0 || '))' AS geo_id, share, x0, y0, x1, y1 FROM final WHERE share >= 0.008),
{_PACK.format(m=0.016)},
sh as (SELECT "group", round(sum(share), 6) AS share_jams FROM grp GROUP BY 1),
{_outline_sql("SELECT g.\"group\" AS grp, x0, y0, x1, y1 FROM grp g JOIN dist ON dist.geo_id = g.geo_id UNION ALL SELECT '999', x0, y0, x1, y1 FROM final WHERE share < 0.008")}
SELECT ol.*, coalesce(share_jams, 0) AS share_jams FROM ol LEFT JOIN sh ON sh."group" = ol."group" """)
def _(spark, sf):
    """Dense tiles packed and drawn, and what they leave of the extent."""
    parts = cut(density.geo_partitions(_dense(stored(spark, sf)), 0.016, _boxed(spark, sf)))
    shares = parts.groupBy("group").agg(F.max("share_jams").alias("share_jams"))
    return rounded(_outlined(parts).join(shares, "group"))


def _grouped(spark, sf):
    df = stored(spark, sf)
    return df.join(density.pack(df).select("geo_id", "group"), "geo_id")


@query("den10_partition_raw", "jams", f"""
{_DIST}, {_PACK.format(m=0.016)}
SELECT j.event_id, coalesce(g."group", '999') AS geo_partition_id FROM jams j JOIN asg a ON a.line_wkt = j.line
LEFT JOIN grp g ON g.geo_id = a.geo_id""")
def _(spark, sf):
    jams = views.jams(spark, sf).select("event_id", "line")
    return density.partition_raw(jams, _grouped(spark, sf), views.GRID, 6).drop("line")


@query("den11_prune", "jams jam_regions", """
SELECT event_id, met AS region_slug, true AS pruned FROM jam_regions""")
def _(spark, sf):
    """Reading only the pruned partitions loses no jam of any region (longest reach of a line: 1.2), and leaves some out."""
    from roadpulse.operators import spatial

    meta = views.meta(spark, sf)
    grouped = _grouped(spark, sf)
    frame = spark.range(1).select(
        F.lit("999").alias("group"), F.lit(-50.0).alias("bx0"), F.lit(-50.0).alias("by0"), F.lit(50.0).alias("bx1"), F.lit(50.0).alias("by1")
    )
    boxes = grouped.select("group", "bx0", "by0", "bx1", "by1").unionByName(frame)
    ids = density.prune(meta, boxes, views.GRID, 5, margin=1.2)
    raw = density.partition_raw(views.jams(spark, sf).select("event_id", "line"), grouped, views.GRID, 6)
    kept = raw.join(ids, "geo_partition_id")
    found = spatial.join_polygons(
        kept.withColumnRenamed("region_slug", "wanted"), meta, grid=views.GRID, resolution=6
    )
    read = ids.agg(F.count(F.lit(1))).scalar()
    every = meta.agg(F.count(F.lit(1))).scalar() * boxes.agg(F.countDistinct("group")).scalar()
    return found.where("wanted = region_slug").select("event_id", "region_slug", (read < every).alias("pruned"))
