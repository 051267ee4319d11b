"""Planar geometry as column expressions.

A line is ``array<struct<x,y>>``. A polygon is ``array<array<array<struct<x,y>>>>``: member
polygons, each a list of closed rings, the first ring being the shell. Everything is built-in
Spark expressions; the functions also accept the columns handed to lambda arguments.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadpulse.functions.text import unquote

EARTH_RADIUS = 6378137.0  # fixed value: web-mercator sphere, metres


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: a column used several times in an expression
    would otherwise be evaluated each time."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# -- text ---------------------------------------------------------------------------------


def _point(text: Column) -> Column:
    xy = F.split(F.trim(text), r"\s+")
    return F.struct(
        F.get(xy, F.lit(0)).try_cast("double").alias("x"),
        F.get(xy, F.lit(1)).try_cast("double").alias("y"),
    )


def _points(text: Column) -> Column:
    return F.transform(F.split(text, ","), _point)


def parse_line(text: Column) -> Column:
    """LINESTRING text to points."""
    return _points(F.regexp_extract(unquote(text), r"\(([^()]*)\)", 1))


def parse_polygon(text: Column) -> Column:
    """POLYGON or MULTIPOLYGON text (quotes ignored) to member polygons."""

    def member(part: Column) -> Column:
        bare = F.regexp_replace(part, r"^[\s(]+|[\s)]+$", "")
        return F.transform(F.split(bare, r"\)\s*,\s*\("), _points)

    def members(clean: Column) -> Column:
        body = F.regexp_replace(clean, r"(?i)^(MULTI)?POLYGON\s*", "")
        multi = F.lower(clean).startswith("multi")
        inner = F.when(multi, F.regexp_replace(body, r"^\(\s*|\s*\)$", "")).otherwise(body)
        return F.transform(F.split(inner, r"\)\s*\)\s*,\s*\(\s*\("), member)

    return let(F.trim(unquote(text)), members)


def _path_text(path: Column) -> Column:
    pairs = F.transform(path, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string")))
    return F.array_join(pairs, ", ")


def line_to_wkt(path: Column) -> Column:
    return F.concat(F.lit("LINESTRING ("), _path_text(path), F.lit(")"))


def polygon_to_wkt(parts: Column) -> Column:
    """POLYGON text for one member, MULTIPOLYGON for several."""

    def member(rings: Column) -> Column:
        shells = F.transform(rings, lambda r: F.concat(F.lit("("), _path_text(r), F.lit(")")))
        return F.concat(F.lit("("), F.array_join(shells, ", "), F.lit(")"))

    def collect(texts: Column) -> Column:
        one = F.concat(F.lit("POLYGON "), F.get(texts, F.lit(0)))
        many = F.concat(F.lit("MULTIPOLYGON ("), F.array_join(texts, ", "), F.lit(")"))
        return F.when(F.size(texts) == 1, one).otherwise(many)

    return let(F.transform(parts, member), collect)


def box_polygon(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """A box as a polygon of one closed ring, counter-clockwise from the lower left corner."""
    corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    ring = F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in corners])
    return F.array(F.array(ring))


def close_ring(ring: Column) -> Column:
    """Repeat the first point at the end unless it is already there."""
    return let(
        ring,
        lambda r: F.when(F.element_at(r, 1) == F.element_at(r, -1), r).otherwise(F.concat(r, F.slice(r, 1, 1))),
    )


# -- structure ----------------------------------------------------------------------------


def edges(path: Column) -> Column:
    """Consecutive points as ``struct<x1,y1,x2,y2>``; a single point gives one empty edge."""

    def build(p: Column) -> Column:
        n = F.greatest(F.size(p) - 1, F.lit(0))
        pairs = F.zip_with(F.slice(p, F.lit(1), n), F.slice(p, F.lit(2), n), _edge)
        return F.when(F.size(p) == 1, F.transform(p, lambda q: _edge(q, q))).otherwise(pairs)

    return let(path, build)


def _edge(a: Column, b: Column) -> Column:
    return F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2"))


def polygon_edges(parts: Column) -> Column:
    """All ring edges of a polygon."""
    return F.flatten(F.transform(F.flatten(parts), edges))


def polygon_points(parts: Column) -> Column:
    return F.flatten(F.flatten(parts))


def bbox(points: Column) -> Column:
    """``struct<x0,y0,x1,y1>`` of a list of points."""

    def build(ps: Column) -> Column:
        xs, ys = F.transform(ps, lambda p: p["x"]), F.transform(ps, lambda p: p["y"])
        return F.struct(
            F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"),
            F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"),
        )

    return let(points, build)


def vertex_count(parts: Column) -> Column:
    return F.size(polygon_points(parts))


def valid(parts: Column) -> Column:
    """Every coordinate is a number and every ring is closed with at least four points."""
    number = F.forall(polygon_points(parts), lambda p: p["x"].isNotNull() & p["y"].isNotNull())
    closed = F.forall(
        F.flatten(parts),
        lambda r: (F.size(r) >= 4) & F.get(r, F.lit(0)).eqNullSafe(F.element_at(r, -1)),
    )
    return F.coalesce(number & closed, F.lit(False))


# -- measures -----------------------------------------------------------------------------


def segment_length(e: Column) -> Column:
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    return F.sqrt(dx * dx + dy * dy)


def line_length(path: Column) -> Column:
    """Planar length in coordinate units."""
    return F.aggregate(edges(path), F.lit(0.0), lambda acc, e: acc + segment_length(e))


def _interval(a: Column, b: Column, low: Column, high: Column) -> tuple[Column, Column]:
    """Parameters at which a coordinate going from a to b is inside [low, high)."""
    step = F.nullif(b - a, F.lit(0.0))
    held = (a >= low) & (a < high)
    t0, t1 = (low - a) / step, (high - a) / step
    enter = F.when(a == b, F.when(held, 0.0).otherwise(2.0)).otherwise(F.least(t0, t1))
    leave = F.when(a == b, F.when(held, 1.0).otherwise(-1.0)).otherwise(F.greatest(t0, t1))
    return enter, leave


def box_share(e: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Share of a segment inside a half-open box; an empty segment counts 1 in its own box.

    Half-open boxes keep the mass of a segment on a shared border from being counted twice.
    """
    enter_x, leave_x = _interval(e["x1"], e["x2"], x0, x1)
    enter_y, leave_y = _interval(e["y1"], e["y2"], y0, y1)
    inside = F.least(F.lit(1.0), leave_x, leave_y) - F.greatest(F.lit(0.0), enter_x, enter_y)
    return F.greatest(F.lit(0.0), inside)


def clip_length(path: Column, box: Column) -> Column:
    """Length of a line inside a box ``struct<x0,y0,x1,y1>``."""
    return F.aggregate(
        edges(path),
        F.lit(0.0),
        lambda acc, e: acc
        + segment_length(e) * box_share(e, box["x0"], box["y0"], box["x1"], box["y1"]),
    )


def signed_area(ring: Column) -> Column:
    """Area of a closed ring, negative if it runs clockwise."""
    return F.aggregate(edges(ring), F.lit(0.0), lambda acc, e: acc + (e["x1"] * e["y2"] - e["x2"] * e["y1"])) / 2


def _ring_area(ring: Column) -> Column:
    return F.abs(signed_area(ring))


def oriented(rings: Column) -> Column:
    """Rings of a member, the shell counter-clockwise and holes clockwise."""
    return F.transform(rings, lambda r, i: F.when((signed_area(r) >= 0) == (i == 0), r).otherwise(F.reverse(r)))


def part_area(rings: Column) -> Column:
    """Shell area less its holes."""

    def net(areas: Column) -> Column:
        holes = F.aggregate(F.slice(areas, F.lit(2), F.size(areas)), F.lit(0.0), lambda a, b: a + b)
        return F.get(areas, F.lit(0)) - holes

    return let(F.transform(rings, _ring_area), net)


def area(parts: Column) -> Column:
    """Planar area in squared coordinate units."""
    return F.aggregate(F.transform(parts, part_area), F.lit(0.0), lambda a, b: a + b)


def _each_point(parts: Column, change) -> Column:
    return F.transform(parts, lambda rings: F.transform(rings, lambda r: F.transform(r, change)))


def mercator(parts: Column) -> Column:
    """Longitude/latitude degrees to web-mercator metres."""

    def project(p: Column) -> Column:
        half = F.radians(p["y"]) / 2 + F.lit(3.141592653589793 / 4)
        return F.struct(
            (F.radians(p["x"]) * EARTH_RADIUS).alias("x"),
            (F.ln(F.tan(half)) * EARTH_RADIUS).alias("y"),
        )

    return _each_point(parts, project)


def area_km2(parts: Column) -> Column:
    return area(mercator(parts)) / 1e6


# -- shapes -------------------------------------------------------------------------------


def largest_part(parts: Column) -> Column:
    """The member polygon with the largest area, as a polygon of one member."""
    ranked = F.transform(parts, lambda p: F.struct(part_area(p).alias("area"), p.alias("part")))
    return F.array(F.array_max(ranked)["part"])


def scale(parts: Column, factor: float = 1.1) -> Column:
    """Scale about the centre of the bounding box."""

    def grow(ps: Column) -> Column:
        def about(box: Column) -> Column:
            cx, cy = (box["x0"] + box["x1"]) / 2, (box["y0"] + box["y1"]) / 2
            return _each_point(
                ps,
                lambda p: F.struct(
                    (cx + (p["x"] - cx) * factor).alias("x"), (cy + (p["y"] - cy) * factor).alias("y")
                ),
            )

        return let(bbox(polygon_points(ps)), about)

    return let(parts, grow)


def _turn(a: Column, b: Column, c: Column) -> Column:
    return (b["x"] - a["x"]) * (c["y"] - a["y"]) - (b["y"] - a["y"]) * (c["x"] - a["x"])


def _chain(points: Column) -> Column:
    """Lower hull of sorted points.

    On a convex chain the left turns towards a new point form a prefix, so the chain is cut after
    the last left turn and the point appended.
    """

    def add(chain: Column, p: Column) -> Column:
        keep = F.filter(
            F.sequence(F.lit(2), F.greatest(F.size(chain), F.lit(2))),
            lambda i: (i <= F.size(chain))
            & (_turn(F.get(chain, i - 2), F.get(chain, i - 1), p) > 0),
        )
        length = F.coalesce(F.array_max(keep), F.lit(1))
        return F.concat(F.slice(chain, F.lit(1), length), F.array(p))

    def fold(ps: Column) -> Column:
        return F.aggregate(F.slice(ps, F.lit(2), F.size(ps)), F.slice(ps, 1, 1), add)

    return let(points, fold)


def convex_hull(points: Column) -> Column:
    """Convex hull of a list of points, as a polygon (monotone chain)."""

    def both(ordered: Column) -> Column:
        upper = _chain(F.reverse(ordered))
        return let(
            _chain(ordered),
            lambda lower: F.array(F.array(F.concat(F.slice(lower, F.lit(1), F.size(lower) - 1), upper))),
        )

    return let(F.array_sort(F.array_distinct(points)), both)


def snap(parts: Column, tolerance: Column) -> Column:
    """Vertices moved to a lattice, consecutive repeats and collapsed rings dropped."""

    def at(v: Column) -> Column:
        return F.round(F.round(v / tolerance) * tolerance, 9)

    def ring(points: Column) -> Column:
        moved = F.transform(points, lambda p: F.struct(at(p["x"]).alias("x"), at(p["y"]).alias("y")))
        return let(
            moved,
            lambda m: F.filter(m, lambda p, i: (i == 0) | (p != F.get(m, F.greatest(i - 1, F.lit(0))))),
        )

    rings = F.transform(parts, lambda rs: F.filter(F.transform(rs, ring), lambda r: F.size(r) >= 4))
    return F.filter(rings, lambda rs: F.size(rs) > 0)


#: Lattices that grow by one step each; further ones double.
EVEN_STEPS = 40


def shrink_to_text(parts: Column, max_chars: int = 5000, step: float = 0.005) -> Column:
    """The shape snapped to ever coarser lattices until its text is shorter than ``max_chars``.

    Lattices are ``step``, ``2 step`` ... and double later on, until they are as wide as the shape.
    They are tried one after the other, and none after the first that fits. A shape that fits none
    before it collapses becomes its bounding box.
    """

    def tolerance(k: Column) -> Column:
        doubled = F.lit(EVEN_STEPS * step) * F.pow(F.lit(2.0), k - EVEN_STEPS)
        return F.when(k <= EVEN_STEPS, k * F.lit(step)).otherwise(doubled)

    def pick(ps: Column) -> Column:
        def within(box: Column) -> Column:
            extent = F.greatest(box["x1"] - box["x0"], box["y1"] - box["y0"])
            doublings = F.ceil(F.log2(extent / (EVEN_STEPS * step))).cast("int")
            steps = EVEN_STEPS + F.greatest(F.coalesce(doublings, F.lit(0)), F.lit(0))

            def coarser(text: Column, k: Column) -> Column:
                snapped = let(snap(ps, tolerance(k)), lambda s: F.when(F.size(s) > 0, polygon_to_wkt(s)))
                return F.when(F.length(text) < max_chars, text).otherwise(F.coalesce(snapped, text))

            text = F.aggregate(F.sequence(F.lit(1), steps), polygon_to_wkt(ps), coarser)
            whole = polygon_to_wkt(box_polygon(box["x0"], box["y0"], box["x1"], box["y1"]))
            return let(text, lambda t: F.when(F.length(t) < max_chars, t).otherwise(whole))

        return let(bbox(polygon_points(ps)), within)

    return let(parts, pick)


def split_box(box: Column) -> Column:
    """Two halves of a box, cut across its longer side (across y when square)."""

    def make(a: Column, b: Column, c: Column, d: Column) -> Column:
        return F.struct(a.alias("x0"), b.alias("y0"), c.alias("x1"), d.alias("y1"))

    def halves(b: Column) -> Column:
        x0, y0, x1, y1 = (b[k] for k in ("x0", "y0", "x1", "y1"))
        mx, my = x0 + (x1 - x0) / 2, y0 + (y1 - y0) / 2
        tall = F.array(make(x0, y0, x1, my), make(x0, my, x1, y1))
        wide = F.array(make(x0, y0, mx, y1), make(mx, y0, x1, y1))
        return F.when((y1 - y0) >= (x1 - x0), tall).otherwise(wide)

    return let(box, halves)


def _chains(ring: Column, axis: str, bound: Column, keep_low: bool) -> Column:
    """Parts of a closed ring on one side of an axis-parallel line, as ``array<struct<points,a,b>>``.

    A chain begins and ends on the line, at the places ``a`` and ``b`` along it. Vertices on the line are on neither side, so
    edges along it are left to the linking and leave no bridges. A ring that does not cross the line has no chains.
    """
    other = "y" if axis == "x" else "x"

    def kept(p: Column) -> Column:
        return p[axis] < bound if keep_low else p[axis] > bound

    def of(r: Column) -> Column:
        n = F.size(r) - 1

        def crossing(i: Column) -> Column:
            p, q = F.get(r, i), F.get(r, i + 1)
            along = p[other] + (q[other] - p[other]) * (bound - p[axis]) / (q[axis] - p[axis])
            values = {axis: bound, other: along}
            return F.struct(values["x"].alias("x"), values["y"].alias("y"))

        def linked(flags: Column) -> Column:
            places = F.sequence(F.lit(0), n - 1)
            enters = F.filter(places, lambda i: ~F.get(flags, i) & F.get(flags, i + 1))
            leaves = F.filter(places, lambda i: F.get(flags, i) & ~F.get(flags, i + 1))

            def build(t: Column) -> Column:
                enters, leaves = t["enters"], t["leaves"]
                # they alternate; the way out behind the k-th way in may lie beyond the end of the ring
                behind = F.when(F.get(leaves, F.lit(0)) < F.get(enters, F.lit(0)), 1).otherwise(0)
                rest = F.slice(r, F.lit(1), n)

                def chain(i: Column, k: Column) -> Column:
                    out = F.coalesce(F.get(leaves, k + behind), F.get(leaves, F.lit(0)) + n)
                    ends = F.struct(crossing(i).alias("a"), crossing(out % n).alias("b"), out.alias("out"))
                    return let(
                        ends,
                        lambda e: F.struct(
                            F.concat(F.array(e["a"]), F.slice(t["twice"], i + 2, e["out"] - i), F.array(e["b"])).alias("points"),
                            e["a"][other].alias("a"),
                            e["b"][other].alias("b"),
                        ),
                    )

                return F.transform(enters, chain)

            rest = F.slice(r, F.lit(1), n)
            return let(F.struct(enters.alias("enters"), leaves.alias("leaves"), F.concat(rest, rest).alias("twice")), build)

        return let(F.transform(r, kept), linked)

    return let(close_ring(ring), of)


def _linked(chains: Column) -> Column:
    """Closed rings of chains: the end of each is joined to the chain that begins at the other end of its gap on the line.

    In order along the line, ends and beginnings bound the inside in pairs. Chains of one ring find the least number among
    them by pointer doubling; the ring is then read off from there.
    """

    def of(c: Column) -> Column:
        m = F.size(c)
        marks = F.array_sort(
            F.concat(
                F.transform(c, lambda e, i: F.struct(e["a"].alias("t"), i.alias("id"), F.lit(0).alias("end"))),
                F.transform(c, lambda e, i: F.struct(e["b"].alias("t"), i.alias("id"), F.lit(1).alias("end"))),
            )
        )

        def mates(s: Column) -> Column:
            pairs = F.transform(s, lambda e, k: F.struct(e["id"].alias("id"), e["end"].alias("end"), F.get(s, k + 1 - 2 * (k % 2)).alias("mate")))
            ends = F.array_sort(F.filter(pairs, lambda e: e["end"] == 1))
            return F.transform(ends, lambda e: F.when(e["mate"]["end"] == 0, e["mate"]["id"]).otherwise(e["id"]))

        def rings(after: Column) -> Column:
            start = F.struct(F.sequence(F.lit(0), m - 1).alias("least"), after.alias("next"))
            rounds = F.sequence(F.lit(0), F.ceil(F.log2(m.cast("double"))).cast("int"))

            def double(acc: Column, _: Column) -> Column:
                return F.struct(
                    F.zip_with(acc["least"], acc["next"], lambda v, j: F.least(v, F.get(acc["least"], j))).alias("least"),
                    F.transform(acc["next"], lambda j: F.get(acc["next"], j)).alias("next"),
                )

            def read(root: Column) -> Column:
                begin = F.struct(F.get(c, root)["points"].alias("points"), F.get(after, root).alias("at"))

                def step(acc: Column, _: Column) -> Column:
                    more = F.struct(F.concat(acc["points"], F.get(c, acc["at"])["points"]).alias("points"), F.get(after, acc["at"]).alias("at"))
                    return F.when(acc["at"] == root, acc).otherwise(more)

                return F.aggregate(F.sequence(F.lit(1), m), begin, step, lambda acc: acc["points"])

            least = F.aggregate(rounds, start, double, lambda acc: acc["least"])
            roots = let(least, lambda v: F.filter(v, lambda x, i: x == i))
            return F.transform(roots, read)

        return let(let(marks, mates), rings)

    return let(chains, of)


def tidy(ring: Column) -> Column:
    """A closed ring without repeated points."""

    def of(r: Column) -> Column:
        return F.filter(r, lambda p, i: (i == 0) | (p != F.get(r, F.greatest(i - 1, F.lit(0)))))

    return let(close_ring(ring), of)


def _half(rings: Column, axis: str, bound: Column, keep_low: bool) -> Column:
    """Member polygons of one member on one side of an axis-parallel line."""

    def of(t: Column) -> Column:
        first = F.get(F.get(t["rings"], F.lit(0)), F.lit(0))[axis]
        within = first < bound if keep_low else first > bound
        none = F.slice(F.array(t["rings"]), 1, 0)
        whole = F.when(within, F.array(t["rings"])).otherwise(none)

        def side(r: Column) -> Column:
            return F.forall(r, lambda p: p[axis] < bound if keep_low else p[axis] > bound)

        holes = F.filter(F.slice(t["rings"], F.lit(2), F.size(t["rings"])), side)
        shells = F.filter(F.transform(_linked(t["chains"]), tidy), lambda r: F.size(r) >= 4)

        def member(s: Column) -> Column:
            def own(es: Column) -> Column:
                return F.filter(holes, lambda h: point_inside(F.get(h, F.lit(0))["x"], F.get(h, F.lit(0))["y"], es))

            return F.concat(F.array(s), let(edges(s), own))

        return F.when(F.size(t["chains"]) == 0, whole).otherwise(F.transform(shells, member))

    chains = F.flatten(F.transform(rings, lambda r: _chains(r, axis, bound, keep_low)))
    return let(F.struct(rings.alias("rings"), chains.alias("chains")), of)


def clip_side(parts: Column, axis: str, bound: Column, keep_low: bool) -> Column:
    """Polygon cut along the line ``axis = bound``; a concave ring gives as many members as it falls into.

    Rings that cross the line become chains, chains are linked into rings along the line, and holes that do not cross it
    go to the new shell around them. Pieces without area are left out. Four sides make a box: ``spatial.clip_boxes``.
    """
    cut = let(parts, lambda held: F.flatten(F.transform(F.transform(held, oriented), lambda rings: _half(rings, axis, bound, keep_low))))
    return F.filter(cut, lambda rings: part_area(rings) > 0)


# -- predicates ---------------------------------------------------------------------------


def ray_hit(x: Column, y: Column, e: Column) -> Column:
    """Whether the ray from a point towards larger x crosses an edge (half-open in y)."""
    at = e["x1"] + (e["x2"] - e["x1"]) * (y - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0))
    return ((e["y1"] > y) != (e["y2"] > y)) & (x < at)


def point_inside(x: Column, y: Column, ring_edges: Column) -> Column:
    """Even-odd test against all ring edges of a polygon."""
    return F.aggregate(
        ring_edges, F.lit(False), lambda acc, e: acc != F.coalesce(ray_hit(x, y, e), F.lit(False))
    )


def _side(ax, ay, bx, by, cx, cy) -> Column:
    return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)


def segments_meet(a: Column, b: Column) -> Column:
    """Closed intersection test of two segments: boxes overlap and each straddles the other."""
    overlap = (
        (F.least(a["x1"], a["x2"]) <= F.greatest(b["x1"], b["x2"]))
        & (F.least(b["x1"], b["x2"]) <= F.greatest(a["x1"], a["x2"]))
        & (F.least(a["y1"], a["y2"]) <= F.greatest(b["y1"], b["y2"]))
        & (F.least(b["y1"], b["y2"]) <= F.greatest(a["y1"], a["y2"]))
    )
    ends_b = _side(a["x1"], a["y1"], a["x2"], a["y2"], b["x1"], b["y1"]) * _side(
        a["x1"], a["y1"], a["x2"], a["y2"], b["x2"], b["y2"]
    )
    ends_a = _side(b["x1"], b["y1"], b["x2"], b["y2"], a["x1"], a["y1"]) * _side(
        b["x1"], b["y1"], b["x2"], b["y2"], a["x2"], a["y2"]
    )
    return overlap & (ends_a <= 0) & (ends_b <= 0)


def boxes_overlap(a: Column, b: Column) -> Column:
    """Closed overlap of two boxes ``struct<x0,y0,x1,y1>``."""
    return (
        (a["x0"] <= b["x1"]) & (b["x0"] <= a["x1"]) & (a["y0"] <= b["y1"]) & (b["y0"] <= a["y1"])
    )


def segment_meets_box(e: Column, box: Column) -> Column:
    """Closed test: an end is in the box or a side is met."""
    x0, y0, x1, y1 = (box[k] for k in ("x0", "y0", "x1", "y1"))
    held = e["x1"].between(x0, x1) & e["y1"].between(y0, y1)
    sides = [(x0, y0, x1, y0), (x1, y0, x1, y1), (x1, y1, x0, y1), (x0, y1, x0, y0)]
    meets = [
        segments_meet(e, {"x1": a, "y1": b, "x2": c, "y2": d}) for a, b, c, d in sides
    ]
    return reduce(lambda a, b: a | b, meets, held)


def box_meets(ring_edges: Column, box: Column) -> Column:
    """A polygon (all its ring edges) and a box share a point."""

    def test(b: Column) -> Column:
        corner = point_inside(b["x0"], b["y0"], ring_edges)
        return corner | F.exists(ring_edges, lambda e: segment_meets_box(e, b))

    return let(box, test)


def convex_share(e: Column, ring_edges: Column) -> Column:
    """Share of a segment inside a convex ring given counter-clockwise.

    Each ring edge is a half-plane that cuts the parameter range of the segment from one side.
    """

    def measure(s: Column) -> Column:
        def cut(acc: Column, r: Column) -> Column:
            ends = F.struct(
                _side(r["x1"], r["y1"], r["x2"], r["y2"], s["x1"], s["y1"]).alias("a"),
                _side(r["x1"], r["y1"], r["x2"], r["y2"], s["x2"], s["y2"]).alias("b"),
            )

            def narrow(t: Column) -> Column:
                a, b = t["a"], t["b"]
                at = a / F.nullif(a - b, F.lit(0.0))
                low = F.when((a < 0) & (b > 0), F.greatest(acc["low"], at)).when((a < 0) & (b <= 0), F.lit(2.0))
                high = F.when((b < 0) & (a >= 0), F.least(acc["high"], at))
                return F.struct(
                    F.coalesce(low, acc["low"]).alias("low"), F.coalesce(high, acc["high"]).alias("high")
                )

            return let(ends, narrow)

        start = F.struct(F.lit(0.0).alias("low"), F.lit(1.0).alias("high"))
        return F.aggregate(
            ring_edges, start, cut, lambda acc: F.greatest(F.lit(0.0), acc["high"] - acc["low"])
        )

    return let(e, measure)


def intersects(path: Column, parts: Column) -> Column:
    """A line meets a polygon: boxes overlap, and an end is inside or an edge is crossed."""

    def against(ring_edges: Column) -> Column:
        start = F.get(path, F.lit(0))
        crossing = F.exists(edges(path), lambda s: F.exists(ring_edges, lambda r: segments_meet(s, r)))
        return point_inside(start["x"], start["y"], ring_edges) | crossing

    near = let(
        F.struct(bbox(path).alias("a"), bbox(polygon_points(parts)).alias("b")),
        lambda t: boxes_overlap(t["a"], t["b"]),
    )
    return near & let(polygon_edges(parts), against)
