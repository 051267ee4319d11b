"""Outlines of groups of boxes: common sides cancel, the rest is stitched into rings.

Boxes may have any sizes; those of a group must not overlap. Every step is a shuffle by a key finer than the group: sides
meet on the straight line they lie on, ends of edges on their point, and a ring is followed by jumps of 1, 4, 16, ...
edges. So no task holds a group; a row of the result is one ring.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.functions import geo
from roadpulse.session import cut

BOX = ("bx0", "by0", "bx1", "by1")


def boundary(boxes: DataFrame, by: Sequence[str], sign: str | None = None) -> DataFrame:
    """Border of the union of each group as longest straight edges x1, y1, x2, y2 with the inside on the left.

    ``sign`` names a column that is 1 for boxes that belong to the group and -1 for boxes cut out of those. A side adds
    its sign from its lower end on and takes it back at its upper end, so sides of neighbours cancel whatever their
    lengths, by one aggregation and a running sum along each straight line.
    """
    s = F.lit(1) if sign is None else F.col(sign)

    def side(axis: int, at: str, low: str, high: str, inside: Column) -> list[Column]:
        return [F.struct(F.lit(axis).alias("axis"), F.col(at).alias("at"), F.col(pos).alias("pos"), d.alias("delta")) for pos, d in ((low, inside), (high, -inside))]

    x0, y0, x1, y1 = BOX
    sides = [*side(0, x0, y0, y1, s), *side(0, x1, y0, y1, -s), *side(1, y0, x0, x1, s), *side(1, y1, x0, x1, -s)]
    ends = boxes.select(*by, F.explode(F.array(*sides)).alias("e")).select(*by, "e.*")
    steps = ends.groupBy(*by, "axis", "at", "pos").agg(F.sum("delta").alias("delta")).where("delta <> 0")
    line = Window.partitionBy(*by, "axis", "at").orderBy("pos")
    runs = steps.withColumn("inside", F.sum("delta").over(line)).withColumn("to", F.lead("pos").over(line)).where("inside <> 0")
    checked = F.when(F.abs("inside") == 1, F.col("inside")).otherwise(F.raise_error(F.lit("boxes of one group overlap")))
    runs = runs.withColumn("inside", checked)
    # above a level side lies the inside if it runs east; right of an upright side if it runs south
    forward = (F.col("axis") == 1) == (F.col("inside") == 1)
    a, b = F.when(forward, F.col("pos")).otherwise(F.col("to")), F.when(forward, F.col("to")).otherwise(F.col("pos"))
    upright = F.col("axis") == 0
    return runs.select(
        *by, F.when(upright, F.col("at")).otherwise(a).alias("x1"), F.when(upright, a).otherwise(F.col("at")).alias("y1"),
        F.when(upright, F.col("at")).otherwise(b).alias("x2"), F.when(upright, b).otherwise(F.col("at")).alias("y2"),
    )


def _followed(edges: DataFrame, by: Sequence[str]) -> DataFrame:
    """id, next: the edge that goes on where an edge ends, to the left where two boxes touch in a corner only."""
    a = edges.select(*by, "id", F.col("x2").alias("x"), F.col("y2").alias("y"), (F.col("x2") - F.col("x1")).alias("ax"), (F.col("y2") - F.col("y1")).alias("ay"))
    b = edges.select(*by, F.col("id").alias("other"), F.col("x1").alias("x"), F.col("y1").alias("y"), (F.col("x2") - F.col("x1")).alias("bx"), (F.col("y2") - F.col("y1")).alias("by"))
    turn = F.col("ax") * F.col("by") - F.col("ay") * F.col("bx")
    return a.join(b, [*by, "x", "y"]).groupBy("id").agg(F.max_by("other", turn).alias("next"))


def rings(edges: DataFrame, by: Sequence[str]) -> DataFrame:
    """Edges with the ring they belong to: ``ring`` is its least edge (a struct), ``place`` the steps from there.

    Each edge knows the least edge among the 4 ** k that follow it and how far that is; a round asks the three edges at
    the ends of these stretches. When no edge learns anything new, all have seen their ring; rounds grow with the
    logarithm of the longest ring.
    """
    edges = cut(edges.withColumn("id", F.monotonically_increasing_id()))
    corner = F.struct("x1", "y1", "x2", "y2", "id")
    known = edges.select("id", corner.alias("least")).join(_followed(edges, by), "id")
    known = cut(known.withColumn("far", F.lit(0).cast("bigint")))
    span, going = 1, True
    while going:
        step = known.withColumns({"at": F.col("next")})
        for k in (1, 2, 3):
            ahead = known.select(F.col("id").alias("at"), F.col("least").alias("_l"), F.col("far").alias("_f"), F.col("next").alias("_n"))
            better = F.col("_l") < F.col("least")
            joined = step.join(ahead, "at")
            step = joined.select(
                "id", "next", F.col("_n").alias("at"), F.when(better, F.col("_f") + k * span).otherwise(F.col("far")).alias("far"),
                F.when(better, F.col("_l")).otherwise(F.col("least")).alias("least"), *([F.col("was")] if "was" in joined.columns else [F.col("least").alias("was")]),
            )
        step = cut(step.select("id", F.col("at").alias("next"), "least", "far", (F.col("least") != F.col("was")).alias("learned")))
        going = not step.where("learned").isEmpty()
        known, span = step.drop("learned"), 4 * span
    length = known.groupBy("least").agg(F.count(F.lit(1)).alias("length"))
    placed = known.join(length, "least").select("id", F.col("least").alias("ring"), F.pmod(F.col("length") - F.col("far"), F.col("length")).alias("place"))
    return edges.join(placed, "id").drop("id")


def outlines(boxes: DataFrame, by: Sequence[str] = ("group",), sign: str | None = None) -> DataFrame:
    """The union of the boxes of each group, a row for each ring: ``shell``, ``hole``, ``area``, ``wkt``.

    ``shell`` is the first corner of the outer ring, that of the ring itself or that around a hole; ``area`` is negative
    for holes, so areas add up to the boxes'; ``wkt`` is the ring as a polygon of its own. Rings begin at their least
    corner. Outer rings that touch in a corner are separate; a hole may pass a corner twice.
    """
    found = rings(boundary(boxes, by, sign), by)
    first, last = F.struct("place", F.col("x1").alias("x"), F.col("y1").alias("y")), F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")
    path = F.transform(F.array_sort(F.collect_list(first)), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    drawn = cut(found.groupBy(*by, "ring").agg(path.alias("path"), (F.sum(last) / 2).alias("area")))
    ring = geo.close_ring(F.col("path"))
    text = geo.polygon_to_wkt(F.array(F.array(ring)))
    name = F.concat_ws(" ", F.col("ring.x1").cast("string"), F.col("ring.y1").cast("string"))
    shells = drawn.where("area > 0").select(*by, name.alias("shell"), F.lit(False).alias("hole"), "area", text.alias("wkt"))
    around = drawn.where("area > 0").select(
        *[F.col(c).alias(f"_{c}") for c in by], name.alias("shell"), F.col("area").alias("_area"), geo.bbox(F.col("path")).alias("_b"), geo.edges(ring).alias("_edges")
    )
    inner = drawn.where("area < 0").select(*by, "ring", "area", text.alias("wkt"), F.slice("path", 1, 2).alias("_p"))
    # the middle of an edge of a hole lies on no other ring
    middle = {c: (F.get("_p", F.lit(0))[c] + F.get("_p", F.lit(1))[c]) / 2 for c in "xy"}
    inner = inner.withColumns({f"_{c}m": middle[c] for c in "xy"})
    on = reduce(Column.__and__, [F.col(c) == F.col(f"_{c}") for c in by])
    on = on & F.col("_xm").between(F.col("_b.x0"), F.col("_b.x1")) & F.col("_ym").between(F.col("_b.y0"), F.col("_b.y1"))
    held = inner.join(around, on).where(geo.point_inside(F.col("_xm"), F.col("_ym"), F.col("_edges")))
    nearest = held.groupBy(*by, "ring", "area", "wkt").agg(F.min_by("shell", "_area").alias("shell"))
    holes = nearest.select(*by, "shell", F.lit(True).alias("hole"), "area", "wkt")
    return shells.unionByName(holes)


def difference(extent: DataFrame, boxes: DataFrame, group: str = "999") -> DataFrame:
    """What is left of the boxes of ``extent`` without ``boxes`` (all inside it): outlines of one group."""
    whole = extent.select(*BOX).withColumn("sign", F.lit(1)).unionByName(boxes.select(*BOX).withColumn("sign", F.lit(-1)))
    return outlines(whole.withColumn("group", F.lit(group)), ["group"], "sign")
