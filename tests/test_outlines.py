"""Outlines of boxes against a flood fill, grouped ranks and quantiles against numpy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadpulse.functions import geo
from roadpulse.operators import grid, outlines, ranks, tci

N = 14


def _boxes(r, fill):
    """Disjoint boxes of several sizes on a lattice of N x N, and the cells they cover."""
    held, out = np.zeros((N, N), bool), []
    for _ in range(int(fill * N * N)):
        w, h = r.choice([(1, 1), (1, 1), (2, 1), (1, 3), (2, 2), (4, 2)])
        x, y = r.randrange(N - w + 1), r.randrange(N - h + 1)
        if not held[x : x + w, y : y + h].any():
            held[x : x + w, y : y + h] = True
            out.append((x / 8, y / 8, (x + w) / 8, (y + h) / 8))
    return out, held


def _components(cells, corners=False):
    """Number of connected parts of a mask, by sides or also by corners."""
    todo, n = {(int(x), int(y)) for x, y in zip(*np.nonzero(cells))}, 0
    steps = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if (a or b) and (corners or not (a and b))]
    while todo:
        n += 1
        stack = [todo.pop()]
        while stack:
            x, y = stack.pop()
            for a, b in steps:
                if (x + a, y + b) in todo:
                    todo.remove((x + a, y + b))
                    stack.append((x + a, y + b))
    return n


@pytest.fixture(scope="module")
def drawn(spark):
    r = random.Random(4)
    cases = {f"g{k}": _boxes(r, fill) for k, fill in enumerate((0.1, 0.5, 0.9, 2.0, 6.0))}
    cases["whole"] = ([(x / 8, y / 8, (x + 1) / 8, (y + 1) / 8) for x in range(N) for y in range(N)], np.ones((N, N), bool))
    rows = [(g, *b) for g, (boxes, _) in cases.items() for b in boxes]
    df = spark.createDataFrame(rows, "group string, bx0 double, by0 double, bx1 double, by1 double")
    found = outlines.outlines(df.repartition(5))
    ring = F.get(F.get(geo.parse_polygon(F.col("wkt")), F.lit(0)), F.lit(0))
    got = found.select("*", geo.signed_area(ring).alias("own"), ring.alias("ring")).collect()
    return cases, got


def test_outlines_match_the_cells(drawn):
    cases, got = drawn
    for name, (_, held) in cases.items():
        mine = [r for r in got if r["group"] == name]
        assert sum(r["area"] for r in mine) == held.sum() / 64
        assert all(r["own"] == r["area"] and (r["area"] < 0) == r["hole"] for r in mine)
        assert sum(not r["hole"] for r in mine) == _components(held)
        # holes are what cannot be reached from outside, also not past a corner
        outside = np.pad(~held, 1, constant_values=True)
        assert sum(r["hole"] for r in mine) == _components(outside, corners=True) - 1
        wide = np.pad(held, 1).astype(int)
        sides = np.abs(np.diff(wide, axis=0)).sum() + np.abs(np.diff(wide, axis=1)).sum()
        assert sum(abs(b["x"] - a["x"]) + abs(b["y"] - a["y"]) for r in mine for a, b in zip(r["ring"], r["ring"][1:])) == sides / 8


def test_rings_turn_at_every_corner_and_holes_lie_in_their_shell(drawn):
    _, got = drawn
    shells = {(r["group"], r["shell"]): r for r in got if not r["hole"]}
    for r in got:
        path = [(p["x"], p["y"]) for p in r["ring"]]
        ways = [a[0] == b[0] for a, b in zip(path, path[1:])]
        assert all(a != b for a, b in zip(ways, ways[1:] + ways[:1])) and path[0] == min(path) == path[-1]
        shell = shells[r["group"], r["shell"]]
        xs, ys = zip(*[(p["x"], p["y"]) for p in shell["ring"]])
        assert all(min(xs) <= x <= max(xs) and min(ys) <= y <= max(ys) for x, y in path)
    assert [len(r["ring"]) for r in got if r["group"] == "whole"] == [5]


def test_difference_is_what_the_boxes_leave(spark):
    boxes, held = _boxes(random.Random(9), 0.7)
    form = "bx0 double, by0 double, bx1 double, by1 double"
    extent = spark.createDataFrame([(0.0, 0.0, N / 8, 1.0), (0.0, 1.0, N / 8, N / 8)], form)
    got = outlines.difference(extent, spark.createDataFrame(boxes, form)).collect()
    assert {r["group"] for r in got} == {"999"}
    assert sum(r["area"] for r in got) == (~held).sum() / 64
    assert sum(not r["hole"] for r in got) == _components(~held)
    assert outlines.difference(extent, extent).count() == 0
    with pytest.raises(Exception, match="boxes of one group overlap"):
        outlines.outlines(extent.unionByName(extent).withColumn("group", F.lit("a"))).collect()
    assert outlines.outlines(extent.limit(0).withColumn("group", F.lit("a"))).count() == 0


# -- ranks ----------------------------------------------------------------------------------


def test_running_totals_inside_groups(spark):
    r = random.Random(1)
    rows = [(r.choice(["a", "a", "a", "b", "c", None]), r.randrange(40), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, major int, minor int")
    got = {row["minor"]: row["place"] for row in ranks.running_total(df, ["major", "minor"], name="place", by=["g"]).collect()}
    want = {}
    for g in {g for g, _, _ in rows}:
        want |= {i: k + 1 for k, (_, i) in enumerate(sorted((m, i) for h, m, i in rows if h == g))}
    assert got == want
    both = F.struct(F.col("minor").cast("long").alias("s"), F.lit(1).cast("long").alias("n"))
    sums = ranks.running_total(df, ["major", "minor"], both, "t", ["g"]).groupBy("g").agg(F.max("t.n").alias("n"), F.max("t.s").alias("s"))
    assert {row["g"]: (row["n"], row["s"]) for row in sums.collect()} == {
        g: (sum(h == g for h, _, _ in rows), sum(i for h, _, i in rows if h == g)) for g in {g for g, _, _ in rows}
    }


def test_a_group_with_most_rows_is_numbered_in_many_tasks(spark):
    # so few rows would be put together again by the adaptive planner
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        _hot_batches(spark)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", was)


def _hot_batches(spark):
    df = spark.range(40_000).select(F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("region_slug"), F.lit(3).alias("ix"), F.col("id").alias("iy"))
    got = grid.batch(df, 100).withColumn("p", F.spark_partition_id())
    assert got.groupBy("region_slug", "group").count().where("count <> 100").count() == 0
    tasks = got.where("region_slug = 'a'").groupBy("p").count().collect()
    assert max(r["count"] for r in tasks) < 20_000


def test_grouped_quantiles(spark):
    r = random.Random(2)
    rows = [(k, r.choice([1.5, 1.5, r.uniform(-9, 9), None])) for k in ("x", "x", "x", "y", None) for _ in range(400)]
    rows += [("one", 7.0), ("none", None), ("two", 1.0), ("two", 2.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    levels = {"low": 0.0, "q": 0.3, "mid": 0.5, "top": 1.0}
    got = {row["k"]: [row[n] for n in levels] for row in ranks.grouped_quantiles(df, ["k"], "v", levels).collect()}
    for k in {k for k, _ in rows}:
        held = [v for j, v in rows if j == k and v is not None]
        want = [float(np.quantile(held, p)) if held else None for p in levels.values()]
        assert got.pop(k) == [pytest.approx(w) if w is not None else None for w in want]
    assert not got and ranks.grouped_quantiles(df.limit(0), ["k"], "v", levels).count() == 0
    plan = tci.baseline_median(df, ["k"], "v")._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan
