"""Reports repeat their lines: geometry is worked out once per distinct line."""

import pytest
from pyspark.sql import functions as F

from roadpulse.functions import geo
from roadpulse.operators import spatial, territory
from roadpulse.suite import registry, views


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """90 events on 5 lines, one of them twice and one without an id."""
    folder = str(tmp_path_factory.mktemp("repeated"))
    ids = [*range(90), 40, None]
    rows = [(i, "2024-01-05 10:00:00", 1, "view", 2.0, '{"k": 20}') for i in ids]
    events = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string")
    events.withColumn("ts", events.ts.cast("timestamp")).write.parquet(f"{folder}/events.parquet")
    regions = [(k, f"R{k}") for k in range(5)]
    spark.createDataFrame(regions, "r_regionkey long, r_name string").write.parquet(f"{folder}/region.parquet")
    return folder


def recorded(monkeypatch, name):
    """The tables that ``spatial.name`` is given."""
    seen, plain = [], getattr(spatial, name)
    monkeypatch.setattr(spatial, name, lambda df, *args, **kw: (seen.append(df), plain(df, *args, **kw))[1])
    return seen


def test_geo04_tests_each_line_once(spark, tables, monkeypatch):
    given = recorded(monkeypatch, "candidates")
    found = registry.queries()["geo04_intersects"](spark, tables)
    rows = views.jams(spark, tables).select("event_id", "line")
    shapes = views.meta(spark, tables).select("region_slug", geo.parse_polygon(F.col("region_shapefile_wkt")).alias("parts"))
    plain = rows.where("event_id IS NOT NULL").crossJoin(shapes).where(geo.intersects(geo.parse_line(rows.line), shapes.parts))
    assert sorted(found.collect()) == sorted(plain.select("event_id", "region_slug").collect()) != []
    distinct = rows.where("event_id IS NOT NULL").select("line").distinct().count()
    assert rows.count() > 100 and given[0].count() == distinct


def test_geo15_cuts_each_line_once(spark, tables, monkeypatch):
    given = recorded(monkeypatch, "clip_boxes")
    found = registry.queries()["geo15_clip_polygon"](spark, tables).collect()
    rows = views.jams(spark, tables).selectExpr("string(event_id) AS id", "line")
    whole = {}
    triangle = F.array(F.array(geo.close_ring(geo.parse_line(rows.line))))
    for r in rows.withColumn("a", geo.area(triangle)).collect():
        whole[r.id] = whole.get(r.id, 0.0) + (r.a or 0.0)
    assert {r.id: r.area for r in found if r.id in whole} == {k: pytest.approx(v, abs=1e-6) for k, v in whole.items()}
    assert whole["40"] > 0 and len(found) == len(whole) + 5
    distinct = rows.select("line").distinct().count()
    assert rows.count() > 100 and sum(df.count() for df in given) == 4 * (distinct + 5)


def test_territory_split_asks_its_verdict_once_a_level(spark):
    """A condition with a subquery gives the pieces of one with a number and is not left in the plan of the result."""
    roots = spark.createDataFrame([("a", "POLYGON ((0 0, 8 0, 8 8, 0 8, 0 0))")], "root string, wkt string")
    lines = [(f"LINESTRING ({k % 8 / 2} {k // 8 / 2}, {k % 8 / 2 + 0.1} {k // 8 / 2})", k % 3 + 1) for k in range(64)]
    lines = spark.createDataFrame(lines, "line_wkt string, count_lines long")
    total = lines.agg(F.sum("count_lines")).scalar()
    grid = spatial.Quad(0.0, 0.0, 16.0)
    found = territory.split(roots, lines, F.col("count_lines"), lambda v: v / total > 0.2, 4, grid=grid, resolution=3)
    assert "scalar-subquery" not in found._jdf.queryExecution().optimizedPlan().toString()
    number = lines.agg(F.sum("count_lines")).first()[0]
    plain = territory.split(roots, lines, F.col("count_lines"), lambda v: v / number > 0.2, 4, grid=grid, resolution=3)
    assert sorted(found.collect()) == sorted(plain.collect()) != []
