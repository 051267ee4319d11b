"""Incremental fill (INC) and the stream (STR)."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse.operators import filters
from roadpulse.plans import incremental
from roadpulse.session import new_path
from roadpulse.sources import calendars
from roadpulse.streaming import feed
from roadpulse.suite import views
from roadpulse.suite.registry import query, rounded, texts


@query("inc01_dates", "", """
SELECT strftime(d, '%Y-%m-%d') AS date FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)""")
def _(spark, sf):
    span = views.table(spark, sf, "orders").agg(F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b"))
    return texts(calendars.expand_days(span, "a", "b"))


_MISSING = """
d as (SELECT unnest(generate_series(DATE '1994-12-01'::timestamp, DATE '2001-12-31'::timestamp, INTERVAL 1 DAY))::date AS date),
miss as (SELECT r.region_slug, d.date FROM (SELECT DISTINCT region_slug FROM series) r, d
  WHERE NOT EXISTS (SELECT 1 FROM series s WHERE s.region_slug = r.region_slug AND s.date = d.date))"""


def _missing(spark, sf):
    df = views.series(spark, sf)
    return incremental.remaining(df, incremental.dates(spark, "1994-12-01", "2001-12-31"), df.select("region_slug", "date"))


@query("inc02_remaining", "series", f"with {_MISSING} SELECT region_slug, strftime(date, '%Y-%m-%d') AS date FROM miss")
def _(spark, sf):
    return texts(_missing(spark, sf))


@query("inc03_slices", "series", f"""
with {_MISSING}, s as (SELECT *, count(*) OVER (PARTITION BY region_slug) AS n FROM miss)
SELECT region_slug, CASE WHEN n >= 30 THEN strftime(date, 'year%Ymonth%m') WHEN n >= 7 THEN strftime(date, 'year%Yweek%W')
  ELSE strftime(date, 'year%Ymonth%mday%d') END AS date_slug, string_agg(strftime(date, '%Y%m%d'), '|' ORDER BY date) AS date_filter FROM s GROUP BY 1, 2""")
def _(spark, sf):
    return incremental.slices(_missing(spark, sf))


_REGION_HOURS = """
with m as (SELECT g.event_id, g.uuid, g.ts, g.length, g.line, met AS slug FROM good g JOIN jam_regions USING (event_id)),
d as (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY slug, uuid, ts::date, (hour(ts) * 60 + minute(ts)) // 5
  ORDER BY ts, length, line, event_id) AS rn FROM m) WHERE rn = 1)
SELECT slug AS region_slug, year(ts)::int AS year, month(ts)::int AS month, day(ts)::int AS day, hour(ts)::int AS hour, isodow(ts)::int AS dow, line,
  round(round(sum(length), 6))::bigint AS tci FROM d GROUP BY ALL"""


def _jams(spark, sf):
    return views.feed(spark, sf).drop("region_slug")


@query("inc04_full", "jam_regions good", _REGION_HOURS)
def _(spark, sf):
    return incremental.segment_hours(_jams(spark, sf), views.meta(spark, sf), grid=views.GRID, resolution=6)


@query("inc04_fill", "jam_regions good", _REGION_HOURS)
def _(spark, sf):
    """Two fills, the second over a longer interval, give the table of one full run."""
    path, meta, jams = new_path(spark, "fill"), views.meta(spark, sf), _jams(spark, sf)
    options = {"grid": views.GRID, "resolution": 6, "lines_path": new_path(spark, "lines")}
    for last in ("2024-01-12", "2024-01-31"):
        incremental.fill(spark, jams, meta, incremental.dates(spark, "2024-01-01", last), path, **options)
    columns = ["region_slug", "year", "month", "day", "hour", "dow", "line", "tci"]
    return spark.read.orc(path).select(*columns)


@query("str01_segment_hour", "dedup", """
SELECT region_slug, line, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour_start, round(sum(length), 6) AS tci FROM dedup GROUP BY ALL""")
def _(spark, sf):
    """The stream over the whole feed equals the batch result.

    A row two days after the last one moves the watermark past the hours still open.
    """
    columns = ["event_id", "region_slug", "uuid", "ts", "length", "line"]
    rows = filters.quality(views.feed(spark, sf)).select(*columns)
    late = rows.agg((F.max("ts") + F.expr("INTERVAL 2 DAY")).alias("ts")).select(
        F.lit(-1).cast("bigint").alias("event_id"), F.lit("end").alias("region_slug"), F.lit("end").alias("uuid"), "ts",
        F.lit(0.0).alias("length"), F.lit("end").alias("line"),
    )
    source, out = new_path(spark, "stream-in"), new_path(spark, "stream-out")
    rows.unionByName(late).write.parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    feed.write(feed.segment_hour(stream), out, new_path(spark, "stream-state")).awaitTermination()
    done = spark.read.schema("region_slug string, line string, hour_start timestamp, tci double").parquet(out)
    return rounded(texts(done.where("region_slug <> 'end'")))
