"""Index products (IDX) and region products (REG) that need no geometry."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse.functions import timefn
from roadpulse.operators import filters
from roadpulse.plans import index
from roadpulse.suite import views
from roadpulse.suite.registry import query, rounded, texts

_BASE_DOW = """
  SELECT region_slug, dow, avg(s) AS expected_2020 FROM (
    SELECT region_slug, month, day, dow, sum(tci) AS s FROM base GROUP BY ALL) GROUP BY ALL"""

_LABELS = """m.region_slug, m.region_name, m.country_name_eng AS country_name, m.country_iso AS country_iso_code,
  m.partner_code AS country_partner_code, m.region_type, m.population, m.timezone"""


def daily_index(spark, sf):
    return index.daily_index(
        views.daily(spark, sf), views.base(spark, sf), views.meta(spark, sf), views.START, exceptions=["purchase"]
    )


@query("idx01_daily_index", "daily base meta", f"""
with h as ({_BASE_DOW}),
d as (SELECT region_slug, year, month, dow, day, sum(tci)::bigint AS observed FROM daily GROUP BY ALL)
SELECT {_LABELS}, d.year, d.month, d.day, d.dow, observed, round(expected_2020, 6) AS expected_2020,
  round(observed / expected_2020, 6) AS ratio_20, round((observed / expected_2020 - 1) * 100, 6) AS tcp,
  m.dashboard, m.region_shapefile_wkt
FROM d JOIN h ON d.region_slug = h.region_slug AND d.dow = h.dow JOIN meta m ON d.region_slug = m.region_slug
WHERE daily_approved OR m.region_slug IN ('purchase')
""")
def _(spark, sf):
    return rounded(daily_index(spark, sf).drop("last_updated_utc"))


@query("idx02_weekly_index", "daily base meta", f"""
with w as (
  SELECT year, month, day, sum(CASE WHEN dow = 1 THEN 1 ELSE 0 END) OVER (ORDER BY date) AS week_number_obs,
    week(date) AS week_number
  FROM (SELECT DISTINCT year, month, day, dow, make_date(year, month, day) AS date FROM daily)),
d as (
  SELECT region_slug, week_number, week_number_obs, min_by(d.year, dow) AS min_year, min_by(d.month, dow) AS min_month,
    min_by(d.day, dow) AS min_day, max_by(d.year, dow) AS max_year, max_by(d.month, dow) AS max_month,
    max_by(d.day, dow) AS max_day, sum(tci)::bigint AS observed
  FROM daily d JOIN w ON d.year = w.year AND d.month = w.month AND d.day = w.day GROUP BY 1, 2, 3),
h as (SELECT region_slug, sum(tci)::bigint AS expected_2020 FROM base GROUP BY 1)
SELECT {_LABELS}, week_number::int AS week_number, week_number_obs::bigint AS week_number_obs, min_year, min_month,
  min_day, max_year, max_month, max_day, observed, expected_2020,
  round(observed / expected_2020, 6) AS ratio_20, round((observed / expected_2020 - 1) * 100, 6) AS tcp,
  m.dashboard, m.region_shapefile_wkt
FROM d JOIN h ON d.region_slug = h.region_slug JOIN meta m ON d.region_slug = m.region_slug
WHERE weekly_approved OR m.region_slug IN ('error')
""")
def _(spark, sf):
    # a day keeps a report through the slot dedup, so its days are those of the feed
    dates = filters.quality(views.feed(spark, sf)).select(*timefn.parts(F.col("ts")))
    df = index.weekly_index(
        views.daily(spark, sf), views.base(spark, sf), views.meta(spark, sf), views.START, exceptions=["error"], dates=dates
    )
    return rounded(df.drop("last_updated_utc"))


@query("idx03_hourly_index", "daily base meta", """
with h as (
  SELECT region_slug, hour, dow, avg(s) AS e FROM (
    SELECT region_slug, year, month, day, hour, dow, sum(tci) AS s FROM base GROUP BY ALL) GROUP BY ALL),
d as (SELECT region_slug, year, month, day, hour, dow, sum(tci)::bigint AS observed FROM daily GROUP BY ALL),
j as (
  SELECT d.*, e, m.timezone, make_timestamp(d.year, d.month, d.day, d.hour, 0, 0) AS ts
  FROM d JOIN h ON d.region_slug = h.region_slug AND d.dow = h.dow AND d.hour = h.hour
  JOIN meta m ON d.region_slug = m.region_slug WHERE daily_approved)
SELECT region_slug, timezone, strftime(
    CASE region_slug WHEN 'click' THEN ts - INTERVAL 3 HOUR WHEN 'error' THEN ts - INTERVAL 6 HOUR
      WHEN 'purchase' THEN ts - INTERVAL 3 HOUR WHEN 'signup' THEN ts - INTERVAL 5 HOUR END,
    '%Y-%m-%d %H:%M:%S') AS timestamp_timezone,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, observed, round((observed / nullif(e, 0) - 1) * 100, 6) AS tci
FROM j
""")
def _(spark, sf):
    df = index.hourly_index(views.daily(spark, sf), views.base(spark, sf), views.meta(spark, sf))
    return rounded(texts(df.drop("last_updated_utc")))


_CHUNK = "CASE WHEN hour BETWEEN 5 AND 9 THEN '5-9' WHEN hour BETWEEN 10 AND 15 THEN '10-15' WHEN hour BETWEEN 16 AND 21 THEN '16-21' ELSE 'rest' END"


@query("idx04_hour_group_index", "daily base meta", f"""
with h as (
  SELECT region_slug, hour_chunk, dow, avg(s) AS e FROM (
    SELECT region_slug, year, month, day, {_CHUNK} AS hour_chunk, dow, sum(tci) AS s FROM base GROUP BY ALL) GROUP BY ALL),
d as (
  SELECT region_slug, year, month, day, dow, {_CHUNK} AS hour_chunk, sum(tci)::bigint AS observed FROM daily GROUP BY ALL)
SELECT {_LABELS}, d.month, d.dow, d.day, d.hour_chunk, round(e, 6) AS expected_2020, round(observed / e, 6) AS ratio_20,
  observed, round((observed / nullif(e, 0) - 1) * 100, 6) AS tci
FROM d JOIN h ON d.region_slug = h.region_slug AND d.dow = h.dow AND d.hour_chunk = h.hour_chunk
JOIN meta m ON d.region_slug = m.region_slug WHERE daily_approved
""")
def _(spark, sf):
    df = index.hour_group_index(views.daily(spark, sf), views.base(spark, sf), views.meta(spark, sf))
    return rounded(df.drop("last_updated_utc"))


@query("idx09_simple_tci", "jams", """
with c as (
  SELECT ts::date AS date, isodow(ts) AS dow, sum(length) AS v FROM jams
  WHERE ts::date BETWEEN DATE '2024-01-08' AND DATE '2024-01-30' AND level <> 5 GROUP BY 1, 2),
b as (
  SELECT isodow(ts) AS dow, sum(length) AS v FROM jams
  WHERE ts::date BETWEEN DATE '2024-01-01' AND DATE '2024-01-07' AND level <> 5 GROUP BY 1)
SELECT 'whole' AS region_name, strftime(date, '%Y-%m-%d') AS date, round((c.v / b.v - 1) * 100, 6) AS tci_index
FROM c JOIN b ON c.dow = b.dow
""")
def _(spark, sf):
    df = index.simple_tci(
        views.feed(spark, sf), (views.START, "2024-01-30"), (views.BASE_START, views.BASE_END), "whole"
    )
    return rounded(texts(df))


@query("idx10_hour_chunk_local", "hours meta", """
with l as (
  SELECT region_slug, make_timestamp(year, month, day, hour, 0, 0)
    - INTERVAL 1 HOUR * CASE region_slug WHEN 'click' THEN 3 WHEN 'error' THEN 6 WHEN 'purchase' THEN 3 ELSE 5 END AS lts, tci
  FROM hours WHERE region_slug <> 'view'),
g as (
  SELECT region_slug, lts::date AS date, CASE WHEN hour(lts) BETWEEN 5 AND 9 THEN 'from 5h to 10h'
    WHEN hour(lts) BETWEEN 10 AND 15 THEN 'from 10h to 16h' WHEN hour(lts) BETWEEN 16 AND 21 THEN 'from 16h to 22h'
    ELSE 'rest' END AS hour_chunk, sum(tci)::bigint AS observed FROM l GROUP BY ALL),
e as (
  SELECT region_slug, hour_chunk, isodow(date) AS dow, avg(observed) AS expected FROM g
  WHERE date BETWEEN DATE '2024-01-01' AND DATE '2024-01-07' GROUP BY ALL)
SELECT g.region_slug, g.hour_chunk, isodow(date)::int AS dow, strftime(date, '%Y-%m-%d') AS date, observed,
  round(expected, 6) AS expected, round(observed / expected, 6) AS ratio
FROM g JOIN e ON g.region_slug = e.region_slug AND g.hour_chunk = e.hour_chunk AND isodow(g.date) = e.dow
""")
def _(spark, sf):
    from roadpulse.functions.timefn import hour_stamp

    hourly = views.hours(spark, sf).withColumn("ts", hour_stamp())
    df = index.hour_chunk_local(hourly, views.meta(spark, sf), (views.BASE_START, views.BASE_END))
    return rounded(texts(df))


@query("idx11_city_index", "sales", """
with hol as (SELECT region_slug, date FROM sales WHERE amount > 450000 GROUP BY ALL),
s as (
  SELECT region_slug, date, isodow(date) AS dow, sum(amount) AS tci FROM sales
  WHERE (region_slug, date) NOT IN (SELECT (region_slug, date) FROM hol) GROUP BY ALL),
e as (
  SELECT region_slug, dow, sum(tci) AS expected FROM s WHERE date BETWEEN DATE '1995-01-02' AND DATE '1995-01-29' GROUP BY ALL)
SELECT s.region_slug, s.dow::int AS dow, strftime(date, '%Y-%m-%d') AS date, round(tci, 2) AS tci,
  round(expected, 2) AS expected, round(tci / expected * 100, 4) AS index
FROM s LEFT JOIN e ON s.region_slug = e.region_slug AND s.dow = e.dow
""")
def _(spark, sf):
    sales = views.sales(spark, sf)
    holidays = sales.where("amount > 450000").select("region_slug", "date").distinct()
    df = index.city_index(sales, holidays, ("1995-01-02", "1995-01-29"), value="amount")
    return texts(df.withColumns({
        "tci": F.round("tci", 2), "expected": F.round("expected", 2), "index": F.round("index", 4)}))
