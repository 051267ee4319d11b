"""Filters (FLT), projections (PRJ), calendars (SRC-03), set steps (SET) and day samples (SRT-05..07)."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse.functions import text, timefn
from roadpulse.operators import dq, filters, reshape, sampling
from roadpulse.sources import calendars
from roadpulse.suite import views
from roadpulse.suite.registry import query, rounded, texts

_JAM = "event_id, region_slug, uuid, length, speed, level, datetime"


def _jam_columns(df):
    return df.select(*[c.strip() for c in _JAM.split(",")])


@query("flt01_quality", "good", f"SELECT {_JAM} FROM good")
def _(spark, sf):
    return _jam_columns(filters.quality(views.jams(spark, sf)))


@query("flt02_on_or_after", "daily", "SELECT * FROM daily")
def _(spark, sf):
    return views.daily(spark, sf)


@query("flt03_between_dates", "series", """
SELECT region_slug, strftime(date, '%Y-%m-%d') AS date, observed FROM series
WHERE date BETWEEN DATE '1996-02-01' AND DATE '1997-03-31'""")
def _(spark, sf):
    return texts(filters.between_dates(views.series(spark, sf), "1996-02-01", "1997-03-31", F.col("date")))


@query("flt04_regions", "meta", """
SELECT region_slug, dashboard FROM meta WHERE upper(dashboard) = 'TRUE' OR region_slug IN ('signup')""")
def _(spark, sf):
    return filters.regions(views.meta(spark, sf), ["signup"], flag="dashboard").select("region_slug", "dashboard")


@query("flt05_approved", "meta", """
SELECT region_slug, daily_approved FROM meta WHERE daily_approved OR region_slug IN ('purchase', 'view')""")
def _(spark, sf):
    kept = filters.approved(views.meta(spark, sf), "daily_approved", ["purchase", "view"])
    return kept.select("region_slug", "daily_approved")


@query("flt06_not_blocked_level", "jams", f"SELECT {_JAM} FROM jams WHERE level <> 5")
def _(spark, sf):
    return _jam_columns(filters.not_blocked_level(views.jams(spark, sf)))


@query("flt07_drop_local_hours", "jams", f"""
SELECT {_JAM} FROM jams WHERE hour(ts - INTERVAL 3 HOUR) NOT IN (21, 22, 23, 0, 1, 2, 3, 4, 5, 6)""")
def _(spark, sf):
    return _jam_columns(filters.drop_local_hours(views.feed(spark, sf), F.col("ts"), F.lit("America/Sao_Paulo")))


@query("flt08_cap", "series", """
SELECT 'drop' AS how, region_slug, strftime(date, '%Y-%m-%d') AS date, observed FROM series WHERE observed < 300000
UNION ALL
SELECT 'clip', region_slug, strftime(date, '%Y-%m-%d'), least(observed, 300000) FROM series""")
def _(spark, sf):
    df = texts(views.series(spark, sf))
    return reshape.union([
        filters.cap(df, "observed", 300000.0, how).withColumn("how", F.lit(how)) for how in ("drop", "clip")
    ])


@query("flt09_drop_holidays", "series sales", """
SELECT region_slug, strftime(date, '%Y-%m-%d') AS date, observed FROM series s WHERE NOT EXISTS (
  SELECT 1 FROM sales h WHERE h.region_slug = s.region_slug AND h.date = s.date AND h.amount > 450000)""")
def _(spark, sf):
    holidays = views.sales(spark, sf).where("amount > 450000").select("region_slug", "date").distinct()
    return texts(filters.drop_holidays(views.series(spark, sf), holidays, ["region_slug", "date"]))


@query("flt10_complete_days", "jams", """
SELECT event_id, datetime FROM jams WHERE datetime IN (
  SELECT datetime FROM jams GROUP BY 1 HAVING count(DISTINCT hour(ts)) = 24)""")
def _(spark, sf):
    feed = views.feed(spark, sf).withColumn("hour", F.hour("ts"))
    return filters.complete_days(feed, ["datetime"]).select("event_id", "datetime")


@query("flt11_complete_weeks", "series", """
SELECT region_slug, strftime(date, '%Y-%m-%d') AS date, strftime(date_trunc('week', date), '%Y-%m-%d') AS week, observed
FROM series WHERE (region_slug, date_trunc('week', date)) IN (
  SELECT (region_slug, date_trunc('week', date)) FROM series GROUP BY region_slug, date_trunc('week', date)
  HAVING count(DISTINCT date) = 7)""")
def _(spark, sf):
    df = views.series(spark, sf).withColumn("week", F.date_trunc("week", "date").cast("date"))
    return texts(filters.complete_weeks(df, ["region_slug", "week"], "date"))


@query("flt12_full_panel", "sales", """
with s as (SELECT nation, strftime(date_trunc('month', date), '%Y-%m-%d') AS month, round(sum(amount), 2) AS amount FROM sales GROUP BY ALL)
SELECT * FROM s WHERE nation IN (
  SELECT nation FROM s GROUP BY 1 HAVING count(DISTINCT month) = (SELECT count(DISTINCT month) FROM s))""")
def _(spark, sf):
    months = views.sales(spark, sf).groupBy("nation", F.date_trunc("month", "date").cast("date").alias("month"))
    return texts(filters.full_panel(months.agg(F.round(F.sum("amount"), 2).alias("amount")), "nation", "month"))


@query("flt13_exclude_prefix", "sales", """
SELECT nation, count(*) AS n FROM sales WHERE nation NOT LIKE 'NATION\\_1%' ESCAPE '\\' GROUP BY 1""")
def _(spark, sf):
    kept = filters.exclude_prefix(views.sales(spark, sf), "NATION_1", "nation")
    return kept.groupBy("nation").agg(F.count(F.lit(1)).alias("n"))


@query("flt14_skip_done", "meta", """
SELECT region_slug, region_name FROM meta WHERE region_shapefile_wkt NOT IN (
  SELECT region_shapefile_wkt FROM meta WHERE daily_approved AND weekly_approved) AND region_slug <> 'error'""")
def _(spark, sf):
    meta = views.meta(spark, sf)
    done = meta.where("daily_approved AND weekly_approved").select("region_shapefile_wkt")
    return filters.skip_done(meta, done, exceptions=["error"]).select("region_slug", "region_name")


# -- projections --------------------------------------------------------------------------


@query("prj01_time_parts", "jams", """
SELECT event_id, year(ts)::int AS year, month(ts)::int AS month, day(ts)::int AS day, hour(ts)::int AS hour,
  isodow(ts)::int AS dow FROM jams""")
def _(spark, sf):
    return views.feed(spark, sf).select("event_id", *timefn.parts(F.col("ts")))


@query("prj02_hour_chunk", "jams", """
SELECT event_id, CASE WHEN hour(ts) BETWEEN 5 AND 9 THEN '5-9' WHEN hour(ts) BETWEEN 10 AND 15 THEN '10-15'
  WHEN hour(ts) BETWEEN 16 AND 21 THEN '16-21' ELSE 'rest' END AS hour_chunk FROM jams""")
def _(spark, sf):
    return views.feed(spark, sf).select("event_id", timefn.hour_chunk(F.hour("ts")).alias("hour_chunk"))


@query("prj03_local_chunk", "jams", """
SELECT event_id, CASE WHEN h BETWEEN 6 AND 11 THEN 'from 6h to 12h' WHEN h BETWEEN 12 AND 17 THEN 'from 12h to 18h'
  ELSE 'rest' END AS chunk FROM (SELECT event_id, hour(ts - INTERVAL 5 HOUR) AS h FROM jams)""")
def _(spark, sf):
    chunk = timefn.local_chunk(F.col("ts"), F.lit("America/Lima"), (6, 12, 18))
    return views.feed(spark, sf).select("event_id", chunk.alias("chunk"))


@query("prj04_workday_daytime", "jams", """
SELECT event_id, isodow(ts) <= 5 AS workday, hour(ts) > 6 AND hour(ts) < 20 AS daytime FROM jams""")
def _(spark, sf):
    ts = F.col("ts")
    return views.feed(spark, sf).select(
        "event_id", timefn.workday(timefn.iso_dow(ts)).alias("workday"), timefn.daytime(ts).alias("daytime")
    )


@query("prj05_local_stamp", "jams meta", """
SELECT event_id, strftime(CASE j.region_slug WHEN 'click' THEN ts - INTERVAL 3 HOUR WHEN 'error' THEN ts - INTERVAL 6 HOUR
  WHEN 'purchase' THEN ts - INTERVAL 3 HOUR WHEN 'signup' THEN ts - INTERVAL 5 HOUR END, '%Y-%m-%d %H:%M:%S') AS local
FROM jams j JOIN meta m ON j.region_slug = m.region_slug""")
def _(spark, sf):
    joined = views.feed(spark, sf).join(views.meta(spark, sf), "region_slug")
    return joined.select("event_id", timefn.local_stamp(F.col("ts"), F.col("timezone")).alias("local"))


@query("prj06_hour_stamp", "jams", "SELECT event_id, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS stamp FROM jams")
def _(spark, sf):
    df = views.feed(spark, sf).select("event_id", *timefn.parts(F.col("ts")))
    return texts(df.select("event_id", timefn.hour_stamp().alias("stamp")))


@query("prj07_slug", "", """
SELECT s_suppkey, 'sao_' || replace(lower(strip_accents(n_name || ' Área ' || s_name)), ' ', '_') AS slug
FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def _(spark, sf):
    supplier = views.table(spark, sf, "supplier")
    nation = views.table(spark, sf, "nation")
    name = F.concat(F.col("n_name"), F.lit(" Área "), F.col("s_name"))
    joined = supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"])
    return joined.select("s_suppkey", text.slug(name, "sao").alias("slug"))


@query("prj08_week_label", "series", """
SELECT region_slug, day(min(date)) || '/' || month(min(date)) || ' to ' || day(max(date)) || '/' || month(max(date)) AS label,
  strftime(date_trunc('week', date), '%Y-%m-%d') AS week FROM series GROUP BY region_slug, date_trunc('week', date)""")
def _(spark, sf):
    weeks = views.series(spark, sf).groupBy("region_slug", F.date_trunc("week", "date").cast("date").alias("week"))
    return texts(weeks.agg(timefn.week_label(F.min("date"), F.max("date")).alias("label")))


@query("src03_year_table", "", """
SELECT year(d)::int AS year, month(d)::int AS month, day(d)::int AS day, isodow(d)::int AS dow, 0 AS sum_length,
  strftime(d, '%m%d') <> '1231' AS short
FROM (SELECT unnest(generate_series(make_date(y, 1, 1)::timestamp, make_date(y, 12, 31)::timestamp, INTERVAL 1 DAY))::date AS d
      FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders))""")
def _(spark, sf):
    years = views.table(spark, sf, "orders").select(F.year("o_orderdate").alias("year")).distinct()
    keys = ["year", "month", "day", "dow", "sum_length"]
    short = calendars.year_table(years, inclusive=False).withColumn("short", F.lit(True))
    full = calendars.year_table(years)
    return full.join(short, keys, "left").fillna(False, ["short"])


# -- sets ---------------------------------------------------------------------------------


@query("set01_union", "", """
SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_name, s_acctbal, NULL FROM supplier""")
def _(spark, sf):
    a = views.table(spark, sf, "customer").selectExpr("c_name AS name", "c_acctbal AS balance", "c_mktsegment AS segment")
    b = views.table(spark, sf, "supplier").selectExpr("s_acctbal AS balance", "s_name AS name")
    return reshape.union([a, b])


@query("set02_distinct", "jams", """
SELECT uuid, datetime, region_slug, length, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY uuid, datetime ORDER BY length, event_id) AS rn FROM jams) WHERE rn = 1""")
def _(spark, sf):
    jams = views.jams(spark, sf).select("uuid", "datetime", "region_slug", "length", "event_id")
    return reshape.distinct(jams, ["uuid", "datetime"], ["length", "event_id"])


@query("set03_key_sets", "", """
SELECT 'only_customers' AS side, n FROM (SELECT c_nationkey AS n FROM customer WHERE c_acctbal < 0 EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)
UNION ALL SELECT 'only_suppliers', n FROM (SELECT s_nationkey AS n FROM supplier WHERE s_acctbal > 5000 EXCEPT SELECT c_nationkey FROM customer WHERE c_acctbal < 0)
UNION ALL SELECT 'both', n FROM (SELECT s_nationkey AS n FROM supplier WHERE s_acctbal > 5000 INTERSECT SELECT c_nationkey FROM customer WHERE c_acctbal < 0)""")
def _(spark, sf):
    a = views.table(spark, sf, "customer").where("c_acctbal < 0").select(F.col("c_nationkey").alias("n"))
    b = views.table(spark, sf, "supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("n"))
    parts = {
        "only_customers": reshape.key_difference(a, b, "n"),
        "only_suppliers": reshape.key_difference(b, a, "n"),
        "both": reshape.key_intersection(a, b, "n"),
    }
    return reshape.union([df.withColumn("side", F.lit(side)) for side, df in parts.items()])


@query("set04_exact_duplicates", "jams", """
SELECT datetime, sum(n)::bigint AS n_rows, count(*) AS n_distinct, sum(n - 1)::bigint AS n_duplicates
FROM (SELECT datetime, uuid, level, count(*) AS n FROM jams GROUP BY ALL) GROUP BY 1""")
def _(spark, sf):
    jams = views.jams(spark, sf).select("datetime", "uuid", "level", "retrievaltime")
    return dq.exact_duplicates(jams, "datetime", ignore=["retrievaltime"])


# -- day samples ----------------------------------------------------------------------------


def _days(spark, sf):
    span = views.table(spark, sf, "orders").agg(
        F.min(F.to_date("o_orderdate")).alias("a"), F.max(F.to_date("o_orderdate")).alias("b")
    )
    return calendars.expand_days(span, "a", "b")


_DAYS = "d as (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY))::date AS d FROM orders)"


@query("srt05_random_days", "jams", """
SELECT datetime FROM (SELECT DISTINCT datetime FROM jams) ORDER BY md5('1234|' || datetime) LIMIT 10""")
def _(spark, sf):
    return sampling.random_days(views.jams(spark, sf).select("datetime"), 10)


@query("srt06_weeks_per_month", "", f"""
with {_DAYS}, w as (SELECT d, date_trunc('week', d) AS w, date_trunc('month', d) AS m FROM d),
f as (SELECT * FROM w WHERE w IN (SELECT w FROM w GROUP BY 1 HAVING count(*) = 7)),
p as (SELECT m, arg_min(w, md5('1234|' || d::varchar)) AS w FROM f GROUP BY 1)
SELECT strftime(d, '%Y-%m-%d') AS date, strftime(d, '%Y%m%d') AS datetime FROM f WHERE w IN (SELECT w FROM p)""")
def _(spark, sf):
    return texts(sampling.weeks_per_month(_days(spark, sf)))


@query("srt07_balanced_weekdays", "", f"""
with {_DAYS}, k as (SELECT d, isodow(d)::int AS dow, date_trunc('week', d)::date AS w FROM d WHERE isodow(d) <= 5
  AND NOT (month(d) = 1 AND day(d) <= 15) AND NOT (month(d) = 12 AND day(d) >= 15)),
r as (SELECT w, row_number() OVER (ORDER BY md5('1234|' || w::varchar)) - 1 AS r FROM (SELECT w FROM k GROUP BY 1 HAVING count(*) = 5))
SELECT strftime(d, '%Y-%m-%d') AS date, dow, strftime(k.w, '%Y-%m-%d') AS week FROM k JOIN r ON r.w = k.w WHERE r < 50 AND dow = r % 5 + 1""")
def _(spark, sf):
    return texts(sampling.balanced_weekdays(_days(spark, sf), 50))
