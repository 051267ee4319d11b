"""Joins (JN) and region plans (REG)."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse.operators import dq, filters, mobility, reshape, stats, tci
from roadpulse.plans import incremental, index, regions
from roadpulse.sources import calendars
from roadpulse.suite import views
from roadpulse.suite.registry import query, rounded, texts
from roadpulse.suite.shapes import _zones, roads

_S = "strftime(date, '%Y-%m-%d') AS date"


@query("jn01_with_baseline", "daily base", """
with h as (SELECT region_slug, dow, avg(s) AS e FROM (
  SELECT region_slug, month, day, dow, sum(tci) AS s FROM base GROUP BY ALL) GROUP BY ALL),
d as (SELECT region_slug, year, month, day, dow, sum(tci)::bigint AS observed FROM daily GROUP BY ALL)
SELECT d.*, round(e, 6) AS expected_2020, round(observed / e, 6) AS ratio_20 FROM d JOIN h ON d.region_slug = h.region_slug AND d.dow = h.dow""")
def _(spark, sf):
    obs = tci.observed(views.daily(spark, sf), ["region_slug", "year", "month", "day", "dow"])
    base = tci.baseline_mean(views.base(spark, sf), ["region_slug", "dow"], ["month", "day"])
    return rounded(tci.with_baseline(obs, base, ["region_slug", "dow"]))


@query("jn02_with_metadata", "hours meta", """
SELECT h.region_slug, m.region_name, m.country_iso AS country_iso_code, h.year, h.month, h.day, h.hour, sum(h.tci)::bigint AS tci
FROM hours h JOIN meta m ON h.region_slug = m.region_slug GROUP BY ALL""")
def _(spark, sf):
    sums = tci.observed(views.hours(spark, sf), ["region_slug", "year", "month", "day", "hour"], name="tci")
    meta = index.labels(views.meta(spark, sf)).select("region_slug", "region_name", "country_iso_code")
    return sums.join(meta, "region_slug")


def _meta(spark, sf):
    """Region metadata of the series, keyed by lower-case region name."""
    return views.meta(spark, sf).withColumn("region_slug", F.lower("region_name"))


def _lengths(spark, sf):
    """Road length per region from part sizes and supplier balances."""
    supplier, nation = views.table(spark, sf, "supplier"), views.table(spark, sf, "nation")
    region = views.table(spark, sf, "region")
    joined = supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"]).join(
        region, nation["n_regionkey"] == region["r_regionkey"])
    return joined.groupBy(F.lower("r_name").alias("region_slug")).agg(F.round(F.sum("s_acctbal") * 10, 2).alias("osm_length"))


def _codes(spark, sf):
    key = F.col("n_nationkey").cast("string")
    return views.table(spark, sf, "nation").select(
        F.concat(F.lit("R"), key).alias("iso2_code"), F.concat(F.lit("P"), key).alias("partner_code"),
        F.concat(F.lit("F"), key).alias("feed_code"), F.col("n_name").alias("country_name_eng"))


def _ready(spark, sf):
    prepared = _meta(spark, sf).drop("partner_code", "country_name_eng")
    return regions.ready(prepared, _lengths(spark, sf), _codes(spark, sf))


_LEN = """
ln as (SELECT lower(r_name) AS region_slug, round(sum(s_acctbal) * 10, 2) AS osm_length FROM supplier JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey GROUP BY 1),
rd as (SELECT lower(m.region_name) AS region_slug, m.region_name, m.country_iso, ln.osm_length, 'P' || n_nationkey AS partner_code,
  'F' || n_nationkey AS feed_code, n_name AS country_name_eng, m.region_shapefile_wkt
  FROM meta m JOIN ln ON ln.region_slug = lower(m.region_name) JOIN nation ON 'R' || n_nationkey = m.country_iso)"""


@query("jn03_ready", "meta", f"with {_LEN} SELECT * FROM rd")
def _(spark, sf):
    return _ready(spark, sf).select(
        "region_slug", "region_name", "country_iso", "osm_length", "partner_code", "feed_code", "country_name_eng", "region_shapefile_wkt")


_VAR = """
dv as (SELECT region_slug, count(*) AS n_days, avg(v) AS daily_mean, stddev_pop(v) AS daily_std, stddev_pop(v) / avg(v) AS dcv,
  avg(v) FILTER (dow IN (6, 7)) AS me, avg(v) FILTER (dow NOT IN (6, 7)) AS mw
  FROM (SELECT region_slug, sum_length AS v, dow FROM analysis) GROUP BY 1),
wv as (SELECT region_slug, avg(s) AS wm, stddev_pop(s) / avg(s) AS wcv FROM (
  SELECT region_slug, week(make_date(year, month, day)) AS w, sum(sum_length) AS s FROM analysis GROUP BY ALL) GROUP BY 1)"""
_VAR_SELECT = """
SELECT rd.region_slug, n_days, round(daily_mean, 4) AS daily_mean, round(daily_mean / osm_length, 6) AS daily_osm_ratio,
  round(me / osm_length, 6) AS weekend_osm_ratio, round(mw / osm_length, 6) AS weekday_osm_ratio,
  round(wm / 7 / osm_length, 6) AS weekly_osm_ratio, round(dcv, 6) AS daily_coef_var, round(wcv, 6) AS weekly_coef_var,
  coalesce(dcv <= 0.65 AND daily_mean / osm_length >= 0.1, false) AS daily_approved,
  coalesce(wcv <= 0.65 AND wm / 7 / osm_length >= 0.1, false) AS weekly_approved"""
_VAR_COLUMNS = [
    "region_slug", "n_days", "daily_mean", "daily_osm_ratio", "weekend_osm_ratio", "weekday_osm_ratio", "weekly_osm_ratio",
    "daily_coef_var", "weekly_coef_var", "daily_approved", "weekly_approved"]


def _var(df):
    return rounded(rounded(df.select(*_VAR_COLUMNS), 4, ("daily_mean",)))


@query("jn04_with_variation", "meta analysis", f"with {_LEN}, {_VAR} {_VAR_SELECT} FROM rd LEFT JOIN dv USING (region_slug) LEFT JOIN wv USING (region_slug)")
def _(spark, sf):
    df = views.analysis(spark, sf)
    both = stats.daily_variation(df).join(stats.weekly_variation(df), "region_slug")
    return _var(regions.with_variation(both, _ready(spark, sf), 0.65, 0.1))


@query("reg03_variation", "meta analysis", f"""
with {_LEN}, {_VAR} {_VAR_SELECT}, CASE WHEN rd.region_slug = 'europe' THEN 11.7 + 0.64 WHEN rd.region_slug = 'middle east' THEN 11.7 - 0.6 ELSE 11.7 END::double AS area
FROM rd LEFT JOIN dv USING (region_slug) LEFT JOIN wv USING (region_slug)""")
def _(spark, sf):
    df = regions.variation(views.analysis(spark, sf), _ready(spark, sf), 0.65, 0.1)
    return rounded(rounded(df.select(*_VAR_COLUMNS, "area"), 4, ("daily_mean",)))


@query("reg01_prepare", "meta", """
SELECT m.region_slug, CASE WHEN n_nationkey = 3 THEN 'America/Santiago' ELSE 'Zone/' || n_nationkey END AS timezone, m.population
FROM meta m JOIN (SELECT ['click', 'error', 'purchase', 'signup', 'view'][r_regionkey + 1] AS region_slug, r_regionkey * 2 + 1.8 AS px FROM region) p
  ON p.region_slug = m.region_slug
LEFT JOIN nation ON px >= n_nationkey * 1.25 - 1 AND px < n_nationkey * 1.25 + 0.25""")
def _(spark, sf):
    df = regions.prepare(views.meta(spark, sf), _zones(spark, sf), views.GRID, 5)
    return df.select("region_slug", "timezone", "population")


@query("reg02_osm_length", "jam_regions jams meta", """
with l as (SELECT met, sum(length) AS v FROM jam_regions JOIN jams USING (event_id) WHERE region_slug IN ('click', 'error', 'purchase') GROUP BY 1)
SELECT region_slug, round(CASE WHEN region_slug IN ('click', 'error') THEN 77.0 ELSE coalesce(v, 0) END, 4)::double AS osm_length
FROM meta LEFT JOIN l ON met = region_slug""")
def _(spark, sf):
    """Two regions are stored unchanged, one is to be rerun, one changed its shape, one is new."""
    meta = views.meta(spark, sf).withColumn("rerun", F.when(F.col("region_slug") == "purchase", "TRUE").otherwise("FALSE"))
    old = F.when(F.col("region_slug") == "signup", "POLYGON ((0 0, 1 0, 1 1, 0 0))").otherwise(F.col("region_shapefile_wkt"))
    current = meta.where("region_slug <> 'view'").select("region_slug", old.alias("region_shapefile_wkt"), F.lit(77.0).alias("osm_length"))
    df = regions.osm_length(meta, current, roads(spark, sf), grid=views.GRID, resolution=6)
    return rounded(df.select("region_slug", "osm_length"), 4)


_CAL = """
cal as (SELECT d::date AS d FROM (SELECT unnest(generate_series(min(make_date(year, 1, 1))::timestamp, max(make_date(year, 12, 30))::timestamp, INTERVAL 1 DAY)) AS d
  FROM analysis) WHERE NOT (month(d) = 12 AND day(d) = 31) AND year(d) IN (SELECT year FROM analysis))"""


@query("jn05_pad_calendar", "analysis", f"""
with {_CAL}, a as (SELECT *, make_date(year, month, day) AS d FROM analysis),
f as (SELECT r.region_slug, cal.d FROM (SELECT DISTINCT region_slug FROM a) r, cal)
SELECT coalesce(f.region_slug, a.region_slug) AS region_slug, year(f.d)::int AS year, month(f.d)::int AS month, isodow(f.d)::int AS dow, day(f.d)::int AS day,
  CASE WHEN coalesce(f.region_slug, a.region_slug) = 'asia' THEN sum_length ELSE coalesce(sum_length, 0) END AS sum_length
FROM f FULL JOIN a ON f.region_slug = a.region_slug AND f.d = a.d""")
def _(spark, sf):
    daily = views.analysis(spark, sf)
    year = daily.select("year").distinct()
    return calendars.pad_calendar(daily, calendars.year_table(year, inclusive=False), sampled=["asia"])


@query("reg04_analysis_daily", "jam_regions good", """
with p as (
  SELECT g.*, met AS slug, ['click', 'error', 'purchase', 'signup', 'view'] AS names FROM good g JOIN jam_regions USING (event_id)
  WHERE 'F' || g.level = 'F' || (list_position(['click', 'error', 'purchase', 'signup', 'view'], met) - 1) AND met <> 'view'
  UNION ALL SELECT g.*, 'view', [] FROM good g),
k as (SELECT * FROM p WHERE (slug <> 'error' AND ts::date BETWEEN DATE '2024-01-01' AND DATE '2024-12-31')
  OR (slug = 'error' AND ts::date IN (DATE '2024-01-03', DATE '2024-01-10', DATE '2024-01-17'))),
d as (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY slug, uuid, ts::date, (hour(ts) * 60 + minute(ts)) // 5 ORDER BY ts, length, line, event_id) AS rn FROM k) WHERE rn = 1),
s as (SELECT slug AS region_slug, ts::date AS d, sum(length) AS v FROM d GROUP BY 1, 2),
cal as (SELECT unnest(generate_series(DATE '2024-01-01'::timestamp, DATE '2024-12-30'::timestamp, INTERVAL 1 DAY))::date AS d),
f as (SELECT region_slug, cal.d FROM (SELECT DISTINCT region_slug FROM s), cal)
SELECT f.region_slug, year(f.d)::int AS year, month(f.d)::int AS month, isodow(f.d)::int AS dow, day(f.d)::int AS day,
  round(CASE WHEN f.region_slug = 'error' THEN v ELSE coalesce(v, 0) END, 4) AS sum_length
FROM f LEFT JOIN s ON s.region_slug = f.region_slug AND s.d = f.d""")
def _(spark, sf):
    jams = views.feed(spark, sf).drop("region_slug").withColumn("country", F.concat(F.lit("F"), F.col("level").cast("string")))
    place = F.array_position(F.array(*[F.lit(s) for s in views.SLUGS]), F.col("region_slug")) - 1
    dim = views.meta(spark, sf).select("region_slug", F.concat(F.lit("F"), place.cast("string")).alias("feed_code"), "region_shapefile_wkt")
    year = views.feed(spark, sf).select(F.year("ts").alias("year")).distinct()
    df = regions.analysis_daily(
        jams, dim, calendars.year_table(year, inclusive=False), "2024-01-01", "2024-12-31",
        {"error": ["20240103", "20240110", "20240117"]}, grid=views.GRID, resolution=6, wide=["view"])
    return rounded(df, 4)


@query("jn09_join_weeks", "hours", """
with w as (SELECT year, month, day, sum(CASE WHEN dow = 1 THEN 1 ELSE 0 END) OVER (ORDER BY d)::bigint AS week_number_obs, week(d)::int AS week_number
  FROM (SELECT DISTINCT year, month, day, dow, make_date(year, month, day) AS d FROM hours) WHERE d >= DATE '2024-01-08')
SELECT h.*, w.week_number_obs, w.week_number FROM hours h JOIN w ON h.year = w.year AND h.month = w.month AND h.day = w.day""")
def _(spark, sf):
    hours = views.hours(spark, sf)
    return calendars.join_weeks(hours, calendars.weeks(hours, views.START))


@query("jn10_missing", "series", f"""
with d as (SELECT unnest(generate_series(DATE '1994-12-01'::timestamp, DATE '2001-12-31'::timestamp, INTERVAL 1 DAY))::date AS date)
SELECT r.region_slug, strftime(d.date, '%Y-%m-%d') AS date FROM (SELECT DISTINCT region_slug FROM series) r, d
WHERE NOT EXISTS (SELECT 1 FROM series s WHERE s.region_slug = r.region_slug AND s.date = d.date)""")
def _(spark, sf):
    df = views.series(spark, sf)
    return texts(incremental.remaining(df, incremental.dates(spark, "1994-12-01", "2001-12-31"), df.select("region_slug", "date")))


@query("jn11_missing_regions", "meta", """
SELECT c_name AS region_slug FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)""")
def _(spark, sf):
    customer, orders = views.table(spark, sf, "customer"), views.table(spark, sf, "orders")
    big = orders.where("o_totalprice > 300000").join(customer, orders["o_custkey"] == customer["c_custkey"])
    return dq.missing_regions(customer.withColumnRenamed("c_name", "region_slug"), big.withColumnRenamed("c_name", "region_slug"))


@query("jn12_in_subquery", "hours meta", """
SELECT region_slug, line, tci FROM hours WHERE region_slug IN (SELECT region_slug FROM meta WHERE region_type = 'city' AND dashboard = 'TRUE')""")
def _(spark, sf):
    test = (F.col("region_type") == "city") & (F.col("dashboard") == "TRUE")
    return filters.in_subquery(views.hours(spark, sf), views.meta(spark, sf), test).select("region_slug", "line", "tci")


# -- external series ----------------------------------------------------------------------


def dash(spark, sf):
    """Index per nation and day from orders."""
    sales = views.sales(spark, sf)
    return sales.groupBy(
        F.lower("nation").alias("region_slug"), F.col("region_slug").alias("country_name"), F.col("nation").alias("country_iso_code"), "date"
    ).agg((F.max("amount") - 250000).alias("tcp"))


def driven(spark, sf):
    """Driven distance per region and shipping day."""
    items, supplier = views.table(spark, sf, "lineitem"), views.table(spark, sf, "supplier")
    nation, region = views.table(spark, sf, "nation"), views.table(spark, sf, "region")
    joined = items.join(supplier, items["l_suppkey"] == supplier["s_suppkey"]).join(
        nation, F.col("s_nationkey") == nation["n_nationkey"]).join(region, F.col("n_regionkey") == region["r_regionkey"])
    return joined.groupBy(F.lower("r_name").alias("country"), F.col("n_name").alias("city"), F.to_date("l_shipdate").alias("date")).agg(
        F.round(F.sum("l_quantity"), 2).alias("pc_driven_miles"))


def report(spark, sf):
    """Mobility report per nation and day from order counts and priorities."""
    sales = views.sales(spark, sf).where("amount < 300000")
    return sales.groupBy(F.col("nation").alias("country_region_code"), F.col("region_slug").alias("country_region"), "date").agg(
        F.max("amount").alias("transit"), F.min("amount").alias("workplace"))


_EXT = """
dash as (SELECT lower(nation) AS region_slug, region_slug AS country_name, nation AS country_iso_code, date, max(amount) - 250000 AS tcp FROM sales GROUP BY ALL),
driven as (SELECT lower(r_name) AS country, n_name AS city, l_shipdate::date AS date, round(sum(l_quantity), 2) AS km FROM lineitem
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL),
rep as (SELECT nation AS code, region_slug AS country, date, max(amount) AS transit, min(amount) AS workplace
  FROM sales WHERE amount < 300000 GROUP BY ALL)"""


@query("jn13_combine_country", "sales", f"""
with {_EXT}, dc as (SELECT country, date, round(sum(km), 2) AS km FROM driven GROUP BY ALL)
SELECT d.region_slug, d.country_name, d.country_iso_code, strftime(d.date, '%Y-%m-%d') AS date, tcp, dc.km AS pc_driven_miles, transit, workplace
FROM dash d LEFT JOIN dc ON dc.country = d.country_name AND dc.date = d.date LEFT JOIN rep ON rep.code = d.country_iso_code AND rep.date = d.date""")
def _(spark, sf):
    per_country = driven(spark, sf).groupBy("country", "date").agg(F.round(F.sum("pc_driven_miles"), 2).alias("pc_driven_miles"))
    return texts(mobility.combine_country(dash(spark, sf), per_country, report(spark, sf)))


@query("jn13_combine_city", "sales", f"""
with {_EXT}
SELECT d.country_iso_code AS country_iso_code__dash, d.country_name AS country_name__dash, d.region_slug AS region_slug__dash,
  strftime(d.date, '%Y-%m-%d') AS date__dash, tcp AS tcp__dash, driven.km AS pc_driven_miles__km, transit AS transit__mob, workplace AS workplace__mob
FROM dash d LEFT JOIN driven ON driven.country = d.country_name AND driven.city = d.country_iso_code AND driven.date = d.date
LEFT JOIN rep ON rep.code = d.country_iso_code AND rep.country = d.country_name AND rep.date = d.date""")
def _(spark, sf):
    nation, region = views.table(spark, sf, "nation"), views.table(spark, sf, "region")
    names = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        F.lower("n_name").alias("region_slug__dash"), F.lower("r_name").alias("country__km"), F.col("n_name").alias("city__km"),
        F.col("n_name").alias("country_region_code__mob"), F.lower("r_name").alias("country_region__mob"),
        F.lit("x").alias("sub_region_1__mob"), F.lit("None").alias("sub_region_2__mob"))
    mob = report(spark, sf).withColumn("sub_region_1", F.lit("x")).withColumn("sub_region_2", F.lit("None"))
    return texts(mobility.combine_city(dash(spark, sf), driven(spark, sf), mob, names))


@query("jn14_merge_all", "series", f"""
SELECT region_slug, {_S}, observed, least(observed, 300000.0) AS clipped, month(date)::int AS month FROM series WHERE observed > 50000 AND isodow(date) <= 5""")
def _(spark, sf):
    df = texts(views.series(spark, sf))
    keys = ["region_slug", "date"]
    a = df.where("observed > 50000")
    b = df.select(*keys, F.least("observed", F.lit(300000.0)).alias("clipped"))
    c = df.where(F.weekday("date") < 5).select(*keys, F.month("date").alias("month"))
    return reshape.merge_all([a, b, c], keys)


@query("jn17_full_join", "series", f"""
SELECT region_slug, strftime(date, '%Y-%m-%d') AS date, CASE WHEN observed > 200000 THEN observed END AS high,
  CASE WHEN observed < 300000 THEN true END AS low FROM series WHERE observed > 200000 OR observed < 300000""")
def _(spark, sf):
    df = texts(views.series(spark, sf))
    a = df.where("observed > 200000").withColumnRenamed("observed", "high")
    b = df.where("observed < 300000").select("region_slug", "date", F.lit(True).alias("low"))
    return reshape.full_join(a, b, ["region_slug", "date"])


@query("jn18_upsert", "", """
SELECT c_custkey, c_name, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders) THEN (SELECT max(o_totalprice) FROM orders WHERE o_custkey = c_custkey) ELSE c_acctbal END AS c_acctbal
FROM customer WHERE c_acctbal > 0
UNION ALL SELECT o_custkey, NULL, max(o_totalprice) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY 1""")
def _(spark, sf):
    current = views.table(spark, sf, "customer").where("c_acctbal > 0").select("c_custkey", "c_name", "c_acctbal")
    changed = views.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("c_acctbal"))
    return reshape.upsert(current, changed, "c_custkey", ["c_acctbal"], add_new=True)


@query("jn19_align", "", """
SELECT coalesce(a.n, b.n) AS n, customers, suppliers FROM (SELECT c_nationkey AS n, count(*) AS customers FROM customer WHERE c_acctbal < 500 GROUP BY 1) a
FULL JOIN (SELECT s_nationkey AS n, count(*) AS suppliers FROM supplier WHERE s_acctbal < 5000 GROUP BY 1) b ON a.n = b.n""")
def _(spark, sf):
    a = views.table(spark, sf, "customer").where("c_acctbal < 500").groupBy(F.col("c_nationkey").alias("n")).agg(F.count(F.lit(1)).alias("customers"))
    b = views.table(spark, sf, "supplier").where("s_acctbal < 5000").groupBy(F.col("s_nationkey").alias("n")).agg(F.count(F.lit(1)).alias("suppliers"))
    return reshape.align([a, b], ["n"])
