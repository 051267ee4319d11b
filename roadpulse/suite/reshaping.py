"""Long/wide forms (RSH), mobility comparison (MOB), product checks (DQ)."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse.operators import dq, mobility, reshape
from roadpulse.suite import views
from roadpulse.suite.indices import daily_index
from roadpulse.suite.joins import _EXT, dash, driven, report
from roadpulse.suite.registry import query, rounded, texts

_S = "strftime(date, '%Y-%m-%d') AS date"


@query("rsh01_to_long", "", """
SELECT l_orderkey, l_linenumber, 'l_quantity' AS measure, l_quantity AS value FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', l_discount FROM lineitem""")
def _(spark, sf):
    return reshape.to_long(views.table(spark, sf, "lineitem"), ["l_quantity", "l_tax", "l_discount"], ["l_orderkey", "l_linenumber"])


@query("rsh02_to_wide", "series", """
SELECT strftime(date, '%Y-%m-%d') AS date, round(avg(observed) FILTER (region_slug = 'africa'), 4) AS africa,
  round(avg(observed) FILTER (region_slug = 'america'), 4) AS america, round(avg(observed) FILTER (region_slug = 'asia'), 4) AS asia,
  round(avg(observed) FILTER (region_slug = 'europe'), 4) AS europe,
  round(avg(observed) FILTER (region_slug = 'middle east'), 4) AS "middle east" FROM series GROUP BY 1""")
def _(spark, sf):
    df = texts(views.series(spark, sf))
    return rounded(reshape.to_wide(df, ["date"], "region_slug", "observed", ["africa", "america", "asia", "europe", "middle east"]), 4)


@query("rsh03_tag_measure", "", """
SELECT l_orderkey, l_linenumber, CASE WHEN m = 'l_quantity' THEN 'tci_observed' ELSE m END AS measure,
  CASE WHEN m IN ('l_quantity', 'l_extendedprice') THEN 'TCI' ELSE 'TCP' END AS type, v AS value FROM (
  SELECT l_orderkey, l_linenumber, 'l_quantity' AS m, l_quantity AS v FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'l_extendedprice', l_extendedprice FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem)""")
def _(spark, sf):
    long = reshape.to_long(views.table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_tax"], ["l_orderkey", "l_linenumber"])
    return reshape.tag_measure(long, ["l_quantity", "l_extendedprice"], {"l_quantity": "tci_observed"})


@query("rsh04_split_label", "", """
SELECT p_partkey, 'shift' AS kind, 'c' || p_size AS c, 'w' || p_brand AS w FROM part""")
def _(spark, sf):
    label = F.concat(F.lit("shift_c"), F.col("p_size").cast("string"), F.lit("_w"), F.col("p_brand"))
    df = views.table(spark, sf, "part").select("p_partkey", label.alias("label"))
    return reshape.split_label(df, "label", ["kind", "c", "w"]).drop("label")


# -- mobility -----------------------------------------------------------------------------


@query("mob01_rebase", "sales", f"""
with {_EXT}, v as (SELECT country, city, date, isodow(date)::int AS dow, km FROM driven),
b as (SELECT country, city, dow, km AS base FROM v WHERE date BETWEEN DATE '1996-03-04' AND DATE '1996-03-10')
SELECT country, city, {_S}, dow, round(100 * (km - base) / base, 4) AS pc_driven_miles FROM v JOIN b USING (country, city, dow)""")
def _(spark, sf):
    df = mobility.rebase(driven(spark, sf), ["country", "city"], ["pc_driven_miles"], ("1996-03-04", "1996-03-10"))
    return rounded(texts(df), 4)


def _long(spark, sf):
    km = driven(spark, sf).groupBy("country", "date").agg(F.round(F.sum("pc_driven_miles"), 2).alias("pc_driven_miles"))
    both = mobility.combine_country(dash(spark, sf), km, report(spark, sf))
    return reshape.to_long(both, ["tcp", "pc_driven_miles", "transit", "workplace"], ["region_slug", "date"])


_LONG = f"""
{_EXT}, dc as (SELECT country, date, round(sum(km), 2) AS km FROM driven GROUP BY ALL),
cb as (SELECT d.region_slug, d.date, tcp, dc.km, transit, workplace FROM dash d
  LEFT JOIN dc ON dc.country = d.country_name AND dc.date = d.date LEFT JOIN rep ON rep.code = d.country_iso_code AND rep.date = d.date),
lg as (SELECT region_slug, date, 'tcp' AS measure, tcp AS value FROM cb UNION ALL SELECT region_slug, date, 'pc_driven_miles', km FROM cb
  UNION ALL SELECT region_slug, date, 'transit', transit FROM cb UNION ALL SELECT region_slug, date, 'workplace', workplace FROM cb),
mn as (SELECT region_slug, measure, avg(value) AS m FROM lg WHERE date BETWEEN DATE '1996-03-01' AND DATE '1996-05-31' GROUP BY ALL),
rs as (SELECT lg.*, -100 * value / nullif(m, 0) AS r, m FROM lg LEFT JOIN mn USING (region_slug, measure))"""


def _rescaled(spark, sf):
    return mobility.rescale(_long(spark, sf), ("1996-03-01", "1996-05-31"))


@query("mob02_rescale", "sales", f"""
with {_LONG} SELECT region_slug, {_S}, measure, value, round(m, 6) AS mean_val, round(r, 6) AS value_rescaled FROM rs""")
def _(spark, sf):
    return rounded(texts(_rescaled(spark, sf)), 6, ("mean_val", "value_rescaled"))


@query("mob03_smooth", "sales", f"""
with {_LONG} SELECT region_slug, {_S}, measure, CASE WHEN count(r) OVER w = 7 THEN round(avg(r) OVER w, 5) END AS value_rescaled_ma FROM rs
WINDOW w AS (PARTITION BY region_slug, measure ORDER BY date ROWS 6 PRECEDING)""")
def _(spark, sf):
    df = texts(mobility.smooth(_rescaled(spark, sf)).select("region_slug", "date", "measure", "value_rescaled_ma"))
    return rounded(df, 5)


@query("mob04_missing_share", "sales", f"""
with {_LONG} SELECT measure, round(avg((value IS NULL)::int), 6) AS missing, count(DISTINCT region_slug) FILTER (value IS NOT NULL) AS regions FROM lg GROUP BY 1""")
def _(spark, sf):
    measures = ["tcp", "pc_driven_miles", "transit", "workplace"]
    wide = reshape.to_wide(_long(spark, sf), ["region_slug", "date"], "measure", "value", measures)
    return rounded(mobility.missing_share(wide, measures))


# -- checks -------------------------------------------------------------------------------


@query("dq01_all_regions_present", "hours good", """
SELECT 'blocked' AS product, region_slug FROM (SELECT DISTINCT uuid AS region_slug FROM jams WHERE uuid NOT IN (SELECT uuid FROM jams WHERE blockingalertuuid IS NOT NULL AND level = 5))
UNION ALL SELECT 'good', region_slug FROM (SELECT DISTINCT uuid AS region_slug FROM jams WHERE uuid NOT IN (SELECT uuid FROM good))""")
def _(spark, sf):
    jams = views.jams(spark, sf).withColumn("region_slug", F.col("uuid"))
    blocked = jams.where("blockingalertuuid IS NOT NULL AND level = 5")
    from roadpulse.operators import filters

    return dq.all_regions_present(jams, {"blocked": blocked, "good": filters.quality(jams)})


@query("dq02_tables_exist", "", """
SELECT 'orders' AS product, true AS readable, 10 AS n_rows FROM (SELECT count(*) AS n FROM orders) WHERE n >= 10
UNION ALL SELECT 'region', true, (SELECT count(*) FROM region)::int UNION ALL SELECT 'nothing', false, 0""")
def _(spark, sf):
    return dq.tables_exist(spark, {n: f"{sf}/{n}.parquet" for n in ("orders", "region", "nothing")})


_IDX = """
h as (SELECT region_slug, dow, avg(s) AS e FROM (SELECT region_slug, month, day, dow, sum(tci) AS s FROM base GROUP BY ALL) GROUP BY ALL),
d as (SELECT region_slug, year, month, dow, day, sum(tci) AS observed FROM daily GROUP BY ALL),
ix as (SELECT d.*, (observed / e - 1) * 100 AS tcp, m.dashboard FROM d JOIN h ON d.region_slug = h.region_slug AND d.dow = h.dow
  JOIN meta m ON d.region_slug = m.region_slug WHERE daily_approved OR m.region_slug = 'purchase')"""


@query("dq03_extreme_regions", "daily base meta", f"with {_IDX} SELECT DISTINCT region_slug FROM ix WHERE dashboard = 'TRUE' AND tcp > 60")
def _(spark, sf):
    return dq.extreme_regions(daily_index(spark, sf), 60)


@query("dq04_sync_publication", "daily base meta", f"""
with {_IDX}, w as (SELECT region_slug, month, day, sum(tci)::bigint AS tci FROM daily GROUP BY ALL)
SELECT w.*, CASE WHEN m.region_slug IN (SELECT region_slug FROM ix WHERE dashboard = 'TRUE') THEN m.dashboard ELSE 'FALSE' END AS dashboard
FROM w JOIN meta m ON m.region_slug = w.region_slug""")
def _(spark, sf):
    sums = views.daily(spark, sf).groupBy("region_slug", "month", "day").agg(F.sum("tci").alias("tci"))
    weekly = sums.join(views.meta(spark, sf).select("region_slug", "dashboard"), "region_slug")
    return dq.sync_publication(weekly, daily_index(spark, sf))


@query("dq05_published_counts", "daily base meta", f"with {_IDX} SELECT dashboard, count(DISTINCT region_slug) AS n_regions FROM ix GROUP BY 1")
def _(spark, sf):
    return dq.published_counts(daily_index(spark, sf))


@query("dq06_duplicate_days", "sales", f"SELECT region_slug, {_S}, count(*) AS n FROM sales GROUP BY region_slug, date HAVING count(*) > 1")
def _(spark, sf):
    return texts(dq.duplicate_days(views.sales(spark, sf)))


