"""Aggregations (AG) and ordering (SRT-02..04)."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse.functions.timefn import hour_stamp, iso_dow
from roadpulse.operators import dq, reshape, stats, tci
from roadpulse.sources.calendars import weeks
from roadpulse.suite import views
from roadpulse.suite.registry import query, rounded, texts


@query("ag01_segment_hour", "hours", "SELECT * FROM hours")
def _(spark, sf):
    return views.hours(spark, sf)


@query("ag02_observed", "daily", """
SELECT region_slug, year, month, day, dow, sum(tci)::bigint AS observed FROM daily GROUP BY ALL""")
def _(spark, sf):
    return tci.observed(views.daily(spark, sf), ["region_slug", "year", "month", "day", "dow"])


@query("ag03_baseline_mean", "base", """
SELECT region_slug, hour, dow, round(avg(s), 6) AS expected_2020 FROM (
  SELECT region_slug, year, month, day, hour, dow, sum(tci) AS s FROM base GROUP BY ALL) GROUP BY ALL""")
def _(spark, sf):
    return rounded(tci.baseline_mean(views.base(spark, sf), ["region_slug", "hour", "dow"], ["year", "month", "day"]))


@query("ag04_baseline_total", "base", "SELECT region_slug, sum(tci)::bigint AS expected_2020 FROM base GROUP BY ALL")
def _(spark, sf):
    return tci.baseline_total(views.base(spark, sf))


@query("ag05_baseline_week", "hours", """
SELECT region_slug, round(sum(m), 6) AS expected_2020 FROM (
  SELECT region_slug, dow, avg(s) AS m FROM (
    SELECT region_slug, month, day, dow, sum(tci) AS s FROM hours GROUP BY ALL) GROUP BY ALL) GROUP BY ALL""")
def _(spark, sf):
    return rounded(tci.baseline_week(views.hours(spark, sf), ["region_slug"]))


@query("ag06_baseline_raw_mean", "base", """
SELECT region_slug, hour, dow, round(avg(tci), 6) AS expected_2020 FROM base GROUP BY ALL""")
def _(spark, sf):
    return rounded(tci.baseline_raw_mean(views.base(spark, sf), ["region_slug", "hour", "dow"]))


@query("ag07_week_observed", "analysis", """
SELECT region_slug, strftime(d - (dow - 1), '%Y-%m-%d') AS monday, week(d)::int AS week_number,
  min_by(year, dow) AS min_year, min_by(month, dow) AS min_month, min_by(day, dow) AS min_day,
  max_by(year, dow) AS max_year, max_by(month, dow) AS max_month, max_by(day, dow) AS max_day,
  round(sum(sum_length), 2) AS observed
FROM (SELECT *, make_date(year, month, day) AS d FROM analysis) GROUP BY 1, 2, 3""")
def _(spark, sf):
    from roadpulse.functions.timefn import ymd

    days = views.analysis(spark, sf).withColumns(
        {"week_number": F.weekofyear(ymd()), "monday": F.date_trunc("week", ymd()).cast("date")}
    )
    df = tci.week_observed(days, ["region_slug", "monday", "week_number"], value="sum_length")
    return rounded(texts(df), 2)


@query("ag08_daily_variation", "analysis", """
SELECT region_slug, count(*) AS n_days, round(avg(v), 4) AS daily_mean, round(stddev_pop(v), 4) AS daily_std,
  round(stddev_pop(v) / avg(v), 4) AS daily_coef_var, round(avg(e), 4) AS daily_mean_weekend,
  round(stddev_pop(e), 4) AS daily_std_weekend, round(stddev_pop(e) / avg(e), 4) AS daily_coef_var_weekend,
  round(avg(w), 4) AS daily_mean_weekday, round(stddev_pop(w), 4) AS daily_std_weekday,
  round(stddev_pop(w) / avg(w), 4) AS daily_coef_var_weekday, round(stddev_pop(w) / avg(e), 4) AS compat_weekday
FROM (SELECT region_slug, sum_length AS v, CASE WHEN dow IN (6, 7) THEN sum_length END AS e,
      CASE WHEN dow NOT IN (6, 7) THEN sum_length END AS w FROM analysis) GROUP BY ALL""")
def _(spark, sf):
    df = views.analysis(spark, sf)
    compat = stats.daily_variation(df, compat=True).select(
        "region_slug", F.col("daily_coef_var_weekday").alias("compat_weekday")
    )
    return rounded(stats.daily_variation(df).join(compat, "region_slug"), 4)


@query("ag09_weekly_variation", "analysis", """
SELECT region_slug, round(avg(s), 4) AS weekly_mean, round(stddev_pop(s), 4) AS weekly_std,
  round(stddev_pop(s) / avg(s), 4) AS weekly_coef_var
FROM (SELECT region_slug, week(make_date(year, month, day)) AS w, sum(sum_length) AS s FROM analysis GROUP BY ALL)
GROUP BY ALL""")
def _(spark, sf):
    return rounded(stats.weekly_variation(views.analysis(spark, sf)), 4)


@query("ag10_grid_variation", "hours", """
with dd as (SELECT region_slug AS grid_id, day, sum(tci) AS v FROM hours GROUP BY ALL),
ww as (
  SELECT grid_id, w, avg(d) AS v FROM (
    SELECT region_slug AS grid_id, week(make_date(year, month, day)) AS w, day, sum(tci) AS d FROM hours GROUP BY ALL)
  GROUP BY ALL HAVING count(*) = 7),
a as (SELECT grid_id, avg(v) AS dm, stddev_pop(v) AS ds FROM dd GROUP BY ALL),
b as (SELECT grid_id, avg(v) AS wm, stddev_pop(v) AS ws FROM ww GROUP BY ALL)
SELECT a.grid_id, round(dm, 6) AS daily_mean, round(ds, 6) AS daily_std, round(ds / dm, 6) AS daily_coef_var,
  round(wm, 6) AS weekly_mean, round(ws, 6) AS weekly_std, round(ws / wm, 6) AS weekly_coef_var
FROM a JOIN b ON a.grid_id = b.grid_id""")
def _(spark, sf):
    cells = views.hours(spark, sf).withColumnRenamed("region_slug", "grid_id")
    return rounded(stats.grid_variation(cells, "daily").join(stats.grid_variation(cells, "weekly"), "grid_id"))


@query("ag11_simple_variation", "jams", """
SELECT round(avg(t), 6) AS avg_tci, round(stddev_pop(t), 6) AS std_tci, round(stddev_pop(t) / avg(t), 6) AS coef_variation_tci
FROM (SELECT ts::date AS d, sum(length) AS t FROM jams WHERE level <> 5 GROUP BY 1)""")
def _(spark, sf):
    return rounded(stats.simple_variation(views.feed(spark, sf)))


@query("ag12_analysis_daily", "dedup", """
SELECT region_slug, year(ts)::int AS year, month(ts)::int AS month, isodow(ts)::int AS dow, day(ts)::int AS day,
  round(sum(length), 4) AS sum_length FROM dedup GROUP BY ALL""")
def _(spark, sf):
    return rounded(tci.analysis_daily(views.dedup(spark, sf)), 4)


@query("ag13_line_counts", "jams", "SELECT line AS line_wkt, count(*) AS count_lines FROM jams GROUP BY ALL")
def _(spark, sf):
    return stats.line_counts(views.jams(spark, sf))


@query("ag17_records", "jams", """
SELECT datetime, level, count(*) AS n_rows, round(sum(length), 4) AS sum_length, count(DISTINCT uuid) AS n_ids
FROM jams GROUP BY ALL""")
def _(spark, sf):
    return rounded(stats.records(views.jams(spark, sf), ["datetime", "level"]), 4)


@query("ag18_arbitrary_dedup", "jams", """
with once as (SELECT uuid, region_slug, length, min(ts) AS ts FROM jams GROUP BY ALL),
kept as (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uuid, ts::date, (hour(ts) * 60 + minute(ts)) // 60
  ORDER BY ts, length, region_slug) AS rn FROM once) WHERE rn = 1)
SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS n_rows, round(sum(length), 4) AS sum_length FROM kept GROUP BY 1""")
def _(spark, sf):
    jams = views.feed(spark, sf).select("uuid", F.col("region_slug").alias("line"), "length", "ts")
    return rounded(texts(stats.arbitrary_dedup(jams, minutes=60)), 4)


_Q = ", ".join(f"round(quantile_cont(observed, {q}), 4) AS {n}" for n, q in stats.QUANTILES.items())


@query("ag19_quantile_profile", "series", f"""
SELECT region_slug, round(avg(observed), 4) AS mean, round(var_pop(observed), 0) AS var_p,
  round(var_samp(observed), 0) AS var_s, {_Q} FROM series GROUP BY ALL""")
def _(spark, sf):
    df = stats.quantile_profile(views.series(spark, sf))
    return rounded(rounded(df, 0, ("var_p", "var_s")), 4)


@query("ag22_count_histogram", "series", """
with a as (SELECT regions, count(*) AS n FROM (
  SELECT date, count(DISTINCT region_slug) AS regions FROM series GROUP BY ALL) GROUP BY ALL),
b as (SELECT n_count, count(*) AS n FROM (SELECT region_slug, count(*) AS n_count FROM series GROUP BY ALL) GROUP BY ALL)
SELECT 'regions' AS kind, regions AS size, n FROM a UNION ALL SELECT 'rows', n_count, n FROM b""")
def _(spark, sf):
    df = views.series(spark, sf)
    a = dq.count_histogram(df).select(F.lit("regions").alias("kind"), F.col("regions").alias("size"), "n")
    return a.unionByName(dq.rows_histogram(df).select(F.lit("rows").alias("kind"), F.col("n_count").alias("size"), "n"))


@query("ag23_coverage", "series", """
SELECT region_slug, count(*) AS n_obs, strftime(min(date), '%Y-%m-%d') AS min_date, strftime(max(date), '%Y-%m-%d') AS max_date,
  count(DISTINCT date) AS n_dates, min(observed) AS min_value, round(avg(observed), 2) AS mean_value, max(observed) AS max_value
FROM series GROUP BY ALL""")
def _(spark, sf):
    return rounded(texts(dq.coverage(views.series(spark, sf), value="observed")), 2)


@query("ag24_describe", "", """
with v as (SELECT 'l_extendedprice' AS col, l_extendedprice::double AS x FROM lineitem
  UNION ALL SELECT 'l_quantity', l_quantity::double FROM lineitem)
SELECT col AS "column", count(x) AS count, round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS std, min(x) AS min,
  round(quantile_cont(x, 0.25), 4) AS q25, round(quantile_cont(x, 0.5), 4) AS q50,
  round(quantile_cont(x, 0.75), 4) AS q75, max(x) AS max FROM v GROUP BY col""")
def _(spark, sf):
    return rounded(stats.describe(views.table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"]), 4)


@query("ag25_trend", "", """
SELECT l_returnflag, round(regr_slope(ln(l_extendedprice), ln(l_quantity)), 6) AS slope,
  round(regr_intercept(ln(l_extendedprice), ln(l_quantity)), 6) AS intercept,
  round(corr(ln(l_extendedprice), ln(l_quantity)), 6) AS corr, count(*) AS n FROM lineitem GROUP BY ALL""")
def _(spark, sf):
    items = views.table(spark, sf, "lineitem")
    return rounded(stats.trend(items, F.ln("l_quantity"), F.ln("l_extendedprice"), ["l_returnflag"]))


@query("ag26_resample_day", "hours", """
SELECT strftime(make_date(year, month, day), '%Y-%m-%d') AS date,
  sum(tci) FILTER (region_slug = 'click')::bigint AS click, sum(tci) FILTER (region_slug = 'error')::bigint AS error,
  sum(tci) FILTER (region_slug = 'purchase')::bigint AS purchase, sum(tci) FILTER (region_slug = 'signup')::bigint AS signup,
  sum(tci) FILTER (region_slug = 'view')::bigint AS view FROM hours GROUP BY 1""")
def _(spark, sf):
    hours = views.hours(spark, sf).withColumn("ts", hour_stamp())
    return texts(tci.resample_day(hours, "ts", "region_slug", views.SLUGS))


@query("ag27_share_of_parent", "hours", """
SELECT year, month, day, sum(tci) FILTER (region_slug = 'click')::bigint AS parent,
  sum(tci) FILTER (region_slug IN ('error', 'view'))::bigint AS children,
  round(sum(tci) FILTER (region_slug IN ('error', 'view')) / nullif(sum(tci) FILTER (region_slug = 'click'), 0), 6) AS share
FROM hours WHERE region_slug IN ('click', 'error', 'view') GROUP BY ALL""")
def _(spark, sf):
    df = tci.share_of_parent(views.hours(spark, sf), "click", ["error", "view"], ["year", "month", "day"])
    return rounded(df)


@query("ag28_baseline_median", "hours", """
SELECT region_slug, dow, hour, quantile_cont(tci::double, 0.5) AS expected FROM hours GROUP BY ALL""")
def _(spark, sf):
    return tci.baseline_median(views.hours(spark, sf), ["region_slug", "dow", "hour"])


@query("ag29_year_adjust", "sales", """
with f as (SELECT year(date) AS y, isodow(date)::int AS dow, date, sum(amount) AS s FROM sales WHERE year(date) IN (1996, 1997)
  GROUP BY ALL HAVING count(DISTINCT region_slug) = 5),
m as (SELECT dow, avg(s) FILTER (y = 1996) AS a, avg(s) FILTER (y = 1997) AS b FROM f GROUP BY ALL)
SELECT dow, round(a, 5) AS mean_first, round(b, 5) AS mean_second, round(b / a, 6) AS ratio, round(b - a, 5) AS difference FROM m""")
def _(spark, sf):
    d = F.col("date")
    sales = views.sales(spark, sf).select(
        "region_slug", "amount", F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("day"),
        iso_dow(d).alias("dow"),
    )
    df = tci.year_adjust(sales, 1996, 1997, ["dow"], "amount", "region_slug", 5)
    return rounded(rounded(df, 5, ("mean_first", "mean_second", "difference")))


@query("ag30_ratio_of_sums", "daily base", """
with h as (SELECT region_slug, dow, hour, avg(tci) AS e FROM base GROUP BY ALL)
SELECT region_slug, month, day, round((sum(tci) / nullif(sum(e), 0) - 1) * 100, 4) AS tci_perc_change
FROM daily JOIN h USING (region_slug, dow, hour) GROUP BY ALL""")
def _(spark, sf):
    keys = ["region_slug", "dow", "hour"]
    joined = views.daily(spark, sf).join(tci.baseline_raw_mean(views.base(spark, sf), keys), keys)
    return rounded(tci.ratio_of_sums(joined, ["region_slug", "month", "day"]), 4)


@query("srt02_order_entities", "series", """
with s as (
  SELECT region_slug, 'mean' AS how, avg(observed) AS score FROM series GROUP BY ALL UNION ALL
  SELECT region_slug, 'median', quantile_cont(observed, 0.5) FROM series GROUP BY ALL UNION ALL
  SELECT region_slug, 'max', max(observed) FROM series GROUP BY ALL UNION ALL
  SELECT region_slug, 'min', min(observed) FROM series GROUP BY ALL UNION ALL
  SELECT region_slug, 'last', max_by(observed, date) FROM series GROUP BY ALL)
SELECT region_slug, how, round(score, 4) AS score,
  row_number() OVER (PARTITION BY how ORDER BY score, region_slug)::bigint AS position FROM s""")
def _(spark, sf):
    df = views.series(spark, sf)
    return rounded(reshape.union([
        reshape.order_entities(df, "region_slug", "observed", "date", how).withColumn("how", F.lit(how))
        for how in ("mean", "median", "max", "min", "last")
    ]), 4)


@query("srt03_worst_period", "series", """
SELECT region_slug, strftime(min_by(date, (observed, date)), '%Y-%m-%d') AS worst_period, min(observed) AS worst_value
FROM series GROUP BY ALL""")
def _(spark, sf):
    return texts(stats.worst_period(views.series(spark, sf), "region_slug", "date", "observed"))


@query("srt04_peek", "hours", "SELECT count(*) AS n FROM (SELECT * FROM hours LIMIT 10)")
def _(spark, sf):
    return dq.peek(views.hours(spark, sf)).agg(F.count(F.lit(1)).alias("n"))


@query("wn02_weeks", "analysis", """
SELECT year, month, day, sum(CASE WHEN dow = 1 THEN 1 ELSE 0 END) OVER (ORDER BY d)::bigint AS week_number_obs,
  week(d)::int AS week_number
FROM (SELECT DISTINCT year, month, day, dow, make_date(year, month, day) AS d FROM analysis)""")
def _(spark, sf):
    return weeks(views.analysis(spark, sf))
