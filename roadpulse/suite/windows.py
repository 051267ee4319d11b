"""Window operators (WN)."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse.operators import features, filters, tci
from roadpulse.suite import views
from roadpulse.suite.registry import query, rounded, texts

_D = "strftime(date, '%Y-%m-%d') AS date"


def _slot_sql(minutes: int) -> str:
    return f"""
SELECT region_slug, uuid, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, length, line, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY region_slug, uuid, ts::date, (hour(ts) * 60 + minute(ts)) // {minutes}
    ORDER BY ts, length, line, event_id) AS rn FROM good) WHERE rn = 1"""


def _slots(spark, sf, minutes):
    jams = filters.quality(views.feed(spark, sf)).select("event_id", "region_slug", "uuid", "ts", "length", "line")
    return texts(tci.dedup_slot(jams, minutes=minutes))


@query("wn01_dedup_slot_5", "good", _slot_sql(5))
def _(spark, sf):
    return _slots(spark, sf, 5)


@query("wn01_dedup_slot_60", "good", _slot_sql(60))
def _(spark, sf):
    return _slots(spark, sf, 60)


@query("wn01_dedup_lineitem", "", """
SELECT l_suppkey, strftime(l_shipdate, '%Y-%m-%d') AS day, l_quantity, l_orderkey, l_linenumber FROM (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_shipdate::date ORDER BY l_shipdate, l_quantity, l_orderkey, l_linenumber) AS rn
  FROM lineitem) WHERE rn = 1""")
def _(spark, sf):
    items = views.table(spark, sf, "lineitem").select(
        "l_suppkey", F.col("l_shipdate").cast("timestamp").alias("ts"), "l_quantity", "l_orderkey", "l_linenumber"
    )
    kept = tci.dedup_slot(items, "l_suppkey", "ts", within=(), ties=("l_quantity", "l_orderkey", "l_linenumber"))
    return texts(kept.select("l_suppkey", F.to_date("ts").alias("day"), "l_quantity", "l_orderkey", "l_linenumber"))


@query("wn03_week_cumsum", "series", f"""
with w as (SELECT *, sum(CASE WHEN isodow(date) = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY region_slug ORDER BY date) AS week FROM series)
SELECT region_slug, {_D}, observed, week::bigint AS week,
  strftime(min(date) OVER (PARTITION BY region_slug, week), '%Y-%m-%d') AS min_date FROM w""")
def _(spark, sf):
    return texts(features.week_cumsum(views.series(spark, sf)))


@query("wn04_lags", "series", f"""
SELECT region_slug, {_D}, dow, observed, a AS observed_1day, b AS observed_7day, c AS observed_1dow,
  round(observed - a, 2) AS diff_1day, round(observed - b, 2) AS diff_7day FROM (
  SELECT *, lag(observed) OVER r AS a, lag(observed, 7) OVER r AS b,
    lag(observed) OVER (PARTITION BY region_slug, dow ORDER BY date) AS c
  FROM (SELECT *, isodow(date)::int AS dow FROM series) WINDOW r AS (PARTITION BY region_slug ORDER BY date))""")
def _(spark, sf):
    df = views.series(spark, sf).withColumn("dow", F.weekday("date") + 1)
    return rounded(texts(features.lags(df)), 2)


@query("wn05_rolling", "series", f"""
SELECT region_slug, {_D}, observed,
  CASE WHEN count(observed) OVER s >= 7 THEN round(avg(observed) OVER s, 4) END AS mean7,
  round(quantile_cont(observed, 0.5) OVER m, 4) AS median30
FROM series WINDOW s AS (PARTITION BY region_slug ORDER BY date ROWS 6 PRECEDING),
  m AS (PARTITION BY region_slug ORDER BY date ROWS 29 PRECEDING)""")
def _(spark, sf):
    df = features.rolling(views.series(spark, sf), "observed", 7, ["region_slug"], name="mean7")
    df = features.rolling(df, "observed", 30, ["region_slug"], min_periods=1, fn="median", name="median30")
    return rounded(texts(df), 4)


@query("wn06_forward_sum", "series", f"""
SELECT region_slug, {_D}, observed, round(sum(observed) OVER (PARTITION BY region_slug ORDER BY date
  RANGE BETWEEN CURRENT ROW AND INTERVAL 6 DAY FOLLOWING), 2) AS forward_sum FROM series""")
def _(spark, sf):
    return rounded(texts(features.forward_sum(views.series(spark, sf), "observed", ["region_slug"])), 2)


@query("wn07_normalise_first", "series", f"""
SELECT region_slug, {_D}, observed, round(observed / first_value(observed) OVER (PARTITION BY region_slug ORDER BY date), 6) AS normalised
FROM series""")
def _(spark, sf):
    return rounded(texts(features.normalise_first(views.series(spark, sf), "observed", ["region_slug"])))


@query("wn10_double_rolling", "series", f"""
SELECT region_slug, {_D}, observed, CASE WHEN count(*) OVER b = 14 AND count(*) OVER a = 14
  THEN round(quantile_cont(observed, 0.5) OVER a - quantile_cont(observed, 0.5) OVER b, 4) END AS change
FROM series WINDOW b AS (PARTITION BY region_slug ORDER BY date ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING),
  a AS (PARTITION BY region_slug ORDER BY date ROWS BETWEEN CURRENT ROW AND 13 FOLLOWING)""")
def _(spark, sf):
    return rounded(texts(features.double_rolling(views.series(spark, sf), "observed", 14, 14)), 4)


@query("wn11_interpolate_linear", "series", f"""
with p as (
  SELECT *, row_number() OVER (PARTITION BY region_slug ORDER BY date) AS i FROM (
    SELECT region_slug, date, CASE WHEN observed - 40000 >= 0 THEN observed - 40000 END AS v FROM series)),
q as (
  SELECT *, last_value(v IGNORE NULLS) OVER b AS v0, last_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER b AS i0,
    first_value(v IGNORE NULLS) OVER a AS v1, first_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER a AS i1
  FROM p WINDOW b AS (PARTITION BY region_slug ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    a AS (PARTITION BY region_slug ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT region_slug, {_D}, round(coalesce(v, v0 + (v1 - v0) * (i - i0) / (i1 - i0), v0), 4) AS observed FROM q""")
def _(spark, sf):
    df = views.series(spark, sf).withColumn("observed", F.col("observed") - 40000)
    return rounded(texts(features.interpolate_linear(df, "observed")), 4)


@query("wn11_interpolate_time", "series", f"""
with p as (
  SELECT region_slug, date, date - DATE '1970-01-01' AS i, CASE WHEN observed >= 60000 THEN ln(1 + observed) END AS v FROM series),
q as (
  SELECT *, last_value(v IGNORE NULLS) OVER b AS v0, last_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER b AS i0,
    first_value(v IGNORE NULLS) OVER a AS v1, first_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER a AS i1
  FROM p WINDOW b AS (PARTITION BY region_slug ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    a AS (PARTITION BY region_slug ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT region_slug, {_D}, round(exp(coalesce(v, v0 + (v1 - v0) * (i - i0) / (i1 - i0), v0)) - 1, 3) AS observed FROM q""")
def _(spark, sf):
    df = views.series(spark, sf).withColumn("observed", F.when(F.col("observed") >= 60000, F.col("observed")))
    return rounded(texts(features.interpolate_linear(df, "observed", by_time=True, log_scale=True)), 3)
