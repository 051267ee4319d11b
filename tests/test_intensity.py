"""Slot dedup, baselines, calendars, approvals: small frames with known answers."""

import datetime as dt

from pyspark.sql import functions as F

from roadpulse.functions import timefn
from roadpulse.operators import dq, filters, stats, tci
from roadpulse.plans import index, regions
from roadpulse.sources import calendars


def jams(spark, data):
    df = spark.createDataFrame(data, "uuid string, at string, length double, line string")
    return df.select(F.lit("r").alias("region_slug"), "uuid", F.to_timestamp("at").alias("ts"), "length", "line")


def test_slot_edges(spark, rows):
    at = ["2020-03-09 00:04:59", "2020-03-09 00:05:00", "2020-03-09 00:05:01", "2020-03-09 23:59:59", "2020-03-10 00:00:00"]
    df = jams(spark, [("a", t, float(i + 1), "x") for i, t in enumerate(at)])
    kept = tci.dedup_slot(df)
    assert rows(kept, "length") == [(1.0,), (2.0,), (4.0,), (5.0,)]
    assert rows(tci.dedup_slot(kept), "length") == rows(kept, "length")


def test_slot_ties_take_the_smaller_length(spark, rows):
    df = jams(spark, [("a", "2020-03-09 10:00:00", 9.0, "y"), ("a", "2020-03-09 10:00:00", 3.0, "z"), ("b", "2020-03-09 10:00:00", 1.0, "z")])
    assert rows(tci.dedup_slot(df), "uuid", "length") == [("a", 3.0), ("b", 1.0)]


def test_one_id_with_most_rows(spark):
    """A hot id is combined before the shuffle: one row per slot leaves each task."""
    hot = spark.range(20000).select(
        F.lit("r").alias("region_slug"), F.lit("hot").alias("uuid"),
        F.timestamp_seconds(F.lit(1583712000) + F.col("id") % 600).alias("ts"), F.col("id").cast("double").alias("length"),
        F.lit("x").alias("line"))
    df = tci.dedup_slot(hot)
    assert df.count() == 2
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_slot_before_reference_truncates_to_zero(spark, rows):
    df = spark.createDataFrame([("2014-12-31 23:58:00",), ("2015-01-01 00:02:00",)], "at string")
    slot = timefn.slot(F.to_timestamp("at"))
    assert rows(df.select(slot)) == [(0,), (0,)]


def test_baselines_differ(spark, rows):
    # two Mondays (10, 30) and one Tuesday (5)
    base = spark.createDataFrame(
        [("r", 2020, 3, 2, 1, 10), ("r", 2020, 3, 9, 1, 20), ("r", 2020, 3, 9, 1, 10), ("r", 2020, 3, 3, 2, 5)],
        "region_slug string, year int, month int, day int, dow int, tci long")
    mean = tci.baseline_mean(base, ["region_slug", "dow"], ["month", "day"])
    assert rows(mean, "dow", "expected_2020") == [(1, 20.0), (2, 5.0)]
    assert rows(tci.baseline_total(base), "expected_2020") == [(45,)]
    assert rows(tci.baseline_week(base, ["region_slug"]), "expected_2020") == [(25.0,)]
    obs = spark.createDataFrame([("r", 1, 40), ("r", 3, 7)], "region_slug string, dow int, observed long")
    joined = tci.with_baseline(obs, mean, ["region_slug", "dow"])
    assert rows(joined, "dow", "ratio_20") == [(1, 2.0)]  # the Wednesday has no baseline


def test_zero_baseline_gives_null(spark, rows):
    base = spark.createDataFrame([("r", 1, 0.0)], "region_slug string, dow int, expected_2020 double")
    obs = spark.createDataFrame([("r", 1, 4)], "region_slug string, dow int, observed long")
    assert rows(tci.with_baseline(obs, base, ["region_slug", "dow"]), "ratio_20") == [(None,)]


def test_iso_weeks_across_new_year(spark, rows):
    days = [dt.date(2020, 12, 28) + dt.timedelta(n) for n in range(8)]
    df = spark.createDataFrame([(d,) for d in days], "date date").select(*timefn.parts(F.col("date").cast("timestamp")))
    got = rows(calendars.weeks(df), "day", "week_number_obs", "week_number")
    assert got == sorted([(28, 1, 53), (29, 1, 53), (30, 1, 53), (31, 1, 53), (1, 1, 53), (2, 1, 53), (3, 1, 53), (4, 2, 1)], key=repr)


def test_monday_weeks_match_strftime(spark):
    days = [dt.date(2020, 1, 1) + dt.timedelta(n) for n in range(800)]
    df = spark.createDataFrame([(d,) for d in days], "date date").select("date", timefn.monday_week(F.col("date")).alias("w"))
    assert all(r["w"] == int(r["date"].strftime("%W")) for r in df.collect())


def test_pad_calendar(spark, rows):
    year = spark.createDataFrame([(2019,)], "year int")
    calendar = calendars.year_table(year, inclusive=False)
    assert calendar.count() == 364
    daily = spark.createDataFrame(
        [("a", 2019, 1, 1, 2, 7.0), ("a", 2019, 12, 31, 2, 9.0), ("s", 2019, 1, 1, 2, 5.0)],
        "region_slug string, year int, month int, day int, dow int, sum_length double")
    padded = calendars.pad_calendar(daily, calendar, sampled=["s"])
    assert padded.where("region_slug = 'a'").count() == 365
    assert rows(padded.where("year IS NULL"), "region_slug", "sum_length") == [("a", 9.0)]
    assert padded.where("region_slug = 'a' AND sum_length = 0").count() == 363
    assert padded.where("region_slug = 's' AND sum_length IS NULL").count() == 363


def test_approvals(spark, rows):
    meta = spark.createDataFrame([(s, 10.0) for s in ("edge", "none", "zero", "over")], "region_slug string, osm_length double")
    values = spark.createDataFrame(
        [("edge", 2.0, 0.5), ("zero", 0.0, None), ("over", 2.0, 0.51)], "region_slug string, daily_mean double, daily_coef_var double")
    both = values.select("*", F.lit(14.0).alias("weekly_mean"), F.lit(0.1).alias("weekly_coef_var"),
                         F.lit(1.0).alias("daily_mean_weekend"), F.lit(1.0).alias("daily_mean_weekday"))
    out = regions.with_variation(both, meta)
    assert rows(out, "region_slug", "daily_approved", "weekly_approved") == [
        ("edge", True, True), ("none", False, False), ("over", False, True), ("zero", False, True)]
    kept = filters.approved(out, "daily_approved", ["none", "over"])
    assert rows(kept, "region_slug") == [("edge",), ("none",), ("over",)]


def test_variation_of_zero_mean_is_null(spark, rows):
    df = spark.createDataFrame([("a", 2019, 1, 1, 2, 0.0)], "region_slug string, year int, month int, day int, dow int, sum_length double")
    assert rows(stats.daily_variation(df), "daily_coef_var", "daily_coef_var_weekend") == [(None, None)]


def test_hour_group_has_no_year_unless_asked(spark):
    daily = spark.createDataFrame([("r", 2020, 3, 9, 5, 1, 4)], "region_slug string, year int, month int, day int, hour int, dow int, tci long")
    meta = spark.createDataFrame(
        [("r", "R", "C", "R0", "P0", "city", "1", "America/Lima", True)],
        "region_slug string, region_name string, country_name_eng string, country_iso string, partner_code string, "
        "region_type string, population string, timezone string, daily_approved boolean")
    assert "year" not in index.hour_group_index(daily, daily, meta).columns
    out = index.hour_group_index(daily, daily, meta, with_year=True)
    assert out.select("year", "hour_chunk", "ratio_20").first() == (2020, "5-9", 1.0)


def test_local_stamp(spark):
    df = spark.createDataFrame([("2020-07-01 03:00:00", "America/Lima"), ("2020-07-01 03:00:00", None)], "at string, tz string")
    got = [r[0] for r in df.select(timefn.local_stamp(F.to_timestamp("at"), F.col("tz"))).collect()]
    assert got == ["2020-06-30 22:00:00", None]


def test_overlapping_slices(spark, rows):
    df = spark.createDataFrame(
        [("a", "year2020month03"), ("a", "year2020month03day09"), ("a", "year2020week20"), ("b", "year2020month03day09"),
         ("a", "year2020month05day20"), ("a", "year2020week00")], "region_slug string, date_slug string")
    assert rows(dq.overlapping_slices(df)) == [("a", "year2020month03day09"), ("a", "year2020month05day20")]
