"""Cleaning invariants on hand-made series."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from roadpulse.operators import clean, features, sampling
from roadpulse.plans import regions
from roadpulse.sources import calendars

START = dt.date(2020, 3, 9)


def series(spark, values, region="r", start=START):
    data = [(region, start + dt.timedelta(i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "region_slug string, date date, observed double")


def weekly_wave(n, level=1000.0):
    return [level + 60 * math.sin(2 * math.pi * i / 7) + 3 * ((i * 37) % 11) for i in range(n)]


def test_nested_medians_equal_the_single_ones(spark):
    rng = random.Random(4)
    rows = [(k, f"2020-{1 + d // 28:02d}-{1 + d % 28:02d}", None if rng.random() < 0.03 else round(rng.uniform(0, 50), 2)) for k in ("a", "b") for d in range(90)]
    rows += [("c", "2020-01-01", 1.0)]
    df = spark.createDataFrame(rows, "region_slug string, date string, v double").withColumn("date", F.to_date("date"))
    out = features.double_rolling_medians(df, "v", (1, 3, 14, 15), ["region_slug"], "date", "m")
    for n in (1, 3, 14, 15):
        out = out.withColumn(f"w{n}", features.double_rolling_column("v", n, n, ["region_slug"], "date"))
    got = out.collect()
    assert all(r[f"m{n}"] == r[f"w{n}"] for r in got for n in (1, 3, 14, 15))
    assert sum(r["m15"] is not None for r in got) > 20 and out.columns[:3] == df.columns


def test_spike_is_voted_and_filled(spark):
    values = weekly_wave(200)
    values[60] = 6000.0
    out = clean.impute_lowess(clean.vote(series(spark, values), "observed", 3.0), "observed").orderBy("date").collect()
    flagged = [i for i, r in enumerate(out) if r["anomaly_sum"] > 0]
    assert 60 in flagged
    assert abs(out[60]["loess"] - 1000) < 300
    assert all(out[i]["loess"] == values[i] for i in range(200) if i not in flagged)


def test_no_votes_in_the_blackout(spark):
    values = weekly_wave(200)
    values[10] = 9000.0  # 2020-03-19
    out = clean.vote(series(spark, values), "observed", 3.0).orderBy("date").collect()
    assert out[10]["anomaly_persist"] and out[10]["anomaly_sum"] == 0


def test_constant_series_has_no_outliers(spark):
    out = clean.vote(series(spark, [5.0] * 120), "observed", 1.5)
    assert out.where("anomaly_sum > 0").count() == 0
    assert clean.shift_votes(series(spark, [5.0] * 120), "observed", 1.0).count() == 0


def test_negative_values_are_replaced(spark):
    values = weekly_wave(120)
    values[50] = -40.0
    out = clean.impute_lowess(clean.vote(series(spark, values), "observed", 3.0), "observed").orderBy("date").collect()
    assert out[50]["loess"] > 800


def test_level_step_is_found_and_removed(spark):
    values = weekly_wave(240)
    values = values[:120] + [v * 1.5 for v in values[120:]]
    df = series(spark, values)
    # a high factor narrows the votes to the days where the medians are furthest apart
    votes = clean.shift_votes(df, "observed", 12.0)
    dates = clean.shift_date(votes)
    found = dates.first()["shift_date"]
    assert abs((found - (START + dt.timedelta(120))).days) <= 9
    dates = spark.createDataFrame([("r", START + dt.timedelta(119))], "region_slug string, shift_date date")
    moved = clean.correct_shift(df, "observed", dates).orderBy("date").collect()
    late = [r["shifted"] for r in moved[130:240]]
    assert abs(sum(late) / len(late) - 1015) < 60
    assert [r["shifted"] for r in moved[:110]] == values[:110]


def test_regions_without_shift_keep_their_values(spark):
    df = series(spark, weekly_wave(100))
    none = spark.createDataFrame([], "region_slug string, shift_date date")
    assert [r["shifted"] for r in clean.correct_shift(df, "observed", none).orderBy("date").collect()] == weekly_wave(100)


def test_regions_are_independent(spark):
    spiky = weekly_wave(150)
    spiky[70] = 8000.0
    both = series(spark, spiky, "a").unionByName(series(spark, weekly_wave(150), "b"))
    alone = clean.step(series(spark, spiky, "a"), "observed", "s1", 3.0, 1.0)
    joint = clean.step(both, "observed", "s1", 3.0, 1.0).where("region_slug = 'a'")
    key = ["date", "loess", "s1", "outliers", "level_shifts"]
    a, b = (df.orderBy("date").select(*key).collect() for df in (alone, joint))
    for x, y in zip(a, b):
        assert x["s1"] == pytest.approx(y["s1"]) and x["outliers"] == y["outliers"]


def test_interpolation_edges(spark):
    out = features.interpolate_linear(series(spark, [None, 2, None, None, 8, -1, None]), "observed").orderBy("date").collect()
    assert [r["observed"] for r in out] == [None, 2.0, 4.0, 6.0, 8.0, 8.0, 8.0]


def test_rolling_needs_a_full_window(spark):
    df = features.rolling(series(spark, [1, 2, None, 4]), "observed", 2, ["region_slug"], name="m")
    df = features.rolling(df, "observed", 2, ["region_slug"], min_periods=1, name="n").orderBy("date")
    assert [(r["m"], r["n"]) for r in df.collect()] == [(None, 1.0), (1.5, 1.5), (None, 2.0), (None, 4.0)]


def test_forward_sum_counts_days_not_rows(spark):
    df = series(spark, [1, 2, 4]).unionByName(series(spark, [8], start=START + dt.timedelta(10)))
    out = features.forward_sum(df, "observed", ["region_slug"]).orderBy("date")
    assert [r["forward_sum"] for r in out.collect()] == [7.0, 6.0, 4.0, 8.0]


def test_c_parameter_factor_100_switches_off(spark):
    df = series(spark, [1.0])
    table = spark.createDataFrame([("r", 2.0)], "region_slug string, c_max double")
    assert clean.c_param(df, table, "max", 4.0).first()["c"] == 8.0
    assert clean.c_param(df, table, "max", 100.0).first()["c"] == 100.0
    assert clean.c_param(df, None, "max", 4.0).first()["c"] == 12.0


def test_weekly_totals(spark):
    df = series(spark, [10.0] * 9).withColumn("expected_2020", F.lit(5.0)).withColumn("s2_shift", F.lit(6.0))
    out = clean.weekly(df).orderBy("week").collect()
    assert [(r["week"], r["days_num"], r["observed"], r["cleaned"], r["tcp"], r["tcp_clean"]) for r in out] == [
        (1, 7, 70.0, 42.0, 100.0, 20.0), (2, 2, 20.0, 12.0, 100.0, 20.0)]


def test_sampled_days(spark):
    days = calendars.dates(spark, "2019-01-01", "2021-08-01")
    drawn = sampling.balanced_weekdays(days, 50, 7).collect()
    assert len(drawn) == 50 and len({r["week"] for r in drawn}) == 50
    for r in drawn:
        assert r["date"].isoweekday() == r["dow"] <= 5
        assert not ((r["date"].month == 1 and r["date"].day <= 15) or (r["date"].month == 12 and r["date"].day >= 15))
    assert [sum(r["dow"] == d for r in drawn) for d in range(1, 6)] == [10] * 5
    again = sampling.balanced_weekdays(days.repartition(5), 50, 7).collect()
    assert sorted(r["date"] for r in again) == sorted(r["date"] for r in drawn)
    weeks = sampling.weeks_per_month(calendars.dates(spark, "2019-01-01", "2019-12-31"), 3).collect()
    assert len(weeks) % 7 == 0 and len({r["date"].month for r in weeks}) == 12


def test_accents_are_removed_by_decomposition(spark):
    names = ["Érd Győr", "Brňany Ýmir", "São João", "été", "Straße", "Ångström", "Ελλάδα"]
    from roadpulse.functions import text

    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(text.strip_accents(F.col("n"))).collect()]
    assert got == ["Erd Gyor", "Brnany Ymir", "Sao Joao", "ete", "Straße", "Angstrom", "Ελλαδα"]


def test_wide_regions_get_the_sums_of_the_whole_feed(spark):
    shape = "POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))"
    dim = spark.createDataFrame([("local", "F0", shape), ("wide1", "F1", shape), ("wide2", "F2", shape)], "region_slug string, feed_code string, region_shapefile_wkt string")
    far, near = "LINESTRING (5 5, 6 6)", "LINESTRING (0.2 0.2, 0.4 0.4)"
    rows = [
        ("u1", "2020-01-02 10:01:00", 3.0, near, "F0"), ("u1", "2020-01-02 10:02:00", 5.0, near, "F0"), ("u1", "2020-01-02 10:06:00", 7.0, far, "F9"),
        ("u2", "2020-01-03 10:01:00", 11.0, far, "F0"), ("u2", "2021-01-03 10:01:00", 13.0, near, "F0"),
    ]
    jams = spark.createDataFrame(rows, "uuid string, ts string, length double, line string, country string").select(
        "uuid", F.col("ts").cast("timestamp").alias("ts"), "length", "line", "country", F.lit(1.0).alias("speed"), F.lit(None).cast("string").alias("blockingalertuuid"))
    days = calendars.year_table(spark.createDataFrame([(2020,)], "year int"))
    out = regions.analysis_daily(jams, dim, days, "2020-01-01", "2020-12-31", {"wide2": ["20200103", "20210103"]}, wide=["wide1", "wide2"])
    got = {(r["region_slug"], r["month"], r["day"]): r["sum_length"] for r in out.where("sum_length > 0 AND year IS NOT NULL").collect()}
    assert got == {("local", 1, 2): 3.0, ("wide1", 1, 2): 10.0, ("wide1", 1, 3): 11.0, ("wide2", 1, 3): 11.0}
