"""Incremental fill, stream, publication."""

import datetime as dt

from pyspark.sql import functions as F

from roadpulse.operators import filters, tci
from roadpulse.operators.spatial import Quad
from roadpulse.plans import incremental
from roadpulse.session import new_path
from roadpulse.sources import export, io
from roadpulse.streaming import feed

GRID = Quad(0.0, 0.0, 16.0)


def region_rows(spark):
    return spark.createDataFrame(
        [("w", "POLYGON ((0 0, 8 0, 8 16, 0 16, 0 0))"), ("e", "POLYGON ((8 0, 16 0, 16 16, 8 16, 8 0))")],
        "region_slug string, region_shapefile_wkt string")


def jam_rows(spark, n=400):
    return spark.range(n).select(
        (F.col("id") % 17).cast("string").alias("uuid"),
        F.timestamp_seconds(F.lit(1583712000) + F.col("id") * 1171).alias("ts"),
        (F.col("id") % 90 + 1).cast("double").alias("length"), F.lit(1.0).alias("speed"), F.lit(None).cast("string").alias("blockingalertuuid"),
        F.date_format(F.timestamp_seconds(F.lit(1583712000) + F.col("id") * 1171), "yyyyMMdd").alias("datetime"),
        F.concat(F.lit("LINESTRING ("), (F.col("id") % 15).cast("string"), F.lit(" 1, "), (F.col("id") % 15 + 1).cast("string"), F.lit(" 2)")).alias("line"))


def test_slices(spark, rows):
    days = [dt.date(2020, 3, 2) + dt.timedelta(n) for n in range(40)]
    missing = [("m", d) for d in days] + [("w", d) for d in days[:10]] + [("d", d) for d in days[:3]]
    df = incremental.slices(spark.createDataFrame(missing, "region_slug string, date date"))
    assert rows(df, "region_slug", "date_slug") == [
        ("d", "year2020month03day02"), ("d", "year2020month03day03"), ("d", "year2020month03day04"),
        ("m", "year2020month03"), ("m", "year2020month04"), ("w", "year2020week09"), ("w", "year2020week10")]
    assert df.where("region_slug = 'w' AND date_slug = 'year2020week10'").first()["date_filter"] == "20200309|20200310|20200311"


def test_incremental_equals_full_and_is_idempotent(spark, rows):
    path, jams, regions = new_path(spark, "inc"), jam_rows(spark), region_rows(spark)
    options = {"grid": GRID, "resolution": 3}
    for last in ("2020-03-10", "2020-03-20", "2020-03-20"):
        incremental.fill(spark, jams, regions, incremental.dates(spark, "2020-03-09", last), path, **options)
    columns = ["region_slug", "year", "month", "day", "hour", "dow", "line", "tci"]
    stored = spark.read.orc(path).select(*columns)
    assert rows(stored) == rows(incremental.segment_hours(jams, regions, **options).select(*columns))
    # one region is lost and only that region is recomputed
    # days without a jam are filled as well: nothing is left, nothing is scanned again
    assert incremental.fill(spark, jams, regions, incremental.dates(spark, "2020-03-09", last), path, **options).count() == 0
    again = incremental.remaining(regions, incremental.dates(spark, "2020-03-09", "2020-03-12"), incremental.existing(stored.where("region_slug = 'w'")))
    assert rows(again, "region_slug") == [("e",)] * 4


def test_partition_fill_leaves_others(spark, rows):
    path = new_path(spark, "fill")
    df = spark.createDataFrame([("a", 1, 10), ("b", 1, 20)], "region_slug string, day int, tci int")
    io.fill_partitions(df, path, ["region_slug", "day"])
    io.fill_partitions(spark.createDataFrame([("b", 1, 99), ("b", 2, 5)], df.schema), path, ["region_slug", "day"])
    assert rows(spark.read.orc(path), "region_slug", "day", "tci") == [("a", 1, 10), ("b", 1, 99), ("b", 2, 5)]


def test_hot_partition_is_written_by_several_tasks(spark):
    path = new_path(spark, "hot")
    df = spark.range(400_000).select(F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(0).alias("region_slug"), F.xxhash64("id").alias("v"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        io.write_partitioned(df, path, ["region_slug"], "parquet")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = spark.read.parquet(path).where("region_slug = 0").select(F.col("_metadata.file_path").alias("f")).distinct().count()
    assert files > 1 and spark.read.parquet(path).count() == 400_000


def test_stream_replay_in_order_equals_batch(spark, rows):
    source, out = new_path(spark, "s-in"), new_path(spark, "s-out")
    jams = jam_rows(spark, 900).select(F.lit("r").alias("region_slug"), "uuid", "ts", "length", "line")
    # repeats inside a slot, out of order inside a batch
    repeats = jams.withColumn("ts", F.col("ts") + F.expr("INTERVAL 20 SECONDS")).withColumn("length", F.col("length") + 0.5)
    both = jams.unionByName(repeats)
    days = [r[0] for r in both.select(F.to_date("ts")).distinct().orderBy(F.to_date("ts")).collect()]
    for day in days:
        both.where(F.to_date("ts") == F.lit(day)).coalesce(1).write.mode("append").parquet(source)
    end = spark.createDataFrame([("end", "end", dt.datetime(2020, 5, 1), 0.0, "end")], "region_slug string, uuid string, ts timestamp, length double, line string")
    end.coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(both.schema).option("maxFilesPerTrigger", 1).parquet(source)
    feed.write(feed.segment_hour(stream, "1 hour"), out, new_path(spark, "s-state")).awaitTermination()
    got = spark.read.parquet(out).where("region_slug = 'r'").select("line", "hour_start", "tci")
    want = tci.dedup_slot(both).groupBy("line", F.date_trunc("hour", "ts").alias("hour_start")).agg(F.sum("length").alias("tci"))
    assert rows(got) == rows(want)


def test_late_rows_are_dropped(spark, rows):
    source, out = new_path(spark, "l-in"), new_path(spark, "l-out")
    schema = "region_slug string, uuid string, ts timestamp, length double, line string"
    batches = [
        [("r", "a", dt.datetime(2020, 3, 9, 10, 0), 1.0, "x")],
        [("r", "b", dt.datetime(2020, 3, 9, 14, 0), 2.0, "x")],
        [("r", "d", dt.datetime(2020, 3, 9, 15, 0), 8.0, "x")],  # rows are judged by the watermark one batch back
        [("r", "c", dt.datetime(2020, 3, 9, 10, 30), 4.0, "x")],  # hours late
        [("end", "z", dt.datetime(2020, 3, 11), 0.0, "x")],
    ]
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    feed.write(feed.segment_hour(stream, "10 minutes"), out, new_path(spark, "l-state")).awaitTermination()
    assert rows(spark.read.parquet(out).where("region_slug = 'r'"), "tci") == [(1.0,), (2.0,), (8.0,)]


def test_publication(spark, rows):
    df = spark.createDataFrame(
        [("a", 5.0, "TRUE", 1), ("b", 6.0, "FALSE", 2), ("h", 7.0, "TRUE", 3), ("c", 8.0, "true", 4)],
        "region_slug string, tcp double, dashboard string, observed int")
    private, public = export.private_public(df, "daily", hidden=["h"])
    assert rows(private, "region_slug", "tcp", "dashboard") == [("a", 5.0, "TRUE"), ("b", 6.0, "FALSE"), ("c", 8.0, "true"), ("h", None, "FALSE")]
    assert public.columns == ["region_slug", "tcp"] and rows(public, "region_slug") == [("a",), ("c",)]
    flags = df.withColumn("dashboard", F.col("dashboard") == "TRUE")
    assert rows(export.private_public(flags, "daily")[1], "region_slug") == [("a",), ("h",)]


def test_weekly_private_drops_max_year(spark):
    df = spark.createDataFrame([("a", 2020, "TRUE")], "region_slug string, max_year int, dashboard string")
    private, public = export.private_public(df, "weekly")
    assert "max_year" not in private.columns and "max_year" in public.columns


def test_history_on_an_empty_store(spark, rows):
    new = spark.createDataFrame([("a", dt.date(2020, 3, 9))], "region_slug string, date date")
    assert rows(export.extend_history(new.limit(0), new)) == [("a", dt.date(2020, 3, 9))]


def test_filters_and_columns_reach_the_scan(spark):
    path = new_path(spark, "scan")
    jam_rows(spark).write.partitionBy("datetime").parquet(path)
    jams = io.read_jams(spark, path, ["20200309"])
    hours = tci.segment_hour(tci.dedup_slot(filters.quality(jams).withColumn("region_slug", F.lit("r"))))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = hours._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    assert "PartitionFilters" in scan and "20200309" in scan
    assert "GreaterThanOrEqual(speed,0.0)" in scan and "GreaterThan(length,0.0)" in scan and "IsNull(blockingalertuuid)" in scan
    assert plan.count("Exchange hashpartitioning") <= 2
