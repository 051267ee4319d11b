"""Sources (SRC) and sinks (SNK) as round trips: tables are written, read back and returned."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse.functions import geo
from roadpulse.operators import dq, mobility, stats
from roadpulse.plans import regions
from roadpulse.session import new_path
from roadpulse.sources import export, io
from roadpulse.suite import views
from roadpulse.suite.indices import daily_index
from roadpulse.suite.registry import query, rounded, texts
from roadpulse.suite.reshaping import _IDX

_JAM = ["event_id", "region_slug", "uuid", "length", "datetime", "line"]
_JAM_SQL = ", ".join(_JAM)


def _jams(spark, sf):
    return views.jams(spark, sf).select(*_JAM)


@query("src01_read_jams", "jams", """
SELECT event_id, length, datetime FROM jams WHERE datetime IN ('20240103', '20240111', '20240129')""")
def _(spark, sf):
    path = new_path(spark, "jams")
    _jams(spark, sf).write.partitionBy("datetime").parquet(path)
    days, columns = ["20240103", "20240111", "20240129"], ["event_id", "length", "datetime"]
    listed = io.read_jams(spark, path, days, columns)
    matched = io.read_jams(spark, path, days, columns, pattern=True)
    df = listed.intersectAll(matched)
    return df.withColumn("datetime", F.col("datetime").cast("string"))


@query("src02_read_pipe_strings", "meta", "SELECT region_slug, region_name, population, timezone, replace(region_shapefile_wkt, '\"', '') AS region_shapefile_wkt FROM meta")
def _(spark, sf):
    path, columns = new_path(spark, "pipe"), ["region_slug", "region_name", "population", "timezone", "region_shapefile_wkt"]
    meta = views.meta(spark, sf).select(*columns).withColumn("region_shapefile_wkt", F.replace("region_shapefile_wkt", F.lit('"'), F.lit("")))
    meta.write.option("sep", "|").csv(path)
    return io.read_pipe_strings(spark, path, columns)


@query("src04_read_shapes", "meta", "SELECT region_name, replace(region_shapefile_wkt, '\"', '') AS region_shapefile_wkt FROM meta")
def _(spark, sf):
    path = new_path(spark, "shapes")
    meta = views.meta(spark, sf).select("region_name", F.replace("region_shapefile_wkt", F.lit('"'), F.lit("")).alias("region_shapefile_wkt"))
    meta.write.option("sep", "|").option("header", True).csv(path)
    return io.read_shapes(spark, path)


@query("src05_read_jams_switch", "jams", """
SELECT event_id, CASE WHEN datetime < '20240115' THEN length ELSE length * 2 END AS length FROM jams""")
def _(spark, sf):
    before = _jams(spark, sf)
    after = before.withColumn("length", F.col("length") * 2)
    day = F.to_date("datetime", "yyyyMMdd")
    return io.read_jams_switch(before, after, "2024-01-15", day).select("event_id", "length")


@query("src06_from_geojson", "jams", """
SELECT 'city_' || event_id AS region_slug, event_id::varchar AS region_name, uuid AS population,
  round(abs(x0 * y1 - x1 * y0 + x1 * y2 - x2 * y1 + x2 * y0 - x0 * y2) / 2, 6) AS area FROM jams""")
def _(spark, sf):
    """Each jam triangle as a GeoJSON document of one feature, a document per line, and back to region rows."""
    path = new_path(spark, "geojson")
    ring = geo.close_ring(geo.parse_line(F.col("line")))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.col("event_id").cast("string").alias("name"), F.col("uuid").alias("population")).alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), F.array(F.transform(ring, lambda p: F.array(p["x"], p["y"]))).alias("coordinates")).alias("geometry"),
    )
    shapes = views.jams(spark, sf).select(F.lit("FeatureCollection").alias("type"), F.array(feature).alias("features"))
    shapes.write.json(path)
    rows = regions.from_geojson(io.read_geojson(spark, path, lines=True), "city")
    return rounded(rows.select(
        "region_slug", "region_name", "population", geo.area(geo.parse_polygon(F.col("region_shapefile_wkt"))).alias("area")))


@query("src07_import_shapes", "", """
SELECT n_name AS region_name, 'br_' || lower(n_name) AS region_slug, (1000 * n_nationkey)::varchar AS population, 'BR' AS country_iso, 'city' AS region_type FROM nation""")
def _(spark, sf):
    nation = views.table(spark, sf, "nation")
    key = F.col("n_nationkey").cast("double")
    wkt = geo.polygon_to_wkt(geo.box_polygon(key, F.lit(0.0), key + 1, F.lit(1.0)))
    shapes = nation.select("n_name", wkt.alias("region_shapefile_wkt")).withColumnRenamed("n_name", "region_name")
    census = nation.select(F.lower("n_name").alias("region_name"), (F.col("n_nationkey") * 1000).alias("population"))
    df = regions.import_shapes(shapes, census, {"country_iso": "BR", "region_type": "city"}, "br")
    return df.drop("region_shapefile_wkt")


@query("src08_read_parts", "sales", """
SELECT region_slug AS source, strftime(date, '%Y-%m-%d') AS date, nation, amount FROM sales""")
def _(spark, sf):
    path = new_path(spark, "parts")
    sales = texts(views.sales(spark, sf)).withColumn("file", F.replace("region_slug", F.lit(" "), F.lit("-")))
    sales.drop("region_slug").write.partitionBy("file").option("header", True).csv(path)
    schema = "date string, nation string, amount double"
    df = io.read_parts(spark, path, schema, r"file=([^/]*)/", recursiveFileLookup="true")
    return df.withColumn("source", F.replace("source", F.lit("-"), F.lit(" ")))


@query("src09_read_driven_km", "sales", """
SELECT region_slug AS country, strftime(date, '%Y-%m-%d') AS date, round(100 * (count(*) / 10.0 + 1), 6) AS pc_driven_miles FROM sales
WHERE region_slug IN ('africa', 'asia') GROUP BY region_slug, date""")
def _(spark, sf):
    path = new_path(spark, "driven")
    days = views.sales(spark, sf).groupBy("region_slug", "date").agg((F.count(F.lit(1)) / 10).alias("pc_driven_miles"))
    days.select(F.date_format("date", "MMM dd, yyyy").alias("date"), F.col("region_slug").alias("country"), "pc_driven_miles").write.option("header", True).csv(path)
    return rounded(texts(mobility.read_driven_km(spark, path, "country", ["africa", "asia"])))


@query("src09_read_report", "sales", """
with r as (SELECT region_slug, nation, date, count(*) AS n FROM sales GROUP BY ALL)
SELECT 'country' AS level, region_slug AS country_region_code, NULL::varchar AS sub_region_1, NULL::varchar AS sub_region_2, strftime(date, '%Y-%m-%d') AS date, (sum(n) + 100)::double AS transit, (100 - sum(n))::double AS workplace FROM r GROUP BY region_slug, date
UNION ALL SELECT 'city', region_slug, nation, 'None', strftime(date, '%Y-%m-%d'), (n + 100)::double, (100 - n)::double FROM r""")
def _(spark, sf):
    path = new_path(spark, "report")
    none = F.lit(None).cast("string")
    n = F.count(F.lit(1))

    def rows(keys, sub):
        g = views.sales(spark, sf).groupBy(*keys, "date").agg(n.alias("n"))
        return g.select(
            F.col("region_slug").alias("country_region_code"), F.col("region_slug").alias("country_region"), sub.alias("sub_region_1"),
            none.alias("sub_region_2"), none.alias("metro_area"), "date",
            F.col("n").cast("double").alias("transit_stations_percent_change_from_baseline"),
            (-F.col("n")).cast("double").alias("workplaces_percent_change_from_baseline"))

    rows(["region_slug"], none).unionByName(rows(["region_slug", "nation"], F.col("nation"))).write.option("header", True).csv(path)
    parts = [mobility.read_report(spark, path, level).withColumn("level", F.lit(level)) for level in ("country", "city")]
    return texts(parts[0].unionByName(parts[1]).drop("country_region", "metro_area"))


@query("src10_read_length_stats", "sales", "SELECT region_slug, round(sum(amount), 2) AS length FROM sales GROUP BY 1")
def _(spark, sf):
    """JSON documents in two folders per region, ``file=slug_1`` and ``file=slug_2``."""
    path = new_path(spark, "lengths")
    element = F.struct(F.struct(F.col("amount").cast("string").alias("length")).alias("tags"))
    sales = views.sales(spark, sf).withColumn("part", (F.weekday("date") > 2).cast("int") + 1)
    name = F.concat_ws("_", F.replace("region_slug", F.lit(" "), F.lit("-")), F.col("part").cast("string"))
    sales.select(F.array(element).alias("elements"), name.alias("file")).write.partitionBy("file").json(path)
    df = io.read_length_stats(spark, path, r"file=(.*)_\d+/", lines=True)
    return rounded(df.withColumn("region_slug", F.replace("region_slug", F.lit("-"), F.lit(" "))), 2)


@query("src11_read_quantiles", "series", """
SELECT region_slug, round(avg(observed), 4) AS mean, round(quantile_cont(observed, 0.1), 4) AS q10, round(quantile_cont(observed, 0.95), 4) AS q95 FROM series GROUP BY 1""")
def _(spark, sf):
    path = new_path(spark, "quantiles")
    profile = stats.quantile_profile(views.series(spark, sf))
    values = F.concat_ws(", ", *[F.col(c).cast("string") for c in profile.columns[1:]])
    profile.select(F.concat(F.lit("['"), F.col("region_slug"), F.lit("', ["), values, F.lit("]]"))).write.text(path)
    return rounded(io.read_quantiles(spark, path).select("region_slug", "mean", "q10", "q95"), 4)


# -- sinks --------------------------------------------------------------------------------


@query("snk01_write_orc", "jams", f"SELECT {_JAM_SQL} FROM jams")
def _(spark, sf):
    path = new_path(spark, "orc")
    io.write_orc(_jams(spark, sf), path)
    return spark.read.orc(path)


def _hours(spark, sf):
    return views.hours(spark, sf)


def _strings(df, *names):
    return df.withColumns({n: F.col(n).cast("string") for n in names})


@query("snk02_write_partitioned", "hours", "SELECT * FROM hours")
def _(spark, sf):
    path = new_path(spark, "partitioned")
    hours = _hours(spark, sf)
    io.write_partitioned(hours, path, ["region_slug"])
    return spark.read.orc(path).select(*hours.columns)


@query("snk03_fill_partitions", "hours", """
SELECT region_slug, year, month, day, hour, dow, line, CASE WHEN day BETWEEN 10 AND 12 THEN tci + 1000 ELSE tci END AS tci FROM hours""")
def _(spark, sf):
    """Days 10 to 12 are replaced, twice; the others stay."""
    path, by = new_path(spark, "filled"), ["region_slug", "year", "month", "day"]
    hours = _hours(spark, sf)
    io.fill_partitions(hours, path, by)
    changed = hours.where("day BETWEEN 10 AND 12").withColumn("tci", F.col("tci") + 1000)
    io.fill_partitions(changed, path, by)
    io.fill_partitions(changed, path, by)
    return spark.read.orc(path).select(*hours.columns)


@query("snk04_append", "hours", "SELECT * FROM hours WHERE hour < 12 UNION ALL SELECT * FROM hours WHERE hour >= 8")
def _(spark, sf):
    path = new_path(spark, "appended")
    hours = _hours(spark, sf)
    io.append(hours.where("hour < 12"), path, ["region_slug"])
    io.append(hours.where("hour >= 8"), path, ["region_slug"])
    return spark.read.orc(path).select(*hours.columns)


@query("snk05_write_parquet", "hours", """
SELECT region_slug, day, sum(tci)::bigint AS tci FROM hours WHERE region_slug <> 'view' GROUP BY ALL
UNION ALL SELECT region_slug, day, count(*) FROM hours WHERE region_slug = 'view' GROUP BY ALL""")
def _(spark, sf):
    path = new_path(spark, "parquet")
    sums = _hours(spark, sf).groupBy("region_slug", "day").agg(F.sum("tci").alias("tci"))
    counts = _hours(spark, sf).where("region_slug = 'view'").groupBy("region_slug", "day").agg(F.count(F.lit(1)).alias("tci"))
    io.write_parquet(counts, path, "overwrite", ["region_slug"])
    io.write_parquet(sums, path, "overwrite", ["region_slug"])
    io.write_parquet(counts, path, "overwrite_partitions", ["region_slug"])
    return spark.read.parquet(path).select("region_slug", "day", "tci")


@query("snk06_register_partitions", "hours", "SELECT region_slug, count(*) AS n FROM hours GROUP BY 1")
def _(spark, sf):
    path, name = new_path(spark, "table"), "roadpulse_registered"
    hours = _hours(spark, sf)
    columns = ", ".join(f"{c} {t}" for c, t in hours.dtypes)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (region_slug) LOCATION '{path}'")
    io.write_parquet(hours, path, "overwrite", ["region_slug"])
    io.register_partitions(spark, name)
    return spark.table(name).groupBy("region_slug").agg(F.count(F.lit(1)).alias("n"))


@query("snk07_write_pipe_text", "hours", "SELECT * FROM hours")
def _(spark, sf):
    path = new_path(spark, "text")
    hours = _hours(spark, sf)
    body = [c for c in hours.columns if c not in ("region_slug", "year")]
    io.write_pipe_text(hours.select(*body, "region_slug", "year"), path)
    types = dict(hours.dtypes)
    schema = ", ".join(f"{c} {types[c]}" for c in [*body, "region_slug", "year"])
    return spark.read.schema(schema).option("sep", "|").csv(path).select(*hours.columns)


_PUB_SQL = f"""
with {_IDX}
SELECT 'private' AS side, ix.region_slug, month, day, CASE WHEN ix.region_slug <> 'click' THEN round(tcp, 6) END AS tcp, observed::bigint AS observed,
  CASE WHEN ix.region_slug = 'click' THEN 'FALSE' ELSE dashboard END AS dashboard FROM ix
UNION ALL SELECT 'public', region_slug, month, day, round(tcp, 6), NULL, NULL FROM ix WHERE dashboard = 'TRUE' AND region_slug <> 'click'"""


@query("snk08_private_public", "daily base meta", _PUB_SQL)
def _(spark, sf):
    path = new_path(spark, "published")
    df = rounded(daily_index(spark, sf).drop("last_updated_utc"))
    export.write_private_public(df, path, "daily", hidden=["click"])
    read = spark.read.option("header", True).option("inferSchema", True)
    private = read.csv(f"{path}/private/daily").withColumn("side", F.lit("private"))
    public = read.csv(f"{path}/public/daily").withColumn("side", F.lit("public"))
    both = private.unionByName(public, allowMissingColumns=True)
    flag = F.upper(F.col("dashboard").cast("string"))
    return both.select("side", "region_slug", "month", "day", "tcp", F.col("observed").cast("bigint").alias("observed"), flag.alias("dashboard"))


@query("snk09_per_day", "hours", "SELECT * FROM hours")
def _(spark, sf):
    path = new_path(spark, "perday")
    hours = _hours(spark, sf)
    export.per_day(hours, path)
    types = dict(hours.dtypes)
    schema = ", ".join(f"{c} {types[c]}" for c in ["hour", "dow", "line", "tci", "region_slug", "year", "month", "day"])
    return spark.read.schema(schema).option("sep", "|").option("header", True).csv(path).select(*hours.columns)


@query("snk10_sample", "jams", f"SELECT {_JAM_SQL} FROM jams WHERE region_slug = 'view' AND datetime = '20240110'")
def _(spark, sf):
    path = new_path(spark, "sample")
    jams = _jams(spark, sf)
    export.sample(jams, path, "view", "20240110")
    return spark.read.schema(jams.schema).option("header", True).csv(path)


@query("snk11_extend_history", "series", """
SELECT region_slug, strftime(date, '%Y-%m-%d') AS date, CASE WHEN date < DATE '1999-06-01' THEN observed ELSE observed + 1 END AS observed FROM series""")
def _(spark, sf):
    df = views.series(spark, sf)
    new = df.withColumn("observed", F.col("observed") + 1)
    return texts(export.extend_history(df.where("date < DATE '1999-06-01'"), new))


@query("snk12_overlapping_slices", "series", """
with m as (SELECT region_slug, date_trunc('month', date) AS mo, count(*) AS n FROM series GROUP BY ALL),
full_m as (SELECT region_slug, mo FROM m WHERE n > 22),
w as (SELECT DISTINCT region_slug, date_trunc('week', date)::date AS wk FROM series WHERE isodow(date) = 7),
d as (SELECT region_slug, date FROM series WHERE isodow(date) = 3),
wd as (SELECT region_slug, wk, year(wk + 6) AS y, unnest([wk, wk + 1, wk + 2, wk + 3, wk + 4, wk + 5, wk + 6]) AS day FROM w),
wk_in as (SELECT DISTINCT wd.region_slug, wk, y FROM wd JOIN full_m f ON f.region_slug = wd.region_slug AND date_trunc('month', wd.day) = f.mo
  WHERE year(wd.day) = y)
SELECT region_slug, 'year' || y || 'week' || strftime(wk + 6, '%W') AS date_slug FROM wk_in
UNION ALL SELECT d.region_slug, strftime(date, 'year%Ymonth%mday%d') FROM d
WHERE EXISTS (SELECT 1 FROM full_m f WHERE f.region_slug = d.region_slug AND f.mo = date_trunc('month', d.date))
  OR EXISTS (SELECT 1 FROM wd WHERE wd.region_slug = d.region_slug AND wd.day = d.date AND year(wd.day) = wd.y)""")
def _(spark, sf):
    """A manifest of full months, weeks that hold a Sunday and single Wednesdays."""
    from roadpulse.functions.timefn import monday_week

    df = views.series(spark, sf)
    d = F.col("date")
    months = df.groupBy("region_slug", F.date_format(d, "'year'yyyy'month'MM").alias("date_slug")).agg(F.count(F.lit(1)).alias("n")).where("n > 22").drop("n")
    week = F.concat(F.date_format(d, "'year'yyyy'week'"), F.lpad(monday_week(d).cast("string"), 2, "0"))
    weeks = df.where(F.weekday(d) == 6).select("region_slug", week.alias("date_slug")).distinct()
    days = df.where(F.weekday(d) == 2).select("region_slug", F.date_format(d, "'year'yyyy'month'MM'day'dd").alias("date_slug"))
    return dq.overlapping_slices(months.unionByName(weeks).unionByName(days))
