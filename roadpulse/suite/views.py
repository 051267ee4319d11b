"""The test tables seen as a congestion feed, in Spark and as oracle SQL.

events -> jam reports (user = jam id, event type = region, value = length, a three-point line from
integer arithmetic on the event id, shared by many reports); a third of the events is reported again at once or
two minutes later, mostly in the same feed slot; region/nation/supplier -> region metadata; orders -> long
daily series per region.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.functions import timefn
from roadpulse.operators import filters, tci
from roadpulse.operators.spatial import Quad

SLUGS = ("click", "error", "purchase", "signup", "view")
ZONES = ("America/Sao_Paulo", "America/Mexico_City", "America/Santiago", "America/Lima", None)
BASE_START, BASE_END, START = "2024-01-01", "2024-01-07", "2024-01-08"
GRID = Quad(-8.0, -8.0, 32.0)  # level 5 has unit cells


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _hundredths(col: Column) -> Column:
    return (col.cast("decimal(12,0)") / 100).cast("decimal(12,2)").cast("string")


def jams(spark: SparkSession, sf_dir: str) -> DataFrame:
    again = F.when(F.col("event_id") % 3 == 1, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    events = table(spark, sf_dir, "events").withColumn("again", F.explode(again))
    i = F.col("event_id")
    # the second report: at the same time and equal, at the same time and half as long, or later and half as long
    later = F.col("again") & ~(i % 9).isin(1, 4)
    half = F.col("again") & (i % 9 != 4)
    events = events.withColumns({
        "ts": F.when(later, F.col("ts") + F.expr("INTERVAL 2 MINUTES")).otherwise(F.col("ts")),
        "value": F.when(half, F.col("value") / 2).otherwise(F.col("value")),
    })
    k = F.get_json_object("props", "$.k").cast("int")
    # a line is reported about 13 times; one line has a third of all reports
    n = F.when(i % 3 == 0, F.lit(7).cast("bigint")).otherwise(F.call_function("div", i, F.lit(20)))
    x0, y0 = (n * 37) % 1000, (n * 91) % 1000
    x1, y1 = x0 + (n % 7 - 3) * 13, y0 + (n % 5 - 2) * 17
    x2, y2 = x1 + (n % 11 - 5) * 7, y1 + (n % 3 - 1) * 29
    pairs = [F.concat_ws(" ", _hundredths(a), _hundredths(b)) for a, b in ((x0, y0), (x1, y1), (x2, y2))]
    line = F.concat(F.lit("LINESTRING ("), F.concat_ws(", ", *pairs), F.lit(")"))
    return events.select(
        F.when(F.col("again"), -1 - i).otherwise(i).alias("event_id"),
        F.col("user_id").cast("string").alias("uuid"),
        F.col("event_type").alias("region_slug"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("retrievaltime"),
        F.col("value").alias("length"),
        (F.col("value") / 10).alias("speed"),
        (k % 6).alias("level"),
        F.when(k < 10, F.concat(F.lit("block-"), i.cast("string"))).alias("blockingalertuuid"),
        F.date_format("ts", "yyyyMMdd").alias("datetime"),
        line.alias("line"),
    )


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jams with the report time as a timestamp."""
    raw = jams(spark, sf_dir)
    return raw.withColumn("ts", timefn.from_epoch_ms(F.col("retrievaltime"))).drop("retrievaltime")


def dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tci.dedup_slot(filters.quality(feed(spark, sf_dir)))


def hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deduplicated hourly table, all days."""
    return tci.segment_hour(dedup(spark, sf_dir))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.on_or_after(hours(spark, sf_dir), START)


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.between_dates(hours(spark, sf_dir), BASE_START, BASE_END)


def _fixed(key: Column, step: float) -> Column:
    return (key.cast("decimal(12,1)") * 2 + F.lit(str(step)).cast("decimal(12,1)")).cast("decimal(12,1)").cast("string")


def region_wkt(key: Column) -> Column:
    """A concave five-sided shell per region; the fourth has a second member, the fifth a hole."""
    at = {s: _fixed(key, s) for s in (0.0, 0.9, 1.8)}
    ring = F.concat(
        F.lit("("), at[0.0], F.lit(" 0, "), at[1.8], F.lit(" 0, "), at[1.8], F.lit(" 9, "),
        at[0.9], F.lit(" 4, "), at[0.0], F.lit(" 9, "), at[0.0], F.lit(" 0)"),
    )
    member = "((6.1 9.5, 7.7 9.5, 7.7 9.9, 6.1 9.9, 6.1 9.5))"
    hole = "(8.2 1, 8.8 1, 8.8 2, 8.2 2, 8.2 1)"
    return (
        F.when(key == 3, F.concat(F.lit("MULTIPOLYGON (("), ring, F.lit(f"), {member})")))
        .when(key == 4, F.concat(F.lit('"POLYGON ('), ring, F.lit(f', {hole})"')))
        .otherwise(F.concat(F.lit("POLYGON ("), ring, F.lit(")")))
    )


def _pick(key: Column, values: tuple) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), key)


def meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("r_regionkey")
    text = key.cast("string")
    return table(spark, sf_dir, "region").select(
        _pick(key, SLUGS).alias("region_slug"),
        F.col("r_name").alias("region_name"),
        F.concat(F.lit("Country "), text).alias("country_name_eng"),
        F.concat(F.lit("R"), text).alias("country_iso"),
        F.concat(F.lit("P"), text).alias("partner_code"),
        F.when(key == 0, "country").otherwise("city").alias("region_type"),
        (1000000 * (key + 1)).cast("string").alias("population"),
        _pick(key, ZONES).alias("timezone"),
        F.when(key == 3, "FALSE").otherwise("TRUE").alias("dashboard"),
        (key != 2).alias("daily_approved"),
        (key != 1).alias("weekly_approved"),
        region_wkt(key).alias("region_shapefile_wkt"),
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with nation and region: (date, region_slug, nation, amount)."""
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("amount")
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region")
    return (
        orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
        .join(nation, F.col("c_nationkey") == nation["n_nationkey"])
        .join(region, F.col("n_regionkey") == region["r_regionkey"])
        .select("date", F.lower("r_name").alias("region_slug"), F.col("n_name").alias("nation"), "amount")
    )


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily value per region, days without orders missing."""
    return (
        sales(spark, sf_dir).groupBy("region_slug", "date").agg(F.round(F.sum("amount"), 2).alias("observed"))
    )


def analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily length table of the reliability statistics."""
    d = F.col("date")
    return series(spark, sf_dir).select(
        "region_slug", F.year(d).alias("year"), F.month(d).alias("month"),
        timefn.iso_dow(d).alias("dow"), F.dayofmonth(d).alias("day"), F.col("observed").alias("sum_length"),
    )


# -- oracle SQL ---------------------------------------------------------------------------
# name -> (needed names, body)

CTES: dict[str, tuple[str, str]] = {
    "ints": (
        "",
        """SELECT CASE WHEN again THEN -1 - event_id ELSE event_id END AS event_id, event_id AS origin, user_id, event_type,
        CASE WHEN again AND event_id % 9 NOT IN (1, 4) THEN ts + INTERVAL 2 MINUTE ELSE ts END AS ts,
        CASE WHEN again AND event_id % 9 <> 4 THEN value / 2 ELSE value END AS value, json_extract_string(props, '$.k')::int AS k,
        (n * 37) % 1000 AS a0, (n * 91) % 1000 AS b0,
        (n * 37) % 1000 + (n % 7 - 3) * 13 AS a1,
        (n * 91) % 1000 + (n % 5 - 2) * 17 AS b1,
        (n * 37) % 1000 + (n % 7 - 3) * 13 + (n % 11 - 5) * 7 AS a2,
        (n * 91) % 1000 + (n % 5 - 2) * 17 + (n % 3 - 1) * 29 AS b2
        FROM (SELECT *, CASE WHEN event_id % 3 = 0 THEN 7 ELSE event_id // 20 END AS n FROM (
          SELECT *, false AS again FROM events UNION ALL SELECT *, true FROM events WHERE event_id % 3 = 1))""",
    ),
    "jams": (
        "ints",
        """SELECT event_id, user_id::varchar AS uuid, event_type AS region_slug, date_trunc('second', ts) AS ts,
        value AS length, value / 10 AS speed, k % 6 AS level,
        CASE WHEN k < 10 THEN 'block-' || origin END AS blockingalertuuid,
        strftime(ts, '%Y%m%d') AS datetime,
        'LINESTRING (' || (a0 / 100.0)::decimal(12,2) || ' ' || (b0 / 100.0)::decimal(12,2) || ', '
        || (a1 / 100.0)::decimal(12,2) || ' ' || (b1 / 100.0)::decimal(12,2) || ', '
        || (a2 / 100.0)::decimal(12,2) || ' ' || (b2 / 100.0)::decimal(12,2) || ')' AS line,
        a0 / 100.0 AS x0, b0 / 100.0 AS y0, a1 / 100.0 AS x1, b1 / 100.0 AS y1, a2 / 100.0 AS x2, b2 / 100.0 AS y2
        FROM ints""",
    ),
    "good": ("jams", "SELECT * FROM jams WHERE speed >= 0 AND length > 0 AND blockingalertuuid IS NULL"),
    "dedup": (
        "good",
        """SELECT * FROM (SELECT *, row_number() OVER (
        PARTITION BY region_slug, uuid, ts::date, (hour(ts) * 60 + minute(ts)) // 5
        ORDER BY ts, length, line, event_id) AS rn FROM good) WHERE rn = 1""",
    ),
    "hours": (
        "dedup",
        """SELECT region_slug, year(ts)::int AS year, month(ts)::int AS month, day(ts)::int AS day,
        hour(ts)::int AS hour, isodow(ts)::int AS dow, line, round(round(sum(length), 6))::bigint AS tci
        FROM dedup GROUP BY ALL""",
    ),
    "daily": ("hours", "SELECT * FROM hours WHERE make_date(year, month, day) >= DATE '2024-01-08'"),
    "base": (
        "hours",
        "SELECT * FROM hours WHERE make_date(year, month, day) BETWEEN DATE '2024-01-01' AND DATE '2024-01-07'",
    ),
    "meta": (
        "",
        """SELECT ['click', 'error', 'purchase', 'signup', 'view'][r_regionkey + 1] AS region_slug,
        r_name AS region_name, 'Country ' || r_regionkey AS country_name_eng, 'R' || r_regionkey AS country_iso,
        'P' || r_regionkey AS partner_code, CASE WHEN r_regionkey = 0 THEN 'country' ELSE 'city' END AS region_type,
        (1000000 * (r_regionkey + 1))::varchar AS population,
        ['America/Sao_Paulo', 'America/Mexico_City', 'America/Santiago', 'America/Lima', NULL][r_regionkey + 1] AS timezone,
        CASE WHEN r_regionkey = 3 THEN 'FALSE' ELSE 'TRUE' END AS dashboard,
        r_regionkey <> 2 AS daily_approved, r_regionkey <> 1 AS weekly_approved,
        CASE WHEN r_regionkey = 3 THEN 'MULTIPOLYGON ((' || ring || '), ((6.1 9.5, 7.7 9.5, 7.7 9.9, 6.1 9.9, 6.1 9.5)))'
             WHEN r_regionkey = 4 THEN '"POLYGON (' || ring || ', (8.2 1, 8.8 1, 8.8 2, 8.2 2, 8.2 1))"'
             ELSE 'POLYGON (' || ring || ')' END AS region_shapefile_wkt
        FROM (SELECT *, '(' || p0 || ' 0, ' || p2 || ' 0, ' || p2 || ' 9, ' || p1 || ' 4, ' || p0 || ' 9, ' || p0 || ' 0)' AS ring
              FROM (SELECT *, (r_regionkey * 2)::decimal(12,1) AS p0, (r_regionkey * 2 + 0.9)::decimal(12,1) AS p1,
                    (r_regionkey * 2 + 1.8)::decimal(12,1) AS p2 FROM region))""",
    ),
    # ring edges of the region shapes
    "shape_edges": (
        "",
        """SELECT ['click', 'error', 'purchase', 'signup', 'view'][r_regionkey + 1] AS region_slug,
        e[1]::double AS ex1, e[2]::double AS ey1, e[3]::double AS ex2, e[4]::double AS ey2
        FROM (SELECT r_regionkey, unnest(
          [[q, 0, q + 1.8, 0], [q + 1.8, 0, q + 1.8, 9], [q + 1.8, 9, q + 0.9, 4], [q + 0.9, 4, q, 9], [q, 9, q, 0]]
          || CASE WHEN r_regionkey = 3 THEN [[6.1, 9.5, 7.7, 9.5], [7.7, 9.5, 7.7, 9.9], [7.7, 9.9, 6.1, 9.9], [6.1, 9.9, 6.1, 9.5]]
                  WHEN r_regionkey = 4 THEN [[8.2, 1, 8.8, 1], [8.8, 1, 8.8, 2], [8.8, 2, 8.2, 2], [8.2, 2, 8.2, 1]]
                  ELSE [] END) AS e
          FROM (SELECT *, r_regionkey * 2.0 AS q FROM region))""",
    ),
    # the two straight pieces of every jam line
    "pieces": (
        "jams",
        """SELECT event_id, line, 1 AS piece, x0 AS px, y0 AS py, x1 AS qx, y1 AS qy FROM jams
        UNION ALL SELECT event_id, line, 2, x1, y1, x2, y2 FROM jams""",
    ),
    # brute force: every jam against every region
    "jam_regions": (
        "pieces shape_edges",
        """SELECT DISTINCT event_id, slug AS met FROM (
        SELECT p.event_id, p.piece, e.region_slug AS slug,
          sum(CASE WHEN p.piece = 1 AND (ey1 > py) <> (ey2 > py)
            AND px < ex1 + (ex2 - ex1) * (py - ey1) / nullif(ey2 - ey1, 0) THEN 1 ELSE 0 END) AS hits,
          bool_or(least(px, qx) <= greatest(ex1, ex2) AND least(ex1, ex2) <= greatest(px, qx)
            AND least(py, qy) <= greatest(ey1, ey2) AND least(ey1, ey2) <= greatest(py, qy)
            AND ((qx - px) * (ey1 - py) - (qy - py) * (ex1 - px)) * ((qx - px) * (ey2 - py) - (qy - py) * (ex2 - px)) <= 0
            AND ((ex2 - ex1) * (py - ey1) - (ey2 - ey1) * (px - ex1)) * ((ex2 - ex1) * (qy - ey1) - (ey2 - ey1) * (qx - ex1)) <= 0
          ) AS crossed
        FROM pieces p CROSS JOIN shape_edges e GROUP BY 1, 2, 3)
        WHERE hits % 2 = 1 OR crossed""",
    ),
    "sales": (
        "",
        """SELECT o_orderdate::date AS date, lower(r_name) AS region_slug, n_name AS nation, o_totalprice AS amount
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    ),
    "series": ("sales", "SELECT region_slug, date, round(sum(amount), 2) AS observed FROM sales GROUP BY ALL"),
    "analysis": (
        "series",
        """SELECT region_slug, year(date)::int AS year, month(date)::int AS month, isodow(date)::int AS dow,
        day(date)::int AS day, observed AS sum_length FROM series""",
    ),
}
