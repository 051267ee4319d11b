"""A stored table of the lines of a feed: which regions each meets, found once."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.operators import spatial

LINE, KEY, WKT = "line", "region_slug", "region_shapefile_wkt"
FOUND = f"{LINE} string, regions array<string>"


def version(regions: DataFrame, **options) -> str:
    """A name for a set of regions with their shapes, and for the cells they are joined by."""
    content = F.sum(F.xxhash64(KEY, WKT).cast("decimal(38)")).cast("string")
    found = regions.agg(F.count(F.lit(1)).alias("n"), F.coalesce(content, F.lit("0")).alias("h")).first()
    cells = "-".join(str(v) for _, v in sorted(options.items()) if isinstance(v, int))
    return f"{found['n']}_{found['h'].lstrip('-')}_{cells}"


def stored(spark: SparkSession, path: str, of: str) -> DataFrame:
    """Lines tested so far against this set of regions, none before the first."""
    try:
        return spark.read.schema(FOUND).parquet(f"{path}/version={of}")
    except AnalysisException:
        return spark.createDataFrame([], FOUND)


def update(spark: SparkSession, path: str, jams: DataFrame, regions: DataFrame, **options) -> DataFrame:
    """Test the lines of ``jams`` that the table at ``path`` does not know yet, append them, and return line and region.

    A line that meets no region is entered as well, so it is not tested again. Another set of regions is a version of its
    own. The table has one writer at a time; lines that an interrupted job did not append are new to the next one.
    """
    of = version(regions, **options)
    known = stored(spark, path, of)
    new = jams.select(LINE).where(F.col(LINE).isNotNull()).distinct().join(known.select(LINE), LINE, "left_anti")
    pairs = spatial.line_polygons(new, regions, LINE, KEY, **options)
    met = pairs.groupBy(LINE).agg(F.sort_array(F.collect_list(KEY)).alias("regions"))  # at most all regions
    none = F.array().cast("array<string>")
    found = new.join(met, LINE, "left").select(LINE, F.coalesce("regions", none).alias("regions"))
    found.write.mode("append").parquet(f"{path}/version={of}")
    return stored(spark, path, of).select(LINE, F.explode("regions").alias(KEY))
