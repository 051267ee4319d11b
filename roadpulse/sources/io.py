"""Readers and writers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.operators.stats import QUANTILES

# -- sources ------------------------------------------------------------------------------


def on_days(df: DataFrame, days: Sequence[str | dt.date], column: str = "datetime", pattern: bool = False) -> DataFrame:
    """Rows of the listed ``YYYYMMDD`` days.

    The default list test prunes partitions in file tables and metastores alike; ``pattern`` uses
    the alternation the raw keys need when they carry an hour after the day.
    """
    texts = [d if isinstance(d, str) else d.strftime("%Y%m%d") for d in days]
    if pattern:
        return df.where(F.col(column).cast("string").rlike("|".join(texts)))
    return df.where(F.col(column).cast("string").isin(texts))


def read_jams(
    spark: SparkSession, path: str, days: Sequence[str | dt.date] | None = None, columns: Sequence[str] | None = None,
    fmt: str = "parquet", pattern: bool = False,
) -> DataFrame:
    """Raw jam table, restricted to days and columns at the scan."""
    df = spark.read.format(fmt).load(path)
    if days is not None:
        df = on_days(df, days, pattern=pattern)
    return df.select(*columns) if columns else df


def read_jams_switch(before: DataFrame, after: DataFrame, break_date: str | dt.date, date: Column) -> DataFrame:
    """Source A for days before a break date, source B from it on."""
    limit = F.lit(break_date).cast("date")
    return before.where(date < limit).unionByName(after.where(date >= limit))


def read_pipe_strings(spark: SparkSession, path: str, columns: Sequence[str], sep: str = "|") -> DataFrame:
    """Headerless delimited text, every column a string."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).option("sep", sep).csv(path)


def read_shapes(spark: SparkSession, path: str, sep: str = "|") -> DataFrame:
    """Delimited shape file with a header."""
    return spark.read.option("header", True).option("sep", sep).csv(path)


def read_parts(
    spark: SparkSession, paths: str | Sequence[str], schema: str, key_pattern: str | None = None, key: str = "source", **options
) -> DataFrame:
    """Many part files as one table, with a key taken from the file path."""
    reader = spark.read.schema(schema).options(**{"header": True, **options})
    df = reader.csv(list(paths) if not isinstance(paths, str) else paths)
    if key_pattern is None:
        return df
    return df.select("*", F.regexp_extract(F.col("_metadata.file_path"), key_pattern, 1).alias(key))


def read_quantiles(spark: SparkSession, path: str) -> DataFrame:
    """Quantile file whose lines are bracketed, quoted lists; brackets and quotes are dropped."""
    names = ["region_slug", "mean", "var_p", "var_s", *QUANTILES]
    cells = F.split(F.regexp_replace("value", r"[\[\]'\"]", ""), r",\s*")
    typed = [F.get(cells, F.lit(0)).alias(names[0])]
    typed += [F.get(cells, F.lit(i)).try_cast("double").alias(n) for i, n in enumerate(names) if i]
    return spark.read.text(path).where(F.trim("value") != "").select(*typed)


GEOJSON = (
    "type string, features array<struct<type: string, properties: map<string, string>, "
    "geometry: struct<type: string, coordinates: string>>>"
)


def read_geojson(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Features of GeoJSON files: properties and geometry as WKT text.

    A file is one document, or one document per line with ``lines`` (files that split). Coordinates
    keep their JSON text: numbers are turned from ``[x,y]`` into ``x y`` and brackets into
    parentheses.
    """
    raw = spark.read.schema(GEOJSON).option("multiLine", not lines).json(path)
    feature = raw.select(F.explode("features").alias("f"))
    pairs = F.regexp_replace("f.geometry.coordinates", r"\[\s*([-0-9.eE+]+)\s*,\s*([-0-9.eE+]+)[^\[\]]*\]", "$1 $2")
    body = F.translate(pairs, "[]", "()")
    spaced = F.regexp_replace(body, r"\s*,\s*", ", ")
    return feature.select(
        F.col("f.properties").alias("properties"),
        F.concat_ws(" ", F.upper("f.geometry.type"), spaced).alias("region_shapefile_wkt"),
    )


def read_length_stats(
    spark: SparkSession, path: str, key_pattern: str = r"([^/]*)_\d+\.json$", lines: bool = False
) -> DataFrame:
    """Road length per region from JSON files, one or more per region (``slug_1.json`` ...).

    A file is one document, or one document per line with ``lines``.
    """
    schema = "elements array<struct<tags: map<string, string>>>"
    raw = spark.read.schema(schema).option("multiLine", not lines).option("recursiveFileLookup", True).json(path)
    key = F.regexp_extract(F.col("_metadata.file_path"), key_pattern, 1)
    rows = raw.select(key.alias("region_slug"), F.explode("elements").alias("e"))
    length = F.try_element_at("e.tags", F.lit("length")).try_cast("double")
    return rows.groupBy("region_slug").agg(F.sum(length).alias("length"))


# -- sinks --------------------------------------------------------------------------------


def write_orc(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("compression", "zlib").orc(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], fmt: str = "orc", mode: str = "overwrite") -> None:
    """Partitioned table. Rows are shuffled by the partition columns and a spread key, so that a hot
    partition is written by several tasks while small ones get few files."""
    spread(df, by).write.mode(mode).partitionBy(*by).format(fmt).options(**_options(fmt)).save(path)


def _options(fmt: str) -> dict[str, str]:
    return {"compression": "zlib"} if fmt == "orc" else {}


def spread(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rebalance by partition columns: adaptive execution splits hot partitions and joins small ones."""
    return df.hint("rebalance", *[F.col(c) for c in by])


def fill_partitions(df: DataFrame, path: str, by: Sequence[str], fmt: str = "orc") -> None:
    """Replace exactly the partitions present in ``df``; running it again changes nothing."""
    (
        spread(df, by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**_options(fmt))
        .partitionBy(*by)
        .format(fmt)
        .save(path)
    )


def append(df: DataFrame, path: str, by: Sequence[str] = (), fmt: str = "orc") -> None:
    writer = df.write.mode("append").options(**_options(fmt)).format(fmt)
    (writer.partitionBy(*by) if by else writer).save(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", by: Sequence[str] = ()) -> None:
    """``overwrite`` replaces the dataset, ``overwrite_partitions`` only the partitions present."""
    writer = df.write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic" if mode == "overwrite_partitions" else "static"
    )
    (writer.partitionBy(*by) if by else writer).parquet(path)


def register_partitions(spark: SparkSession, table: str) -> None:
    """Discover partition folders of a catalog table."""
    spark.catalog.recoverPartitions(table)


def write_pipe_text(df: DataFrame, path: str, by: Sequence[str] = ("region_slug", "year"), sep: str = "|") -> None:
    """Delimited text, partitioned, no header."""
    df.write.mode("overwrite").partitionBy(*by).option("sep", sep).option("timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
