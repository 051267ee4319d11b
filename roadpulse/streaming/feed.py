"""The 5-minute feed as a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions import timefn


def first_reports(
    jams: DataFrame, delay: str = "10 minutes", minutes: int = timefn.FEED_MINUTES, id_col: str = "uuid", ts: str = "ts",
    within: Sequence[str] = ("region_slug",), ties: Sequence[str] = ("length", "line"),
) -> DataFrame:
    """Earliest report per id and feed slot, emitted once the slot is past the watermark.

    A windowed minimum instead of dropping duplicates on arrival: the result does not depend on the
    order in which rows arrive, so it equals the batch dedup. State is one row per id and open
    slot. Slots are aligned to the epoch, which is the batch alignment when ``minutes`` divides a day.
    """
    rest = [c for c in jams.columns if c not in {*within, id_col, ts, *ties}]
    row = F.struct(ts, *ties, *rest)
    slots = (
        jams.withWatermark(ts, delay)
        .groupBy(*within, id_col, F.window(ts, f"{minutes} minutes").alias("slot"))
        .agg(F.min(row).alias("_row"))
    )
    return slots.select(*within, id_col, F.window_time("slot").alias("slot_time"), "_row.*")


def segment_hour(
    jams: DataFrame, delay: str = "10 minutes", minutes: int = timefn.FEED_MINUTES, id_col: str = "uuid", ts: str = "ts",
    within: Sequence[str] = ("region_slug",),
) -> DataFrame:
    """Hourly intensity per region and polyline; rows later than ``delay`` are dropped."""
    kept = first_reports(jams, delay, minutes, id_col, ts, within)
    hours = kept.groupBy(*within, "line", F.window("slot_time", "1 hour").alias("hour")).agg(F.sum("length").alias("tci"))
    return hours.select(*within, "line", F.col("hour.start").alias("hour_start"), "tci")


def write(df: DataFrame, path: str, checkpoint: str, by: Sequence[str] = (), available_now: bool = True):
    """Append to a file table; ``available_now`` processes what is there and stops.

    ``checkpoint`` belongs in the shared folder, so a restarted query resumes where it stopped.
    """
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).option("path", path)
    if by:
        writer = writer.partitionBy(*by)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
