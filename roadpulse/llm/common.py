"""Shared folder, written intermediate tables, and Arrow batches cut to a bounded number of bytes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Used only by local sessions that name no folder, as in tests.
LOCAL_FOLDER = "/tmp/checkpoints"
#: Rows handed to Python at once; long texts make wide rows, so the number is small.
BATCH_ROWS = 1000
#: Bytes handed to Python at once, unless one row alone is larger.
BATCH_BYTES = 4 << 20
#: Bytes of text worked on at once inside a task, unless one text alone is longer.
SLICE_BYTES = 1 << 18
#: Entries of a table of words that a worker keeps from one task to the next.
KEPT_ENTRIES = 60_000


def prepare(spark: SparkSession) -> SparkSession:
    """Settings that results depend on (UTC) and that bound a task's memory."""
    for key, value in (
        ("spark.sql.session.timeZone", "UTC"),
        ("spark.sql.adaptive.enabled", "true"),
        ("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS)),
        ("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES)),
    ):
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a local session without one gets ``LOCAL_FOLDER``."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return LOCAL_FOLDER


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage ends there, and lost executors do not matter."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def trimmed(table: dict) -> dict:
    """The first entries of a table of words: those met first are mostly those met often."""
    return dict(islice(table.items(), KEPT_ENTRIES))


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array, nulls as empty texts; offsets start at 0 and have one entry more than rows."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64, len(texts) + 1 + texts.offset)[texts.offset :]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of each hold ``limit`` bytes at most, or are one text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = text_buffers(batch.column(column))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(at, at[start] + limit, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end
