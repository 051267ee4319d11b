"""Exact dedup by a Golomb-coded fingerprint exchange: only texts that may have a copy are ever shuffled.

1. Every partition writes its rows once, with the normalised text, its SHA-256 and a 64-bit hash, bucketed by the number
   of the partition. From here on that table is the partition's memory.
2. A sender (up to ``SEND`` rows of a task) cuts its hashes to log2(rows) + ``SPARE`` bits, sorts them and sends each
   distinct value once to the owner of its range: gaps between neighbours, Golomb-coded with a power of two, some ten bits
   for a document. Values that it holds twice are suspect without asking.
3. An owner decodes what all senders sent and answers each with a bitmap: which of your values has somebody else? It
   holds about ``OWN`` values, however large the table is; a text in a third of all rows is one value from each sender.
4. Bitmaps become one bit for each row of a partition and are joined to the bucketed table without moving it: the
   texts of rows without a set bit never leave their place. Chance agreement lets 1 / 2 ** SPARE of the others through.
5. Suspects are grouped by digest and whole text, byte by byte; copies are combined before the shuffle. Of each group the
   row with the smallest id stays, of rows that repeat that id the first stored; rows without an id stay only where no
   row of the group has one. Digests and texts must correspond one to one, else the job ends with an error.

Texts are equal if they are identical after every run of white space became one blank; null counts as empty. Every row
has a row in the result. Other columns are dropped. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import shared_folder, stored

#: Rows a sender gathers, values an owner holds on average, bits beyond those needed to tell all rows apart.
SEND, OWN, SPARE = 1 << 19, 1 << 16, 8
#: Number of a row inside its partition, and of the partition above it, as Spark gives them.
POSITION_BITS = 33


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def memory(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """id, norm, sha, hash, row, part of every row, written in buckets of ``part``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).alias("id"), normalised(F.col(text_column)).alias("norm"))
    rows = rows.select("id", "norm", F.sha2("norm", 256).alias("sha"), F.xxhash64("norm").alias("hash"), F.monotonically_increasing_id().alias("row"))
    rows = rows.withColumn("part", F.call_function("shiftright", F.col("row"), F.lit(POSITION_BITS)))
    name = f"exact_dedup_{uuid.uuid4().hex}"
    # as many buckets as exchanges have partitions, so that a join by part moves nothing of this side
    writer = rows.write.format("parquet").bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "part")
    writer.option("path", f"{shared_folder(spark)}/{name}").saveAsTable(name)
    return spark.table(name)


def encode(gaps: np.ndarray) -> tuple[int, bytes, bytes]:
    """Golomb code of non-negative numbers with a parameter of 2 ** k: k, quotients in unary, remainders in k bits each."""
    k = max(0, int(np.floor(np.log2(max(1.0, 0.69 * float(gaps.mean()))))))
    ends = np.cumsum((gaps >> k) + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1, np.uint8)
    unary[ends] = 1
    rest = np.empty((len(gaps), k), np.uint8)
    for bit in range(k):
        rest[:, bit] = (gaps >> bit) & 1
    return k, np.packbits(unary).tobytes(), np.packbits(rest).tobytes()


def decode(n: int, k: int, unary: bytes, rest: bytes) -> np.ndarray:
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)))[:n]
    gaps = np.diff(ends, prepend=-1) - 1 << k
    bits = np.unpackbits(np.frombuffer(rest, np.uint8), count=n * k).reshape(n, k)
    for bit in range(k):
        gaps |= bits[:, bit].astype(np.int64) << bit
    return gaps


_SENT = pa.schema(
    [("sender", pa.int64()), ("owner", pa.int32()), ("n", pa.int32()), ("k", pa.int32()), ("unary", pa.binary()), ("rest", pa.binary()),
     ("rows", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32()))]
)


def messages(rows: np.ndarray, hashes: np.ndarray, bits: int, width: int) -> pa.RecordBatch:
    """What one sender sends, a row for each owner; ``rows`` and ``counts`` stay with the sender, in order of the values."""
    value = (hashes.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
    order = np.lexsort((rows, value))
    rows, value = rows[order], value[order]
    start = np.flatnonzero(np.diff(value, prepend=-1))
    distinct, counts = value[start], np.diff(start, append=len(value))
    owner = distinct // width
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    out: list[dict] = []
    for a, b in zip(first, [*first[1:], len(owner)]):
        k, unary, rest = encode(np.diff(distinct[a:b], prepend=owner[a] * width))
        end = start[b] if b < len(start) else len(rows)
        out.append(
            {"sender": rows.min(), "owner": owner[a], "n": b - a, "k": k, "unary": unary, "rest": rest,
             "rows": rows[start[a] : end], "counts": counts[a:b]}
        )
    return pa.RecordBatch.from_arrays([pa.array([m[f.name] for m in out], f.type) for f in _SENT], schema=_SENT)


def send(table: DataFrame, bits: int, width: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= SEND:
                yield flush(held)
                held, n = [], 0
        if n:
            yield flush(held)

    def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        both = pa.Table.from_batches(held)
        return messages(both["row"].to_numpy(), both["hash"].to_numpy(), bits, width)

    kinds = "sender long, owner int, n int, k int, unary binary, rest binary, rows array<long>, counts array<int>"
    return table.select("row", "hash").mapInArrow(work, kinds)


def answer(sent: DataFrame) -> DataFrame:
    """sender, owner, bits: a bit for each value of a message, set if another message has the value too."""

    def owned(received: pa.Table) -> pa.Table:
        columns = [received[c].to_pylist() for c in ("n", "k", "unary", "rest")]
        values = [np.cumsum(decode(*m)) for m in zip(*columns)]
        _, at, counts = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
        twice = counts[at] > 1
        ends = np.cumsum([len(v) for v in values])
        bits = [np.packbits(part).tobytes() for part in np.split(twice, ends[:-1])]
        return pa.table({"sender": received["sender"], "owner": received["owner"], "bits": pa.array(bits, pa.binary())})

    asked = sent.select("sender", "owner", "n", "k", "unary", "rest")
    return asked.groupBy("owner").applyInArrow(owned, "sender long, owner int, bits binary")


def marked(sent: DataFrame, answers: DataFrame) -> DataFrame:
    """part, words: bit i of word j is set if row 64 j + i of the partition may have a copy."""

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                counts = batch["counts"][i].values.to_numpy()
                asked = np.unpackbits(np.frombuffer(batch["bits"][i].as_py(), np.uint8), count=len(counts)).astype(bool)
                rows = batch["rows"][i].values.to_numpy()[np.repeat(asked | (counts > 1), counts)]
                if len(rows):
                    yield pa.RecordBatch.from_arrays([pa.array(rows >> POSITION_BITS), pa.array(rows & (1 << POSITION_BITS) - 1)], ["part", "pos"])

    def bits(found: pa.Table) -> pa.Table:
        pos = found["pos"].to_numpy()
        held = np.zeros((int(pos.max()) // 64 + 1) * 64, np.uint8)
        held[pos] = 1
        words = np.packbits(held, bitorder="little").view("<i8")
        return pa.table({"part": found["part"][:1], "words": pa.array([words], pa.list_(pa.int64()))})

    own = sent.select("sender", "owner", "rows", "counts")
    found = own.join(answers, ["sender", "owner"]).select("rows", "counts", "bits").mapInArrow(suspects, "part long, pos long")
    return found.groupBy("part").applyInArrow(bits, "part long, words array<long>")


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", spare: int = SPARE) -> DataFrame:
    """For every row its id, keep_id, group_size, kept and text_sha256."""
    table = memory(docs, id_column, text_column)
    n = table.count()
    bits = min(62, max(1, n).bit_length() + spare)
    owners = -(-n // OWN) or 1
    sent = stored(send(table, bits, -(-(1 << bits) // owners)), "exact-sent")
    words = stored(marked(sent, answer(sent)), "exact-suspects").hint("shuffle_hash")

    place = F.col("row").bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    word = F.get("words", (place / 64).cast("int"))
    suspect = F.coalesce(F.call_function("getbit", word, (place % 64).cast("int")) == 1, F.lit(False))
    rows = table.join(words, "part", "left").withColumn("suspect", suspect)

    maybe = rows.where("suspect")
    same = maybe.groupBy("sha", "norm").agg(F.count(F.lit(1)).alias("n")).groupBy("sha").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("size"))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    first = maybe.groupBy("sha").agg(F.min(order).alias("first"))
    one = F.when(F.col("texts") == 1, F.col("first")).otherwise(F.raise_error(F.lit("two texts have one SHA-256")))
    # written, so that the join below has an exchange on either side and a hot digest can be split
    groups = stored(same.join(first, "sha").select("sha", "size", one.alias("first")), "exact-groups")
    found = maybe.select("id", "row", "sha").join(groups, "sha")
    copies = found.select("id", F.col("first.id").alias("keep"), "size", (F.col("row") == F.col("first.row")).alias("kept"), "sha")
    alone = rows.where("NOT suspect").select("id", F.col("id").alias("keep"), F.lit(1).cast("long").alias("size"), F.lit(True).alias("kept"), "sha")
    return copies.unionByName(alone).toDF(id_column, "keep_id", "group_size", "kept", "text_sha256")
