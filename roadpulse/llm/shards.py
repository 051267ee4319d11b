"""Sharding by histogram sort: exact byte counts below probe keys, refined until the splitters meet the tolerance.

The key of a document is (hash of its text, its id), so equal texts stand side by side and share a shard unless a
splitter has to fall into their group. All keys are read as a string of digits of ``DIGIT_BITS`` bits. Each round counts
bytes by the next digit, only in the cells in which a splitter still lies; the driver moves each splitter to the cell
that holds its target, which narrows all splitters at once. A splitter stops at a cell border that is within
``tolerance`` of its target; a group of equal texts is cut only if its borders are too far off. Then the rows are exchanged once, by key ranges.

Everything runs as DataFrame operations. The driver holds one count for each digit and splitter, whatever the data.
A text null counts as no bytes; an id null as the smallest id. Rows with equal keys stay in one shard: they cannot be
told apart. Ties of the order inside a shard are broken by size. An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import stored

DIGIT_BITS = 12
#: digits of the hash and of the id, 64 bits each
DIGITS = 6
OVERHEAD = 16


def keyed(documents: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the two parts of the key, ``hash`` and ``part``, as signed 64-bit numbers."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return documents.select(
        "doc_id",
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("hash"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("part"),
    )


def _digit(k: int) -> Column:
    """Digit ``k`` of the key, the most significant first; order of digits is order of signed numbers."""
    name, k = ("hash", k) if k < DIGITS else ("part", k - DIGITS)
    low = max(64 - DIGIT_BITS * (k + 1), 0)
    shifted = F.shiftright(name, low)
    bits = 64 - DIGIT_BITS * k - low
    return shifted if k == 0 else shifted.bitwiseAND(2**bits - 1)


def _prefix(k: int) -> list[Column]:
    """Columns that are equal for keys with the same first ``k`` digits."""
    if k <= DIGITS:
        return [F.shiftright("hash", max(64 - DIGIT_BITS * k, 0))] if k else []
    return [F.col("hash"), F.shiftright("part", max(64 - DIGIT_BITS * (k - DIGITS), 0))]


def _border(prefix: tuple[int, ...], k: int, digit: int) -> tuple[int, int]:
    """The smallest key (hash, part) whose first digits are ``prefix`` (of length k) and ``digit``."""
    if k < DIGITS:
        low = max(64 - DIGIT_BITS * (k + 1), 0)
        bits = 64 - DIGIT_BITS * k - low
        head = (prefix[0] << bits) if prefix else 0
        return ((head + digit) << low, -(2**63))
    j = k - DIGITS
    low = max(64 - DIGIT_BITS * (j + 1), 0)
    bits = 64 - DIGIT_BITS * j - low
    head = (prefix[1] << bits) if j else 0
    return (prefix[0], (head + digit) << low)


def splitters(keys: DataFrame, shards: int, tolerance: float = 0.002, whole: float = 0.01) -> list[tuple[int, int]]:
    """The keys at which shards 1, 2, ... begin, so that each begins within ``tolerance`` shards of its target byte.

    Where that needs a cut inside a group of equal texts, its border does instead if it is within ``whole`` shards.
    """
    total = keys.agg(F.sum("size").alias("s")).first()["s"]
    if not total:
        return []
    allowed = tolerance * total / shards
    wanted = {i: total * i / shards for i in range(1, shards)}
    at: dict[int, tuple[tuple[int, ...], int]] = {i: ((), 0) for i in wanted}  # cell of each open splitter, bytes before it
    found: dict[int, tuple[int, int]] = {}
    for k in range(2 * DIGITS):
        cells = sorted({at[i][0] for i in at})
        prefix = _prefix(k)
        rows = keys
        if prefix:
            # at most one cell for each splitter
            match = F.lit(False)
            for cell in cells:
                same = F.lit(True)
                for column, value in zip(prefix, cell, strict=True):
                    same = same & (column == F.lit(value))
                match = match | same
            rows = keys.where(match)
        names = [f"p{n}" for n in range(len(prefix))]
        counted = rows.groupBy(*[c.alias(n) for c, n in zip(prefix, names, strict=True)], _digit(k).alias("d")).agg(F.sum("size").alias("s"))
        histogram: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for r in counted.collect():
            histogram.setdefault(tuple(r[n] for n in names), []).append((r["d"], r["s"]))
        following: dict[int, tuple[tuple[int, ...], int]] = {}
        for i, (cell, before) in at.items():
            bins = sorted(histogram.get(cell, []))
            sums = [before]
            for _, s in bins:
                sums.append(sums[-1] + s)
            j = min(max(bisect_right(sums, wanted[i]) - 1, 0), len(bins) - 1)
            near = j if wanted[i] - sums[j] <= sums[j + 1] - wanted[i] else j + 1
            last = k == 2 * DIGITS - 1
            if abs(sums[near] - wanted[i]) <= (whole * total / shards if k == DIGITS - 1 else allowed) or last:
                digit = bins[near][0] if near < len(bins) else bins[-1][0] + 1
                found[i] = _border(cell, k, digit)
                continue
            digit = bins[j][0]
            following[i] = (_next(cell, k, digit), sums[j])
        at = following
        if not at:
            break
    limit = 2**63 - 1
    return [(min(h, limit), min(p, limit)) for _, (h, p) in sorted(found.items())]


def _next(cell: tuple[int, ...], k: int, digit: int) -> tuple[int, ...]:
    """The cell of the digits of ``cell`` and ``digit``, as values of ``_prefix(k + 1)``."""
    h, p = _border(cell, k, digit)
    if k + 1 <= DIGITS:
        return (h >> max(64 - DIGIT_BITS * (k + 1), 0),)
    return (h, p >> max(64 - DIGIT_BITS * (k + 1 - DIGITS), 0))


def _below(borders: list[tuple[int, int]], first: int = 0) -> Column:
    """The number of borders that a key reaches, by bisection."""
    if not borders:
        return F.lit(first)
    m = len(borders) // 2
    h, p = borders[m]
    reached = (F.col("hash") > h) | ((F.col("hash") == h) & (F.col("part") >= p))
    return F.when(reached, _below(borders[m + 1 :], first + m + 1)).otherwise(_below(borders[:m], first))


def shard(documents: DataFrame, shards: int = 40, tolerance: float = 0.002) -> DataFrame:
    """doc_id, size, text_crc32, ``shard`` and ``slot`` (gapless from 0 in each shard, in order of keys)."""
    keys = stored(keyed(documents), "shard-keys")
    keys = keys.withColumn("shard", _below(splitters(keys, shards, tolerance)).cast("int"))
    order = ["hash", "part", "size"]
    # the one exchange: ranges of the key, many to a shard, each in order; the id tells range and place in it
    placed = keys.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    placed = stored(placed, "shard-rows")
    run = F.shiftright("place", 33)
    runs = placed.groupBy("shard", run.alias("run")).agg(F.min("place").alias("begin"), F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    placed = placed.withColumn("run", run).join(runs, ["shard", "run"])
    slot = (F.col("place") - F.col("begin") + F.col("before")).alias("slot")
    return placed.select("doc_id", "size", "text_crc32", "shard", slot)


def write(documents: DataFrame, path: str, shards: int = 40) -> None:
    """Documents written to one folder for each shard, with their slot."""
    keys = keyed(documents)
    at = _below(splitters(stored(keys, "shard-keys"), shards))
    text = F.coalesce(F.col("text"), F.lit(""))
    part = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    whole = documents.withColumn("hash", F.xxhash64(text)).withColumn("part", part)
    whole = whole.withColumn("shard", at.cast("int")).repartitionByRange("hash", "part").sortWithinPartitions("hash", "part")
    whole.drop("hash", "part").write.partitionBy("shard").parquet(path)
