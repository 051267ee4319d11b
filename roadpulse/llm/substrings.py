"""Repeated passages by seed and extend.

A window is ``length`` consecutive words of one document. Seeds are winnowed anchors: of the ``SEED``-word sequences in
a window, the one with the least hash, the leftmost of equals. Equal windows have the same anchor at the same place, so
documents that share a window meet when joined on anchors. Neighbouring windows mostly have the same anchor; such a run
of windows spans the anchor extended to both sides, as far as any window reaches, and is compared as a whole first:

* an anchor that occurs once ends there (most do);
* if all occurrences of an anchor have the same span, all windows of all but the first repeat an earlier one;
* where spans differ, the repeat ends within the span, and the windows of the span are compared one by one; the first
  occurrence of each window is found by a minimum, which is combined before any shuffle.

The union of the repeated windows of a document is its maximal repeats of at least ``length`` words. A word is removed if
a repeated window covers it. Windows are judged on the input, so nothing depends on an order of work.

Hot passages cost no more than others: occurrences meet only in aggregations, and joins that Spark can split.
Sequences are compared by 64-bit hashes. Null texts count as empty; texts shorter than a window lose nothing. Rows are
marked by keys of their own: the id where ids are unique, else the id and a number given in a table that is written once.
So rows that share an id, or have none, are documents like others, in order of (id, number); a null id is the smallest,
and of two equal rows one keeps its words. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import slices, stored, text_buffers
from roadpulse.llm.words import Words

LENGTH = 20
SEED = 5


def runs(words: Words, length: int, seed: int) -> tuple[np.ndarray, ...]:
    """(row, start, windows, anchor, span) of each run of windows of one text with the same anchor."""
    start, first = words.windows(length)
    if not len(start):
        empty = np.empty(0, np.int64)
        return empty, empty, empty, empty, empty
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    n = len(words.hashes)
    grams = words.spans(np.arange(n - seed + 1), np.arange(seed, n + 1))
    reach = length - seed + 1
    # least of each reach sequences by doubling: least of 2, 4, 8, ... with leftmost places
    place, width = np.arange(len(grams)), 1
    while width * 2 <= reach:
        a, b = place[:-width], place[width:]
        place = np.where(grams[b] < grams[a], b, a)
        width *= 2
    a, b = place[start], place[start + reach - width]
    anchor = np.where(grams[b] < grams[a], b, a)
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(start)))
    begin = start[at]
    spans = words.spans(begin, begin + count + length - 1)
    return row[at], begin - words.first[row[at]], count, grams[anchor[at]].view(np.int64), spans.view(np.int64)


def keyed(documents: DataFrame, *columns: str) -> DataFrame:
    """``row``, a key that is never null and ordered as the ids, ``text``, and the given columns as a struct ``doc``."""
    rows = documents.select("text", F.struct(*columns).alias("doc"), F.col("doc_id").alias("id"))
    odd = rows.groupBy("id").count().where("count > 1 OR id IS NULL")
    if odd.isEmpty():
        return rows.select(F.col("id").alias("row"), "text", "doc")
    numbered = rows.select(F.struct("id", F.monotonically_increasing_id().alias("number")).alias("row"), "text", "doc")
    return stored(numbered, "substring-rows")


def anchors(rows: DataFrame, length: int, seed: int) -> DataFrame:
    """row, start, windows, anchor, span of every run."""
    kind = rows.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            row, start, count, anchor, span = runs(Words(*text_buffers(batch.column("text"))), length, seed)
            columns = [batch.column("row").take(pa.array(row)), pa.array(start, pa.int32()), pa.array(count, pa.int16()), pa.array(anchor), pa.array(span)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "start", "windows", "anchor", "span"])

    return rows.select("row", "text").mapInArrow(run, f"row {kind}, start int, windows smallint, anchor long, span long")


def _covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of ``n`` words the windows at ``starts`` cover."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + length, n), -1)
    return np.cumsum(change[:n]) > 0


def dedup(documents: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """doc_id, ``n_words``, ``n_removed``, and ``removed``: an array of (begin, end) of the words that go."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words, gone = _gone(batch, length)
            counts = np.diff(words.first)
            removed = []
            for g in gone:
                edge = np.flatnonzero(np.diff(np.concatenate([[0], g.astype(np.int8), [0]])))
                removed.append([{"begin": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)])
            kinds = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
            columns = [batch.column("doc").field(0), pa.array(counts, pa.int64()), pa.array([int(g.sum()) for g in gone], pa.int64()), pa.array(removed, kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "removed"])

    schema = f"doc_id {kind}, n_words long, n_removed long, removed array<struct<begin:int,end:int>>"
    return _with_marks(keyed(documents, "doc_id"), length, seed).mapInArrow(run, schema)


def digests(documents: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the kept words, joined by one space."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            counts, removed, texts = _kept(batch, length)
            digest = [hashlib.sha256(t).hexdigest() for t in texts]
            columns = [batch.column("doc").field(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept_sha256"])

    schema = f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string"
    return _with_marks(keyed(documents, "doc_id"), length, seed).mapInArrow(run, schema)


def cleaned(documents: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """``documents`` with texts that lost words rewritten as their kept words joined by one space; others unchanged."""
    names = documents.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            _, removed, texts = _kept(batch, length)
            old = batch.column("text").to_pylist()
            text = pa.array([t.decode() if r else o for r, t, o in zip(removed, texts, old, strict=True)], pa.string())
            given = iter(batch.column("doc").flatten())
            yield pa.RecordBatch.from_arrays([text if n == "text" else next(given) for n in names], names)

    return _with_marks(keyed(documents, *[n for n in names if n != "text"]), length, seed).mapInArrow(run, fields)


def _gone(batch: pa.RecordBatch, length: int) -> tuple[Words, list[np.ndarray]]:
    words = Words(*text_buffers(batch.column("text")))
    counts = np.diff(words.first)
    gone = []
    for n, marks in zip(counts, batch.column("marks").to_pylist(), strict=True):
        starts = np.concatenate([np.arange(m["start"], m["start"] + m["windows"]) for m in marks]) if marks else np.empty(0, np.int64)
        gone.append(_covered(starts, length, int(n)))
    return words, gone


def _kept(batch: pa.RecordBatch, length: int) -> tuple[list[int], list[int], list[bytes]]:
    data, _ = text_buffers(batch.column("text"))
    raw = data.tobytes()
    words, gone = _gone(batch, length)
    counts, removed, texts = [], [], []
    for i, g in enumerate(gone):
        a, b = words.first[i], words.first[i + 1]
        stay = ~g
        starts, ends = words.starts[a:b][stay].tolist(), words.ends[a:b][stay].tolist()
        counts.append(int(b - a))
        removed.append(int(g.sum()))
        texts.append(b" ".join([raw[s:e] for s, e in zip(starts, ends, strict=True)]))
    return counts, removed, texts


def _with_marks(rows: DataFrame, length: int, seed: int) -> DataFrame:
    found = stored(_marked(rows, length, seed), "substring-marks")
    return rows.join(found, "row", "left")


def _marked(rows: DataFrame, length: int, seed: int) -> DataFrame:
    """row and ``marks``: runs (start, windows) of windows that repeat an earlier one."""
    every = anchors(rows, length, seed)
    place = F.struct("row", "start")
    known = every.groupBy("anchor").agg(
        F.count("*").alias("n"), F.min("span").alias("low"), F.max("span").alias("high"), F.min(place).alias("origin")
    )
    # written first, so that the join below is one of plain exchanges, in which Spark can split a hot anchor
    known = stored(known.where("n > 1").select("anchor", (F.col("low") == F.col("high")).alias("same"), "origin"), "substring-anchors")
    # occurrences of repeated anchors; those of one span need no more than the first occurrence
    met = stored(every.join(known, "anchor"), "substring-seeds")
    whole = met.where(F.col("same") & (place != F.col("origin"))).select("row", "start", "windows")
    unlike = met.where(~F.col("same"))
    # of equal spans of an anchor, the first is compared window by window, the others repeat it whole
    first = unlike.groupBy("anchor", "span").agg(F.min(place).alias("origin"), F.count("*").alias("n"))
    first = stored(first, "substring-spans")
    several = first.where("n > 1").drop("n")
    again = unlike.drop("origin").join(several, ["anchor", "span"]).where(place != F.col("origin"))
    again = again.select("row", "start", "windows")
    single = _windows(rows, unlike.drop("origin").join(first.drop("n"), ["anchor", "span"]).where(place == F.col("origin")), length)
    single = stored(single, "substring-windows")
    earliest = single.groupBy("window").agg(F.count("*").alias("n"), F.min(place).alias("origin")).where("n > 1").drop("n")
    earliest = stored(earliest, "substring-earliest")
    later = single.join(earliest, "window").where(place != F.col("origin"))
    later = later.select("row", "start", F.lit(1).cast("smallint").alias("windows"))
    marks = whole.unionByName(again).unionByName(later)
    return marks.groupBy("row").agg(F.collect_list(F.struct("start", "windows")).alias("marks"))  # bounded by the text


def _windows(rows: DataFrame, spans: DataFrame, length: int) -> DataFrame:
    """row, start and hash ``window`` of every window of the given runs."""
    kind = rows.schema["row"].dataType.simpleString()
    asked = spans.groupBy("row").agg(F.collect_list(F.struct("start", "windows")).alias("marks"))  # bounded by the text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = Words(*text_buffers(batch.column("text")))
            row, start = [], []
            for i, marks in enumerate(batch.column("marks").to_pylist()):
                own = np.concatenate([np.arange(m["start"], m["start"] + m["windows"]) for m in marks])
                row.append(np.full(len(own), i)), start.append(own)
            row, start = np.concatenate(row), np.concatenate(start)
            at = words.first[row] + start
            window = words.spans(at, at + length).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(row)), pa.array(start, pa.int32()), pa.array(window)], ["row", "start", "window"])

    return rows.select("row", "text").join(asked, "row").mapInArrow(run, f"row {kind}, start int, window long")
