"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

A document is its byte-level BPE ids and one end id. A document longer than the capacity is cut into pieces of exactly
the capacity, the rest being its first piece; full pieces are sequences of their own. All other pieces are dealt at
random into blocks of about ``BLOCK_ITEMS``. Each block is evolved by several islands, one task each:

* individuals are sets of bins; the first comes from best fit by decreasing length, others from a disturbed order;
* crossover injects well-filled bins of one parent whole into the other, removes the bins that hold an injected piece,
  and puts the displaced pieces back by best fit; mutation breaks up the emptiest bins and does the same;
* an island stops when it has reached the bound ceil(tokens / capacity) or its generations are used up;
* then elites migrate to the next island of the block, and evolution goes on from both elites.

The best island gives the bins of a block. Pieces in ill-filled bins of many blocks are then dealt into new blocks and
packed once more, so that the last bins of the blocks do not stay half empty. Only lengths are shuffled, never ids.

Null texts count as empty (the end id alone). Repeated rows are packed once each. An empty table gives an empty result;
other columns are dropped. All randomness is seeded by block and island, so a lost task gives the same bins again.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from random import Random

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import slices, stored, trimmed

CAPACITY = 2048
BLOCK_ITEMS = 2048
ISLANDS = 2
GENERATIONS = 6
POPULATION = 4
#: Bins filled less than this are opened again in the second round; so many blocks give one new block.
REOPEN_BELOW, BLOCKS_JOINED = 0.97, 16
TABLE_ENTRIES = 600_000
LONGEST_KEPT = 48
#: Words encoded at once if they are not of letters alone; longer texts cost the tokenizer more for each word.
TOGETHER = 100
END_ID = 0

#: A space before a character that is no white space always starts a new pre-token, whatever stands before it.
_CUT = re.compile(r" (?=\S)")
_BLANK = re.compile(r"\s")
#: Latin letters: a run of them, with or without a space in front, is one pre-token.
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ɏ]+")
_coders: dict[str, Coder] = {}


class Coder:
    """Byte-level BPE ids with a table from each distinct spaced word to its ids.

    Pre-tokens never cross a cut, so the ids of a text are those of its words in order. Nor do they cross a single line
    feed between other characters, or the border of letters and a full stop or comma. New words of Latin letters are one
    pre-token each and go straight to the merges of the model; others are encoded many at a time, one a line, as a line
    feed before a space is a token of its own.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.model = Tokenizer.from_file(path)
        self.merges = self.model.model.tokenize
        #: how the model spells a space and letters beyond ASCII, byte by byte
        spelt = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.front = spelt(" ")[0][0]
        self.spelling = {c: spelt(chr(c))[0][0] for c in range(0xC0, 0x250)}
        #: added tokens are found before words are; texts that hold one are encoded whole
        self.added = [t.content for t in self.model.get_added_tokens_decoder().values()]
        #: ids of words with a space in front; keys never begin with white space
        self.table: dict[str, bytes] = {}
        #: ids of words without a space in front
        self.bare: dict[str, bytes] = {}
        self.feed = self._plain("\n")
        self.marks = {m: array("I", self._plain(m)).tobytes() for m in ".,"}

    def _plain(self, text: str) -> list[int]:
        return self.model.encode(text, add_special_tokens=False).ids

    def _encode(self, words: list[str], space: str, table: dict[str, bytes]) -> None:
        """Words without white space, into ``table``."""
        front, others = self.front if space else "", []
        for w in words:
            if _LETTERS.fullmatch(w):
                spelt = w if w.isascii() else w.translate(self.spelling)
                table[w] = array("I", [t.id for t in self.merges(front + spelt)]).tobytes()
            else:
                others.append(w)
        for k in range(0, len(others), TOGETHER):
            part = others[k : k + TOGETHER]
            ids = np.asarray(self._plain("\n".join([space + w for w in part])), "<u4")
            cuts = np.flatnonzero(ids == self.feed[0])
            if len(self.feed) == 1 and len(cuts) == len(part) - 1:
                raw, at = ids.tobytes(), [-1, *cuts.tolist(), len(ids)]
                for w, a, b in zip(part, at[:-1], at[1:], strict=True):
                    table[w] = raw[4 * a + 4 : 4 * b]
            else:
                for w in part:
                    table[w] = array("I", self._plain(space + w)).tobytes()

    def _words(self, words: set[str], space: str, table: dict[str, bytes]) -> None:
        """As ``_encode``, with a mark after letters taken off first."""
        marked = [w for w in words if w[-1] in ".," and w[:-1].isalpha()]
        new = words.difference(marked)
        new.update(w[:-1] for w in marked if w[:-1] not in table)
        self._encode(list(new), space, table)
        for w in marked:
            table[w] = table[w[:-1]] + self.marks[w[-1]]

    def learn(self, words: set[str]) -> None:
        """Add words to the table. They do not begin with white space."""
        simple, lined = set(), {}
        for w in words:
            if w.isalpha() or not _BLANK.search(w):
                simple.add(w)
                continue
            parts = w.split("\n")
            if all(parts) and not any(_BLANK.search(p) for p in parts):
                lined[w] = parts
            else:
                self.table[w] = array("I", self._plain(f" {w}")).tobytes()
        simple.update(p[0] for p in lined.values() if p[0] not in self.table)
        self._words(simple, " ", self.table)
        self._words({x for p in lined.values() for x in p[1:] if x not in self.bare}, "", self.bare)
        feed = array("I", self.feed).tobytes()
        for w, parts in lined.items():
            self.table[w] = feed.join([self.table[parts[0]], *[self.bare[x] for x in parts[1:]]])

    def rest(self) -> None:
        """Forget most words, so that a worker does not hold them between tasks."""
        self.table, self.bare = trimmed(self.table), {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        if len(self.table) > TABLE_ENTRIES:
            self.rest()
        if len(self.bare) > TABLE_ENTRIES // 8:
            self.bare.clear()
        table = self.table
        split, new = [], set()
        for text in texts:
            if any(a in text for a in self.added):
                split.append((text, [], [], []))
                continue
            rest = text.split(" ")
            head = rest.pop(0)
            found = list(map(table.get, rest))
            holes = [i for i, ids in enumerate(found) if ids is None]
            if any(not rest[i] or rest[i][0].isspace() for i in holes):  # a space before white space is no cut
                head, *rest = _CUT.split(text)
                found = list(map(table.get, rest))
                holes = [i for i, ids in enumerate(found) if ids is None]
            new.update([rest[i] for i in holes])
            split.append((head, rest, found, holes))
        self.learn(new)
        out = []
        for head, rest, found, holes in split:
            for i in holes:
                found[i] = table[rest[i]]
            ids = array("I", self._plain(head)).tobytes() if head else b""
            out.append(ids + b"".join(found))
        for w in new:
            if len(w) > LONGEST_KEPT:
                table.pop(w, None)
        return out


def coder(path: str) -> Coder:
    if path not in _coders:
        _coders[path] = Coder(path)
    return _coders[path]


def pieces(
    documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece; with ``with_ids`` also its ids."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, end = coder(tokenizer_path), array("I", [end_id]).tobytes()
        for batch in slices(batches, "text"):
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for r, raw in enumerate(code([t or "" for t in batch.column("text").to_pylist()])):
                raw += end
                n, at, k = len(raw) // 4, 0, 0
                while at < n:
                    size = (n % capacity or capacity) if not at else capacity
                    part = raw[4 * at : 4 * (at + size)]
                    row.append(r), piece.append(k), start.append(at), length.append(size), crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
                    at, k = at + size, k + 1
            columns = [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                       pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)
        code.rest()

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return documents.select("doc_id", "text").mapInArrow(run, schema)


class Bins:
    """Bins of one individual: free space of each, and their items."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.items: dict[int, list[int]] = {}
        self.fill: dict[int, int] = {}
        self.open: list[tuple[int, int]] = []  # (free space, bin), ascending
        self.made = 0

    def copy(self) -> Bins:
        other = Bins(self.capacity)
        other.items, other.fill = {k: v.copy() for k, v in self.items.items()}, self.fill.copy()
        other.open, other.made = self.open.copy(), self.made
        return other

    def add(self, items: list[int], total: int) -> None:
        self.items[self.made], self.fill[self.made] = items, total
        if total < self.capacity:
            insort(self.open, (self.capacity - total, self.made))
        self.made += 1

    def drop(self, b: int) -> list[int]:
        space = self.capacity - self.fill.pop(b)
        if space:
            self.open.pop(bisect_left(self.open, (space, b)))
        return self.items.pop(b)

    def best_fit(self, order: list[int], length: list[int]) -> Bins:
        for i in order:
            size = length[i]
            at = bisect_left(self.open, (size, -1))
            if at == len(self.open):
                self.add([i], size)
                continue
            space, b = self.open.pop(at)
            self.items[b].append(i)
            self.fill[b] += size
            if space > size:
                insort(self.open, (space - size, b))
        return self

    def fitness(self) -> tuple[int, float]:
        """Fewer bins first, then fuller ones."""
        return -len(self.fill), sum((f / self.capacity) ** 2 for f in self.fill.values())


def crossed(a: Bins, b: Bins, length: list[int], random: Random) -> Bins:
    """``a`` with about half of the well-filled bins of ``b`` injected whole."""
    child = a.copy()
    held = {i: k for k, v in child.items.items() for i in v}
    full = [k for k, f in b.fill.items() if f >= 0.99 * b.capacity and random.random() < 0.5]
    injected = {i for k in full for i in b.items[k]}
    displaced = []
    for k in sorted({held[i] for i in injected}):
        displaced += [i for i in child.drop(k) if i not in injected]
    for k in full:
        child.add(b.items[k].copy(), b.fill[k])
    return child.best_fit(sorted(displaced, key=lambda i: -length[i]), length)


def mutated(a: Bins, length: list[int], random: Random) -> Bins:
    """``a`` with its emptiest bins and a few others broken up."""
    child = a.copy()
    order = sorted(child.fill, key=child.fill.__getitem__)
    chosen = set(order[: max(2, len(order) // 50)]) | set(random.sample(order, min(len(order), max(2, len(order) // 20))))
    displaced = [i for k in sorted(chosen) for i in child.drop(k)]
    return child.best_fit(sorted(displaced, key=lambda i: -length[i]), length)


def evolve(length: list[int], seeds: list[list[int]], capacity: int, seed: int, generations: int = GENERATIONS) -> list[int]:
    """The bin of each item. ``seeds``: bins of each item in elites to start from."""
    random = Random(seed)
    least = -(-sum(length) // capacity)
    people: list[Bins] = []
    for bins in seeds:
        groups: dict[int, list[int]] = {}
        for i, b in enumerate(bins):
            groups.setdefault(b, []).append(i)
        person = Bins(capacity)
        for _, items in sorted(groups.items()):
            person.add(items, sum(length[i] for i in items))
        people.append(person)
    if not seeds:
        people.append(Bins(capacity).best_fit(sorted(range(len(length)), key=lambda i: -length[i]), length))
    best = max(people, key=Bins.fitness)
    if len(best.fill) > least:
        while len(people) < POPULATION:
            noise = [n * random.uniform(0.8, 1.25) for n in length]
            people.append(Bins(capacity).best_fit(sorted(range(len(length)), key=lambda i: -noise[i]), length))
        for _ in range(generations):
            people.sort(key=Bins.fitness, reverse=True)
            if len(people[0].fill) == least:
                break
            a, b = people[0], random.choice(people[1:])
            children = [crossed(a, b, length, random), crossed(b, a, length, random), mutated(a, length, random)]
            people = sorted([*people, *children], key=Bins.fitness, reverse=True)[:POPULATION]
        best = max(people, key=Bins.fitness)
    out = [0] * len(length)
    for k, (_, items) in enumerate(sorted(best.items.items())):
        for i in items:
            out[i] = k
    return out


ITEM = "doc_id {kind}, piece int, start long, length long, ids_crc32 long, item long"


def _packed(items: DataFrame, kind: str, capacity: int, islands: int) -> DataFrame:
    """Items of each ``block`` with their ``bin``, after two epochs on all islands."""
    fields = ITEM.format(kind=kind) + ", block long"

    def first(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("item", ignore_index=True)
        bins = evolve(rows["length"].tolist(), [], capacity, 1000 * int(key[0]) + int(key[1]))
        return rows.assign(bin=bins)

    def second(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("item", ignore_index=True)
        elites = [rows["bin"].tolist(), rows["guest"].tolist()]
        bins = evolve(rows["length"].tolist(), elites, capacity, 1000 * int(key[0]) + int(key[1]) + 500)
        return rows.drop(columns="guest").assign(bin=bins, bins=len(set(bins)))

    spread = items.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))))
    grown = spread.groupBy("block", "island").applyInPandas(first, f"{fields}, island int, bin long")
    grown = stored(grown, "packing-epoch")
    guests = grown.select("block", "item", F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"), F.col("bin").alias("guest"))
    met = grown.join(guests, ["block", "island", "item"])
    met = met.select(*[c.strip().split()[0] for c in fields.split(",")], "island", "bin", "guest")
    final = met.groupBy("block", "island").applyInPandas(second, f"{fields}, island int, bin long, bins long")
    final = stored(final, "packing-epoch")
    best = final.groupBy("block").agg(F.min(F.struct("bins", "island")).alias("best"))
    best = best.select("block", F.col("best.island").alias("island"))
    return final.join(best, ["block", "island"]).drop("island", "bins")


def pack(found: DataFrame, capacity: int = CAPACITY, block_items: int = BLOCK_ITEMS, islands: int = ISLANDS) -> DataFrame:
    """``pieces`` with ``sequence_id`` (long) and ``offset`` (long, gapless from 0)."""
    kind = found.schema["doc_id"].dataType.simpleString()
    found = stored(found.withColumn("item", F.monotonically_increasing_id()), "packing-pieces")
    full = found.where(F.col("length") == capacity).withColumn("sequence_id", -1 - F.col("item")).withColumn("offset", F.lit(0).cast("long"))
    short = found.where(F.col("length") < capacity)
    blocks = -(-short.count() // block_items) or 1

    def dealt(items: DataFrame, n: int, salt: int) -> DataFrame:
        return items.withColumn("block", F.pmod(F.xxhash64("item", F.lit(salt)), F.lit(n)))

    once = stored(_packed(dealt(short, blocks, 0), kind, capacity, islands), "packing-round")
    fill = once.groupBy("block", "bin").agg(F.sum("length").alias("filled"))
    once = once.join(fill, ["block", "bin"])
    kept = once.where(F.col("filled") >= REOPEN_BELOW * capacity)
    kept = kept.withColumn("sequence_id", F.shiftleft("block", 32) + F.col("bin"))
    again = once.where(F.col("filled") < REOPEN_BELOW * capacity).drop("block", "bin", "filled")
    joined = -(-blocks // BLOCKS_JOINED)
    again = _packed(dealt(again, joined, 1), kind, capacity, islands)
    again = again.withColumn("sequence_id", F.shiftleft(F.col("block") + blocks, 32) + F.col("bin"))
    names = [*found.columns, "sequence_id"]
    sequences = kept.select(*names).unionByName(again.select(*names))
    before = Window.partitionBy("sequence_id").orderBy("item").rowsBetween(Window.unboundedPreceding, -1)
    sequences = sequences.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long"))
    out = full.select(*names, "offset").unionByName(sequences)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
