"""N-gram Jaccard join by parity sketches.

The set of a document is its distinct word shingles. Two documents link if the Jaccard similarity of their sets reaches
the threshold, 75 % by default; in whole numbers, if 7 times the symmetric difference is at most the sum of both sizes.

* **Sketches.** A parity sketch is a row of blocks; each shingle is hashed to one block and XORed into it. A shingle in
  only one of two sets changes one block, so the number of blocks that differ (the Hamming distance in blocks) is a lower
  bound of the symmetric difference. A second sketch of one-bit blocks, two for each shingle that the size band allows and
  1,024 at least, serves as a filter before texts are compared. Halves XORed onto each other give the next smaller sketch.
* **Size bands.** Band j holds sizes from 2**j. A document also enters the next band if a partner can be there, so every
  linkable pair meets in one band. The largest symmetric difference d of a linkable pair in a band gives its d + 1 blocks,
  of which by the pigeonhole principle one at least is equal in both documents.
* **Join.** Equal blocks that are not empty are the join keys. A document has ``KEYS`` keys in a band at most: the first
  ``KEYS`` blocks if there are more, the blocks of several independent sketches if there are fewer. The lowest bit of a
  key tells the two bands of a document apart. A linked pair agrees in at least a third of the blocks on average, so the
  chance that it agrees in none of 48 keys that are not empty is about 1e-9 at the very threshold, where both sets have
  the largest size of the band, and vanishes above it; ``keys`` lowers it further, and ``keys=None`` takes all d + 1 blocks
  of every set (``KEYS`` keys at least): some hundred keys for a set of a thousand shingles.
* **Verification.** Sizes, then bit sketches, then whole texts are compared. Members of a bucket are first compared with
  the member that shares most; links give components, and only pairs of different components are compared further: all of
  them in buckets of ``SMALL`` members at most. Larger (hot) buckets come from passages that many texts share, or from
  large groups of near copies. A document keeps the first d + 1 of its keys of a band, d being the blocks in which it can
  differ from any partner and the order of keys the same for all, by the size of their buckets: the first key that two
  linked documents share is among them in both. So it leaves the other hot buckets; large sets leave none. The rest is
  compared bucket by bucket: sketches in tiles, each pair of tiles a task of bounded size that gives out only the pairs
  whose sketches allow a link. Hotness of a key loses no pair that shares it.

Equal sets are one entry throughout (by a 64-bit hash of the set), so copies cost nothing. Components are found by
label propagation over written tables; nothing of the size of the data is collected.

Null and empty texts have no shingle, size 0, and link with nothing, not even each other. Texts with fewer words than a
shingle have the whole sequence as their one shingle. Rows with equal ids are rows of their own; a null id is never the
smallest id. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import slices, stored, text_buffers
from roadpulse.llm.words import Words, mixed

SHINGLE = 5
KEYS = 48
BITS = 1024
#: Buckets of more members are compared by tiles of sketches.
SMALL, TILE = 24, 256
SIEVE_BITS = 22
_MASK = (1 << 64) - 1
_BLOCK = 0x8EBC6AF09C88C6E3
_KEY, _BIT, _SET = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB), np.uint64(0x589965CC75374CC3)


def shingles(texts: pa.Array, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each text, by row."""
    words = Words(*text_buffers(texts), lower=True)
    counts = np.diff(words.first)
    start, first = words.windows(k)
    short = np.flatnonzero((counts > 0) & (counts < k))
    row = np.concatenate([np.repeat(np.arange(len(counts)), np.diff(first)), short])
    h = np.concatenate([words.spans(start, start + k), words.spans(words.first[short], words.first[short + 1])])
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    return row[new], h[new]


def entries(row: np.ndarray, h: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash of each set."""
    total = np.zeros(len(size), np.uint64)
    if len(row):
        begin = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        total[row[begin]] = np.add.reduceat(mixed(h + _SET), begin)
    return mixed(total + size.astype(np.uint64) * _SET).view(np.int64)


def block_keys(row: np.ndarray, h: np.ndarray, size: np.ndarray, keys: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of the blocks in which a document may meet a partner; without ``keys``, of all blocks."""
    rows, found = [], []
    band = np.floor(np.log2(np.maximum(size, 1))).astype(np.int64)
    for shift in (0, 1):
        largest = 2 ** (band + shift + 1) - 1
        allowed = 2 * largest // 7  # symmetric difference of a linkable pair in this band
        blocks = allowed + 1
        most = np.maximum(blocks, KEYS) if keys is None else np.full(len(size), keys)
        begins = np.append(0, np.cumsum(most))
        enters = (size > 0) & (allowed > 0)
        if shift:
            enters &= size * 4 // 3 >= 2 ** (band + 1)
        repeat = 0
        while True:
            use = enters & (blocks * repeat < most)
            if not use.any():
                break
            take = use[row]
            r, hs = row[take], h[take]
            at = repeat * blocks[r] + (mixed(hs + np.uint64((_BLOCK * (2 * repeat + 1)) & _MASK)) % blocks[r].astype(np.uint64)).astype(np.int64)
            take = at < most[r]
            r, hs, at = r[take], hs[take], at[take]
            slot = begins[r] + at
            order = np.argsort(slot, kind="stable")
            slot = slot[order]
            begin = np.flatnonzero(np.append(True, slot[1:] != slot[:-1])) if len(slot) else np.empty(0, np.int64)
            if len(begin):
                parity = np.bitwise_xor.reduceat(mixed(hs[order] + _KEY), begin)
                slot = slot[begin]
                r = np.searchsorted(begins, slot, side="right") - 1
                place = ((band[r] + shift) * 65536 + slot - begins[r]).astype(np.uint64)
                rows.append(r)
                side = ((band[r] + shift) & 1).astype(np.uint64)
                found.append(mixed(parity ^ mixed(place)) & ~np.uint64(1) | side)
            repeat += 1
    empty = np.empty(0, np.int64)
    return (np.concatenate(rows), np.concatenate(found)) if rows else (empty, empty.astype(np.uint64))


def sketch_bits(size: np.ndarray) -> np.ndarray:
    """Bits of the filter sketch: they grow with the size band, so that large sets that differ do not fill them."""
    return np.maximum(BITS, 4 << np.floor(np.log2(np.maximum(size, 1))).astype(np.int64))


def folded(bits: np.ndarray, length: int) -> np.ndarray:
    """A sketch as one of ``length`` words: position modulo a power of two keeps all parities."""
    return np.bitwise_xor.reduce(bits.reshape(-1, length), axis=0)


def halved(bits: Column, other: Column) -> Column:
    """``bits``, or its halves XORed if the sketch ``other`` is shorter. Linkable sets are one band apart at most."""
    half = (F.size(bits) / 2).cast("int")
    short = F.zip_with(F.slice(bits, F.lit(1), half), F.slice(bits, half + 1, half), lambda x, y: x.bitwiseXOR(y))
    return F.when(F.size(bits) > F.size(other), short).otherwise(bits)


def sketched(documents: DataFrame, k: int = SHINGLE, keys: int | None = KEYS) -> DataFrame:
    """doc_id, n (size of the set), entry (hash of the set, null if empty), bits (the one-bit sketch), keys."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def lists(row: np.ndarray, values: np.ndarray, n: int) -> pa.Array:
        order = np.argsort(row, kind="stable")
        at = np.searchsorted(row[order], np.arange(n + 1))
        return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values[order].view(np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            n = batch.num_rows
            row, h = shingles(batch.column("text"), k)
            size = np.bincount(row, minlength=n)
            width = sketch_bits(size)
            begin = np.append(0, np.cumsum(width))
            bit = begin[row] + (mixed(h + _BIT) % width[row].astype(np.uint64)).astype(np.int64)
            parity = np.packbits(np.bincount(bit, minlength=begin[-1]).astype(np.uint8) & 1).view(np.int64)
            bits = pa.ListArray.from_arrays(pa.array(begin // 64, pa.int32()), pa.array(parity))
            columns = [batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(entries(row, h, size), mask=size == 0), bits, lists(*block_keys(row, h, size, keys), n)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "entry", "bits", "keys"])

    schema = f"doc_id {kind}, n long, entry long, bits array<long>, keys array<long>"
    return documents.select("doc_id", "text").mapInArrow(run, schema)


def side(key: Column) -> Column:
    """Whether the band of a key is odd; the two bands of a document differ in it."""
    return key.bitwiseAND(F.lit(1)).cast("int")


def differing(n: Column, odd: Column, keys: int | None) -> Column:
    """In how many keys of its band of this side, at most, a set of size n differs from a set it links with."""
    own = F.length(F.bin(n)) - 1
    band = own + F.when(own % 2 == odd, 0).otherwise(1)
    largest = F.pow(F.lit(2), band + 1).cast("long") - 1
    blocks = F.floor(2 * largest / 7) + 1
    most = F.floor((n + F.least(largest, F.floor(4 * n / 3))) / 7)
    used = F.greatest(blocks, F.lit(KEYS)) if keys is None else F.lit(keys)
    sketches = F.floor(used / blocks)
    return sketches * F.least(most, blocks) + F.least(most, used - sketches * blocks)


def linkable(difference: Column, n: Column, m: Column) -> Column:
    """Whether sets of sizes n and m with this symmetric difference have a similarity of 75 % at least."""
    return 7 * difference <= n + m


class Join:
    """The state of one join: entries, their shared keys, texts, pairs compared and components so far."""

    def __init__(self, documents: DataFrame, k: int, keys: int | None):
        self.documents, self.k, self.keys = documents, k, keys
        self.rows = stored(sketched(documents, k, keys), "jaccard-rows")
        held = self.rows.where("entry is not null")
        self.entries = stored(held.groupBy("entry").agg(F.first("n").alias("n"), F.first("bits").alias("bits"), F.min("doc_id").alias("doc_id"), F.max(F.size("keys")).alias("n_keys"), F.max(F.size(F.filter("keys", lambda x: side(x) == 0))).alias("n_even")), "jaccard-entries")
        keyed = held.select(F.explode("keys").alias("key"), "entry", "n")
        shared = keyed.groupBy("key").agg(F.min("entry").alias("low"), F.max("entry").alias("high")).where("low <> high")
        # written first, so that Spark can split a hot key in the join of plain exchanges
        shared = stored(shared.select("key"), "jaccard-shared")
        #: key, entry and its size, of the keys that several entries have
        self.members = stored(keyed.join(shared, "key").groupBy("key", "entry").agg(F.first("n").alias("size")), "jaccard-members")
        self.tried: DataFrame | None = None
        self.texts: DataFrame | None = None
        #: entry and comp of the entries with links
        self.components: DataFrame | None = None

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) whose sizes and bit sketches allow a link, each once, without those compared before.

        ``pairs`` has the sizes n_a and n_b too, so that most go before sketches are joined to them.
        """
        pairs = pairs.where("4 * least(n_a, n_b) >= 3 * greatest(n_a, n_b)")
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if self.tried is not None:
            pairs = pairs.join(self.tried, ["a", "b"], "left_anti")
        e = self.entries.select("entry", "n", "bits")
        pairs = pairs.join(e.toDF("a", "n_a", "bits_a"), "a")
        pairs = pairs.join(e.toDF("b", "n_b", "bits_b"), "b")
        a, b = F.col("bits_a"), F.col("bits_b")
        differ = F.aggregate(F.zip_with(halved(a, b), halved(b, a), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, c: s + c)
        return pairs.where(linkable(differ, F.col("n_a"), F.col("n_b"))).select("a", "b")

    def with_texts(self, pairs: DataFrame) -> DataFrame:
        """The texts of the entries of ``pairs``: read from documents once, then kept in the shared folder."""
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("entry")).distinct()
        if self.texts is not None:
            wanted = stored(wanted.join(self.texts, "entry", "left_anti"), "jaccard-wanted")
            if wanted.isEmpty():
                return self.texts
        # written, so that Spark knows its size and need not shuffle all texts for a few
        chosen = self.entries.select("entry", F.col("doc_id").alias("__id")).join(wanted, "entry")
        chosen = stored(chosen, "jaccard-chosen")
        found = sifted(self.documents, chosen.select("__id")).join(chosen, F.col("doc_id").eqNullSafe(F.col("__id")))
        # rows that share an id may differ: only the text of the entry counts
        found = self._own(found)
        self.texts = stored(found if self.texts is None else self.texts.unionByName(found), "jaccard-texts")
        return self.texts

    def _own(self, found: DataFrame) -> DataFrame:
        k = self.k

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text"):
                row, h = shingles(batch.column("text"), k)
                entry = entries(row, h, np.bincount(row, minlength=batch.num_rows))
                yield batch.filter(pa.array(entry == batch.column("entry").to_numpy()))

        return found.select("entry", "text").mapInArrow(run, "entry long, text string").dropDuplicates(["entry"])

    def compare(self, pairs: DataFrame) -> None:
        """Compare likely pairs by their whole texts; merge the components of those that link."""
        pairs = stored(pairs, "jaccard-pairs")
        if pairs.isEmpty():
            return
        texts, k = self.with_texts(pairs), self.k

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text_a"):
                n = batch.num_rows
                (ra, ha), (rb, hb) = shingles(batch.column("text_a"), k), shingles(batch.column("text_b"), k)
                row, h = np.concatenate([ra, rb]), np.concatenate([ha, hb])
                order = np.lexsort((h, row))
                row, h = row[order], h[order]
                common = np.bincount(row[1:][(row[1:] == row[:-1]) & (h[1:] == h[:-1])], minlength=n)
                size = np.bincount(row, minlength=n)
                yield batch.filter(pa.array(7 * (size - 2 * common) <= size)).select(["a", "b"])

        both = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
        links = stored(both.mapInArrow(run, "a long, b long"), "jaccard-links")
        self.tried = pairs if self.tried is None else self.tried.unionByName(pairs)
        if not links.isEmpty():
            self.merge(links)

    def merge(self, links: DataFrame) -> None:
        if self.components is None:
            self.components = components(links)
            return
        old = self.components
        roots = self.labelled(self.labelled(links, "a").drop("a").withColumnRenamed("comp", "a"), "b").drop("b").withColumnRenamed("comp", "b")
        joined = components(roots.where("a <> b").select("a", "b"))
        # entries seen for the first time keep their own label until the join
        every = old.unionByName(links.select(F.explode(F.array("a", "b")).alias("entry")).distinct().join(old, "entry", "left_anti").withColumn("comp", F.col("entry")))
        merged = every.join(joined.toDF("comp", "root"), "comp", "left")
        self.components = stored(merged.select("entry", F.coalesce("root", "comp").alias("comp")), "jaccard-components")

    def labelled(self, rows: DataFrame, column: str = "entry") -> DataFrame:
        """``rows`` with ``comp``, the component of the entry in ``column``."""
        if self.components is None:
            return rows.withColumn("comp", F.col(column))
        found = rows.join(self.components.toDF(column, "__comp"), column, "left")
        return found.withColumn("comp", F.coalesce("__comp", column)).drop("__comp")

    def open(self, members: DataFrame) -> DataFrame:
        """Members of the buckets with several components: key, entry, comp, n (members of the bucket)."""
        members = self.labelled(members)
        buckets = members.groupBy("key").agg(F.count("*").alias("n"), F.min("comp").alias("low"), F.max("comp").alias("high"))
        buckets = stored(buckets.where("low <> high").select("key", "n"), "jaccard-buckets")
        return members.join(buckets, "key")

    def centred(self) -> None:
        """Compare each entry with the bucket centre it shares most keys with."""
        self.sizes = stored(self.members.groupBy("key").agg(F.count("*").alias("n")), "jaccard-sizes")
        weight = self.members.join(self.sizes, "key").groupBy("entry").agg(F.sum("n").alias("w"))
        weighed = self.members.join(weight, "entry")
        centre = weighed.groupBy("key").agg(F.max(F.struct("w", "entry", "size")).alias("c"))
        centre = centre.select("key", F.col("c.entry").alias("centre"), F.col("c.size").alias("n_b"))
        centre = stored(centre, "jaccard-centres")
        met = self.members.join(centre, "key").where("entry <> centre AND 4 * least(size, n_b) >= 3 * greatest(size, n_b)")
        met = met.groupBy("entry", "centre").agg(F.count("*").alias("n"), F.first("size").alias("n_a"), F.first("n_b").alias("n_b"))
        likely = self.likely(met.select(F.col("entry").alias("a"), F.col("centre").alias("b"), "n_a", "n_b"))
        best = stored(met.join(likely.selectExpr("a as entry", "b as centre").unionByName(likely.selectExpr("b as entry", "a as centre")), ["entry", "centre"]), "jaccard-stars")
        first = best.groupBy("entry").agg(F.max(F.struct("n", "centre")).alias("c"))  # one of KEYS centres at most
        self.compare(first.select(F.least("entry", "c.centre").alias("a"), F.greatest("entry", "c.centre").alias("b")).distinct())

    def finish(self, small: int) -> None:
        """Compare what is still open."""
        found = stored(self.open(self.members), "jaccard-open")
        few = found.where(F.col("n") <= small)
        a, b = few.select("key", F.col("entry").alias("a"), F.col("comp").alias("x"), F.col("size").alias("n_a")), few.select("key", F.col("entry").alias("b"), F.col("comp").alias("y"), F.col("size").alias("n_b"))
        self.compare(self.likely(a.join(b, "key").where("a < b and x <> y")))
        self.compare(self.likely(self.tiled(self.open(self.hot(small)))))

    def hot(self, small: int) -> DataFrame:
        """key, entry, size of the members that must be compared in the large buckets.

        All keys have one order, by the size of their bucket. The first key that two linked sets share in it stands behind
        keys of either that the other has not, so it is among the first d + 1 of both, d being the keys in which they may
        differ: a member stays in those large buckets only.
        """
        own = Window.partitionBy("entry", "side")
        large = self.sizes.where(F.col("n") > small).withColumnRenamed("n", "members")
        met = self.members.join(large, "key").withColumn("side", side(F.col("key")))
        met = met.withColumn("hot", F.count("*").over(own)).withColumn("place", F.row_number().over(own.orderBy("members", "key")))
        cold = F.when(F.col("side") == 0, F.col("n_even")).otherwise(F.col("n_keys") - F.col("n_even")) - F.col("hot")
        met = met.join(self.entries.select("entry", "n", "n_keys", "n_even"), "entry")
        return stored(met.where(cold + F.col("place") <= differing(F.col("n"), F.col("side"), self.keys) + 1).select("key", "entry", "size"), "jaccard-hot")

    def tiled(self, members: DataFrame) -> DataFrame:
        """Pairs (a, b) of different components that share a bucket and whose sizes and sketches allow a link.

        Buckets are cut into tiles; a task compares the sketches of two tiles and keeps the few pairs that pass.
        """
        held = members.join(self.entries.select("entry", "bits"), "entry")
        tiles = F.ceil(F.col("n") / TILE).cast("int")
        held = held.withColumn("tile", F.pmod(F.xxhash64("entry", "key"), tiles).cast("int"))
        held = held.withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
        held = held.select("key", "entry", "comp", "size", "bits", "tile", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"))

        def meet(rows: pd.DataFrame) -> pd.DataFrame:
            given = rows["bits"].to_numpy()
            words = np.array([len(x) for x in given])
            # members of one bucket are of one band or the one below it
            sketches = {w: np.stack([folded(x, w) if len(x) >= w else np.zeros(w, np.int64) for x in given]).view(np.uint64) for w in set(words.tolist())}
            entry, comp, size = (rows[c].to_numpy() for c in ("entry", "comp", "size"))
            one, two = rows["low"].iat[0], rows["high"].iat[0]
            left, right = np.flatnonzero(rows["tile"] == one), np.flatnonzero(rows["tile"] == two)
            out = []
            for i in left:
                js = right[(comp[right] != comp[i]) & (entry[right] != entry[i])]
                if one == two:
                    js = js[js > i]
                js = js[4 * np.minimum(size[js], size[i]) >= 3 * np.maximum(size[js], size[i])]
                for w in set(np.minimum(words[js], words[i]).tolist()):
                    ks = js[np.minimum(words[js], words[i]) == w]
                    bits = sketches[w]
                    differ = np.bitwise_count(bits[ks] ^ bits[i]).sum(1, dtype=np.int64)
                    ks = ks[7 * differ <= size[ks] + size[i]]
                    out.append(pd.DataFrame({"a": entry[i], "b": entry[ks], "n_a": size[i], "n_b": size[ks]}))
            return pd.concat(out) if out else pd.DataFrame({"a": [], "b": [], "n_a": [], "n_b": []})

        return held.groupBy("key", "low", "high").applyInPandas(meet, "a long, b long, n_a long, n_b long")


def sifted(documents: DataFrame, chosen: DataFrame) -> DataFrame:
    """doc_id and text of the documents whose id may be among ``chosen`` (``__id``).

    A bitmap of 2 ** ``SIEVE_BITS`` places, whatever the data, tells most other documents apart before their texts are
    shuffled. It never loses one; the join that follows is exact.
    """
    place = F.pmod(F.xxhash64(F.col("__id")), F.lit(1 << SIEVE_BITS))
    words = chosen.select(F.shiftright(place, 6).cast("int").alias("w"), place.bitwiseAND(F.lit(63)).cast("int").alias("b"))
    words = words.groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("bits")).collect()
    sieve = np.zeros(1 << (SIEVE_BITS - 6), np.int64)
    for r in words:
        sieve[r["w"]] = r["bits"]
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sieve.view(np.uint64)
        for batch in batches:
            at = batch.column("place").to_numpy()
            keep = (table[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
            yield batch.select(["doc_id", "text"]).filter(pa.array(keep.astype(bool)))

    places = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(1 << SIEVE_BITS)).alias("place")
    return documents.select("doc_id", "text", places).mapInArrow(run, f"doc_id {kind}, text string")


def components(links: DataFrame) -> DataFrame:
    """entry and comp (the smallest entry it is joined to) of all ends of ``links`` (a, b)."""
    edges = stored(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "jaccard-edges")
    labels = stored(edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("entry"), F.least("a", "m").alias("comp")), "jaccard-labels")
    while True:
        near = edges.join(labels.toDF("b", "c"), "b").groupBy("a").agg(F.min("c").alias("c"))
        step = labels.join(near.withColumnRenamed("a", "entry"), "entry").select("entry", F.least("comp", "c").alias("next"), "comp")
        step = stored(step, "jaccard-step")
        # follow labels to their own labels: distances halve
        jump = step.select(F.col("entry").alias("next"), F.col("next").alias("further"))
        step = step.join(jump, "next").select("entry", F.least("next", "further").alias("comp"), (F.least("next", "further") != F.col("comp")).alias("moved"))
        step = stored(step, "jaccard-labels")
        labels = step.select("entry", "comp")
        if step.where("moved").isEmpty():
            return labels


def join(documents: DataFrame, k: int = SHINGLE, keys: int | None = KEYS, small: int = SMALL) -> DataFrame:
    """doc_id, ``n_shingles`` and ``component_id``, the smallest doc_id reachable by links, of every document."""
    state = Join(documents, k, keys)
    state.centred()
    state.finish(small)
    rows = state.rows.select("doc_id", "n", "entry")
    grouped = state.labelled(rows.where("entry is not null"))
    least = stored(grouped.groupBy("comp").agg(F.min("doc_id").alias("component_id")), "jaccard-least")
    linked = grouped.join(least, "comp").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = rows.where("entry is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)
