"""Near-duplicates, repeated passages and neighbours against brute force."""

import hashlib
import re

import numpy as np
import pytest
from odd_texts import ODD
from pyspark.sql import functions as F

from roadpulse.llm import ann, jaccard, substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def corpus(prose):
    """Copies, near copies at many distances, a passage in many texts, and odd texts."""
    passage = prose(60, 777)
    rows = [(i, prose(12 + 9 * i % 300, i)) for i in range(60)]
    base = prose(200, 500).split()
    for k in range(50):  # near copies, some of them below the threshold to each other
        words = base.copy()
        for j in range(k % 12):
            words[(k * 37 + j * 17) % 200] = f"new{k}x{j}"
        rows.append((100 + k, " ".join(words)))
    rows += [(200 + k, f"{prose(15 + k, 900 + k)} {passage} {prose(20, 950 + k)}") for k in range(40)]
    rows += [(300 + k, rows[k % 3][1].upper() if k % 2 else rows[k % 3][1]) for k in range(12)]
    rows += [(400 + k, t) for k, t in enumerate(ODD)]
    return rows


def _components(rows):
    sets = {}
    for i, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets[i] = {tuple(w[s : s + 5]) for s in range(max(1, len(w) - 4))} if w else set()
    low = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                changed = True
    return {(i, len(sets[i]), low[i]) for i in sets}


@pytest.mark.parametrize(("small", "tile"), [(24, 256), (2, 7)])
def test_jaccard(documents, corpus, small, tile, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", tile)
    got = {tuple(r) for r in jaccard.join(documents(corpus, extra=True), small=small).collect()}
    assert got == _components(corpus)


def test_jaccard_with_all_blocks(documents, corpus):
    got = {tuple(r) for r in jaccard.join(documents(corpus, extra=True), keys=None).collect()}
    assert got == _components(corpus)


def test_all_blocks_are_keys():
    r = np.random.default_rng(5)
    size = np.array([3, 40, 130, 900, 0, 6000])
    row = np.repeat(np.arange(len(size)), size)
    h = r.integers(0, 1 << 63, len(row), dtype=np.uint64)
    some, every = (jaccard.block_keys(row, h, size, keys) for keys in (jaccard.KEYS, None))
    for i, n in enumerate(size):
        a, b = ({*found[1][found[0] == i].tolist()} for found in (some, every))
        blocks = 2 * (2 ** int(n).bit_length() - 1) // 7 + 1 if n else 0
        # empty blocks are no keys: in the higher of two bands up to a sixth of them
        assert a <= b and (a == b or len(b) >= 0.75 * blocks)
    assert len(every[0]) > 10 * len(some[0])


def test_longer_relatives_of_a_hot_group(documents):
    # each longer text links with one member only, that is hardly a bucket centre, and shares little but hot keys with it
    base = [f"c{i}" for i in range(754)]
    group = {k: base + [f"g{k}x{i}" for i in range(k % 18)] for k in range(300)}
    rows = [(k, " ".join(w)) for k, w in group.items()]
    rows += [(1000 + k, " ".join(w + [f"h{k}x{i}" for i in range(249)])) for k, w in group.items() if 3 <= k % 18 <= 5 and k < 125]
    got = {r["doc_id"]: r["component_id"] for r in jaccard.join(documents(rows)).collect()}
    assert got == dict.fromkeys(got, 0)


def test_jaccard_edges(documents):
    rows = [(7, "a b c d e"), (3, "A B C D E"), (3, "A B C D E"), (None, "a b c d e"), (5, None), (6, ""), (8, "a b"), (9, "a b"), (None, None)]
    got = sorted(map(tuple, jaccard.join(documents(rows)).collect()), key=repr)
    expected = [(7, 1, 3), (3, 1, 3), (3, 1, 3), (None, 1, 3), (5, 0, 5), (6, 0, 6), (8, 1, 8), (9, 1, 8), (None, 0, None)]
    assert got == sorted(expected, key=repr)
    assert jaccard.join(documents([])).count() == 0


def test_blocks_bound_the_difference():
    r = np.random.default_rng(3)
    for n in (4, 9, 40, 300, 2000):
        a = r.integers(1, 2**63, n, np.int64).astype(np.uint64)
        drop = n // 8
        b = np.concatenate([a[drop:], r.integers(1, 2**63, drop, np.int64).astype(np.uint64)])
        assert 7 * 2 * drop <= 2 * n
        row = np.repeat([0, 1], n)
        rows, keys = jaccard.block_keys(row, np.concatenate([a, b]), np.array([n, n]), jaccard.KEYS)
        assert set(keys[rows == 0].tolist()) & set(keys[rows == 1].tolist())
        assert np.bincount(rows).max() <= 2 * jaccard.KEYS


def test_filter_sketches_of_large_sets(documents, prose):
    passage = prose(300, 1)
    texts = [f"{passage} {prose(n, 40 + n, 10**6)}" for n in (2600, 2700, 4000)]
    texts.append(" ".join(texts[2].split()[:3300]))  # one band below its partner
    rows = jaccard.sketched(documents(list(enumerate(texts)))).collect()
    bits = {r["doc_id"]: np.array(r["bits"]) for r in rows}
    size = {r["doc_id"]: r["n"] for r in rows}

    def differ(a, b):
        w = min(len(bits[a]), len(bits[b]))
        return int(np.bitwise_count((jaccard.folded(bits[a], w) ^ jaccard.folded(bits[b], w)).view(np.uint64)).sum())

    assert 7 * differ(0, 1) > size[0] + size[1]
    a, b = texts[2].split(), texts[3].split()
    assert differ(2, 3) <= len({tuple(a[i : i + 5]) for i in range(len(a) - 4)} ^ {tuple(b[i : i + 5]) for i in range(len(b) - 4)})


def test_large_sets_of_two_bands(documents, prose):
    long = prose(4300, 7, 10**6).split()
    rows = [(k, " ".join(long[: 3400 + 300 * k])) for k in range(4)] + [(9, prose(4000, 8, 10**6))]
    assert {tuple(r) for r in jaccard.join(documents(rows)).collect()} == _components(rows)
    assert {tuple(r) for r in jaccard.join(documents(rows), small=1).collect()} == _components(rows)


def _unrepeated(rows, length=20):
    first, out = {}, set()
    for i, t in sorted(rows):
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for s in range(len(w) - length + 1):
            key = tuple(w[s : s + length])
            if first.setdefault(key, (i, s)) != (i, s):
                gone[s : s + length] = [True] * length
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.add((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("length", [20, 7])
def test_substrings(documents, corpus, length):
    rows = [*corpus, (600, "x y " * 300), (601, "x y " * 30), (602, " ".join(corpus[0][1].split() * 3))]
    docs = documents(rows, extra=True)
    assert {tuple(r) for r in substrings.digests(docs, length).collect()} == _unrepeated(rows, length)
    if length == 20:
        texts = dict(rows)
        clean = {r["doc_id"]: r["text"] for r in substrings.cleaned(docs).collect()}
        spans = {r["doc_id"]: r for r in substrings.dedup(docs).collect()}
        for i, t in texts.items():
            w = WORD.findall(t or "")
            keep = [x for k, x in enumerate(w) if not any(s["begin"] <= k < s["end"] for s in spans[i]["removed"])]
            assert clean[i] == (" ".join(keep) if spans[i]["n_removed"] else t)
        assert substrings.cleaned(docs).columns == docs.columns


def test_substrings_edges(documents, prose):
    t = prose(40, 5)
    rows = [(None, t), (2, t), (3, None), (3, "short")]
    got = sorted((r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in substrings.digests(documents(rows)).collect())
    assert got == [(0, 40, 0), (2, 40, 40), (3, 0, 0), (3, 1, 0)]
    assert substrings.digests(documents([])).count() == 0


def test_rows_that_share_an_id_lose_only_their_own_words(documents, prose):
    w, v, y = prose(60, 51), prose(60, 52), prose(90, 53)
    rows = [(1, w), (7, w), (7, v), (None, "z z"), (None, y), (9, y), (9, y + " end"), (20, v), (20, v)]
    docs = documents(rows, extra=True).withColumns({"marks": F.lit("?"), "__marks": F.lit("?"), "__id": F.lit("?"), "doc": F.lit("?"), "number": F.lit(0)})
    got = sorted(((r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in substrings.digests(docs).collect()))
    assert got == sorted([(1, 60, 0), (7, 60, 60), (7, 60, 0), (0, 2, 0), (0, 90, 0), (9, 90, 90), (9, 91, 90), (20, 60, 60), (20, 60, 60)])
    clean = substrings.cleaned(docs)
    assert clean.columns == docs.columns
    assert sorted(((r["doc_id"] or 0, r["text"]) for r in clean.collect())) == sorted([(1, w), (7, ""), (7, v), (0, "z z"), (0, y), (9, ""), (9, "end"), (20, ""), (20, "")])
    # of two equal rows of one id that repeat nothing, one keeps its words
    got = sorted(r["n_removed"] for r in substrings.digests(documents([(4, v), (4, v), (None, w), (None, w), (None, w)])).collect())
    assert got == [0, 0, 60, 60, 60]


@pytest.fixture(scope="module")
def vectors():
    r = np.random.default_rng(4)
    centres = r.normal(size=(20, 24))
    x = centres[r.integers(0, 20, 900)] + 0.7 * r.normal(size=(900, 24))
    x[100:140] = x[100]  # one vector many times
    return x.astype(np.float32)


def test_neighbours(spark, vectors):
    rows = [(i, v.tolist(), 1) for i, v in enumerate(vectors)]
    odd = [(2000, None, 1), (2020, [0.0] * 24, 1), (2040, [1.0] * 5, 1), (2060, [float("nan")] + [1.0] * 23, 1), (2080, [None] + [1.0] * 23, 1), (None, [1.0] * 24, 1)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, row int")
    got = {}
    for r in ann.search(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    x = vectors.astype(float)
    assert sorted(got) == list(range(0, 900, 20))
    hits = 0
    for q, found in got.items():
        s = (x * x[q]).sum(1)
        order = [i for i in np.lexsort((np.arange(900), -s)) if i != q][:20]
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21)) and all(f[2] == pytest.approx(s[f[1]], abs=1e-12) for f in found)
        hits += len(set(order) & {f[1] for f in found})
        if q in (100, 120):
            assert [f[1] for f in found] == order
    assert hits / len(got) / 20 >= 0.9


def test_neighbours_of_few(spark):
    schema = "vec_id long, embedding array<double>"
    few = spark.createDataFrame([(20, [1.0, 0.0]), (21, [0.5, 1.0]), (22, [2.0, 0.0])], schema)
    got = ann.search(few, F.col("vec_id") % 20 == 0).collect()
    assert [tuple(r) for r in got] == [(20, 1, 22, 2.0), (20, 2, 21, 0.5)]
    assert ann.search(few.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert ann.search(few.where("vec_id = 20"), F.col("vec_id") % 20 == 0).count() == 0


def test_hot_buckets_keep_only_the_keys_that_must_meet(documents, prose, monkeypatch):
    # a passage in unlinked texts: their keys are hot, and most of a text's keys need not be compared
    passage = prose(24, 5)
    rows = [(k, f"{prose(14, 100 + k)} {passage}") for k in range(60)]
    rows += [(100 + k, f"{rows[k][1]} tail{k}") for k in range(0, 60, 7)]
    seen, tiled = {}, jaccard.Join.tiled

    def record(self, members):
        large = self.members.join(self.sizes.where("n > 4"), "key")
        seen["hot"], seen["kept"] = large.count(), members.count()
        return tiled(self, members)

    monkeypatch.setattr(jaccard.Join, "tiled", record)
    got = {tuple(r) for r in jaccard.join(documents(rows), small=4).collect()}
    assert got == _components(rows)
    assert len({r[2] for r in got}) == 60 and 0 < seen["kept"] < 0.8 * seen["hot"]
