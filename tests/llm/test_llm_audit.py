"""Hard negatives, exact dedup and the filter audit against plain versions."""

import hashlib
import itertools
import re

import numpy as np
import pytest
from odd_texts import ODD
from pyspark.sql import functions as F

from roadpulse.llm import exact_dedup, filter_audit, hard_negatives
from roadpulse.llm.queries import op11_hard_negatives

WORD = re.compile(r"[^\x20\x09-\x0D]+")
GIVEN = "vec_id long, label int, embedding array<long>"


def _mined(rows, is_anchor, positives=5, negatives=3, band=(50, 95)):
    rows = [r for r in rows if None not in r and None not in r[2]]
    width = max((len(r[2]) for r in rows), default=0)
    x = np.array([list(r[2]) + [0] * (width - len(r[2])) for r in rows], dtype=object).reshape(len(rows), width)
    out = []
    for i, (a, label, _) in enumerate(rows):
        if not is_anchor(a):
            continue
        score = x @ x[i]
        others = sorted((-score[j], r[0], r[1]) for j, r in enumerate(rows) if r[0] != a)
        for p, pid, _ in [o for o in others if o[2] == label][:positives]:
            fits = [(n, nid) for n, nid, other in others if other != label and band[0] * -p <= 100 * -n <= band[1] * -p]
            out += [(a, pid, k + 1, nid, -p, -n) for k, (n, nid) in enumerate(fits[:negatives])]
    return sorted(out)


@pytest.mark.parametrize("case", ["uniform", "clustered", "ties", "large"])
def test_mined_negatives(spark, monkeypatch, case):
    r = np.random.default_rng(len(case))
    n, width = 700, 37
    labels = np.where(r.random(n) < 0.4, 0, r.integers(0, 5, n))
    x = r.normal(0, 40, (n, width))
    if case == "clustered":
        x = r.normal(0, 60, (5, width))[labels] + np.repeat(r.normal(0, 90, (n, 4)), 10, 1)[:, :width] + r.normal(0, 12, (n, width))
    if case == "ties":
        x[: n // 3] = x[0]
    if case == "large":
        x *= 1e5
    x = np.floor(x).astype(int)
    rows = [(int(i), int(k), [int(c) for c in v]) for i, k, v in zip(r.permutation(n), labels, x)]
    monkeypatch.setattr(hard_negatives, "BLOCK", 64)
    monkeypatch.setattr(hard_negatives, "CHUNK", 16)
    got = hard_negatives.mine(spark.createDataFrame(rows, GIVEN).repartition(3), F.col("vec_id") % 10 == 0, anchors=30)
    assert sorted(map(tuple, got.collect())) == _mined(rows, lambda i: i % 10 == 0)


def test_mined_edges(spark):
    rows = [
        (0, 1, [3, 4]), (1, 1, [3, 3]), (2, 1, [3, 3]), (3, 2, [2, 2]), (4, 2, [2, 2]), (5, 2, [1, 2, 9]), (6, 2, []), (7, 3, [-5, -5]),
        (8, None, [3, 4]), (9, 2, None), (10, 2, [None, 1]), (None, 2, [2, 2]), (20, 9, [1, 1]), (30, 1, [-9, 0]), (1, 2, [2, 2]),
    ]
    df = spark.createDataFrame(rows, GIVEN).withColumn("id", F.lit("?")).withColumn("v", F.lit(0)).withColumn("score", F.lit(1))
    got = hard_negatives.mine(df, F.col("vec_id") % 10 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == _mined(rows, lambda i: i % 10 == 0)
    assert hard_negatives.mine(df, F.col("vec_id") == -1).count() == 0
    assert hard_negatives.mine(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    with pytest.raises(Exception, match="inner products beyond"):
        hard_negatives.mine(spark.createDataFrame([(0, 1, [1 << 40]), (1, 1, [1 << 40]), (2, 2, [1])], GIVEN), F.col("vec_id") == 0).collect()


def test_bounds_hold():
    r = np.random.default_rng(3)
    a, b = r.integers(-200, 200, (40, 50)), r.integers(-200, 200, (60, 50))
    exact, width = a @ b.T, None
    for level in hard_negatives.LEVELS:
        (am, ad), (bm, bd) = hard_negatives.Summaries.measured(a).at[level], hard_negatives.Summaries.measured(b).at[level]
        mean, spread = am @ bm.T, ad @ bd.T
        assert (np.abs(exact - mean) <= spread + 1e-6).all()
        assert width is None or (spread <= width + 1e-6).all() or spread.mean() < width.mean()
        width = spread


def test_labels_shift_and_odd_vectors_stay_out(spark, tmp_path):
    inf = float("inf")
    rows = [(0, 3, [0.5, 0.25]), (7, 2, [0.5, 0.5]), (1, 4, [0.45, 0.45]), (2, 3, [0.5, 0.3]), (3, 4, [inf, 0.1]), (4, 4, [float("nan"), 1.0]), (5, None, [0.5, 0.5])]
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = op11_hard_negatives(spark, str(tmp_path)).collect()
    # anchor 0 has label 4 now, its positives are 1; 7 has label 3
    whole = [(i, (k + 1) % 10 if i % 7 == 0 else k, [int(np.floor(256 * np.float64(np.float32(c)))) for c in v]) for i, k, v in rows if k is not None and np.isfinite(v).all()]
    assert sorted(map(tuple, got)) == _mined(whole, lambda i: i % 50 == 0)


def _deduplicated(rows):
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    out = []
    for (i, _), t in zip(rows, texts):
        ids = [j for (j, _), u in zip(rows, texts) if u == t]
        known = [j for j in ids if j is not None]
        out.append((i, min(known, default=None), len(ids), hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("spare", [-6, 8])
def test_exact_copies(documents, prose, monkeypatch, spare):
    monkeypatch.setattr(exact_dedup, "SEND", 100)
    monkeypatch.setattr(exact_dedup, "OWN", 64)
    rows = [(k, t) for k, t in enumerate([*ODD, "two words ", "two\t\n words ", " ", "\r\n", None])]
    rows += [(100 + k, prose(20, k % 150)) for k in range(300)] + [(1000 + k, "one hot\ntext") for k in range(250)]
    rows += [(None, "one hot text"), (None, "no id"), (None, "no  id"), (7, "id again"), (7, "id again"), (7, "id  again"), (1 << 60, "x" * 50_000)]
    got = exact_dedup.deduplicate(documents(rows, extra=True).repartition(5), spare=spare).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=repr) == _deduplicated(rows)
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len({r["text_sha256"] for r in got}) == len({r["text_sha256"] for r in kept})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_exact_edges(documents):
    assert exact_dedup.deduplicate(documents([])).count() == 0
    assert [tuple(r)[:4] for r in exact_dedup.deduplicate(documents([(None, None)])).collect()] == [(None, None, 1, True)]


def test_only_suspects_are_shuffled(documents, prose):
    df = exact_dedup.deduplicate(documents([(k, prose(30, k)) for k in range(50)]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange[^\n]*\n[^\n]*norm", plan) and "Bucketed: true" in plan


def test_golomb_code():
    r = np.random.default_rng(2)
    for gaps in (np.array([0]), np.array([5]), np.zeros(9, np.int64), r.geometric(0.001, 4000) - 1, np.array([1 << 40, 0, 3])):
        if gaps.max() > 1 << 30:
            gaps = np.repeat(gaps, 1) + (1 << 41)
        k, unary, rest = exact_dedup.encode(gaps)
        assert (exact_dedup.decode(len(gaps), k, unary, rest) == gaps).all()
    gaps = r.geometric(1 / 300, 20000) - 1
    _, unary, rest = exact_dedup.encode(gaps)
    assert 8 * (len(unary) + len(rest)) / len(gaps) < np.log2(300) + 2


def _audited(rows, labels):
    rows = [(i, t or "", s or "") for i, t, s in rows]
    label = {}
    for i, q, t in labels:
        if i is None:
            continue
        old = label.get(i, (0, 0))
        label[i] = (max(old[0], q or 0), max(old[1], t or 0))
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t] = min(first.get(t, i), i)
    out, parts = [], {}
    for i, t, s in rows:
        w = WORD.findall(t)
        fails = [len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), bool(re.search(r"[#$%&*|]", t)), i is not None and i > first[t]]
        parts.setdefault(s, []).append(({k for k, f in zip("ABCDE", fails) if f}, *label.get(i, (0, 0))))
    for part, own in parts.items():
        removed_by = dict.fromkeys("ABCDE", 0)
        rest = []
        for order in itertools.permutations("ABCDE"):
            for k, f in enumerate(order):
                here = [o for o in own if f in o[0] and not o[0] & set(order[:k])]
                removed_by[f] += len(here)
                rest.append(
                    (part, "".join(order), k + 1, f, sum(not o[0] & set(order[: k + 1]) for o in own), len(here), sum(f in o[0] and bool(o[0] & set(order[:k])) for o in own),
                     sum(o[0] == {f} for o in own), sum(o[1] == 1 for o in here), sum(o[2] == 1 for o in here))
                )
        out += [(*r[:3], *r[4:], removed_by[r[3]]) for r in rest]
    return sorted(out)


def test_filter_audit(spark, prose):
    texts = [*ODD, prose(60, 1), prose(60, 1), prose(60, 1) + " #", prose(30, 2).upper(), "a b " * 40, "A B c " * 40, "É" * 30 + "AB", prose(70, 3).title(), "x|y", "", None]
    rows = [(k, t, ("web", "book", None, "")[k % 4]) for k, t in enumerate(texts)]
    rows += [(200 + k, "hot text " * 30, "web") for k in range(60)] + [(None, "hot text " * 30, "web"), (None, "x", None), (200, "hot text " * 30, "book"), (5, "again", "web")]
    labels = [(k, k % 2, k % 3 == 0) for k in range(0, 260, 3)] + [(0, None, None), (3, 0, 1), (None, 1, 1), (9999, 1, 1)]
    labels = [(i, q, None if t is None else int(t)) for i, q, t in labels]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("part", F.lit("?")).withColumn("A", F.lit(3)).withColumn("n", F.lit(1)).withColumn("digest", F.lit("d"))
    given = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("q", F.lit(7))
    got = filter_audit.audit(docs.repartition(4), given).collect()
    assert sorted(map(tuple, got)) == _audited(rows, labels)
    assert filter_audit.audit(docs.limit(0), given).count() == 0
    assert filter_audit.audit(docs, given.limit(0)).count() == len(got)
