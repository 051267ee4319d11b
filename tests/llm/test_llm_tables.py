"""Quality rules and sharding against plain versions; the pipeline."""

import re
import zlib

import numpy as np
import pytest
from odd_texts import ODD
from pyspark.sql import functions as F

import corpus_pipeline
from roadpulse.llm import quality_rules, shards
from roadpulse.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _base(t):
    w = WORD.findall(t or "")
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    at = {}
    for i in range(len(w) - 7):
        at.setdefault(tuple(w[i : i + 8]), []).append(i)
    covered = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered), failed


def test_rules(documents, prose):
    texts = [*ODD, prose(500, 1) + " " + prose(500, 1), "a b c d e f g h " * 40, "x y z " * 3 + prose(100, 3), prose(8, 4), f"{prose(8, 4)} {prose(8, 4)}"]
    texts += [prose(60 + k, 100 + k) for k in range(60)] + [" ".join(w + "%%%" for w in prose(70, 300 + k).split()) for k in range(5)]
    rows = list(enumerate(texts)) + [(None, "no id"), (3, "id again")]
    got = quality_rules.judge(documents(rows, extra=True)).collect()
    plain = sorted(((i, *_base(t)) for i, t in rows), key=repr)
    assert sorted(((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in got), key=repr) == plain
    kept = {r["doc_id"]: r["kept"] for r in got}
    first = len(ODD) + 5
    assert all(kept[i] for i in range(first, first + 60)) and not any(kept[i] for i in range(first + 60, first + 65))
    assert not any(r["kept"] and r["base_failed"] for r in got)
    assert quality_rules.judge(documents([])).count() == 0


def test_null_language_and_source(spark, prose):
    rows = [(i, prose(50, i), None if i % 2 else "en", None) for i in range(30)]
    got = quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert len(got) == 30 and all(r["kept"] for r in got)


def test_core_estimate_resists_outliers(spark):
    r = np.random.default_rng(1)
    x = r.multivariate_normal([1, 2, 3, 4, 5], np.diag([1, 2, 3, 1, 2]) + 0.5, 4000)
    x[:600] += 40
    rows = spark.createDataFrame([("a", "b", *map(float, v)) for v in x], "lang string, pool string, " + ", ".join(f"x{i} double" for i in range(5)))
    m = quality_rules.estimates(rows).first()
    assert np.abs(np.array([m[f"m{i}"] for i in range(5)]) - [1, 2, 3, 4, 5]).max() < 0.2
    low = np.array([[m[f"l{i}{j}"] if j <= i else 0.0 for j in range(5)] for i in range(5)])
    # the core is three quarters of all rows, so a little wider than that of the clean ones alone
    ratio = np.diag(low @ low.T) / np.diag(np.cov(x[600:].T))
    assert 0.9 < ratio.min() and ratio.max() < 1.5
    assert np.diag(np.cov(x.T)).min() > 100


def test_chi_squared():
    assert quality_rules.chi_quantile(0.95, 5) == pytest.approx(11.0705, abs=1e-4)
    assert quality_rules.chi_squared(2.0, 2) == pytest.approx(1 - np.exp(-1))


def test_shards(documents, prose):
    rows = [(i, prose(5 + 13 * i % 90, i)) for i in range(3000)]
    rows += [(5000 + i, "one text many times over") for i in range(900)] + [(None, None), (None, "x"), (7, None), (2**62, ""), (-5, "y")]
    got = shards.shard(documents(rows, extra=True), 40).collect()
    plain = sorted(((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows), key=repr)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=repr) == plain
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r)
    assert sorted(by) == list(range(40))
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    sizes = [sum(r["size"] for r in own) for own in by.values()]
    assert max(sizes) < 1.05 * sum(sizes) / 40 and min(sizes) > 0.95 * sum(sizes) / 40
    homes = {}
    for r in got:
        if r["text_crc32"] != zlib.crc32(b"one text many times over"):
            homes.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert all(len(h) == 1 for h in homes.values())


def test_shards_edges(documents):
    assert shards.shard(documents([]), 40).count() == 0
    got = shards.shard(documents([(1, "a"), (1, "a"), (2, None)]), 40).collect()
    assert len(got) == 3 and len({(r["shard"], r["slot"]) for r in got}) == 3
    assert all(0 <= r["shard"] < 40 for r in got)


def test_written_shards(documents, prose, tmp_path, spark):
    docs = documents([(i, prose(30, i)) for i in range(200)])
    shards.write(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 200 and back.select("shard").distinct().count() == 4
    assert back.drop("shard").columns == docs.columns


def test_every_operator_has_a_query():
    names = [n.split("_")[0] for n in QUERIES]
    assert names == [f"op{n}" for n in range(1, 14)] and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    import check

    assert check.compare(QUERIES[name](spark, SF), check.connect(SF).sql(ORACLES[name])) == ""


def test_pipeline_keeps_clean_rows_without_id(spark, documents, prose):
    a, b, c, d = (prose(80, 7000 + k) for k in range(4))
    rows = [*((k, prose(60, 7100 + k)) for k in range(30)), (None, a), (None, b), (None, "too short"), (None, None)]
    got = corpus_pipeline.good(spark, documents(rows), SF)
    assert sorted(r["text"] for r in got.where("doc_id IS NULL").collect()) == sorted([a, b]) and got.count() == 32
    rows = [(10, a), (9, a), (None, a), (None, b), (None, b), (None, b + " more"), (None, c), (5, d), (None, None), (None, None)]
    got = [tuple(r) for r in corpus_pipeline.different(spark, documents(rows), SF).select("doc_id", "text").collect()]
    assert sum(t is None for _, t in got) == 2 and {(9, a), (None, c), (5, d)} <= set(got) and len(got) == 6
    assert sum(i is None and t in (b, b + " more") for i, t in got) == 1


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    begin = docs
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SF)
        docs.cache()
        if name == "best-fit packing":
            break
        assert docs.columns == begin.columns
        kept, had = ({r["doc_id"] for r in d.select("doc_id").collect()} for d in (docs, before))
        assert kept <= had
        if name == "substring dedup":
            assert kept == had and docs.where(F.length("text") != F.col("n_chars")).count() == 0
    pieces = docs.select("doc_id").distinct().count()
    assert pieces == len(kept)
    total = docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n").alias("n")).first()["n"]
    assert total <= 2048
    labels = spark.read.parquet(f"{SF}/labels.parquet").join(begin, "doc_id")
    clean = {r["doc_id"] for r in labels.where("quality = 1 and toxic = 0").collect()}
    rules = {r["doc_id"] for r in corpus_pipeline.good(spark, begin, SF).collect()}
    words = {r["doc_id"]: len(WORD.findall(r["text"])) for r in begin.collect()}
    long = {i for i in clean if words[i] >= 20}
    assert len(long & rules) >= 0.97 * len(long)
