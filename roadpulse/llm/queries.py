"""The driver queries of the operators; each derives the columns asked for from its operator's result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm import ann, exact_dedup, filter_audit, hard_negatives, html, jaccard, packing, pieces, quality_model, quality_rules, shards, substrings, toxicity
from roadpulse.llm.common import stored, table


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json")))


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = toxicity.fit(documents, table(spark, sf_dir, "labels"))
    return _judged(toxicity.score(documents, model), 0.5)


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digests(table(spark, sf_dir, "documents"))


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.shard(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stored(quality_model.described(table(spark, sf_dir, "documents")), "quality-statistics")
    model = quality_model.fit(found, table(spark, sf_dir, "labels"))
    return _judged(quality_model.score(found, model), 0.3)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")))
    used = rows.where(F.col("label").isNotNull() & finite)
    return hard_negatives.mine(used.select("vec_id", label.alias("label"), whole.alias("embedding")), F.col("vec_id") % 50 == 0)


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _judged(scores: DataFrame, least: float) -> DataFrame:
    held = F.coalesce(toxicity.fold(F.col("doc_id")) == 0, F.lit(False))
    return scores.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ann": op1_ann,
    "op2_jaccard": op2_jaccard,
    "op3_quality_rules": op3_quality_rules,
    "op4_pieces": op4_pieces,
    "op5_packing": op5_packing,
    "op6_html": op6_html,
    "op7_toxicity": op7_toxicity,
    "op8_substrings": op8_substrings,
    "op9_shards": op9_shards,
    "op10_quality": op10_quality,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_filter_audit": op13_filter_audit,
}
_WORD = r"'[^\x20\x09-\x0D]+'"

ORACLES: dict[str, str] = {
    "op2_jaccard": f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_WORD}) AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM sh x JOIN sh y ON x.k = y.k AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * common >= 75 * (p.n + q.n - common)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b)
SELECT doc_id, coalesce(n, 0)::bigint AS n_shingles, m AS component_id
FROM documents JOIN (SELECT a, min(b) AS m FROM r GROUP BY 1) ON a = doc_id LEFT JOIN n USING (doc_id)""",
    "op8_substrings": f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM documents),
s AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d)),
g AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS rn FROM s) WHERE rn > 1),
c AS (SELECT DISTINCT doc_id, i + j AS i FROM g, range(0, 20) AS t(j)),
p AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
k AS (SELECT p.doc_id, count(*) AS n, count(c.i) AS gone, string_agg(word, ' ' ORDER BY p.i) FILTER (WHERE c.i IS NULL) AS kept
  FROM p LEFT JOIN c ON c.doc_id = p.doc_id AND c.i = p.i GROUP BY 1)
SELECT doc_id, coalesce(n, 0)::bigint AS n_words, coalesce(gone, 0)::bigint AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN k USING (doc_id)""",
    "op11_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::double)) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.e, b.e)::bigint AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER w)::int AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) QUALIFY rank <= 3""",
    "op12_exact_dedup": r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, row_number() OVER (PARTITION BY t ORDER BY doc_id) = 1 AS kept,
  sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)""",
    "op13_filter_audit": f"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM documents),
f AS (
  SELECT doc_id, part, len(w) < 50 AS a, 100 * len(list_distinct(w)) < 65 * len(w) AS b,
    100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d, doc_id > min(doc_id) OVER (PARTITION BY t) AS e FROM d),
b AS (
  SELECT part, a::int + 2 * b::int + 4 * c::int + 8 * d::int + 16 * coalesce(e, false)::int AS bits, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic
  FROM f LEFT JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY 1) USING (doc_id)),
n AS (SELECT part, bits, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic FROM b GROUP BY 1, 2),
i AS (SELECT unnest([0, 1, 2, 3, 4]) AS k),
o AS (SELECT [v.k, w.k, x.k, y.k, z.k] AS o FROM i v, i w, i x, i y, i z WHERE len(list_distinct([v.k, w.k, x.k, y.k, z.k])) = 5),
s AS (
  SELECT array_to_string(list_transform(o, lambda k: chr(65 + k)), '') AS filter_order, step, o[step] AS k,
    list_sum(list_transform(o[1:step], lambda k: 1 << k))::int AS upto, (1 << o[step]) AS own FROM o, range(1, 6) AS r(step)),
r AS (
  SELECT part, filter_order, step, k, sum(n) FILTER (WHERE bits & upto = 0) AS kept, sum(n) FILTER (WHERE bits & upto = own) AS removed,
    sum(n) FILTER (WHERE bits & own <> 0 AND bits & (upto - own) <> 0) AS redundant, sum(n) FILTER (WHERE bits = own) AS unique_fails,
    sum(good) FILTER (WHERE bits & upto = own) AS good_lost, sum(toxic) FILTER (WHERE bits & upto = own) AS toxic_lost
  FROM n, s GROUP BY ALL)
SELECT part, filter_order, step::int AS step, {", ".join(f"coalesce({c}, 0)::bigint AS {c}" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"))},
  (sum(coalesce(removed, 0)) OVER (PARTITION BY part, k))::bigint AS shapley FROM r""",
}
