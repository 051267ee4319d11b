"""A corpus from raw documents to packed sequences: the stages in order, each on what its predecessor kept.

Every stage but the last returns the columns of ``documents``. Null and empty texts fail the quality rules and go there;
a document whose words all repeat earlier ones stays with an empty text. Rows that share an id are kept or rejected
together by the stages that decide by id. A row without an id counts by its content: the quality rules judge it by its
own text, language and source; of near-duplicates a row with an id stays rather than one without, and among rows without
one a single row stays, of equal texts any. Rows without an id and without words link with nothing and all stay there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm import jaccard, packing, quality_rules, substrings, toxicity
from roadpulse.llm.common import prepare, stored, table
from roadpulse.llm.queries import tokenizer


def named(docs: DataFrame, *content: str) -> Column:
    """A key that is never null, smaller with an id than without: the id, or a hash of these columns."""
    none = F.col("doc_id").isNull()
    return F.struct(none.alias("none"), F.col("doc_id").alias("id"), F.when(none, F.sha2(F.to_json(F.struct(*content)), 256)).alias("own"))


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the outlier test keep."""
    prepare(spark)
    if docs.where("doc_id IS NULL").isEmpty():
        kept = quality_rules.judge(docs).where("kept").select("doc_id").distinct()
        return docs.join(kept, "doc_id", "left_semi")
    keyed = docs.withColumn("__id", named(docs, "text", "lang", "source"))
    kept = quality_rules.judge(keyed.withColumn("doc_id", F.col("__id"))).where("kept").select(F.col("doc_id").alias("__id")).distinct()
    return keyed.join(kept, "__id", "left_semi").select(docs.columns)


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifiers do not reject."""
    return toxicity.kept(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def different(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates."""
    prepare(spark)
    if docs.where("doc_id IS NULL").isEmpty():
        kept = jaccard.join(docs).where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
        return docs.join(kept, "doc_id", "left_semi")
    keyed = docs.withColumn("__id", named(docs, "text"))
    found = jaccard.join(keyed.select(F.col("__id").alias("doc_id"), "text")).where(F.col("doc_id") == F.col("component_id"))
    kept = found.groupBy(F.col("doc_id").alias("__id")).agg(F.max("n_shingles").alias("__n"))
    rows = keyed.join(kept, "__id")
    single = F.col("__id.none") & (F.col("__n") > 0)
    return rows.where(~single).unionByName(rows.where(single).dropDuplicates(["__id"])).select(docs.columns)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that stand earlier in the corpus."""
    prepare(spark)
    return substrings.cleaned(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in the packed sequences."""
    prepare(spark)
    return packing.pack(packing.pieces(docs, tokenizer("byte_bpe_50k.json")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", good),
    ("toxicity", civil),
    ("n-gram Jaccard join", different),
    ("substring dedup", unrepeated),
    ("best-fit packing", packed),
]

#: Trained scores, robust estimates and packing have no SQL form; tests/llm compares stages with brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each stage's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
