"""Corpus pipeline over ``documents``: quality rules, near-duplicates, benchmark
decontamination, personal data, packing.

Each stage takes (spark, docs, sf_dir), works on everything the stage before
kept and returns the columns of ``documents``; the last one returns the batches. Between
stages the rows are written as Parquet in the shared folder and read again.

Documents are told apart by doc_id and text, so rows with a null or repeated
doc_id go through every stage; equal rows are copies, of which near_duplicates keeps one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.llm import chosen_path, decontaminate, packing, pii, quality_rules
from sensorlake.llm.tables import free_prefix, stored
from sensorlake.session import workers_find_package


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the learned decision list."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    p = free_prefix(docs, "_q_")
    judged = quality_rules.judged(docs, quality_rules.fit(docs.select("doc_id", "text"), labels), prefix=p)
    return judged.filter(f"{p}kept").select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8): its smallest doc_id."""
    key = F.xxhash64("doc_id", "text")
    # equal rows first: the rows of one (doc_id, text) are copies of one document
    groups = chosen_path.near_duplicates(docs, with_key=True)
    first = stored(groups.filter("kept").groupBy("root").agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("n")), "keepers")
    k = free_prefix(docs, "_key")
    keyed = docs.withColumn(k, key)
    # the same plan at every size: the keys grow with the documents
    single = keyed.join(first.filter("n = 1").select(F.col("key").alias(k)).hint("shuffle_hash"), k, "left_semi")
    repeated = first.filter("n > 1").select(F.col("key").alias(k))
    if not repeated.isEmpty():
        single = single.unionByName(keyed.join(repeated, k, "left_semi").dropDuplicates([k]))
    return single.select(*[F.col(f"`{c}`") for c in docs.columns])


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    key = F.xxhash64("doc_id", "text")
    hits = decontaminate.contaminated(docs.select(key.alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    # stored, so that the join is planned from the measured size of the hits
    k = free_prefix(docs, "_key")
    found = stored(hits.select(F.col("doc_id").alias(k)).distinct(), "contaminated")
    return docs.withColumn(k, key).join(found, k, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by marks; n_chars follows the text."""
    out = pii.redact(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length bucket, batch and slot of every document that is left."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: the learned rules and spans have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = workers_find_package(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
