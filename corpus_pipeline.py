"""The corpus pipeline: stages over ``documents``; each stage reads what its predecessor wrote.

A stage takes (spark, docs, sf_dir). All but the last return the columns of ``documents``; the last returns pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyridge.llm import decontamination, jaccard, packing, secrets, toxicity
from tallyridge.llm.tables import read, shared_folder


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fitted model scores below 0.7 stay. It is fitted on the labels outside the held-out third."""
    labels = read(spark, sf_dir, "labels").where(~toxicity.held_out())
    return toxicity.score(docs, toxicity.fit(docs, labels)).where("predicted = 0").select(*docs.columns)


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8: the document with the smallest id of each component stays, and what has no id: it links with nothing."""
    gone = jaccard.join(docs, 5, 80, 100).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark passage stay."""
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"), decontamination.Settings(short_items=True))


def secrets_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, with its secrets masked and its length counted anew where any was."""
    masked = secrets.redacted(secrets.scan(docs.withColumn("__before", F.col("text"))))
    changed = ~F.col("text").eqNullSafe(F.col("__before"))
    return masked.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    return packing.pack(docs, path("word_bpe_49k.json"))


STAGES = [("toxicity", toxic_out), ("near copies", near_copies_out), ("decontamination", benchmark_out), ("secrets", secrets_masked), ("packing", packed)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the whole pipeline over ``documents``; each stage is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    folder = shared_folder(spark, "/tmp/tallyridge-checkpoints")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{k}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
