"""The corpus pipeline: five operators in a row over ``documents``.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before
it kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadflux.llm import bpe, decontaminate, langid, minhash, quality
from roadflux.llm.common import learns, read
from roadflux.llm.warc import scratch_folder
from roadflux.storage import drop_folder


def packed(docs: DataFrame) -> DataFrame:
    """Whole rows as one column beside what a stage reads, so that no name of a document column can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text", "lang")


def unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.3 or more; the classifier learns from the labelled rows outside fold 0."""
    model = quality.train(docs, read(spark, sf_dir, "labels"), learns("doc_id", 5) != 0)
    return unpacked(quality.with_score(packed(docs), model, ["row"]).where("score >= 0.3"), docs)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the corpus teaches; the letterless and the alien go."""
    return unpacked(langid.identify(packed(docs), F.col("lang").isNotNull(), ["row"]).where("not rejected"), docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.deduplicated(docs, k=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids and digests of every remaining text."""
    return bpe.encoded(docs.select("doc_id", "text"), ids=True)


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("encoding", encoding_stage),
]

#: The classifiers and the language models are trained; SQL has no form of them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet in the shared folder and read again; a stage's rows go when the next one has written its own."""
    folder = scratch_folder(spark, "pipeline")
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            drop_folder(spark, f"{folder}/{before}")
        before = name
    return docs
