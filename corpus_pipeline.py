"""Corpus pipeline over ``documents``: quality, near duplicates, personal data, mixture, pieces.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every stage's result as Parquet into the
shared checkpoint folder and reads it back as the next stage's input. All stages but the last return the columns that
they got. Null texts count as empty throughout; an empty table passes as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shoplens.llm import catalog, mixing, ngram_join, pii, quality, segment
from shoplens.llm.common import materialize, read_table


#: Bytes of an Arrow batch between Spark and its Python workers in the pipeline's session. At Spark's own limits (64 MB, 10,000
#: rows) each task holds several copies of tens of MB of whole texts, in the executor and in its worker.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 2 << 20


def small_batches(spark: SparkSession) -> None:
    """Plans that the session runs from here on cut their Arrow batches at ``BATCH_BYTES``; no result depends on it."""
    spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier (learned from the labels table) rejects go."""
    small_batches(spark)
    return quality.keep_good(docs, quality.fit_on(docs, read_table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, Jaccard similarity 0.8 or more."""
    small_batches(spark)
    return ngram_join.deduplicate(docs, k=5, percent=80)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Confirmed personal data is replaced by its kind."""
    return pii.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as their fitted rate asks for: less toxic text, clean documents stay."""
    small_batches(spark)
    return mixing.mixed(docs, catalog.domain_labels(spark, sf_dir), catalog.PIPELINE_WEIGHTS)


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two segmentations of each row, sampled without replacement: the first as columns, the second in ``others``."""
    small_batches(spark)
    return segment.sample_segmentations(docs, k=2, one_row=True, nodes=500_000, batch_bytes=125_000)


STAGES = [
    ("quality_classifier", quality_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("pii", personal_data_stage),
    ("mixing", mixing_stage),
    ("sentencepiece", pieces_stage),
]

#: SQL can express neither the fitted classifiers nor the sampler; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
