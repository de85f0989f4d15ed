"""Registered queries of this package: each takes (spark, sf_dir) and runs over its whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.session import ensure_checkpoint_dir

from . import alignment, conversations, language, licenses, mixing, ngram_join, pii, quality, secrets, segment, sharding, simhash, vectors
from .common import read_table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(read_table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality.quality_scores(docs, quality.fit_on(docs, read_table(spark, sf_dir, "labels")))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(read_table(spark, sf_dir, "documents"), k=3, percent=90)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"), shards=8)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return language.predict_languages(docs, language.fit_on(docs))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_report(read_table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(read_table(spark, sf_dir, "documents"))


def op8_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(read_table(spark, sf_dir, "embeddings"), threshold=0.93)


#: Shares of all tokens by domain (quality and toxicity of the labels table).
MIX_WEIGHTS = {"good-clean": 0.86, "good-toxic": 0.02, "poor-clean": 0.11, "poor-toxic": 0.01}


def domain_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, domain) of the labels table; null where either label is."""
    good = F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    toxic = F.when(F.col("toxic") == 1, "toxic").when(F.col("toxic") == 0, "clean")
    return read_table(spark, sf_dir, "labels").select("doc_id", F.concat(good, F.lit("-"), toxic).alias("domain"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read_table(spark, sf_dir, "documents"), domain_labels(spark, sf_dir), MIX_WEIGHTS)


def op10_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.sample_segmentations(read_table(spark, sf_dir, "documents"), k=2)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_report(read_table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_conversations(conversations.damage(read_table(spark, sf_dir, "conversations")), alive="alive")


def op13_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every call starts a ledger of its own, so all blobs are new to it."""
    docs = read_table(spark, sf_dir, "documents")
    return secrets.secret_report(docs, secrets.scan(docs, f"{ensure_checkpoint_dir(spark).rstrip('/')}/shoplens-ledger-{uuid.uuid4().hex[:12]}"))


#: For the pipeline, whose first stage has taken poor documents out: less toxic text, the other domains as they stand. A
#: target of 0 is no choice here: with soft membership every document has a share in every domain.
PIPELINE_WEIGHTS = {"good-toxic": 0.03}


def registry() -> dict:
    found = [op1_license_scan, op2_quality, op3_ngram_join, op4_sharding, op5_language, op6_fingerprints, op7_pii, op8_near_vectors, op9_mixing, op10_sampled_pieces,
             op11_token_alignment, op12_conversation_repair, op13_secret_ledger]
    return {f.__name__: f for f in found}
