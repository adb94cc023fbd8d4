"""The corpus pipeline: identify languages, join near copies, remove benchmark leaks, mix to target weights, shard."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, langid, minhash, mixing, queries
from tidemark.llm.common import fresh_path, materialise

log = logging.getLogger(__name__)
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
ROW = "__row"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a language: no letter, or no language likelier than all the others together."""
    found = langid.identify(docs, queries.language_model(docs))
    return found.where((F.col("lang_pred") != langid.UND) & (F.col("score") >= 0.5)).select(*docs.columns)


def numbered(docs: DataFrame) -> DataFrame:
    """Every row with a number of its own, written down, since doc_id may be null or repeat with another text."""
    return materialise(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered")


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each class of linked rows: the one with the smallest id, or any if none has an id. Of rows without a word, those
    that repeat an id and text are kept once."""
    rows = numbered(docs)
    classes = minhash.jaccard_classes(rows, ROW, "text").select(F.col("id").alias(ROW), "class_id")
    # a wordless row is alone in its class; those with an id are known by id and digest instead
    bare = F.coalesce(~F.col("text").rlike(r"[\p{L}\p{M}\p{N}]"), F.lit(True)) & F.col("doc_id").isNotNull()
    facts = rows.select(ROW, "doc_id", F.when(bare, F.coalesce(F.md5(F.col("text").cast("binary")), F.lit(""))).alias("digest"))
    named = facts.join(classes, ROW).withColumn("class_id", F.when(F.col("digest").isNull(), F.col("class_id"))).withColumn("own", F.when(F.col("digest").isNotNull(), F.col("doc_id")))
    first = named.groupBy("class_id", "own", "digest").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", ROW))[ROW].alias(ROW))
    return rows.join(first, ROW, "left_semi").select(*docs.columns)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes rows that hold a passage aligned with a benchmark item, with or without a doc_id."""
    rows = numbered(docs)
    leaks = decontam.leaks(rows, ROW, "text", queries.table(spark, sf_dir, "benchmark"), "item_id", "text")
    return rows.join(leaks.select(F.col("id").alias(ROW)).distinct(), ROW, "left_anti").select(*docs.columns)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or removes documents by their rates; the budget is above the input, so good documents stay once at least."""
    labels = queries.table(spark, sf_dir, "labels")
    domains = sorted(queries.MIX_WEIGHTS)
    model = mixing.fit(docs, "doc_id", "text", labels, "doc_id", queries.domain_label(), domains)
    scored = materialise(mixing.posteriors(docs, "doc_id", "text", model, keep=docs.columns), "posteriors")
    found = mixing.fit_rates(scored, domains, queries.MIX_WEIGHTS, queries.MIX_BUDGET)
    log.info("mixing: %s", mixing.told(found, domains))
    times = mixing.copies(F.col("doc_id"), mixing.rate(found.multipliers))
    return scored.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), times))).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard and slot on the Hilbert curve."""
    return queries.sharded(docs).select(*docs.columns, "shard", "slot")


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", join_near_copies),
    ("decontaminate", remove_benchmark),
    ("mix", mix_domains),
    ("shard", shard),
]

ORACLE_SQL = None  # language models, alignments and gradient steps have no SQL form; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
