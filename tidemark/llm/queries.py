"""The corpus queries opN_<name> and the pipeline, with production parameters, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import ann, chat, decontam, hilbert, langid, linededup, minhash, mixing, sql, toxicity, warc
from tidemark.llm.common import fresh_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    segments = chat.format_turns(turns.unionByName(hard), "conv_id", "turn", "role", "text")
    return chat.read_back(segments).withColumnRenamed("conv", "conv_id")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), "page_id", "url", "html", path)
    found = warc.read_records(spark, path)
    return found.select(F.col("key").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 20 == 0, k=20)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    teaching = table(spark, sf_dir, "labels").where(~langid.held_out(F.col("doc_id")))
    texts, labels = toxicity.sample(docs, "doc_id", "text", teaching, "doc_id", "toxic")
    scored = toxicity.score(docs, "doc_id", "text", toxicity.train(texts, labels))
    return scored.select(F.col("id").alias("doc_id"), langid.held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


SHARDS = 40
DIMENSIONS = [hilbert.Dimension("lang"), hilbert.Dimension("source"), hilbert.Dimension("size", "size")]
MIX_WEIGHTS = {"good": 0.90, "low": 0.08, "toxic": 0.02}
MIX_BUDGET = 1.25  # tokens to draw, as a multiple of those at hand


def sharded(docs: DataFrame) -> DataFrame:
    """Documents with size, shard and slot: sorted by language, source and size along the curve, cut into runs of equal counts."""
    return hilbert.order_and_cut(_sized(docs), "doc_id", DIMENSIONS, SHARDS)


def _sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 16)


def op2_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    cut = hilbert.order_and_cut(_sized(docs).drop("text"), "doc_id", DIMENSIONS, SHARDS)  # texts are measured, not moved
    return cut.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def domain_label() -> Column:
    """Domain of a row of labels; null where neither label says."""
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "good")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    mixed = mixing.mix(docs, "doc_id", "text", labels, "doc_id", domain_label(), MIX_WEIGHTS)
    shares = [F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(sorted(MIX_WEIGHTS))]
    return mixed.select("doc_id", "tokens", *shares, "rate")


def language_model(docs: DataFrame) -> langid.LanguageModel:
    """Learn from the rows that are not held out."""
    return langid.train(docs.where(~langid.held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()), "text", "lang", "doc_id")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.leaks(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "benchmark"), "item_id", "text", n=3, similarity=0.8)
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "similarity", "first_word", "n_words")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, language_model(docs), keep=["doc_id"])
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.jaccard_classes(table(spark, sf_dir, "documents"), "doc_id", "text", n=5, threshold=0.8)
    return found.select(F.col("id").alias("doc_id"), "class_id", "n_links")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.remove_repeated_runs(docs, "doc_id", "text", min_words=25)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [op1_chat_format, op2_hilbert_shards, op3_warc, op4_decontaminate, op5_language_id, op6_nearest, op7_toxicity, op8_jaccard_join, op9_line_dedup, op10_mixing, pipeline]
    return {f.__name__: f for f in named}


def oracle_sql() -> dict[str, str]:
    return sql.oracle_sql()
