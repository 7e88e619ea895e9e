"""The queries of this subpackage: one per operator, over the whole of its table, and the SQL of those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressbeat.llm import bpe, chat, hmm, html_blocks, kmeans, merkle, near_dup, pii, quality, shards, templates, token_store, toxicity
from pressbeat.llm.common import materialize, table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_blocks.extract(pages, html_blocks.train(pages))


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.store_and_read(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op3_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(table(spark, sf_dir, "documents"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"))
    # formatted apart, so that a conversation -1 of the table stays one of its own
    both = chat.format_conversations(rows).unionByName(chat.format_conversations(extra.select(*(F.col(c).cast(t) for c, t in rows.dtypes))))
    return chat.digests(materialize(both, "chat"))


def op6_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.scores(table(spark, sf_dir, "documents"))


def op7_naive_bayes_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op8_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.reports(table(spark, sf_dir, "documents"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_multi_50k.tiktoken"), pattern())


def op10_weighted_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.classes(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"))


def op12_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.reports(table(spark, sf_dir, "documents"))


def op13_ns_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmeans.clusters(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_main_text,
        op2_token_store,
        op3_template_leaks,
        op4_adaptive_quality,
        op5_chat_format,
        op6_hidden_markov,
        op7_naive_bayes_toxicity,
        op8_bootstrapped_pii,
        op9_byte_bpe,
        op10_weighted_near_dup,
        op11_merkle_manifest,
        op12_external_shuffle,
        op13_ns_kmeans,
    )
}
#: The others learn, sample or merge in ways SQL cannot state; their tests compare them with brute force.
ORACLES: dict[str, str] = {"op3_template_leaks": templates.SQL, "op4_adaptive_quality": quality.SQL}
