"""The registered queries of the operators, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import balltree, chat, lines, mixing, neardup, periodic, phrases, pieces, quality, sharding, toxicity, whitening, wordbpe
from .common import documents


def op1_host_quality(spark: SparkSession, root: str) -> DataFrame:
    return quality.judge(documents(spark, root))


def op2_order_minhash(spark: SparkSession, root: str) -> DataFrame:
    return neardup.classes(documents(spark, root)).withColumn("kept", F.col("doc_id") == F.col("class_id"))


def op3_kneser_ney_toxicity(spark: SparkSession, root: str) -> DataFrame:
    return toxicity.score(documents(spark, root), table(spark, root, "labels"))


def op4_phrase_automata(spark: SparkSession, root: str) -> DataFrame:
    return phrases.removals(documents(spark, root))


def op5_fuzzy_lines(spark: SparkSession, root: str) -> DataFrame:
    return lines.dedup_digests(documents(spark, root))


def op6_piece_encoding(spark: SparkSession, root: str) -> DataFrame:
    return pieces.encode_digests(documents(spark, root), model_path())


def op7_ball_tree(spark: SparkSession, root: str) -> DataFrame:
    return balltree.top_k(table(spark, root, "embeddings"))


def op8_rendezvous_shards(spark: SparkSession, root: str) -> DataFrame:
    return sharding.assign(documents(spark, root))


def op9_poisson_mix(spark: SparkSession, root: str) -> DataFrame:
    mixed = mixing.replicate(documents(spark, root).select("doc_id", "text", "source"))
    return mixed.select("_row.doc_id", "_row.source", F.round("_rate", 6).alias("rate"),
                        F.col("_n").alias("n_copies"), F.col("_copy").alias("copy"), F.col("_order").alias("order_key"))


def op10_chat_grammar(spark: SparkSession, root: str) -> DataFrame:
    return chat.read_back(chat.format_turns(chat.with_hostile(table(spark, root, "conversations"))))


def op11_baier_runs(spark: SparkSession, root: str) -> DataFrame:
    return periodic.digests(periodic.collapse(periodic.with_repeats(documents(spark, root))))


def op12_word_bpe(spark: SparkSession, root: str) -> DataFrame:
    import public_tokenizers

    docs = documents(spark, root).select("doc_id", "text")
    return wordbpe.digests(wordbpe.encode(docs, public_tokenizers.path("word_bpe_49k.json")))


def op13_jacobi_davidson(spark: SparkSession, root: str) -> DataFrame:
    return whitening.whiten(table(spark, root, "embeddings"))


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


QUERIES = {f.__name__: f for f in (
    op1_host_quality, op2_order_minhash, op3_kneser_ney_toxicity, op4_phrase_automata,
    op5_fuzzy_lines, op6_piece_encoding, op7_ball_tree,
    op8_rendezvous_shards, op9_poisson_mix, op10_chat_grammar,
    op11_baier_runs, op12_word_bpe, op13_jacobi_davidson)}
ORACLES = {
    "op7_ball_tree": balltree.ORACLE,
    "op1_host_quality": quality.ORACLE,
    "op8_rendezvous_shards": sharding.ORACLE,
    "op9_poisson_mix": mixing.ORACLE,
    "op10_chat_grammar": chat.ORACLE,
}
