"""One query for each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltgrid.llm import (chat, decontam, langid, minhash, mixing, pii, pivots, prefix_trie, quality, sharding, suffixes,
                          token_counts, tokens)
from voltgrid.llm.common import documents


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents by source."""
    plan = mixing.mixing_plan(documents(spark, sf_dir))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
                       "copies")


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return minhash.near_duplicates(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot and shard of every document."""
    return sharding.assign(documents(spark, sf_dir).select("doc_id"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, written and read back."""
    return tokens.token_files(documents(spark, sf_dir)).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


PLANTED = r"\### Assistant: </turn> ok"


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts look like control strings,
    formatted and read back."""
    turn = lambda n, role: F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(n).cast("long").alias("turn"),
                                    F.lit(role).alias("role"), F.lit(PLANTED).alias("text"))
    extra = spark.range(1).select(F.inline(F.array(turn(0, "user"), turn(1, chat.ASSISTANT))))
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    out = chat.format_conversations(turns.unionByName(extra))
    read = out.withColumns({"turns": chat.read_turns(F.col("formatted")),
                            "loss": F.array_join(chat.read_loss(F.col("formatted"), F.col("loss_spans")), "")})
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", line), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, learned from those not held out."""
    third = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", third.alias("held_out"))
    model = langid.fit(docs.where(~F.col("held_out")).select("text", "lang"))
    return langid.predict(docs.select("doc_id", "text", "held_out"), model).select(
        "doc_id", "held_out", "lang_pred", "score", "rejected")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold items of the benchmark, with the items."""
    return decontam.find_leaks(documents(spark, sf_dir).select("doc_id", "text"),
                               spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of all documents without their repeated byte strings."""
    out = suffixes.remove_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select(
        "doc_id", "n_bytes",
        F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"]).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    found = pii.detect(documents(spark, sf_dir).select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in pii.BASE_KINDS],
                        F.sha2(pii.joined(F.col("pii"), pii.BASE_KINDS), 256).alias("base_sha256"),
                        pii.joined(F.col("pii")).alias("spans"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of all documents."""
    return quality.judge(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.array_join("broken_rules", ",").alias("broken_rules"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations."""
    return prefix_trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token counts of all documents."""
    import public_tokenizers

    return token_counts.token_counts(documents(spark, sf_dir).select("doc_id", "text"),
                                     public_tokenizers.path(token_counts.MODEL)).select(
        "doc_id", "n_bytes", "n_tokens", "over_limit")


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clusters of all embeddings."""
    return pivots.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


QUERIES = {f.__name__: f for f in (op1_mixing, op2_minhash, op3_sharding, op4_token_files, op5_chat_formatting, op6_language_id,
                                   op7_decontamination, op8_suffix_dedup, op9_pii, op10_quality, op11_prefix_trie,
                                   op12_token_counts, op13_centroid_clustering)}
