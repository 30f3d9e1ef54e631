"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontamination, edit_fingerprints, line_dedup, line_quality, minhash_dedup, mixing, prefix_trie, quality_classifier,
               secrets, sharding, token_files, toxicity, whitening)
from .common import is_held_out, staged_path, table
from .oracle import ORACLE_SQL


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near duplicates per document: 3-word shingles, Jaccard of 85 % and more."""
    found = minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id",
                        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, read back from the token files."""
    import public_tokenizers

    path = staged_path(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), path)
    return token_files.read_tokens(spark, path)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the line blocks that align with an earlier one."""
    found = line_dedup.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.col("__lines").alias("n_lines"),
                        F.size("__deleted").cast("long").alias("n_deleted"),
                        F.concat_ws(",", F.transform("__deleted", lambda k: k.cast("string"))).alias("deleted"), "text")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 16 shards of near-equal bytes, by the edited slot map."""
    return sharding.sharded(table(spark, sf_dir, "documents"), shards=16)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, through a new ledger."""
    docs, path = table(spark, sf_dir, "documents"), staged_path(spark, "ledger")
    secrets.create(spark, path)
    secrets.update(docs, path)

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    def number(rank):
        return F.size(F.filter("spans", lambda s: s["rank"] == rank)).cast("long")

    base = F.filter("spans", lambda s: s["rank"] < len(secrets.BASE))
    counts = [number(k).alias(f"n_{r.kind}") for k, r in enumerate(secrets.BASE)]
    return secrets.by_path(docs, path).select(
        "doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Noisy-or score of every document and its offending sentences."""
    docs = table(spark, sf_dir, "documents")
    found = toxicity.scored(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
                        (F.col("score") >= toxicity.REJECT).cast("int").alias("predicted"),
                        F.concat_ws(",", F.transform("offending", lambda s: F.concat_ws(
                            ":", s["start"], s["end"]))).alias("offending"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that each document contains: 5-word shingles, 80 % and more."""
    found = decontamination.with_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                                         words=5, percent=80, carry=("doc_id",))
    ids = F.array_sort(F.transform("__matches", lambda m: m["item_id"]))
    return found.select("doc_id", (F.size("__matches") > 0).alias("contaminated"),
                        F.size("__matches").cast("long").alias("n_items"),
                        F.concat_ws(",", F.transform(ids, lambda i: i.cast("string"))).alias("items"))


def op8_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the line-first rules for every document."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
             "n_failed_lines", "lost_chars")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_quality.measured(docs).select("doc_id", *(F.col(f"__q.{n}").alias(n) for n in names))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positive-unlabelled quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.scored(docs, model).select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), F.lit(model.prior).alias("prior"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that the mix takes of every document, against its source's target."""
    return mixing.mixed(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "weight", "shard")


def op11_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its edited text, their likeness, and its near copies' id."""
    return edit_fingerprints.near_copies(table(spark, sf_dir, "documents")).drop("text_md5")


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 8 whitened components of every embedding, fitted on all of them."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_line_dedup": op2_line_dedup,
    "op3_sharding": op3_sharding,
    "op4_secrets": op4_secrets,
    "op5_toxicity": op5_toxicity,
    "op6_minhash_dedup": op6_minhash_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_line_quality": op8_line_quality,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_mixing": op10_mixing,
    "op11_edit_fingerprints": op11_edit_fingerprints,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_prefix_trie": op13_prefix_trie,
}

__all__ = ["QUERIES", "ORACLE_SQL"]
