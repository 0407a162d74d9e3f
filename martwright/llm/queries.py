"""The registered queries of the operators: one thin ``opN_`` query each, over whole tables."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.llm import bpe, ctw, dartminhash, decontam, hardneg, lines, mixing, quality, repeats, tokens, toxicity, trie, warc
from martwright.llm.text import in_bucket
from martwright.session import materialize, shared_folder

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
WORD_VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_token_counts(spark: SparkSession, folder: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """Tokens of every document, and after masking and removal of repeated lines, re-encoding only what changed."""
    known = tokens.ranks(spark, vocabulary)
    state = tokens.with_trees(table(spark, folder, "documents"), known)
    after = tokens.apply_edits(state, known, find=tokens.redactions)
    # node 1 of a tree is its root
    return after.select(
        "doc_id",
        F.col("tokens_before").alias("n_tokens"),
        "n_edits",
        F.get("tree_tokens", F.lit(1)).alias("n_tokens_after"),
        F.get("tree_chars", F.lit(1)).alias("n_chars_after"),
        "chars_encoded",
    )


def op2_context_tree_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Texts count with A-Z in lower case, as words and as bytes."""
    text = F.translate("text", string.ascii_uppercase, string.ascii_lowercase).alias("text")
    return ctw.scored(table(spark, folder, "documents").select("doc_id", text))


def op3_dartminhash(spark: SparkSession, folder: str) -> DataFrame:
    found = dartminhash.classes(table(spark, folder, "documents"))
    return found.select("doc_id", "class_id", "class_size", "stays")


def op4_quality_ledger(spark: SparkSession, folder: str) -> DataFrame:
    ledger = quality.apply_policy(quality.ledger(table(spark, folder, "documents")), "v1")
    return ledger.select(
        "doc_id",
        *quality.MEASURES[:5],
        (~quality.passes(F.col("failed_bits"), "base")).alias("base_failed"),
        "kept",
        "failed_bits",
    )


def op5_warc_salvage(spark: SparkSession, folder: str) -> DataFrame:
    archives = shared_folder(spark, "warc")
    warc.write(warc.with_records(table(spark, folder, "pages")), archives)
    fields = warc.read(spark, archives).drop("payload")
    return warc.resolved(materialize(fields, "records"))


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    done = lines.drop_lines(docs, lines.keep_bitmaps(docs, min_documents=10, min_chars=1))
    return done.select("doc.doc_id", "n_lines", "n_dropped", F.sha2(F.col("doc.text"), 256).alias("kept_sha256"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scored = toxicity.score(docs, toxicity.train(toxicity.learnable(docs), toxicity.learnable(labels)))
    return scored.select(
        "doc_id",
        in_bucket(F.col("doc_id"), 3, 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op8_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mix = mixing.Mix(table(spark, folder, "documents"))
    return mix.documents().select("doc_id", "size", "source_size", "target", "taken")


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = repeats.without_repeats(table(spark, folder, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Anchors are the rows whose id is divisible by 100; every seventh row carries a neighbouring label."""
    other = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), other.alias("label"), F.col("embedding").alias("vector"))
    ints = hardneg.usable(rows).select("id", "label", hardneg.quantized("vector", 256.0).alias("ints"))
    return hardneg.hard_negatives(ints, F.col("id") % 100 == 0, positives=5, negatives=5, low=80, high=100)


def op12_bpe_round_trip(spark: SparkSession, folder: str, vocabulary: str = WORD_VOCABULARY) -> DataFrame:
    """Every text encoded and decoded again; the ids' digest is taken before they leave for decoding."""
    known = bpe.read_vocabulary(spark, vocabulary)
    codes = bpe.encoded(table(spark, folder, "documents").select("doc_id", "text"), known)
    texts = bpe.decoded(codes.withColumn("ids_sha256", F.sha2("ids", 256)), known)
    return texts.select("doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """The trie of conversations whose first turns are those of the first of each five."""
    turns = trie.numbered_turns(table(spark, folder, "conversations"))
    return trie.prefix_trie(*trie.shared_heads(turns, group=5, longest=8))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_context_tree_scores": op2_context_tree_scores,
    "op3_dartminhash": op3_dartminhash,
    "op4_quality_ledger": op4_quality_ledger,
    "op5_warc_salvage": op5_warc_salvage,
    "op6_line_dedup": op6_line_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_source_mix": op8_source_mix,
    "op9_decontamination": op9_decontamination,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_bpe_round_trip": op12_bpe_round_trip,
    "op13_prefix_trie": op13_prefix_trie,
}
