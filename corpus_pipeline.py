"""From raw documents to a training mix: five stages over whole tables, each written before the next.

Quality rules reject documents, common lines leave the texts, one document of each near-duplicate class stays,
documents with test items go, and the rest is mixed to the sources' target weights. Every stage judges what its
predecessor kept. All but the last return the columns of ``documents`` (``n_chars`` follows the text).

A NULL text is an empty text, which the quality rules reject, so later stages see none; empty tables pass
through. Very long texts go through every stage whole. Repeated rows are near duplicates, of which one stays; of equal ids the
row with the smaller text hash does. Extra columns pass through, but for those that the mix adds under their names. Texts can become shorter in the line stage, and empty; they stay until a later stage decides on them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.llm import dartminhash, decontam, lines, mixing, quality
from martwright.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that policy v1 of the rule ledger keeps."""
    return quality.keep_good(docs, "v1")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in at least 10 documents leave every text."""
    done = lines.deduplicated(docs, min_documents=10, min_chars=1)
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 on five-word shingles, the one with the smallest id."""
    return dartminhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no item of ``benchmark`` is found."""
    return decontam.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix reads, with ``size``, ``target`` of their source and ``taken`` (words read).

    A document's own column of one of these names gives way.
    """
    added = ["size", "source_size", "target", "taken"]
    columns = [c for c in docs.columns if c not in added]
    mix = mixing.Mix(docs, keep=[c for c in columns if c not in ("doc_id", "source")])
    read = mix.documents().filter("taken > 0")
    kept = [F.col(c) if c in ("doc_id", "source") else F.col("kept")[c].alias(c) for c in columns]
    return read.select(*kept, *added)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("source mix", source_mix),
]

# SQL cannot express the near-duplicate classes and the passage search; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"stage{k + 1}")
    return docs
