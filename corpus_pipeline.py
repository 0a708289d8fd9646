"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import jaccard_join, line_dedup, mixing, quality_rules, sentencepiece_nbest
from millrace.llm._base import Scratch, documents, maybe_broadcast
from millrace.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that the quality rules reject go. Verdicts are matched by identifier and text hash, so rows
    that share an identifier are judged on their own."""
    scratch = Scratch(spark, "rejects")
    verdict = quality_rules.quality_rules(docs).where(~F.col("kept"))
    rejected = scratch.save(verdict.select(F.col("doc_id").alias("_bad_id"), F.col("text_h").alias("_bad_h")).distinct(), "rejects")
    same = F.col("doc_id").eqNullSafe(F.col("_bad_id")) & (quality_rules.text_hash(F.col("text")) == F.col("_bad_h"))
    return docs.join(maybe_broadcast(rejected), same, "left_anti")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: repeated lines go from the texts; documents that are left without any word go."""
    return line_dedup.drop_duplicate_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: of documents linked by 5-word shingles the smallest identifier stays. Rows are matched by identifier
    and text hash: of rows that share a group's smallest identifier the first by text hash stays, and of equal rows one.
    Rows without an identifier or a word link with nothing and stay."""
    scratch = Scratch(spark, "copies")
    found = jaccard_join.jaccard_components(docs, k=5, percent=80).where("doc_id is not null and n_shingles > 0")
    found = found.groupBy("doc_id", "text_h", "component_id").agg(F.count(F.lit(1)).alias("rows"))
    found = scratch.save(found, "found")
    staying = found.where("doc_id = component_id").groupBy("component_id").agg(F.min("text_h").alias("first_h"))
    judged = found.join(staying, "component_id").where("doc_id != component_id or text_h != first_h or rows > 1")
    stays = (F.col("doc_id") == F.col("component_id")) & (F.col("text_h") == F.col("first_h"))
    judged = scratch.save(judged.select(F.col("doc_id").alias("_id"), F.col("text_h").alias("_h"), stays.alias("_stays")), "judged")
    h = quality_rules.text_hash(F.col("text"))
    same = (F.col("doc_id") == F.col("_id")) & (h == F.col("_h"))
    left = docs.join(maybe_broadcast(judged.select("_id", "_h")), same, "left_anti")
    repeated = judged.where("_stays")
    if repeated.isEmpty():
        return left
    return left.unionByName(docs.join(maybe_broadcast(repeated), same, "left_semi").dropDuplicates(["doc_id", "text"]))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: sources replicated to target weights in a global random order."""
    return mixing.mix(docs, temperature=0.5, budget=1.0).drop("copy", "position")


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: the texts encoded, with the scores of the N best segmentations."""
    return sentencepiece_nbest.encode(docs, tokenizer_path("piece_bpe_32k.model"), n_best=4)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("mixing sources to target weights", mixed),
    ("SentencePiece encoding and decoding", pieces),
]

#: Fuzzy line clusters, components and segmentations have no SQL form; tests compare with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = documents(spark, sf_dir)
    last = None
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"stage{k + 1}")
        if last is not None:
            scratch.drop(last)
        last = docs
    return docs
