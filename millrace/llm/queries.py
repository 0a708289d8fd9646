"""The queries over the operators of this subpackage, each over its whole table with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import exact_dedup as _exact
from millrace.llm import jaccard_join as _jaccard
from millrace.llm import line_dedup as _lines
from millrace.llm import mixing as _mixing
from millrace.llm import paragraph_dedup as _passages
from millrace.llm import quality_classifier as _qda
from millrace.llm import quality_rules as _rules
from millrace.llm import sentencepiece_nbest as _pieces
from millrace.llm import sharding as _sharding
from millrace.llm import token_counts as _tokens
from millrace.llm._base import documents


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer file is: in $MILLRACE_TOKENIZERS, or else where the installed package has it."""
    folder = os.environ.get("MILLRACE_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_mix_poisson(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixing.mix(documents(spark, sf_dir), temperature=0.5, budget=1.0)


def op2_sentencepiece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tokenizer_path("piece_bpe_32k.model")
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return _pieces.encode(docs, model, n_best=4, check=True).drop("text")


def op3_shard_hypergeometric(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _sharding.shard(documents(spark, sf_dir), 40)
    text = F.coalesce("text", F.lit(""))
    return rows.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _jaccard.jaccard_components(documents(spark, sf_dir), k=5, percent=80)


def op5_quality_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rules.quality_rules(documents(spark, sf_dir))


def op6_token_counts_resync(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tokens.count_tokens(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"), limit=2048)


def op7_line_dedup_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines.duplicate_lines(documents(spark, sf_dir), threshold=0.8)


def op8_quality_qda(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _qda.quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"), cut=0.3)


def op9_substring_dedup_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _passages.repeated_passages(documents(spark, sf_dir), threshold=0.8, recall=0.99, min_words=20)


def op10_exact_dedup_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exact.exact_dedup(documents(spark, sf_dir), keep="largest")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mix_poisson,
        op2_sentencepiece_nbest,
        op3_shard_hypergeometric,
        op4_ngram_jaccard_join,
        op5_quality_line_rules,
        op6_token_counts_resync,
        op7_line_dedup_minhash,
        op8_quality_qda,
        op9_substring_dedup_paragraphs,
        op10_exact_dedup_sort,
    )
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE_SQL: dict[str, str] = {
    "op1_mix_poisson": f"""
WITH docs AS (SELECT * FROM documents), {_mixing.mix_sql()}
SELECT doc_id, text, lang, source, n_chars, copy::INTEGER AS copy,
       md5('mix:' || coalesce(doc_id::VARCHAR, 'null') || ':copy:' || copy::VARCHAR) AS position
FROM copies""",
    "op10_exact_dedup_sort": f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM d""",
}
