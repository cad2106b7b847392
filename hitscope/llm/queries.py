"""Registered queries of the operators: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each reads its whole table and returns its operator's full result in the columns that the
contract of the query names.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from hitscope.llm import block_naming, byte_bpe, line_join, ngram_join, page_text, pivotal_mix, quality_neighbours, repeated_spans, scaled_sketch, spelling_variants, surrogates, target_sampling, toxicity

Query = Callable[[SparkSession, str], DataFrame]
TOKENIZER = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: The query's key; a user keeps their own secret.
SURROGATE_KEY = "registered query"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract(_table(spark, sf_dir, "pages"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.tokenise(_table(spark, sf_dir, "documents"), TOKENIZER)


def op3_line_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_join.deduplicate(_table(spark, sf_dir, "documents"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(_table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replace(_table(spark, sf_dir, "documents"), SURROGATE_KEY)


def op7_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivotal_mix.summary(_table(spark, sf_dir, "documents"))


def op8_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_naming.deduplicate(_table(spark, sf_dir, "documents"))


def op9_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scaled_sketch.fingerprints(_table(spark, sf_dir, "documents"))


def op10_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans.digest(_table(spark, sf_dir, "documents"))


def op11_target_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return target_sampling.draw(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.group(_table(spark, sf_dir, "documents"))


def op13_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_neighbours.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES: dict[str, Query] = {
    "op1_page_text": op1_page_text,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_line_join": op3_line_join,
    "op4_ngram_join": op4_ngram_join,
    "op5_toxicity": op5_toxicity,
    "op6_surrogates": op6_surrogates,
    "op7_pivotal_mix": op7_pivotal_mix,
    "op8_block_naming": op8_block_naming,
    "op9_scaled_sketch": op9_scaled_sketch,
    "op10_repeated_spans": op10_repeated_spans,
    "op11_target_sampling": op11_target_sampling,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_quality_neighbours": op13_quality_neighbours,
}

#: DuckDB text of the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op4_ngram_join": ngram_join.ORACLE,
    "op8_block_naming": block_naming.ORACLE,
    "op10_repeated_spans": repeated_spans.ORACLE,
    "op11_target_sampling": target_sampling.ORACLE,
    "op12_spelling_variants": spelling_variants.ORACLE,
}
