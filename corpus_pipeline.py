"""From raw documents to training tokens: five stages, each written as a table and read again.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns the documents that the
next stage works on, with the columns of ``documents``. The last returns the tokens.

Defined results of all stages: a null or empty text is a document without words, which no stage drops (line
dedup drops only what loses its last words) but the mix, which never takes it; a null doc_id passes as such; repeated rows are
documents of their own (near duplicates keep all rows of the id that stays); texts of any length are read whole; an
empty table gives an empty table; further columns are kept up to the last stage, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitscope.llm import byte_bpe, line_join, ngram_join, pivotal_mix, toxicity
from hitscope.llm.queries import TOKENIZER
from hitscope.session import scratch_path


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go."""
    return toxicity.clean_documents(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line go, and with them documents that lose all their words."""
    out = line_join.remove(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the document with the smallest id stays."""
    return ngram_join.one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them: not at all, once or twice."""
    return pivotal_mix.repeated(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the ids (little-endian unsigned 32-bit integers), and hashes of them and of the text decoded from them."""
    return byte_bpe.tokenise(docs, TOKENIZER, with_ids=True)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("byte_bpe", token_stage),
]

#: SQL expresses neither the classifier nor the mix; tests/llm/test_pipeline.py holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, "corpus_pipeline", name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
