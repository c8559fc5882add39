"""From raw documents to token ids, stage by stage.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next one's
docs.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marblework.llm import bpe, decontam, langid, near_dup, secrets
from marblework.llm.common import cut

#: SQL cannot express the language model, the lexer or the tokenizer.
ORACLE_SQL = None

# What all stages have in common: a row is judged by its text alone or, for near
# copies, against all others; columns besides doc_id and text pass through
# whatever they are called or hold, nulls included; repeated rows meet the same
# fate, an empty table gives an empty one, and texts of any length are read whole.


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in any language or mixture of languages that the corpus has.

    Null texts, texts without a letter, and texts to which the best mixture gives
    less likelihood than chance go.  The model learns from all labelled rows;
    where there are none, every text with a letter stays.
    """
    return langid.keep_languages(docs, langid.train(docs, F.lit(True)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each group of near copies.

    Null, empty and wordless texts have no copies and stay, as do rows with a null
    doc_id.  Rows that share a doc_id are one document and stay or go together.
    """
    return near_dup.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark; null and wordless texts stay, and so does all if the benchmark is empty."""
    return decontam.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked and n_chars renewed; null texts stay null and have a null n_chars."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the ids as little-endian 32-bit integers; null and empty texts have no tokens."""
    return bpe.encode_column(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("secrets", mask_secrets),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
