"""A corpus pipeline: language, exact copies, near copies, mixing, tokens; each stage is written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewise.llm import encoding, jaccard, langid, mixing, recipes
from casewise.llm.common import Tables, added
from casewise.llm.queries import tokenizer


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null texts and texts without a letter go. Languages are learned from the labels of ``docs``; without labels, all others stay."""
    labels, weights = langid.fit(docs)
    (text,) = added(docs, "pipeline_text")
    marked = langid.predicted(docs.withColumn(text, F.col("text")), labels, weights, text)
    return marked.where(F.coalesce(F.col(marked.columns[-1]), F.lit(1.0)) > 0).select(*docs.columns)  # 0 without a letter only


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays."""
    return recipes.without_duplicates(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8 or more, the one with the smallest id stays."""
    return jaccard.one_of_each(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, little-endian unsigned 32-bit numbers, and the text decoded from them in place of the source."""
    return encoding.encoded(docs, tokenizer("word_bpe_49k.json")).drop("text")


STAGES = [
    ("language", language), ("exact copies", exact_copies), ("near copies", near_copies), ("mixing", mixing_sources), ("tokens", tokens),
]
#: The language model, the similarity join and the tokenizer are not SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Tables(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = tables.store(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
