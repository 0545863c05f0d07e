"""Documents to token ids, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before
it kept; stages are written and read again in between. Null texts are empty ones,
rows alike count as rows of their own until near duplicates go, very long texts
stay whole, and an empty table gives an empty table in every stage. Other columns
than those of documents pass through all stages but the last.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from jobuse.llm import bpe, decontaminate, pii, rules, simhash
from jobuse.llm.common import documents, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the learned decision list let pass."""
    small_row_groups(spark)
    return rules.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document of smallest id."""
    return simhash.representatives(docs, shingle=3, max_bits=2)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data and secrets masked; ``n_chars`` is that of the masked text."""
    return pii.masked(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the bytes they decode to."""
    pieces = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    found = bpe.round_trip(docs.select("doc_id", "text"), pieces, public_tokenizers.PATTERN)
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids_sha256", "decoded_sha256", "ids")


def small_row_groups(spark: SparkSession) -> None:
    """Stages write whole texts: their writers hold 16 MB, not 128, before it goes to the file."""
    spark.conf.set("parquet.block.size", str(16 << 20))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_leaks", benchmark_leaks),
    ("personal_data", personal_data),
    ("token_ids", token_ids),
]

# SQL cannot express the learned rules, the components or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
