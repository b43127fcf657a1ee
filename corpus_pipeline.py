"""From raw documents to token files: five stages, each a written table that the next one reads.

Every stage handles null columns, empty and long texts, repeated rows and empty tables as its operator's docstring
says; no stage reads other columns than those it needs, and all but the last return the columns they got.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kinfold.llm import decontaminate, jaccard, mixing, quality, tokenfiles
from kinfold.session import store

TOKENIZER = "word_bpe_49k.json"
#: Sampling by hash of ids, model fitting and file layout have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that the quality rules reject go."""
    return quality.filter_quality(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: of documents linked by five-word shingles at 0.8, the one with the smallest id stays."""
    return jaccard.first_of_groups(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that contain an item of ``benchmark`` go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: token files, read back: doc_id, start, n_tokens, ids_crc32."""
    found = tokenfiles.token_file_digests(docs, public_tokenizers.path(TOKENIZER))
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("quality rules", good_documents),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources", mixed),
    ("token files", token_files),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
