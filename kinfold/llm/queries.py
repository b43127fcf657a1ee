"""Registered queries of the numbered operators, with DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, decontaminate, jaccard, language, lines, merkle, mixing, quality, suffixes, tokenfiles, toxicity, transducer, warc
from .sql import LEAK_SQL, LINES_SQL, MERKLE_SQL, MIX_SQL

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql:
            ORACLES[name] = sql
        return query

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


TOKENIZER = "word_bpe_49k.json"


@register("op1_toxicity")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.judge_toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


@register("op2_decontaminate", LEAK_SQL)
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@register("op4_mix_sources", MIX_SQL)
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@register("op5_line_templates", LINES_SQL)
def op5(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = lines.drop_lines(table(spark, sf, "documents"))
    return cleaned.select(
        "doc.doc_id", "cleaned.n_lines", "cleaned.n_dropped", F.md5(F.col("cleaned.text")).alias("kept_md5")
    )


@register("op6_token_files")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    digests = tokenfiles.token_file_digests(table(spark, sf, "documents"), public_tokenizers.path(TOKENIZER))
    return digests.select("doc_id", "start", "n_tokens", "ids_crc32")


@register("op8_quality_rules")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return quality.judge_quality(table(spark, sf, "documents")).drop("posterior")


@register("op9_warc_revisits")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@register("op10_language_id")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return language.identify_languages(table(spark, sf, "documents"))


@register("op3_jaccard_join")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    found = jaccard.similar_components(table(spark, sf, "documents"), k=4, similar=(17, 20))
    return found.select("doc_id", "n_shingles", "component_id")


@register("op7_suffix_dedup")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf, "documents"), with_bytes=False)


@register("op11_bpe_transducer")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return transducer.round_trips(table(spark, sf, "documents"), public_tokenizers.path(TOKENIZER))


@register("op12_merkle_manifest", MERKLE_SQL)
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.audited(table(spark, sf, "documents")).drop("path")


@register("op13_align_tokenizers")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment.align_tokenizers(table(spark, sf, "documents"), *paths)
