"""The operators as queries over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketbars.llm.alignment import align
from marketbars.llm.decontamination import contaminated
from marketbars.llm.language import predict
from marketbars.llm.linechunks import dedup_lines
from marketbars.llm.mixing import mix
from marketbars.llm.oracle import ORACLE
from marketbars.llm.quality import quality
from marketbars.llm.separators import document_token_counts
from marketbars.llm.simhash import near_duplicates
from marketbars.llm.superkmers import dedup
from marketbars.llm.surrogates import pseudonymised
from marketbars.llm.tokenfile import token_files
from marketbars.llm.urlrules import judge
from marketbars.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]

__all__ = ["ORACLE", "QUERIES"]

TOKENIZER = "word_bpe_49k.json"
# The two tokenizers whose tokens are aligned.
BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
# Ends a document in flat files: <|endoftext|> of that vocabulary.
FLAT_END = 49407
# Ends a document in token-id files.
FILE_END = 1
# Whoever knows the key can tell which surrogate an entity has; set your own.
SURROGATE_KEY = os.environ.get("SURROGATE_KEY", "public test key")
# Host, path, verdict.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def tokenizer() -> str:
    return public_tokenizers.path(TOKENIZER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers find this package wherever the driver was started from.
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    if root not in (paths := environment.get("PYTHONPATH", "").split(os.pathsep)):
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = predict(table(spark, sf_dir, "documents"))
    return found.withColumn("n_spans", F.size("spans").cast("bigint")).drop("spans")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_token_counts(table(spark, sf_dir, "documents"), tokenizer(), FLAT_END)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op9_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pseudonymised(table(spark, sf_dir, "documents"), SURROGATE_KEY)
    return found.select("doc_id", "text", "n_entities")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"), tokenizer(), FILE_END)


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = align(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path(BYTE_LEVEL),
        public_tokenizers.path(PIECES),
        written=lambda groups: F.when(groups == "", "").otherwise(F.sha2(groups, 256)),
    )
    return found.withColumnRenamed("groups", "groups_sha256")


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = "host", "path", "verdict"
    rules = [
        F.struct(*(F.lit(v).alias(n) for n, v in zip(names, rule, strict=True)))
        for rule in URL_RULES
    ]
    rules = spark.range(1).select(F.inline(F.array(*rules)))
    return judge(table(spark, sf_dir, "pages"), rules)


QUERIES: dict[str, Query] = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_decontamination": op2_decontamination,
    "op3_language_id": op3_language_id,
    "op4_token_counts": op4_token_counts,
    "op5_mixing": op5_mixing,
    "op6_quality_rules": op6_quality_rules,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_line_dedup": op8_line_dedup,
    "op9_pii_surrogates": op9_pii_surrogates,
    "op10_token_files": op10_token_files,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_token_alignment": op12_token_alignment,
    "op13_url_filters": op13_url_filters,
}
