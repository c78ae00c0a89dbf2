"""Registered queries of the thirteen operators: ``opN_<name>(spark, sf_dir)``."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle as _oracle
from .decontamination import find_contamination
from .langid import fit_language_model, held_out, predict_languages
from .lexical import lexical_search
from .minhash import near_duplicates
from .mixing import mix_sources
from .pivots import near_vectors
from .quality import fit_quality, score_quality
from .repetition import repetition_coverage
from .sentencepieces import encode_texts
from .substring import dedup_substrings
from .tables import table
from .toxicity import fit_toxicity, score_toxicity
from .urls import filter_urls
from .whitening import whiten

#: Folder of the public tokenizers' vocabulary files, and the piece model in it.
TOKENIZERS, PIECES = "/opt/tokenizers", "piece_bpe_32k.model"


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(table(spark, sf_dir, "documents"), str(Path(TOKENIZERS) / PIECES))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_coverage(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict_languages(docs, fit_language_model(docs.filter(~held_out(docs["doc_id"]))))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, span: n + span["end"] - span["start"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_mix_sources": op3_mix_sources,
    "op4_quality_rules": op4_quality_rules,
    "op5_language_id": op5_language_id,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_toxicity": op8_toxicity,
    "op9_url_filters": op9_url_filters,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_decontamination": op11_decontamination,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_lexical_search": op13_lexical_search,
}

ORACLE_SQL = dict(_oracle.SQL)
