"""The corpus pipeline: five stages over ``documents``, each one operator of ``visitlens.llm``.

Every stage takes all rows its predecessor kept and returns the columns of its input, except
the last.  Rows that repeat an id become one row in the second stage.  Rows with a null id
cannot be told apart by id: they are judged by language, never linked or cut, and taken once.
Columns besides doc_id, text, lang, source and n_chars pass through unchanged; a null or
letterless text goes in the first stage; an empty table stays empty through all stages.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm.langid import fit_language_model, held_out, keep_identified
from visitlens.llm.minhash import near_duplicates
from visitlens.llm.mixing import mix_sources
from visitlens.llm.queries import PIECES, TOKENIZERS
from visitlens.llm.sentencepieces import encode_texts
from visitlens.llm.substring import dedup_substrings
from visitlens.llm.tables import only_ids, ship_code, table, written

#: A document goes if its best language has a lower calibrated probability, or if fewer of its
#: n-grams are known from the training documents (which also tells texts of no learned
#: language, however few languages are learned).
MIN_LANGUAGE_SCORE, MIN_FAMILIAR = 0.4, 0.7


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have (names are compared without case)."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; ``lang`` itself is left as it is."""
    ship_code(spark)
    model = fit_language_model(docs.filter(~held_out(docs["doc_id"])))
    return keep_identified(docs, model, MIN_LANGUAGE_SCORE, min_familiar=MIN_FAMILIAR)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near duplicates; one row per id (of
    several texts under one id the one with the smallest hash)."""
    ship_code(spark)
    found = written(near_duplicates(docs), "stage-groups").filter("doc_id IS NOT NULL")
    dropped = written(found.filter("NOT kept").select("doc_id").distinct(), "stage-dropped")
    repeated = found.filter("kept").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    repeated = written(repeated, "stage-repeated")
    kept = only_ids(docs, dropped, "doc_id", "left_anti").select(*docs.columns)
    if repeated.isEmpty():
        return kept
    once = only_ids(kept, repeated, "doc_id", "left_anti")
    rest, row = [c for c in docs.columns if c != "doc_id"], _free(docs, "row")
    least = F.min_by(F.struct(*rest), F.struct(F.xxhash64("text"), "text"))
    one = only_ids(kept, repeated, "doc_id").groupBy("doc_id").agg(least.alias(row)).select("doc_id", f"{row}.*")
    return once.unionByName(one.select(*docs.columns)).select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that earlier documents hold; a document that loses all
    its words goes.  Texts that lose words are written as their words joined by one space."""
    ship_code(spark)
    kept_text, left = _free(docs, "kept_text"), _free(docs, "left_words")
    cut = dedup_substrings(docs, with_text=True).filter("n_removed > 0")
    cut = cut.groupBy("doc_id").agg(F.max("kept_text").alias(kept_text), F.max(F.col("n_words") - F.col("n_removed")).alias(left))
    out = docs.join(written(cut, "stage-cut"), "doc_id", "left").filter(F.col(left).isNull() | (F.col(left) > 0))
    out = out.withColumn("text", F.coalesce(kept_text, "text"))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col(kept_text).isNull(), F.col("n_chars")).otherwise(length))
    return out.select(*docs.columns)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    ship_code(spark)
    copies, copy = _free(docs, "copies"), _free(docs, "copy")
    wanted = mix_sources(docs).filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("copies").alias(copies))
    taken = F.when(F.col("doc_id").isNull(), 1).otherwise(F.coalesce(copies, F.lit(0)))
    out = docs.join(written(wanted, "stage-copies"), "doc_id", "left").withColumn(copies, taken.cast("int")).filter(F.col(copies) > 0)
    return out.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, pieces and round_trip of every row."""
    ship_code(spark)
    return encode_texts(docs, str(Path(TOKENIZERS) / PIECES))


STAGES = [
    ("language_id", language_id),
    ("minhash_near_dedup", minhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_to_targets),
    ("sentencepiece", sentencepiece),
]

#: Learned predictions, Newton iterations and tokenization are not SQL; tests compare the
#: stages with brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
