"""The bounded sample of labelled documents on which a classifier is fitted."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .langid import held_out
from .tables import only_ids, ship_code, written

#: Bytes of packed examples that may reach the driver.
PAYLOAD = 96 << 20


def draw(*columns: Column | str) -> Column:
    """The order in which rows are sampled: a hash, the same in every run."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30))


def training_marks(labels: DataFrame, label: str) -> DataFrame:
    """``doc_id, label`` of every id that may train: held-out ids never do, and an id
    labelled both 0 and 1 counts as not labelled."""
    marks = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[label].cast("int").alias("label"))
    marks = marks.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return marks.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("high")).filter("label = high").drop("high")


def one_per_id(rows: DataFrame) -> DataFrame:
    """One row per ``doc_id``: of several, the one whose text has the smallest hash."""
    rest = [c for c in rows.columns if c != "doc_id"]
    least = F.min_by(F.struct(*rest), F.struct(F.xxhash64("text"), "text"))
    return rows.groupBy("doc_id").agg(least.alias("row")).select("doc_id", "row.*")


def labelled_documents(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """All rows of ``docs`` (``doc_id`` and what the classifier reads) that may train, with their ``label``."""
    ship_code(docs.sparkSession)
    marks = written(training_marks(labels, label), "labelled-all")
    return only_ids(docs, marks.select("doc_id"), "doc_id").join(marks, "doc_id")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """One row of ``docs`` for each of ``most`` labelled ids at most, the first by ``draw``."""
    ship_code(docs.sparkSession)
    marks = training_marks(labels, label)
    chosen = written(marks.orderBy(draw("doc_id"), "doc_id").limit(most), "labelled-sample")
    return one_per_id(only_ids(docs, chosen.select("doc_id"), "doc_id")).join(chosen, "doc_id")


def to_driver(examples: DataFrame, packed: list[str], payload: int = PAYLOAD) -> pa.Table:
    """The examples (a bounded sample, packed into binary columns), in the order of ``draw``,
    up to ``payload`` bytes in all; very long texts make for fewer examples."""
    examples = written(examples, "labelled-examples")
    size = sum((F.length(c) for c in packed), F.lit(0)).cast("long")
    order = Window.orderBy(draw("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    upto = examples.select("doc_id", F.sum(size).over(order).alias("upto"))  # one number a sampled id
    kept = written(upto.filter(F.col("upto") <= payload).select("doc_id"), "labelled-kept")
    return examples.join(F.broadcast(kept), "doc_id").orderBy(draw("doc_id"), "doc_id").toArrow()
