"""Ranked lexical search over a length-stratified index.

Score of a document for an item: the sum over the item's terms of
``w * ((1000000000 * tf) div (1000 * tf + 8 * m))``, where m depends on the document's length
only.  So documents with equal m form a stratum in which a term's impact depends on tf alone.

Method:

1. one pass over the texts keeps, per document, its number of terms and the occurrences of
   the items' terms; N, L and the document frequencies follow from these rows;
2. documents are grouped by m into index blocks.  A block holds, for every term, runs of
   documents with equal tf, the highest tf first, so an impact is computed once per term
   and tf and not per document.  A stratum with many postings is dealt to several blocks;
3. the first run of every term gives the most a block can score for an item.  The block with
   the highest bound is read first for every item; its 10th score is a threshold for all
   others.  Every task takes ``OPEN_BLOCKS`` blocks or ``OPEN_POSTINGS`` postings at a time,
   visits them in order of their bounds and leaves out those whose bound is below the best 10
   found so far; what it returns is ranked once more.

Scale: the index is keyed by (m, block), so no stratum, term or item gathers its postings in
one task; a block has about ``BLOCK_DOCUMENTS`` documents and ``BLOCK_POSTINGS`` postings at most.  Bounds are tight enough to drop a
block, never a document with a score that counts: results are exact.  Items are taken in
blocks of about ``QUERY_TERMS`` terms (their dictionary is what every task holds), each
searched against all documents; a task returns 10 rows per item at most.

Defined results: terms are maximal runs of digits, letters A-Z and a-z (A-Z lower-cased) and
code points from U+0080 on; a null text has none, and documents without terms count neither
in N nor anywhere.  Every row is a document of its own: rows that repeat an id take ranks of
their own, and rows with a null id rank after others with the same score.  Rows that
repeat an item id (null too) are one item with the terms of all of them; an item without terms, or
whose terms no document has, has no rows.  Equal scores rank by ascending doc_id.  Other
columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat
from math import ceil, floor, log
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import BROADCAST_BYTES, ship_code, written
from .terms import raw_texts, term_list

TOP = 10
BLOCK_POSTINGS, BLOCK_DOCUMENTS, QUERY_TERMS = 1 << 17, 1 << 8, 1 << 18
#: What a task holds unpacked at a time (one block at least).
OPEN_BLOCKS, OPEN_POSTINGS = 32, 1 << 20
#: Sums below this are exact in doubles.
_EXACT = 1 << 53


class Items(NamedTuple):
    """The items of one block: item i has the terms ``terms[first[i]:first[i + 1]]``."""

    ids: list[int | None]
    first: np.ndarray
    terms: np.ndarray


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        terms = [sorted({w.decode() for w in term_list(raw)}) for raw in raw_texts(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(terms, pa.list_(pa.string()))], ["item_id", "terms"])


def _forward(numbers):
    """doc_id, number of terms, packed (term, tf) of the known terms, and a salt."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, row = numbers.value.get, 0
        for batch in batches:
            n, entries = [], []
            for raw in raw_texts(batch.column(1)):
                words = term_list(raw)
                n.append(len(words))
                codes = np.fromiter(map(get, words, repeat(-1)), np.int32, len(words))
                term, tf = np.unique(codes[codes >= 0], return_counts=True)
                entries.append(term.tobytes() + tf.astype(np.int32).tobytes())
            salt = np.arange(row, row + len(n))
            row += len(n)
            arrays = [batch.column(0), pa.array(n, pa.int64()), pa.array(entries, pa.binary()), pa.array(salt)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n", "entries", "salt"])

    return run


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and tf of all packed entries."""
    packed = column.to_pylist()
    halves = np.array([len(p) // 8 for p in packed], np.int64)
    term = np.frombuffer(b"".join(p[: len(p) // 2] for p in packed), np.int32)
    tf = np.frombuffer(b"".join(p[len(p) // 2 :] for p in packed), np.int32)
    return np.repeat(np.arange(len(packed)), halves), term, tf


def _holders(n_terms: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(_unpacked(batch.column(0))[1], minlength=n_terms)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["term", "df"])

    return run


_BLOCK = "m long, block int, run_term binary, run_tf binary, run_end binary, documents binary, ids array<long>"


def _block(group: pa.Table) -> pa.Table:
    """One index block: runs of (term, falling tf) and the documents of every run."""
    row, term, tf = _unpacked(group.column("entries"))
    order = np.lexsort((row, -tf, term))
    row, term, tf = row[order], term[order], tf[order]
    last = np.ones(len(row), bool)
    last[:-1] = (term[1:] != term[:-1]) | (tf[1:] != tf[:-1])
    end = np.flatnonzero(last)
    packed = [term[end], tf[end], (end + 1).astype(np.int32), row.astype(np.int32)]
    arrays = [group.column("m").slice(0, 1), group.column("block").slice(0, 1)]
    arrays += [pa.array([a.tobytes()], pa.binary()) for a in packed]
    arrays.append(pa.array([group.column("doc_id").to_pylist()], pa.list_(pa.int64())))
    return pa.table(arrays, ["m", "block", "run_term", "run_tf", "run_end", "documents", "ids"])


class _Runs:
    """Runs of one block with their values, one impact per tf."""

    def __init__(self, m: int, term: bytes, tf: bytes, weights: np.ndarray):
        self.term = np.frombuffer(term, np.int32)
        tfs, place = np.unique(np.frombuffer(tf, np.int32), return_inverse=True)
        tfs = tfs.astype(np.int64)
        impact = (1_000_000_000 * tfs) // (1000 * tfs + 8 * m)
        self.value = weights[self.term] * impact[place]
        self.first = np.ones(len(self.term), bool)
        self.first[1:] = self.term[1:] != self.term[:-1]

    def bounds(self, items: Items, n_terms: int) -> np.ndarray:
        """The most a document of the block can score, for every item."""
        most = np.zeros(n_terms, np.int64)
        most[self.term[self.first]] = self.value[self.first]
        return np.add.reduceat(most[items.terms], items.first[:-1])


class _Postings:
    """A block's postings, ready to be summed for any item."""

    def __init__(self, runs: _Runs, end: bytes, documents: bytes, n_docs: int, n_terms: int):
        ends = np.frombuffer(end, np.int32).astype(np.int64)
        self.documents, self.n = np.frombuffer(documents, np.int32), n_docs
        self.value = np.repeat(runs.value, np.diff(ends, prepend=0))
        self.start, self.end = np.zeros(n_terms, np.int32), np.zeros(n_terms, np.int32)
        heads = np.flatnonzero(runs.first)
        self.start[runs.term[heads]] = np.append(0, ends)[heads]
        self.end[runs.term[heads]] = ends[np.append(heads[1:], len(ends)) - 1]

    def scores(self, terms: np.ndarray, bound: int) -> np.ndarray:
        lists = [slice(a, b) for a, b in zip(self.start[terms].tolist(), self.end[terms].tolist()) if a < b]
        who = np.concatenate([self.documents[s] for s in lists])
        what = np.concatenate([self.value[s] for s in lists])
        if bound < _EXACT:
            return np.bincount(who, what, self.n).astype(np.int64)
        total = np.zeros(self.n, np.int64)
        np.add.at(total, who, what)
        return total


class _Best:
    """The best rows of one item so far: score falling, then ids ascending, null ids last."""

    def __init__(self, top: int, least: int):
        self.top, self.least = top, max(1, least)
        self.score, self.id, self.no_id = (np.zeros(0, t) for t in (np.int64, np.int64, bool))

    def add(self, score: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        good = np.flatnonzero(score >= self.least)
        if len(good) > self.top:  # ties with the last of the best stay
            cut = -np.partition(-score[good], self.top - 1)[self.top - 1]
            good = good[score[good] >= cut]
        if not len(good):
            return
        score, ids, no_id = (np.append(old, new[good]) for old, new in ((self.score, score), (self.id, ids), (self.no_id, no_id)))
        order = np.lexsort((ids, no_id, -score))[: self.top]
        self.score, self.id, self.no_id = score[order], ids[order], no_id[order]
        if len(order) == self.top:
            self.least = max(self.least, int(self.score[-1]))


def _few_blocks(batch: pa.RecordBatch, documents: int) -> Iterator[pa.RecordBatch]:
    """The blocks of ``batch``, some at a time; ``documents`` is the column with their postings."""
    postings = np.cumsum(pc.binary_length(batch.column(documents)).to_numpy(zero_copy_only=False).astype(np.int64) // 4)
    lo = 0
    while lo < len(postings):
        before = postings[lo - 1] if lo else 0
        hi = min(lo + OPEN_BLOCKS, max(lo + 1, int(np.searchsorted(postings, before + OPEN_POSTINGS, "right"))))
        yield batch.slice(lo, hi - lo)
        lo = hi


def _search(shared, n_terms: int, top: int):
    """Best documents of every item in the blocks of a task; visits follow the bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights, least = shared.value
        best = [_Best(top, at) for at in least]
        for batch in (few for whole in batches for few in _few_blocks(whole, 4)):
            columns = [batch.column(i).to_pylist() for i in range(5)]
            runs = [_Runs(m, term, tf, weights) for m, term, tf in zip(*columns[:3])]
            bounds = np.stack([r.bounds(items, n_terms) for r in runs])
            opened: dict[int, tuple] = {}
            for i, found in enumerate(best):
                for b in np.argsort(-bounds[:, i], kind="stable").tolist():
                    bound = int(bounds[b, i])
                    if bound < found.least:
                        break
                    if b not in opened:
                        ids = batch.column(5)[b].values
                        no_id = ids.is_null().to_numpy(zero_copy_only=False)
                        postings = _Postings(runs[b], columns[3][b], columns[4][b], len(ids), n_terms)
                        opened[b] = postings, ids.fill_null(0).to_numpy(), no_id
                    postings, ids, no_id = opened[b]
                    terms = items.terms[items.first[i] : items.first[i + 1]]
                    found.add(postings.scores(terms, bound), ids, no_id)
        n = [len(f.score) for f in best]
        ids = [i for f in best for i in pa.array(f.id, mask=f.no_id).to_pylist()]
        arrays = [pa.array(np.repeat(np.arange(len(best)), n).astype(np.int32)), pa.array(ids, pa.int64())]
        arrays.append(pa.array(np.concatenate([f.score for f in best])))
        yield pa.RecordBatch.from_arrays(arrays, ["item", "doc_id", "score"])

    return run


def _best_blocks(shared, n_terms: int):
    """Per task and item the block with the highest bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights, _ = shared.value
        high, m_of, block_of = (np.zeros(len(items.ids), np.int64) for _ in range(3))
        for batch in batches:
            for m, block, term, tf in zip(*(batch.column(i).to_pylist() for i in range(4))):
                bounds = _Runs(m, term, tf, weights).bounds(items, n_terms)
                better = bounds > high
                high[better], m_of[better], block_of[better] = bounds[better], m, block
        some = np.flatnonzero(high)
        arrays = [pa.array(some.astype(np.int32)), *(pa.array(a[some]) for a in (high, m_of))]
        yield pa.RecordBatch.from_arrays([*arrays, pa.array(block_of[some].astype(np.int32))], ["item", "bound", "m", "block"])

    return run


class LexicalIndex(NamedTuple):
    """Blocks of the documents' postings for a set of terms, and the terms' weights."""

    blocks: DataFrame
    numbers: dict[bytes, int]
    weights: np.ndarray


def build_index(docs: DataFrame, terms: list[bytes], id_col: str = "doc_id", text_col: str = "text") -> LexicalIndex:
    """The index of all documents, restricted to ``terms`` (distinct)."""
    spark = docs.sparkSession
    ship_code(spark)
    numbers = {w: i for i, w in enumerate(terms)}
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    forward = rows.mapInArrow(_forward(spark.sparkContext.broadcast(numbers)), "doc_id long, n long, entries binary, salt long")
    forward = written(forward.filter("n > 0"), "lexical-forward")
    size = forward.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
    held = forward.select("entries").mapInArrow(_holders(len(terms)), "term int, df long")
    weights = np.zeros(len(terms), np.int64)
    for row in held.groupBy("term").agg(F.sum("df").alias("df")).collect():  # one row a term
        weights[row["term"]] = floor(1000 * log((2 * size["docs"] + 2) / (2 * row["df"] + 1)))

    m = F.expr(f"10L + (90L * n * {size['docs']}L) div {max(1, size['words'])}L")
    forward = forward.filter(F.length("entries") > 0).select("doc_id", "entries", "salt", m.alias("m"))
    strata = forward.groupBy("m").agg(F.sum(F.length("entries")).alias("bytes"), F.count("*").alias("docs"))
    blocks = F.ceil(F.greatest(F.col("bytes") / (8 * BLOCK_POSTINGS), F.col("docs") / BLOCK_DOCUMENTS)).cast("int")
    strata = written(strata.select("m", blocks.alias("blocks")), "lexical-strata")
    if strata.count() * 64 <= BROADCAST_BYTES:
        strata = F.broadcast(strata)
    dealt = forward.join(strata, "m").withColumn("block", F.pmod(F.xxhash64("doc_id", "salt"), F.col("blocks")).cast("int"))
    blocks = dealt.select("m", "block", "doc_id", "entries").groupBy("m", "block").applyInArrow(_block, _BLOCK)
    return LexicalIndex(written(blocks, "lexical-index"), numbers, weights)


def search_index(index: LexicalIndex, items: Items, top: int = TOP) -> DataFrame:
    """item (its number), doc_id, score and rank of the best documents of every item."""
    spark, n_terms = index.blocks.sparkSession, len(index.numbers)
    columns = ["m", "run_term", "run_tf", "run_end", "documents", "ids"]
    found = "item int, doc_id long, score long"
    by_rank = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))

    least = np.zeros(len(items.ids), np.int64)
    shared = spark.sparkContext.broadcast((items, index.weights, least))
    heads = index.blocks.select("m", "block", "run_term", "run_tf").mapInArrow(
        _best_blocks(shared, n_terms), "item int, bound long, m long, block int"
    )
    seeds = heads.groupBy("item").agg(F.max_by(F.struct("m", "block"), "bound").alias("b")).select("b.*").distinct()
    seeds = F.broadcast(written(seeds, "lexical-seeds"))  # one row an item at most
    first = index.blocks.join(seeds, ["m", "block"], "left_semi").select(*columns).mapInArrow(_search(shared, n_terms, top), found)
    first = first.withColumn("rank", F.row_number().over(by_rank)).filter(F.col("rank") == top)
    for row in first.collect():  # one row an item at most
        least[row["item"]] = row["score"]

    shared = spark.sparkContext.broadcast((items, index.weights, least))
    every = index.blocks.select(*columns).mapInArrow(_search(shared, n_terms, top), found)
    return every.withColumn("rank", F.row_number().over(by_rank).cast("int")).filter(F.col("rank") <= top)


def lexical_search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    top: int = TOP,
    query_terms: int = QUERY_TERMS,
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` best documents of every item."""
    spark = docs.sparkSession
    ship_code(spark)
    asked = items.select(items[item_col].cast("long").alias("item_id"), items["text"].alias("text"))
    asked = asked.mapInArrow(_item_terms, "item_id long, terms array<string>").dropDuplicates()
    asked = asked.select("item_id", F.explode("terms").alias("term")).distinct()
    asked = written(asked.groupBy("item_id").agg(F.collect_list("term").alias("terms")), "lexical-items")
    parts = max(1, ceil((asked.agg(F.sum(F.size("terms"))).first()[0] or 0) / query_terms))
    out = None
    for part in range(parts):
        rows = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part).collect()  # about query_terms terms
        if not rows:
            continue
        terms = sorted({t.encode() for r in rows for t in r["terms"]})
        index = build_index(docs, terms, id_col, text_col)
        lists = [np.array([index.numbers[t.encode()] for t in r["terms"]], np.int64) for r in rows]
        ends = np.cumsum([0, *map(len, lists)])
        block = Items([r["item_id"] for r in rows], ends, np.concatenate(lists))
        names = spark.createDataFrame([(i, r) for i, r in enumerate(block.ids)], "item int, item_id long")
        best = search_index(index, block, top).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        out = best if out is None else out.unionByName(best)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
