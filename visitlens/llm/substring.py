"""Removal of passages that already occur in an earlier document (exact substrings of words).

A window is ``window`` consecutive words of one document.  Every word covered by a window
whose words also occur in a document with a smaller id is removed; windows are judged on
the input, not on what is left.

Method, difference-cover anchors: take a period v and a difference cover D of it (every
residue is a difference of two members).  Shorter windows of ``window - v + 1`` words are
hashed only at positions whose residue modulo v is in D (6 of 31).  Two equal windows in
any two documents, however they are aligned, hold a pair of equal anchors at the same
offset.  So:

1. a digest of each whole text finds exact copies; all of a later copy's windows occur in
   the first, so only the first goes on (it has the smallest id, so nothing is lost);
2. anchors are hashed and counted by one pre-aggregated grouping; anchors that occur in
   two documents are joined back to their places;
3. only windows that hold a shared anchor are extended to the full length: their 124-bit
   hashes are grouped, and the smallest id that holds a window decides.

Places of a hot anchor or window meet in joins whose sides are both read from written
tables, so adaptive execution can split them; no group is gathered in one task.  Equality
of windows is equality of two independent hashes of 62 bits each (polynomials modulo a
prime over hashed words).

Defined results: a null or empty text has no words; a row with a null id keeps its words
and removes none; rows with the same id never remove words of each other; documents
shorter than ``window`` keep all words.  One row results per input row.  Other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import only_ids, ship_code, written
from .words import Rolling, Texts, signed, slices

# Perfect difference sets, period: members.
COVERS = {
    3: (0, 1),
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    21: (0, 1, 4, 14, 16),
    31: (0, 1, 3, 8, 12, 18),
    57: (0, 1, 3, 13, 32, 36, 43, 52),
}
WINDOW = 50


def is_cover(period: int, members: tuple[int, ...]) -> bool:
    return {(a - b) % period for a in members for b in members} == set(range(period))


def cover_for(window: int) -> tuple[int, tuple[int, ...]]:
    """The largest period that leaves anchors of at least 0.4 of the window."""
    fitting = [v for v in COVERS if window - v + 1 >= max(1, 0.4 * window)]
    if not fitting:
        raise ValueError("a window has at least 5 words")
    period = max(fitting)
    return period, COVERS[period]


def _hash_pair(t: Texts) -> tuple[Rolling, Rolling]:
    h = t.word_hashes()
    return Rolling(h), Rolling(h, 1)


def _sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, t in slices(batch.column(1)):
            a, b = _hash_pair(t)
            ends = t.first[:-1], t.first[1:]
            sha = [_sha(t.words(i)) for i in range(t.n)]
            arrays = [batch.column(0).slice(lo, hi - lo), signed(a.spans(*ends)), signed(b.spans(*ends))]
            arrays += [pa.array(t.n_words.astype(np.int64)), pa.array(sha)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "s1", "s2", "n_words", "whole_sha"])


def _anchors(window: int):
    period, members = cover_for(window)
    length = window - period + 1
    at_cover = np.zeros(period, bool)
    at_cover[list(members)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, hi, t in slices(batch.column(1)):
                at = t.windows(length)
                doc = t.doc_of_word()[at]
                place = at - t.first[doc]
                keep = at_cover[place % period] & (t.n_words[doc] >= window)
                at, doc, place = at[keep], doc[keep], place[keep]
                rolling = Rolling(t.word_hashes())
                whole = rolling.spans(t.first[:-1], t.first[1:])
                arrays = [signed(rolling.spans(at, at + length)), pa.array(ids[lo:hi][doc]), signed(whole[doc]), pa.array(place.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(arrays, ["h", "doc_id", "s1", "place"])

    return run


def _windows(window: int):
    period, _ = cover_for(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            places = batch.column(2)
            for lo, hi, t in slices(batch.column(1)):
                own = places.slice(lo, hi - lo)
                doc = np.repeat(np.arange(t.n), own.value_lengths().to_numpy(zero_copy_only=False))
                anchor = t.first[doc] + own.flatten().to_numpy(zero_copy_only=False)
                # windows from period - 1 words before a shared anchor to the anchor itself
                step = np.zeros(len(t.start) + 1, np.int64)
                np.add.at(step, np.maximum(anchor - period + 1, t.first[doc]), 1)
                np.add.at(step, anchor + 1, -1)
                near = np.cumsum(step[:-1]) > 0
                at = t.windows(window)
                at = at[near[at]]
                doc = t.doc_of_word()[at]
                a, b = _hash_pair(t)
                whole = a.spans(t.first[:-1], t.first[1:])
                arrays = [signed(a.spans(at, at + window)), signed(b.spans(at, at + window)), pa.array(ids[lo:hi][doc])]
                arrays += [signed(whole[doc]), pa.array((at - t.first[doc]).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(arrays, ["w1", "w2", "doc_id", "s1", "place"])

    return run


def _cut(window: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column(3)
            for lo, hi, t in slices(batch.column(2)):
                n_removed, sha, texts = [], [], []
                for i in range(t.n):
                    words = t.words(i)
                    step = np.zeros(len(words) + 1, np.int64)
                    at = places[lo + i].values.to_numpy(zero_copy_only=False)
                    np.add.at(step, at, 1)
                    np.add.at(step, at + window, -1)
                    gone = np.cumsum(step[:-1]) > 0
                    left = [words[k] for k in np.flatnonzero(~gone)]
                    n_removed.append(int(gone.sum()))
                    sha.append(_sha(left))
                    texts.append(b" ".join(left).decode() if with_text else None)
                keys = [batch.column(k).slice(lo, hi - lo) for k in (0, 1)]
                arrays = [*keys, pa.array(n_removed, pa.int64()), pa.array(sha), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "s1", "n_removed", "kept_sha256", "kept_text"])

    return run


def _shared(rows: DataFrame, *key: str) -> DataFrame:
    """Keys found under two ids or more, with the smallest id."""
    lows = rows.groupBy(*key).agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    return lows.filter("low < high").select(*key, "low")


def dedup_substrings(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, with_text: bool = False
) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, and with ``with_text`` the kept text of
    documents that lost words (null: the text stays as it is)."""
    ship_code(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    digest = written(
        rows.mapInArrow(_digests, "doc_id long, s1 long, s2 long, n_words long, whole_sha string"), "substring-digest"
    )
    long_ones = digest.filter((F.col("n_words") >= window) & F.col("doc_id").isNotNull())
    first = written(_shared(long_ones, "s1", "s2"), "substring-copies")
    digest = digest.join(first, ["s1", "s2"], "left").withColumn(
        "is_copy", F.coalesce((F.col("doc_id") > F.col("low")) & (F.col("n_words") >= window), F.lit(False))
    )
    only_copies = digest.groupBy("doc_id").agg(F.min("is_copy").alias("all_copies")).filter("all_copies")
    copies = written(only_copies.select("doc_id"), "substring-copy-ids")

    firsts = only_ids(rows.filter("doc_id IS NOT NULL"), copies, "doc_id", "left_anti")
    anchors = firsts.mapInArrow(_anchors(window), "h long, doc_id long, s1 long, place int")
    shared = written(_shared(anchors, "h"), "substring-anchors")
    found = anchors.join(shared.select("h"), "h")
    places = written(found.groupBy("doc_id", "s1").agg(F.collect_list("place").alias("places")), "substring-places")

    some = only_ids(rows, places.select("doc_id"), "doc_id")
    some = some.mapInArrow(_with_key, "doc_id long, text string, s1 long").join(places, ["doc_id", "s1"])
    some = written(some.select("doc_id", "text", "places", "s1"), "substring-texts")
    windows = some.mapInArrow(_windows(window), "w1 long, w2 long, doc_id long, s1 long, place int")
    twice = written(_shared(windows, "w1", "w2"), "substring-windows")
    later = windows.join(twice, ["w1", "w2"]).filter("doc_id > low")
    lost = later.groupBy("doc_id", "s1").agg(F.collect_set("place").alias("lost"))

    texts = some.select("doc_id", "text", "s1").dropDuplicates(["doc_id", "s1"])
    cut = texts.join(lost, ["doc_id", "s1"]).select("doc_id", "s1", "text", "lost")
    cut = cut.mapInArrow(
        _cut(window, with_text), "doc_id long, s1 long, n_removed long, kept_sha256 string, kept_text string"
    )
    out = digest.join(cut, ["doc_id", "s1"], "left")
    copy = F.col("is_copy")

    def either(for_copy: Column, name: str, other: Column) -> Column:
        return F.when(copy, for_copy).otherwise(F.coalesce(F.col(name), other)).alias(name)

    columns = [
        F.col("doc_id"),
        F.col("n_words"),
        either(F.col("n_words"), "n_removed", F.lit(0).cast("long")),
        either(F.lit(_sha([])), "kept_sha256", F.col("whole_sha")),
    ]
    if with_text:
        columns.append(either(F.lit(""), "kept_text", F.lit(None).cast("string")))
    return out.select(*columns)


def _with_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, t in slices(batch.column(1)):
            key = Rolling(t.word_hashes()).spans(t.first[:-1], t.first[1:])
            kept = [batch.column(k).slice(lo, hi - lo) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*kept, signed(key)], ["doc_id", "text", "s1"])
