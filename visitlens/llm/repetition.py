"""Quality rules: how much of a text lies in repeated word n-grams and lines.

Rolling hashes of several n-gram lengths are taken over the words of a whole text.  For
each length, characters of words covered by an n-gram that occurred earlier in the text
count as duplicated (each once); for the short lengths, the share of the most frequent
n-gram (``TOP_COUNT`` occurrences or more) is measured instead.  Lines equal to an earlier line count with all their
characters.  A text is kept if no judged share passes its limit; the share of duplicate lines
is reported but not judged, only that of their characters.

Departures from the published limits, with their cost in documents marked good, are in the
README: 5- to 10-grams have 0.05 more, and 2- to 4-grams count from three occurrences.

Defined results: a null or empty text has zero counts, fails the base rules and is not
kept; a very long text takes memory in proportion to itself in its own task only; null and
repeated ids change nothing; rows are judged one by one, so repeated rows repeat their result; other columns of
the input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .tables import ship_code
from .words import Rolling, Texts, groups, salted, slices, span_hashes

#: occurrences from which an n-gram counts as frequent; two can be chance in a short text
TOP_COUNT = 3
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class RepetitionLimits:
    """Largest allowed shares of a text's word characters.

    After published web-text rules; those for 5- to 10-grams are 0.05 wider than published,
    so that one repeated line does not condemn a text of a few dozen words."""

    dup_line_chars: float = 0.20
    top_ngram: dict[int, float] = field(default_factory=lambda: {2: 0.20, 3: 0.18, 4: 0.16})
    dup_ngram: dict[int, float] = field(
        default_factory=lambda: {5: 0.20, 6: 0.19, 7: 0.18, 8: 0.17, 9: 0.16, 10: 0.15}
    )


def _lines(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, start and end (bytes) of every line."""
    breaks = np.flatnonzero(t.data == 10)
    text = np.concatenate((np.arange(t.n), np.searchsorted(t.offsets, breaks, "right") - 1))
    start = np.concatenate((t.offsets[:-1], breaks + 1))
    order = np.lexsort((start, text))
    text, start = text[order], start[order]
    last = np.append(text[1:] != text[:-1], True)
    end = np.where(last, t.offsets[text + 1], np.append(start[1:], 0) - 1)
    return text, start, end


def repeated_lines(t: Texts) -> np.ndarray:
    """Per text, the share of its lines with a word that equal an earlier one."""
    text, start, end = _lines(t)
    full = np.searchsorted(t.start, end) > np.searchsorted(t.start, start)
    text, start, end = text[full], start[full], end[full]
    again = _later(salted(text, span_hashes(t.data, start, end - start)))
    return np.bincount(text[again], minlength=t.n) / np.maximum(np.bincount(text, minlength=t.n), 1)


def _later(key: np.ndarray) -> np.ndarray:
    """True where an equal key occurred earlier."""
    again = np.ones(len(key), bool)
    if len(key):
        order, runs = groups(key)
        again[np.minimum.reduceat(order, runs)] = False
    return again


def _in_runs(order: np.ndarray, size: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places, ascending, of the values in the wanted runs."""
    return np.sort(order[np.repeat(wanted, size)])


def _covered(start: np.ndarray, n: int, total: int) -> np.ndarray:
    """True for words in any window of ``n`` words from ``start``."""
    begun = np.zeros(total + 1, np.int32)
    begun[start + 1] = 1
    begun = np.cumsum(begun)
    covered = begun[1:] > 0
    if total > n:
        covered[n:] = begun[n + 1 :] > begun[1 : total - n + 1]
    return covered


def measure(t: Texts, limits: RepetitionLimits) -> dict[str, np.ndarray]:
    """All counts and shares for the texts of a slice."""
    doc, h, chars = t.doc_of_word(), t.word_hashes(), t.word_chars()
    per_doc = lambda weight: np.bincount(doc, weight, t.n).astype(np.int64)
    out = {"n_words": t.n_words.astype(np.int64), "word_chars": per_doc(chars), "n_symbols": t.count(SYMBOLS)}
    total = np.maximum(out["word_chars"], 1)

    text, start, end = _lines(t)
    first, stop = np.searchsorted(t.start, start), np.searchsorted(t.start, end)
    full = stop > first  # lines with a word
    text, start, end, first, stop = (x[full] for x in (text, start, end, first, stop))
    again = _later(salted(text, span_hashes(t.data, start, end - start)))
    inside = np.concatenate(([0], np.cumsum(chars)))
    out["n_dup_lines"] = np.bincount(text[again], minlength=t.n).astype(np.int64)
    n_lines = np.maximum(np.bincount(text, minlength=t.n), 1)
    out["dup_line_share"] = out["n_dup_lines"] / n_lines
    line_chars = (inside[stop] - inside[first])[again]
    out["dup_line_char_share"] = np.bincount(text[again], line_chars, t.n) / total

    good = out["dup_line_char_share"] <= limits.dup_line_chars
    stop = t.first[1:][doc]  # where the word's text ends
    at, rolling = np.arange(len(h)), Rolling(h)
    for n in sorted({3, *limits.top_ngram, *limits.dup_ngram}):
        # a repeated n-gram begins with a repeated shorter one, so only their places go on
        at = at[at + n <= stop[at]]
        key = salted(doc[at], rolling.spans(at, at + n))
        order, runs = groups(key)
        size = np.diff(np.append(runs, len(key)))
        if n == 3:
            out["n_repeat_words"] = per_doc(_covered(at[_in_runs(order, size, size > 1)], 3, len(h)))
        if n in limits.top_ngram:
            most = np.zeros(t.n)
            one = at[order[runs]]  # any occurrence: all have the same words
            share = np.where(size >= TOP_COUNT, size * (inside[one + n] - inside[one]), 0) / total[doc[one]]
            np.maximum.at(most, doc[one], share)
            out[f"top_{n}gram_share"] = np.minimum(most, 1.0)
            good &= most <= limits.top_ngram[n]
        if n in limits.dup_ngram:
            later = np.ones(len(key), bool)
            if len(key):
                later[np.minimum.reduceat(order, runs)] = False
            share = np.bincount(doc, chars * _covered(at[later], n, len(h)), t.n) / total
            out[f"dup_{n}gram_share"] = share
            good &= share <= limits.dup_ngram[n]
        at = at[_in_runs(order, size, size > 1)]
    out["base_failed"] = (out["n_words"] < 50) | (100 * out["n_repeat_words"] > 50 * out["n_words"])
    out["kept"] = good & ~out["base_failed"]
    return out


def repetition_coverage(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limits: RepetitionLimits | None = None
) -> DataFrame:
    """One row per input row: id, counts, shares, ``base_failed`` and ``kept``."""
    ship_code(docs.sparkSession)
    limits = limits or RepetitionLimits()
    longs = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    shares = ["dup_line_share", "dup_line_char_share"]
    shares += [f"top_{n}gram_share" for n in limits.top_ngram] + [f"dup_{n}gram_share" for n in limits.dup_ngram]
    names = [*longs, "base_failed", "kept", *shares]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, t in slices(batch.column(1)):
                found = measure(t, limits)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), *(pa.array(found[k]) for k in names)], ["doc_id", *names]
                )

    schema = "doc_id long, " + ", ".join(f"{k} long" for k in longs)
    schema += ", base_failed boolean, kept boolean, " + ", ".join(f"{k} double" for k in shares)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return rows.mapInArrow(run, schema)
