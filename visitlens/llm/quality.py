"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

A document is a sparse vector: its distinct letter runs (A-Z lower-cased) hashed to ``WORDS``
columns with weight sqrt(count / words), structure statistics of the whole text, and its
recorded length.  The score is the logistic of

    bias + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)

so all pairwise interactions cost time linear in the vector's size.  The model is fitted by
Adagrad on a bounded sample of labelled documents (``SAMPLE``, and ``labelled.PAYLOAD`` bytes); scoring is one pass over
the table.

Defined results: null and empty texts have no words and are scored by their statistics;
a null length counts as 0; without labels every score is 0.5; rows are scored one by one, so
repeated rows repeat their result; a null id is not held out; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import labelled_sample, to_driver
from .langid import held_out
from .repetition import repeated_lines
from .tables import ship_code
from .words import NOT_LETTER, Texts, groups, salted, slices

WORDS, FACTORS = 1 << 18, 8
# START damps the first steps, so a word seen in a few texts moves little.
SAMPLE, EPOCHS, RATE, DECAY, START = 6000, 6, 0.2, 1e-4, 0.05


def _table(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


# Character classes whose share of the text is a feature.
CLASSES = [
    _table(bytes(range(48, 58))),
    _table(bytes(range(65, 91))),
    _table(b"#*$%&|<>"),
    _table(b".,;:"),
    _table(b"!?"),
    _table(b"{}[]()=_/\\@"),
    _table(b"\n"),
    _table(b" \t\r\v\f"),
    ~NOT_LETTER,
]
STATISTICS = len(CLASSES) + 7


def statistics(t: Texts, recorded: np.ndarray) -> np.ndarray:
    """One row of structure statistics per text, each about 0 to 1."""
    size = np.diff(t.offsets)
    some = np.maximum(size, 1)
    words = np.maximum(t.n_words, 1)
    columns = [t.count(c) / some for c in CLASSES]
    doc, h = t.doc_of_word(), t.word_hashes(lower=True)
    key = salted(doc, h)
    order, runs = groups(key)
    distinct = np.bincount(doc[order[runs]] if len(key) else doc, minlength=t.n)
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    lines = repeated_lines(t)
    columns += [distinct / words, np.bincount(doc[again], minlength=t.n) / words, lines]
    columns += [np.minimum(np.bincount(doc, t.end - t.start, t.n) / words / 10, 2)]
    columns += [np.log1p(t.n_words) / 10, np.log1p(np.nan_to_num(np.maximum(recorded, 0))) / 12, (t.n_words == 0).astype(float)]
    return np.stack(columns, 1)


def vectors(t: Texts, recorded: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, column and value of every non-zero entry, sorted by text."""
    feature = (t.word_hashes(lower=True) & np.uint64(WORDS - 1)).astype(np.int64)
    key, count = np.unique(t.doc_of_word() * WORDS + feature, return_counts=True)
    doc, column = key // WORDS, key % WORDS
    value = np.sqrt(count / np.maximum(t.n_words, 1)[doc])
    stats = statistics(t, recorded)
    doc = np.concatenate((doc, np.repeat(np.arange(t.n), STATISTICS)))
    column = np.concatenate((column, np.tile(np.arange(WORDS, WORDS + STATISTICS), t.n)))
    value = np.concatenate((value, stats.ravel()))
    order = np.argsort(doc, kind="stable")
    return doc[order], column[order], value[order]


@dataclass
class FactorisationMachine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def logits(self, doc: np.ndarray, column: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        out = self.bias + np.bincount(doc, self.linear[column] * value, n)
        for f in range(self.factors.shape[1]):
            part = self.factors[column, f] * value
            out += 0.5 * (np.bincount(doc, part, n) ** 2 - np.bincount(doc, part * part, n))
        return out


def fit_machine(examples: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS) -> FactorisationMachine:
    """Adagrad on the logistic loss; examples are (columns, values, 0 or 1)."""
    size = WORDS + STATISTICS
    rng = np.random.default_rng(0)
    w, v = np.zeros(size), rng.normal(0, 0.02, (size, FACTORS))
    gw, gv, gb = np.full(size, START), np.full((size, FACTORS), START), START
    positive = sum(y for *_, y in examples)
    bias = float(np.log((positive + 1) / (len(examples) - positive + 1)))
    for _ in range(epochs):
        for k in rng.permutation(len(examples)):
            at, x, y = examples[k]
            own = v[at]
            total = x @ own
            logit = bias + x @ w[at] + 0.5 * float(total @ total - (x * x) @ (own * own).sum(1))
            slope = 1 / (1 + np.exp(-min(max(logit, -30), 30))) - y
            gb += slope * slope
            bias -= RATE * slope / gb**0.5
            g = slope * x + DECAY * w[at]
            gw[at] += g * g
            w[at] -= RATE * g / np.sqrt(gw[at])
            g = slope * (x[:, None] * total[None, :] - own * (x * x)[:, None]) + DECAY * own
            gv[at] += g * g
            v[at] -= RATE * g / np.sqrt(gv[at])
    return FactorisationMachine(bias, w.astype(np.float32), v.astype(np.float32))


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        recorded = batch.column(2).cast(pa.float64()).to_numpy(zero_copy_only=False)
        for lo, hi, t in slices(batch.column(1), gap=NOT_LETTER):
            doc, column, value = vectors(t, recorded[lo:hi])
            edge = np.searchsorted(doc, np.arange(t.n + 1))
            pairs = list(zip(edge, edge[1:]))
            arrays = [
                batch.column(0).slice(lo, hi - lo),
                pa.array([column[a:b].astype(np.int32).tobytes() for a, b in pairs], pa.binary()),
                pa.array([value[a:b].astype(np.float32).tobytes() for a, b in pairs], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays([*arrays, batch.column(3).slice(lo, hi - lo)], ["doc_id", "columns", "values", "label"])


def _inputs(docs: DataFrame, text_col: str, length_col: str | None) -> list:
    length = docs[length_col].cast("long") if length_col else F.lit(0).cast("long")
    return [docs[text_col].alias("text"), length.alias("recorded")]


def fit_quality(
    docs: DataFrame, labels: DataFrame, label: str = "quality", text_col: str = "text", length_col: str | None = "n_chars", sample: int = SAMPLE
) -> FactorisationMachine:
    read = docs.select(docs["doc_id"].cast("long").alias("doc_id"), *_inputs(docs, text_col, length_col))
    rows = labelled_sample(read, labels, label, sample)
    got = to_driver(rows.mapInArrow(_examples, "doc_id long, columns binary, values binary, label int"), ["columns", "values"])
    examples = [
        (np.frombuffer(c, np.int32), np.frombuffer(x, np.float32).astype(float), y)
        for c, x, y in zip(*(got.column(k).to_pylist() for k in ("columns", "values", "label")), strict=True)
    ]
    return fit_machine(examples)


def score_quality(
    docs: DataFrame,
    model: FactorisationMachine,
    threshold: float = 0.7,
    id_col: str = "doc_id",
    text_col: str = "text",
    length_col: str | None = "n_chars",
) -> DataFrame:
    """doc_id, held_out, score and predicted of every input row."""
    ship_code(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # WORDS * (FACTORS + 1) floats: 9 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            recorded = batch.column(3).cast(pa.float64()).to_numpy(zero_copy_only=False)
            for lo, hi, t in slices(batch.column(2), gap=NOT_LETTER):
                logit = shared.value.logits(*vectors(t, recorded[lo:hi]), t.n)
                score = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
                kept = [batch.column(k).slice(lo, hi - lo) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(score), pa.array((score >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"]
                )

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), held_out(docs[id_col]).alias("held_out"), *_inputs(docs, text_col, length_col))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
