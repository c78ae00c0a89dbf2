"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Characters are code points; letters are lower-cased, everything else becomes a space.  All
n-grams of lengths 1 to 3 of the whole text are hashed to ``FEATURES`` columns, weighted by
``(1 + ln count) * idf`` and scaled to unit length.  Document frequencies come from every
training document (a grouping with at most ``FEATURES`` rows).  The classifier is fitted
with follow-the-regularised-leader (proximal, elastic net) on a bounded sample of labelled
documents: up to ``PER_CLASS`` of each language and ``SAMPLE`` in all, those with the
smallest hash of their id.  A fifth of the sample is kept apart to fit the temperature that
calibrates the probabilities.

Defined results: a null text, or one without any letter, is ``und`` with score 0; without
training documents every text is ``und``; documents are scored one by one and whole, so
repeated rows repeat their result; a null id is not held out and never trains; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import only_ids, ship_code, written
from .words import IS_LEAD, Texts, mix, slices

FEATURES = 1 << 14
LENGTHS = (1, 2, 3)
PER_CLASS, SAMPLE = 1000, 6000
EPOCHS, ALPHA, BETA, L1, L2 = 3, 0.5, 1.0, 0.02, 0.2
UNKNOWN = "und"
#: Share of the training documents from which an n-gram is known.
KNOWN_SHARE = 0.05

_fold: list[np.ndarray] = []


def _folded(points: np.ndarray) -> np.ndarray:
    """Lower-case letters; 32 for everything else."""
    if not _fold:
        table = np.full(0x10000, 32, np.uint32)
        for c in range(0x10000):
            if chr(c).isalpha():
                low = chr(c).lower()
                table[c] = ord(low) if len(low) == 1 else c
        _fold.append(table)
    out = _fold[0][np.minimum(points, 0xFFFF)]
    for c in np.unique(points[points > 0xFFFF]):
        out[points == c] = c if chr(c).isalpha() else 32
    return out


def ngrams(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, feature and count of every n-gram feature, sorted; whether a text has a letter."""
    points = np.frombuffer(t.data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    starts = np.concatenate(([0], np.cumsum(IS_LEAD[t.data])))[t.offsets]
    c = _folded(points).astype(np.uint64)
    doc = np.repeat(np.arange(t.n), np.diff(starts))
    letter = np.bincount(doc[c != 32], minlength=t.n) > 0
    keys, h = [], np.zeros(len(c), np.uint64)
    for n in range(1, max(LENGTHS) + 1):
        if len(c) < n:
            break
        h = h[: len(c) - n + 1] * np.uint64(0x100000001B3) + c[n - 1 :] + np.uint64(n)
        if n in LENGTHS:
            whole = doc[: len(h)] == doc[n - 1 :]
            feature = (mix(h[whole]) & np.uint64(FEATURES - 1)).astype(np.int64)
            keys.append(doc[: len(h)][whole] * FEATURES + feature)
    key, count = np.unique(np.concatenate(keys) if keys else np.empty(0, np.int64), return_counts=True)
    return key // FEATURES, key % FEATURES, count, letter


def _vectors(doc: np.ndarray, feature: np.ndarray, count: np.ndarray, idf: np.ndarray, n: int) -> np.ndarray:
    """Unit-length TF-IDF values."""
    value = (1 + np.log(count)) * idf[feature]
    norm = np.sqrt(np.bincount(doc, value * value, n))
    return value / np.maximum(norm, 1e-12)[doc]


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # a row per feature and one for the bias, a column per language
    temperature: float = 1.0
    #: features found in ``KNOWN_SHARE`` of the training documents or more
    known: np.ndarray = field(default_factory=lambda: np.ones(FEATURES, bool))

    def scores(self, t: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Index of the best language (-1: none) and its probability, for every text."""
        return self.judge(t)[:2]

    def judge(self, t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``scores``, and the share of every text's n-grams that training documents know,
        which unlike a probability is low for texts of no learned language."""
        best, score = np.full(t.n, -1), np.zeros(t.n)
        if not self.languages:
            return best, score, score
        doc, feature, count, letter = ngrams(t)
        familiar = np.bincount(doc, count * self.known[feature], t.n) / np.maximum(np.bincount(doc, count, t.n), 1)
        value = _vectors(doc, feature, count, self.idf, t.n)
        logits = np.stack([np.bincount(doc, value * w[:-1][feature], t.n) + w[-1] for w in self.weights.T], 1)
        p = _softmax(logits / self.temperature)
        best[letter] = p.argmax(1)[letter]
        score[letter] = p.max(1)[letter]
        return best, score, familiar


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def ftrl(examples: Sequence[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = EPOCHS) -> np.ndarray:
    """Weights fitted by FTRL-proximal with elastic net; examples are (features, values, class)."""
    z, n = np.zeros((FEATURES + 1, classes)), np.zeros((FEATURES + 1, classes))

    def current(at: np.ndarray) -> np.ndarray:
        part = z[at]
        strong = np.abs(part) - L1
        return np.where(strong > 0, -np.sign(part) * strong / ((BETA + np.sqrt(n[at])) / ALPHA + L2), 0.0)

    order = np.random.default_rng(0)
    for _ in range(epochs):
        for k in order.permutation(len(examples)):
            at, x, label = examples[k]
            w = current(at)
            slope = _softmax(x @ w)
            slope[label] -= 1
            g = x[:, None] * slope[None, :]
            grown = n[at] + g * g
            z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / ALPHA * w
            n[at] = grown
    return current(np.arange(FEATURES + 1))


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least negative log-likelihood, by golden-section search on its log."""
    if not len(labels):
        return 1.0

    # targets a little short of certainty, as from one more unseen error, keep it finite
    doubt = 1 / (len(labels) + 2)
    wanted = np.full(logits.shape, doubt / max(1, logits.shape[1] - 1))
    wanted[np.arange(len(labels)), labels] = 1 - doubt

    def loss(log_t: float) -> float:
        return float(-(wanted * np.log(np.maximum(_softmax(logits / np.exp(log_t)), 1e-12))).sum(1).mean())

    low, high, ratio = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with each feature, in one task; feature -1 counts the documents."""
    total = np.zeros(FEATURES, np.int64)
    n = 0
    for batch in batches:
        for _, _, t in slices(batch.column(0)):
            total += np.bincount(ngrams(t)[1], minlength=FEATURES)
            n += t.n
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], n))], ["feature", "docs"])


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, t in slices(batch.column(2)):
            doc, feature, count, _ = ngrams(t)
            edge = np.searchsorted(doc, np.arange(t.n + 1))
            parts = [(feature[a:b].astype(np.uint16).tobytes(), count[a:b].astype(np.uint32).tobytes()) for a, b in zip(edge, edge[1:])]
            arrays = [batch.column(k).slice(lo, hi - lo) for k in (0, 1)]
            arrays += [pa.array([p[k] for p in parts], pa.binary()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "lang", "features", "counts"])


class Examples(Sequence):
    """Rows of ``_examples`` as (features, values, class) with the bias, in the order of ``rows``;
    they stay packed until one is asked for, so the driver holds them once."""

    def __init__(self, packed: pa.Table, rows: np.ndarray, idf: np.ndarray, languages: list[str]):
        self.packed, self.rows, self.idf, self.languages = packed, rows, idf, languages

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, at: int) -> tuple[np.ndarray, np.ndarray, int]:
        lang, feature, count = (self.packed.column(c)[int(self.rows[at])].as_py() for c in ("lang", "features", "counts"))
        feature, count = np.frombuffer(feature, np.uint16).astype(np.int64), np.frombuffer(count, np.uint32)
        value = _vectors(np.zeros(len(feature), np.int64), feature, count, self.idf, 1)
        return np.append(feature, FEATURES), np.append(value, 1.0), self.languages.index(lang)


#: Values of the language column a model may learn; its weights have this many columns.
MAX_LANGUAGES = 1000


def held_out(id_col: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_language_model(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_class: int = PER_CLASS, sample: int = SAMPLE
) -> LanguageModel:
    """Learn from all rows of ``docs`` that have an id, a text and a language."""
    ship_code(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[lang_col].cast("string").alias("lang"), docs[text_col].alias("text"))
    rows = rows.filter("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"))
    languages = {r["lang"]: r["n"] for r in sizes.orderBy("lang").limit(MAX_LANGUAGES + 1).collect()}
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: the column holds something else")
    if not languages:
        return LanguageModel([], np.ones(FEATURES), np.zeros((FEATURES + 1, 0)))
    counts = rows.select("text").mapInArrow(_document_counts, "feature long, docs long").groupBy("feature").agg(F.sum("docs").alias("docs"))
    found = dict(counts.collect())  # at most FEATURES + 1 rows
    total = found.pop(-1, 0)
    idf = np.full(FEATURES, np.log((1 + total) / 1) + 1)
    known = np.zeros(FEATURES, bool)
    for feature, n in found.items():
        idf[feature] = np.log((1 + total) / (1 + n)) + 1
        known[feature] = n >= KNOWN_SHARE * total

    most = max(1, min(per_class, sample // len(languages)))
    # about 1.5 times as many ids as wanted pass a threshold that follows the language's size,
    # so the ranking sees a bounded number whatever the language's share of the rows
    share = F.create_map(*[F.lit(x) for name, n in languages.items() for x in (name, min(1.0, 1.5 * (most + 20) / n))])
    languages = list(languages)
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    near = rows.select("doc_id", "lang").filter(drawn < F.element_at(share, F.col("lang")) * (1 << 30)).distinct()
    first = Window.partitionBy("lang").orderBy(drawn, "doc_id")
    chosen = near.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= most).select("doc_id", "lang")
    chosen = written(chosen.groupBy("doc_id").agg(F.min("lang").alias("taken")), "langid-sample")
    texts = only_ids(rows, chosen.select("doc_id"), "doc_id").join(chosen, "doc_id").filter("lang = taken")
    least = F.min_by("text", F.struct(F.xxhash64("text"), "text"))
    texts = texts.groupBy("doc_id", "lang").agg(least.alias("text"))  # one text an id
    got = texts.mapInArrow(_examples, "doc_id long, lang string, features binary, counts binary").toArrow()
    ids = got.column("doc_id").to_numpy()
    order = np.lexsort((ids, mix(ids.astype(np.uint64))))
    kept_apart = np.arange(len(order)) % 5 == 4
    examples, apart = (Examples(got, order[rows], idf, languages) for rows in (~kept_apart, kept_apart))
    weights = ftrl(examples, len(languages))
    logits = np.array([x @ weights[at] for at, x, _ in apart]).reshape(len(apart), len(languages))
    return LanguageModel(languages, idf, weights, fit_temperature(logits, np.array([y for *_, y in apart], int)), known)


def predict_languages(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred and score of every input row."""
    ship_code(docs.sparkSession)
    names = [*model.languages, UNKNOWN]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, t in slices(batch.column(2)):
                best, score = model.scores(t)
                kept = [batch.column(k).slice(lo, hi - lo) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array([names[k] for k in best]), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"]
                )

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), held_out(docs[id_col]).alias("held_out"), docs[text_col].alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(
    docs: DataFrame, model: LanguageModel, min_score: float, text_col: str = "text", min_familiar: float = 0.0
) -> DataFrame:
    """The rows, with all their columns, whose language is known with ``min_score`` or more and
    whose n-grams are known to a share of ``min_familiar`` or more; if no language was
    learned, the rows with a letter."""
    ship_code(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, t in slices(batch.column(at)):
                if model.languages:
                    best, score, familiar = model.judge(t)
                    keep = (best >= 0) & (score >= min_score) & (familiar >= min_familiar)
                else:
                    keep = ngrams(t)[3]
                yield batch.slice(lo, hi - lo).filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
