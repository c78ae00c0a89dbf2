"""Toxicity by multiple-instance learning: documents are bags of sentences.

Sentences end at ``.``, ``!``, ``?`` and line breaks.  A sentence's features are its letter
runs (A-Z lower-cased) and their first 4, 5 and 6 bytes, so inflected forms share evidence.
Its probability is the logistic of a bias and the weights of its distinct features; a
document's is the noisy-or of its sentences with a learned leak,

    P = 1 - (1 - leak) * prod over sentences of (1 - p_s)

so only document labels are needed to train, and the sentences that carry the score can be
located.  The leak takes up labels that no sentence explains; without it every long text
would drift towards 1.

A grouping over all labelled documents counts each feature's documents by label; features in
``MIN_DOCS`` documents or more whose smoothed log-odds are ``MIN_ODDS`` or more from the
average form the vocabulary (``VOCABULARY`` at most, the size of the model: the strongest
first).  Weights are fitted by about ``UPDATES`` Adagrad steps through the noisy-or on a
bounded sample of labelled documents (``SAMPLE``, and ``labelled.PAYLOAD`` bytes).  Scoring
is one pass over the whole texts.

Defined results: null and empty texts have no sentences and score the leak; without labels
the leak is 0.5; rows are scored one by one, so repeated rows repeat their result; a null
id is not held out; of sentences that tie, the first is named; other columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import labelled_documents, labelled_sample, to_driver
from .langid import held_out
from .tables import ship_code
from .words import NOT_LETTER, Texts, groups, salted, signed, slices

SAMPLE, MIN_DOCS, MIN_ODDS, VOCABULARY = 10_000, 5, 1.0, 20_000
UPDATES, RATE, DECAY, START = 60_000, 0.2, 1e-4, -5.0
PREFIXES = (4, 5, 6)
ENDS = np.zeros(256, bool)
ENDS[list(b".!?\n")] = True


def sentences(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text and first byte (of its first word) of every sentence; every word's sentence."""
    breaks = np.searchsorted(np.flatnonzero(ENDS[t.data]), t.start)
    doc = t.doc_of_word()
    new = np.ones(len(doc), bool)
    new[1:] = (breaks[1:] != breaks[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], t.start[new], np.cumsum(new) - 1


def features(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Word and hash of every feature."""
    word, prefix = t.prefix_hashes(PREFIXES, lower=True)
    return np.concatenate((np.arange(len(t.start)), word)), np.concatenate((t.word_hashes(lower=True), prefix))


def _known(vocabulary: np.ndarray, t: Texts, sentence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sentence and vocabulary index of the known features, each once per sentence."""
    if not len(vocabulary):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    word, h = features(t)
    at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
    hit = vocabulary[at] == h
    key = np.unique(sentence[word[hit]] * len(vocabulary) + at[hit])
    return key // len(vocabulary), key % len(vocabulary)


@dataclass
class BagModel:
    words: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float
    leak: float  # a probability

    def score(self, t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Document scores; sentences' texts, first bytes and probabilities."""
        doc, first, sentence = sentences(t)
        s, at = _known(self.words, t, sentence)
        logit = self.bias + np.bincount(s, self.weights[at], len(doc))
        clean = np.bincount(doc, np.logaddexp(0, logit), t.n)  # -log prod (1 - p)
        return 1 - (1 - self.leak) * np.exp(-clean), doc, first, 1 / (1 + np.exp(-np.clip(logit, -40, 40)))


def fit_bags(words: np.ndarray, known: list[tuple[np.ndarray, np.ndarray, int, int]], updates: int = UPDATES) -> BagModel:
    """Bags are (sentence and vocabulary index of every feature, number of sentences, 0 or 1)."""
    positive = sum(y for *_, y in known)
    if not known:
        return BagModel(words, np.zeros(len(words)), START, 0.5)
    w, gw, bias, gb = np.zeros(len(words)), np.full(len(words), 0.01), START, 1e-2
    share = min(max(positive / len(known) / 4, 1e-4), 0.5)
    leak, gl = float(np.log(share / (1 - share))), 1e-2
    rng = np.random.default_rng(0)
    for _ in range(-(-updates // len(known))):
        for k in rng.permutation(len(known)):
            s, at, n, y = known[k]
            logit = np.clip(bias + np.bincount(s, w[at], n), -40, 40) if n else np.empty(0)
            p = 1 / (1 + np.exp(-logit))
            own_leak = 1 / (1 + np.exp(-leak))
            clean = np.exp(-np.logaddexp(0, logit).sum()) * (1 - own_leak)  # 1 - P
            pull = -clean / max(1 - clean, 1e-6) if y else 1.0
            g = pull * own_leak
            gl += g * g
            leak -= RATE * g / gl**0.5
            if not n:
                continue
            slope = pull * p
            g = float(slope.sum())
            gb += g * g
            bias -= RATE * g / gb**0.5
            g = slope[s] + DECAY * w[at]
            np.add.at(gw, at, g * g)
            np.subtract.at(w, at, RATE * g / np.sqrt(gw[at]))
    return BagModel(words, w, bias, float(1 / (1 + np.exp(-leak))))


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch, documents and positive documents with each feature."""
    for batch in batches:
        label = batch.column(1).to_numpy(zero_copy_only=False)
        for lo, hi, t in slices(batch.column(0), gap=NOT_LETTER):
            word, h = features(t)
            doc = t.doc_of_word()[word]
            order, runs = groups(salted(doc, h))
            once = order[runs]
            found, inverse, docs = np.unique(h[once], return_inverse=True, return_counts=True)
            toxic = np.bincount(inverse, label[lo:hi][doc[once]], len(found)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([signed(found), pa.array(docs.astype(np.int64)), pa.array(toxic)], ["feature", "docs", "toxic"])


def _bags(vocabulary: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, t in slices(batch.column(1), gap=NOT_LETTER):
                doc, _, sentence = sentences(t)
                s, at = _known(vocabulary, t, sentence)
                begin = np.searchsorted(doc, np.arange(t.n + 1))
                edge = np.searchsorted(doc[s] if len(s) else s, np.arange(t.n + 1))
                pairs = list(zip(edge, edge[1:], begin))
                arrays = [
                    batch.column(0).slice(lo, hi - lo),
                    pa.array([(s[a:b] - c).astype(np.int32).tobytes() for a, b, c in pairs], pa.binary()),
                    pa.array([at[a:b].astype(np.int32).tobytes() for a, b, _ in pairs], pa.binary()),
                    pa.array(np.diff(begin).astype(np.int64)),
                    batch.column(2).slice(lo, hi - lo),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "sentences", "words", "n", "label"])

    return run


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", text_col: str = "text", sample: int = SAMPLE) -> BagModel:
    read = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    every = labelled_documents(read, labels, label)
    all_docs, positive = every.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    counts = every.select("text", "label").mapInArrow(_feature_counts, "feature long, docs long, toxic long")
    counts = counts.groupBy("feature").agg(F.sum("docs").alias("docs"), F.sum("toxic").alias("toxic")).filter(F.col("docs") >= MIN_DOCS)
    usual = float(np.log((positive + 0.5) / (all_docs - positive + 0.5)))
    odds = F.abs(F.log((F.col("toxic") + 0.5) / (F.col("docs") - F.col("toxic") + 0.5)) - usual)
    chosen = counts.withColumn("odds", odds).filter(F.col("odds") >= MIN_ODDS)
    chosen = chosen.orderBy(F.col("odds").desc(), "feature").limit(VOCABULARY).select("feature").toArrow()
    vocabulary = np.sort(chosen.column("feature").to_numpy().view(np.uint64))
    rows = labelled_sample(read, labels, label, sample)
    bags = rows.mapInArrow(_bags(vocabulary), "doc_id long, sentences binary, words binary, n long, label int")
    got = to_driver(bags, ["sentences", "words"])
    names = ("sentences", "words", "n", "label")
    bags = [
        (np.frombuffer(s, np.int32).astype(np.int64), np.frombuffer(at, np.int32).astype(np.int64), n, y)
        for s, at, n, y in zip(*(got.column(k).to_pylist() for k in names), strict=True)
    ]
    return fit_bags(vocabulary, bags)


def score_toxicity(
    docs: DataFrame, model: BagModel, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, held_out, score, predicted, n_sentences, and the worst sentence: its number
    (from 0; null without sentences), probability, and text up to the next sentence end."""
    ship_code(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most the sample's distinct words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, t in slices(batch.column(2), gap=NOT_LETTER):
                score, doc, first, p = shared.value.score(t)
                n = np.bincount(doc, minlength=t.n)
                begin = np.cumsum(n) - n
                ends = np.flatnonzero(ENDS[t.data])
                worst, value, text = [], [], []
                order = np.lexsort((np.arange(len(p)), -p, doc))  # worst sentence first in each text
                for i in range(t.n):
                    if not n[i]:
                        worst.append(None), value.append(None), text.append(None)
                        continue
                    k = order[begin[i]]
                    after = np.searchsorted(ends, first[k])
                    stop = min(ends[after] + 1 if after < len(ends) else len(t.data), t.offsets[i + 1])
                    worst.append(int(k - begin[i])), value.append(float(p[k]))
                    text.append(t.data[first[k] : stop].tobytes().decode("utf-8", "replace"))
                kept = [batch.column(c).slice(lo, hi - lo) for c in (0, 1)]
                arrays = [*kept, pa.array(score), pa.array((score >= threshold).astype(np.int32)), pa.array(n.astype(np.int64))]
                arrays += [pa.array(worst, pa.int64()), pa.array(value, pa.float64()), pa.array(text, pa.string())]
                names = ["doc_id", "held_out", "score", "predicted", "n_sentences", "worst_sentence", "worst_score", "worst_text"]
                yield pa.RecordBatch.from_arrays(arrays, names)

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), held_out(docs[id_col]).alias("held_out"), docs[text_col].alias("text"))
    schema = "doc_id long, held_out boolean, score double, predicted int, n_sentences long, worst_sentence long, worst_score double, worst_text string"
    return rows.mapInArrow(run, schema)
