"""URL filters: allow / block rules, and gradient-boosted trees for URLs that no rule covers.

A rule is ``host/path``: it fits its host and all subdomains when the url's path starts with
the rule's path; the longest fitting rule wins.  URLs that a rule covers are the labelled
ones.  On a bounded sample of the distinct ones (about ``SAMPLE``, by a hash of the url) trees are boosted with
Newton steps on the logistic loss over histograms of lexical features: lengths, depth, digit
ratio, character entropy, parameter counts, punctuation, and suffix statistics.  The latter
are smoothed block rates of the host's last label and last two labels, counted over every
labelled url and hashed to ``BINS`` bins each, so their size does not follow the input.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path:
from there up to ``?``, ``#`` or the end.

Defined results: a null url, or one without ``://``, has empty host and path and is judged
by the trees like any other; without labelled urls (or with one label only) the trees add
nothing and the prior decides, block above one half; rows are judged one by one, so
repeated rows repeat their result; other columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import ship_code, written
from .words import byte_view, slices

#: The rules of the registered query: (host, path, verdict).
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
SAMPLE, BINS, PRIOR = 20_000, 4096, 20.0
LEXICAL = 14  # lexical features
TREES, DEPTH, RATE, LEVELS, LEAST, RIDGE = 60, 3, 0.2, 64, 20, 1.0

Rules = Sequence[tuple[str, str, str]]


def url_host(url: Column) -> Column:
    after = F.substr(url, F.length(F.substring_index(url, "://", 1)) + 4)
    host = F.translate(F.regexp_extract(after, r"^[^/?#]*", 0), ascii_uppercase, ascii_lowercase)
    return F.coalesce(F.when(F.contains(url, F.lit("://")), host), F.lit(""))


def url_path(url: Column) -> Column:
    after = F.substr(url, F.length(F.substring_index(url, "://", 1)) + 4)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.when(F.contains(url, F.lit("://")), path), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Rules) -> Column:
    """The longest rule that fits, as a struct (rule, verdict); null if none does."""
    found: Column | None = None
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        value = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return F.lit(None).cast("struct<rule:string,verdict:string>") if found is None else found


def _bin(text: Column) -> Column:
    return F.pmod(F.xxhash64(text), F.lit(BINS)).cast("int")


def parsed(pages: DataFrame, rules: Rules, id_col: str, url_col: str) -> DataFrame:
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].alias("url"))
    rows = rows.withColumns({"host": url_host(rows["url"]), "path": url_path(rows["url"])})
    rows = rows.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
    return rows.select(
        "page_id", "url", "host", "path", F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("ruled"),
        _bin(F.substring_index("host", ".", -1)).alias("bin1"), _bin(F.substring_index("host", ".", -2)).alias("bin2"),
    )


def _of(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


_DIGITS, _SLASH, _DOT, _DASH, _PARAMS = _of(b"0123456789"), _of(b"/"), _of(b"."), _of(b"-_"), _of(b"=")
_SEPARATORS, _ESCAPES, _QUERY, _UPPER = _of(b"&;"), _of(b"%@~"), _of(b"?#"), _of(bytes(range(65, 91)))


def lexical_features(url: pa.Array, host: pa.Array, path: pa.Array) -> np.ndarray:
    """One row of lexical features per url."""
    parts = []
    for lo, hi, t in slices(url):
        n, size = t.n, np.diff(t.offsets)
        doc = np.repeat(np.arange(n), size)
        seen = np.bincount(doc * 256 + t.data, minlength=n * 256).reshape(n, 256) / np.maximum(size, 1)[:, None]
        entropy = -(seen * np.log2(np.where(seen > 0, seen, 1))).sum(1)
        sizes = [np.diff(byte_view(c.slice(lo, hi - lo))[1]) for c in (host, path)]
        counts = [t.count(c) for c in (_SLASH, _DOT, _DASH, _PARAMS, _SEPARATORS, _ESCAPES, _QUERY, _UPPER, _DIGITS)]
        ratio = counts[-1] / np.maximum(size, 1)
        parts.append(np.stack([size, *sizes, *counts, ratio, entropy], 1).astype(float))
    return np.concatenate(parts) if parts else np.empty((0, LEXICAL))


def _packed_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the sample with their lexical features packed, whatever the url's length."""
    for batch in batches:
        x = pa.array([row.tobytes() for row in lexical_features(*batch.columns[1:4])], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), x, *batch.columns[4:]], ["draw", "x", "bin1", "bin2", "label"])


@dataclass
class Trees:
    """Boosted trees of equal depth; a row of ``feature`` and ``cut`` has a tree's inner nodes."""

    base: float = 0.0
    feature: np.ndarray = field(default_factory=lambda: np.empty((0, 2**DEPTH - 1), np.int64))
    cut: np.ndarray = field(default_factory=lambda: np.empty((0, 2**DEPTH - 1)))
    leaf: np.ndarray = field(default_factory=lambda: np.empty((0, 2**DEPTH)))

    def logits(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += leaf[node - inner] if len(x) else 0
        return out


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Newton boosting on the logistic loss over at most ``LEVELS`` bins per feature."""
    positive = float(y.sum())
    base = float(np.log((positive + 0.5) / (len(y) - positive + 0.5))) if len(y) else 0.0
    if not 0 < positive < len(y):
        return Trees(base)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, LEVELS)[1:-1], method="lower")) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T, strict=True)], 1)
    width, n_features = LEVELS, x.shape[1]
    logit, found = np.full(len(y), base), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-logit))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(y), np.int64)
        feature, cut = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
        for level in range(depth):
            first, n_nodes = 2**level - 1, 2**level
            at = ((node - first)[:, None] * n_features + np.arange(n_features)) * width + binned
            shape = (n_nodes, n_features, width)
            sums = [np.bincount(at.ravel(), np.repeat(v, n_features), n_nodes * n_features * width).reshape(shape).cumsum(2) for v in (g, h, np.ones(len(y)))]
            gl, hl, nl = sums
            gt, ht, nt = (s[:, :, -1:] for s in sums)
            gain = gl**2 / (hl + RIDGE) + (gt - gl) ** 2 / (ht - hl + RIDGE) - gt**2 / (ht + RIDGE)
            gain = np.where((nl >= LEAST) & (nt - nl >= LEAST), gain, 0).reshape(n_nodes, -1)
            best = gain.argmax(1)
            for k in range(n_nodes):
                f, b = divmod(int(best[k]), width)
                if gain[k, best[k]] > 1e-9 and b < len(cuts[f]):
                    feature[first + k], cut[first + k] = f, cuts[f][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > cut[node])
        node -= 2**depth - 1
        leaf = -RATE * np.bincount(node, g, 2**depth) / (np.bincount(node, h, 2**depth) + RIDGE)
        logit += leaf[node]
        found.append((feature, cut, leaf))
    return Trees(base, *(np.array(part) for part in zip(*found)))


@dataclass
class UrlModel:
    trees: Trees
    rates: np.ndarray  # smoothed block rate of every bin, for the two suffix lengths

    def features(self, url: pa.Array, host: pa.Array, path: pa.Array, bin1: np.ndarray, bin2: np.ndarray) -> np.ndarray:
        return np.column_stack([lexical_features(url, host, path), self.rates[0][bin1], self.rates[1][bin2]])


def _fit(rows: DataFrame, sample: int) -> UrlModel:
    """``rows`` as ``parsed`` gives them."""
    labelled = rows.filter("ruled IS NOT NULL").withColumn("label", (F.col("ruled") == "block").cast("int"))
    rates = np.zeros((2, BINS))
    total = blocked = 0
    for k in (0, 1):
        n, bad = np.zeros(BINS), np.zeros(BINS)
        for at, count, blocks in labelled.groupBy(f"bin{k + 1}").agg(F.count("*"), F.sum("label")).collect():  # BINS rows at most
            n[at], bad[at] = count, blocks
        total, blocked = n.sum(), bad.sum()
        rates[k] = (bad + PRIOR * (blocked + 0.5) / (total + 1)) / (n + PRIOR)
    urls = labelled.select("url", "host", "path", "bin1", "bin2", "label").distinct()  # a url's label follows from itself
    urls = urls.withColumn("draw", F.pmod(F.xxhash64("url"), F.lit(1 << 30)))
    share = min(1.0, sample / max(1, urls.count()))
    chosen = urls.filter(F.col("draw") < int(share * (1 << 30))).select("draw", "url", "host", "path", "bin1", "bin2", "label")
    got = chosen.mapInArrow(_packed_features, "draw long, x binary, bin1 int, bin2 int, label int").toArrow()
    order = np.lexsort((np.array(got.column("x").to_pylist(), dtype=bytes), got.column("draw").to_numpy()))
    got = got.take(pa.array(order))
    model = UrlModel(Trees(), rates)
    lexical = np.frombuffer(b"".join(got.column("x").to_pylist())).reshape(-1, LEXICAL)
    x = np.column_stack([lexical, *(rates[k][got.column(f"bin{k + 1}").to_numpy()] for k in (0, 1))])
    # every third row carries the average rates, as a suffix without labelled urls does, so
    # the trees also learn to judge by the other features
    x[::3, -2:] = (blocked + 0.5) / (total + 1)
    model.trees = fit_trees(x, got.column("label").to_numpy().astype(float))
    return model


def filter_urls(
    pages: DataFrame, rules: Rules = RULES, id_col: str = "page_id", url_col: str = "url", sample: int = SAMPLE
) -> DataFrame:
    """page_id, host, path, rule, verdict and score (the trees' chance of block) of every input row."""
    ship_code(pages.sparkSession)
    rows = written(parsed(pages, rules, id_col, url_col), "urls")
    shared = pages.sparkSession.sparkContext.broadcast(_fit(rows, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            model = shared.value
            x = model.features(*batch.columns[1:4], *(c.to_numpy(zero_copy_only=False) for c in batch.columns[6:8]))
            score = 1 / (1 + np.exp(-np.clip(model.trees.logits(x), -40, 40)))
            judged = pa.array(np.where(score > 0.5, "block", "allow"))
            verdict = pa.compute.coalesce(batch.column(5), judged.cast(batch.column(5).type))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *batch.columns[2:5], verdict, pa.array(score)], ["page_id", "host", "path", "rule", "verdict", "score"]
            )

    return rows.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string, score double")
