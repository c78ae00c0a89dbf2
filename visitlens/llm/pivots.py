"""Near-duplicate embeddings by a pivot-permutation index.

Vectors are described by the order of their nearest reference points (pivots), the prefix of
a permutation.  Similar vectors share most of that prefix, so candidates are vectors that
share at least two pivots: the inverted lists are kept per pair of pivots, and a pair of
vectors is looked at in the list of its two smallest shared pivots only, which the
shared-pivot counts below that list decide.  Every candidate's cosine is then taken in
double precision, so no link is below the threshold.

Pivots are directions seen from the mean of a bounded sample, since real embeddings share a
common direction that would make all prefixes alike.  Number of pivots and prefix length are
calibrated on the sample: among settings in which at least ``RECALL`` of made-up partners
exactly at the threshold share two pivots, the one with the least work is taken (random
pairs that share two, and lists a vector is written to).

Dense groups would fill the prefixes of their members with pivots of their own.  So no two
pivots are within a radius rho, and every pivot has one more list, of all vectors within rho
(its close vectors), which is compared in full.  A vector within rho less the threshold's
distance of a pivot has all its links in that list (triangle inequality), so it is in no
list of pairs; pairs that share several close pivots belong to the smallest, and vectors
that share one are not compared in lists of pairs.  rho is twice the threshold's distance,
or less where more than one in as many sampled pairs as there are pivots are that close, so a
list holds about n / pivots vectors besides its dense group.

Scale: pivots are a bounded sample of the vectors (about sqrt(n / 3) times 1 to 8, so lists
keep their mean length as n grows; ``MAX_PIVOTS`` and ``PIVOT_BYTES`` at most), filled up with
random directions where the sample leaves too few.  Equal vectors are folded to one row with
a count by a pre-aggregated grouping before anything else.  A list longer than ``BLOCK`` is
compared in blocks dealt to different tasks; within a block only link counts and a spanning
forest leave the task, never pairs.  What costs more than a list's length are vectors close
to one pivot: a group of g near copies takes g * g comparisons in all, because every link
counts in ``n_links``.

Defined results: vectors that are null, empty or zero, or hold null or non-finite
components, or differ in length from the most frequent length (the smallest of equally
frequent ones), link with nothing and are kept; rows that repeat an id and its vector count
as one vector; a null id gets a null component, links with nothing and is kept; one row
results per input row; doubles of any size are scaled by a power of two before they are
squared; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components, spanning_labels
from .tables import ship_code, written

THRESHOLD, BLOCK = 0.9, 1024
MIN_PIVOTS, MAX_PIVOTS, PIVOT_BYTES = 64, 1 << 16, 64 << 20
#: Share of partners at the threshold that must be candidates; longest prefix tried.
RECALL, LONGEST = 0.994, 28
#: Sampled vectors that calibrate; comparisons that cost as much as one posting.
CALIBRATED, POSTING_COST = 1500, 8
#: Rows of a list that share a close pivot from which they are left out together.
DENSE = 32
#: Rows of short lists that one task compares at a time, about.
PACKED = 8192


def _rows(column: pa.Array, size: int, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, size)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(float)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _scaled(x: np.ndarray) -> np.ndarray:
    """The vector times a power of two, its largest component between 1/2 and 1."""
    return np.ldexp(x, -int(np.frexp(np.abs(x).max(initial=0))[1]))


def distance(cosine: float) -> float:
    """Of unit vectors at the cosine."""
    return float(np.sqrt(max(0.0, 2 - 2 * np.clip(cosine, -1, 1))))


def cosine_within(radius: float) -> float:
    """Cosine of unit vectors at the distance, a little lower to allow for rounding."""
    return 1 - radius * radius / 2 - 1e-9


def thinned(x: np.ndarray, most: int, cosine: float) -> np.ndarray:
    """Up to ``most`` unit vectors of the rows, in order, no two at the cosine or above."""
    kept = np.empty((min(most, len(x)), x.shape[1]))
    n = 0
    for part in range(0, len(x), 512):
        some = _unit(x[part : part + 512])
        free = ~(some @ kept[:n].T >= cosine).any(1)
        some = some[free]
        near = some @ some.T >= cosine
        left = np.ones(len(some), bool)
        for i in range(len(some)):
            if left[i] and n < len(kept):
                kept[n] = some[i]
                n += 1
                left &= ~near[i]
    return kept[:n]


def close_radius(sample: np.ndarray, n_pivots: int, threshold: float) -> float:
    """rho: twice the threshold's distance, or the distance below which one in ``n_pivots`` pairs
    of the sample lies, if that is less; dense groups count once, and it is not below the
    threshold's distance."""
    reach = distance(threshold)
    apart = thinned(sample, CALIBRATED, cosine_within(reach))
    if len(apart) < 32:
        return 2 * reach
    cosines = (apart @ apart.T)[np.triu_indices(len(apart), 1)]
    usual = distance(float(np.quantile(cosines, max(0.0, 1 - 1 / n_pivots))))
    return min(2 * reach, max(reach, usual))


class Pivots:
    """Directions for prefixes, seen from ``mean``; points with close lists, and their radius."""

    def __init__(self, sample: np.ndarray, n_pivots: int, threshold: float):
        size = sample.shape[1]
        units = _unit(sample) if len(sample) else np.empty((0, size))
        self.mean = units.mean(0) if len(units) else np.zeros(size)
        if 1 - self.mean @ self.mean < 1e-6:  # all but one direction: nothing is left of it
            self.mean = np.zeros(size)
        reach = distance(threshold)
        self.radius = close_radius(units, n_pivots, threshold)
        self.close_cosine, self.covered_cosine = cosine_within(self.radius), 1 - max(0.0, self.radius - reach) ** 2 / 2
        self.points = thinned(units, n_pivots, self.close_cosine)
        seen = self.points - self.mean
        seen = seen[(seen * seen).sum(1) > 1e-12]
        fill = np.random.default_rng(0).normal(size=(n_pivots, size))
        fill = np.concatenate((fill, -fill[:1]))
        directions = np.concatenate((_unit(seen), thinned(fill, n_pivots + 1, 1 - 1e-9)))
        self.directions = directions[: max(n_pivots, 1)]
        self.k = len(self.directions)

    def nearest(self, units: np.ndarray, k: int) -> np.ndarray:
        """Numbers of the ``k`` nearest directions of unit vectors, nearest first."""
        seen = (units - self.mean) @ self.directions.T
        part = np.argpartition(-seen, k - 1, axis=1)[:, :k]
        return np.take_along_axis(part, np.argsort(-np.take_along_axis(seen, part, 1), 1, kind="stable"), 1)

    def describe(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Prefixes of the rows, ascending; row and pivot of all close pairs; whether a row's
        links are all in a close list."""
        near, covered = np.empty((len(x), self.k), np.int64), np.zeros(len(x), bool)
        rows, close = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for part in range(0, len(x), 512):
            units = _unit(x[part : part + 512])
            near[part : part + 512] = np.sort(self.nearest(units, self.k), 1)
            if len(self.points):
                cosines = units @ self.points.T
                covered[part : part + 512] = cosines.max(1) >= self.covered_cosine
                row, pivot = np.nonzero(cosines >= self.close_cosine)
                rows.append(row + part)
                close.append(pivot)
        return near, np.concatenate(rows), np.concatenate(close), covered


def _shared(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Shared pivots of every row of ``a`` with the same row of ``b``, by prefix length."""
    place = np.full((len(a), n), 1 << 20, np.int32)
    np.put_along_axis(place, a, np.broadcast_to(np.arange(a.shape[1], dtype=np.int32), a.shape), 1)
    joint = np.maximum(np.take_along_axis(place, b, 1), np.arange(b.shape[1]))  # prefix length that holds both, less 1
    return np.stack([(joint < k).sum(1) for k in range(1, a.shape[1] + 1)], 1)


def calibrated(sample: np.ndarray, n: int, base: int, most: int, threshold: float) -> Pivots:
    """The pivots and prefix length of least work that find ``RECALL`` of partners at the threshold."""
    rng = np.random.default_rng(1)
    apart = min(CALIBRATED, len(sample) // 3)  # these are no pivots, which would find themselves
    units, sample = _unit(sample[: max(apart, min(len(sample), 100))]), sample[apart:]
    noise = rng.normal(size=units.shape)
    noise -= (noise * units).sum(1, keepdims=True) * units
    length = np.sqrt((noise * noise).sum(1, keepdims=True))
    partners = threshold * units + np.sqrt(1 - threshold**2) * np.divide(noise, length, out=np.zeros_like(noise), where=length > 0)
    best, cost = None, np.inf
    for n_pivots in sorted({min(most, base * m) for m in (1, 2, 4, 8)}):
        made = Pivots(sample, n_pivots, threshold)
        longest = min(LONGEST, len(made.directions))
        if not len(units):
            made.k = min(8, longest)
            return made
        own, other = made.nearest(units, longest), made.nearest(_unit(partners), longest)
        found = (_shared(own, other, len(made.directions)) >= 2).mean(0)
        enough = np.flatnonzero(found >= RECALL)
        made.k = int(enough[0]) + 1 if len(enough) else longest
        chance = np.mean([(_shared(own, np.roll(own, shift, 0), len(made.directions))[:, made.k - 1] >= 2).mean() for shift in (1, 7, 31, 101)])
        work = chance * n / 2 + POSTING_COST * made.k * (made.k - 1) / 2 + (0 if len(enough) else n)
        if work < cost:
            best, cost = made, work
    return best


def _postings(shared, kind: type, lists_only: bool = False):
    """One row per vector and list of it: list, id, count, vector, nearest and close pivots.
    List a * (number of directions) + b is that of the pair a < b; list -1 - p that of the
    close vectors of point p.  With ``lists_only`` the first column only."""
    names = ["list", "vec_id", "copies", "vec", "near", "close"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = shared.value
        pairs, n_pivots = list(combinations(range(pivots.k), 2)), len(pivots.directions)
        for batch in batches:
            if not batch.num_rows:
                continue
            near, row, pivot, covered = pivots.describe(_rows(batch.column(2), len(pivots.mean), kind))
            if lists_only:
                open_ones = near[~covered]
                keys = [-1 - pivot, *(open_ones[:, a] * n_pivots + open_ones[:, b] for a, b in pairs)]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys))], ["list"])
                continue
            ends = np.searchsorted(row, np.arange(len(near) + 1))
            packed = [pa.array([r.tobytes() for r in near.astype(np.uint16)], pa.binary())]
            packed.append(pa.array([pivot[i:j].astype(np.uint16).tobytes() for i, j in zip(ends, ends[1:])], pa.binary()))
            whole = pa.RecordBatch.from_arrays([*batch.columns, *packed], names[1:])
            yield pa.RecordBatch.from_arrays([pa.array(-1 - pivot), *whole.take(pa.array(row)).columns], names)
            open_ones = np.flatnonzero(~covered)
            whole, near = whole.take(pa.array(open_ones)), near[open_ones]
            for a, b in pairs:
                key = near[:, a] * n_pivots + near[:, b]
                yield pa.RecordBatch.from_arrays([pa.array(key), *whole.columns], names)

    return run


def _marks(close: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Row and number of every packed mark."""
    rows = np.repeat(np.arange(len(close)), [len(c) // 2 for c in close])
    return rows, np.frombuffer(b"".join(close), np.uint16).astype(np.int64)


def _meeting(rows: np.ndarray, marks: np.ndarray, n: int) -> np.ndarray:
    """One row of 0 and 1 per vector; two vectors share a mark if their product is not 0."""
    used, column = np.unique(marks, return_inverse=True)
    out = np.zeros((n, len(used)), np.float32)
    out[rows, column] = 1
    return out


def _compare(size: int, kind: type, k: int, n_pivots: int, threshold: float):
    """Links between the two chunks of a block that belong to this list: one row for every
    vector with such links, the smallest id it reaches by them, and their number."""

    def block(group: pa.Table) -> pa.Table:
        ids, copies, chunk = (group.column(c).to_numpy() for c in ("vec_id", "copies", "chunk"))
        number = group.column("list")[0].as_py()
        low, high = group.column("low_chunk")[0].as_py(), group.column("high_chunk")[0].as_py()
        x = _unit(_rows(group.column("vec"), size, kind))
        rows, marks = _marks(group.column("close").to_pylist())
        together = np.full(len(x), -1)  # vectors with one number are not compared here
        if number < 0:  # pairs that share a smaller close pivot belong to its list
            earlier = marks < -1 - number
            rows, marks = rows[earlier], marks[earlier]
        else:  # and so do pairs that share any, or an earlier pair of pivots
            first, second = divmod(number, n_pivots)
            together[rows[::-1]] = marks[::-1]  # a vector's smallest close pivot
            near = _rows(group.column("near"), k, np.uint16)
            more, places = np.nonzero((near < second) & (near != first))
            rows, marks = np.append(rows, more), np.append(marks, (1 << 16) + near[more, places].astype(np.int64))
        earlier = _meeting(rows, marks, len(x))
        left, right = np.flatnonzero(chunk == low), np.flatnonzero(chunk == high)
        links = np.zeros((len(left), len(right)), bool)
        many = np.bincount(together[left] + 1)
        for one in [-1, *(np.flatnonzero(many[1:] >= DENSE).tolist())]:
            if one < 0:
                big = np.append(True, many[1:] < DENSE)  # of no dense group
                i, j = np.flatnonzero(big[together[left] + 1]), np.arange(len(right))
            else:
                i, j = np.flatnonzero(together[left] == one), np.flatnonzero(together[right] != one)
            if len(i) and len(j):
                a, b = left[i], right[j]
                links[np.ix_(i, j)] = (x[a] @ x[b].T >= threshold) & (earlier[a] @ earlier[b].T == 0)
        if low == high:
            np.fill_diagonal(links, False)
        counts = np.zeros(len(x), np.int64)
        counts[left] += links @ copies[right]
        if low != high:
            counts[right] += links.T @ copies[left]
        label = spanning_labels(ids, left, right, links)
        some = counts > 0
        return pa.table({"a": pa.array(ids[some], pa.int64()), "b": pa.array(label[some], pa.int64()), "links": pa.array(counts[some], pa.int64())})

    def run(group: pa.Table) -> pa.Table:
        """A group is one block of a long list, or several short lists."""
        number = group.column("list").to_numpy()
        order = np.argsort(number, kind="stable")
        cuts = np.flatnonzero(np.diff(number[order])) + 1
        if not len(cuts):
            return block(group)
        group = group.take(pa.array(order)).combine_chunks()
        edges = [0, *cuts.tolist(), len(number)]
        return pa.concat_tables([block(group.slice(a, b - a)) for a, b in zip(edges, edges[1:])])

    return run


def _packed(kind: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec = [(np.asarray(v, kind) if kind is np.float32 else _scaled(np.asarray(v, kind))).tobytes() for v in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(vec, pa.binary())], ["vec_id", "h1", "h2", "vec"])

    return run


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
    nearest: int | None = None,
    pivots: int | None = None,
) -> DataFrame:
    """vec_id, n_links, component_id and kept (the component's smallest id) of every row."""
    spark = vectors.sparkSession
    ship_code(spark)
    kind = np.float32 if vectors.schema[vector_col].dataType == T.ArrayType(T.FloatType()) else np.float64
    element = "float" if kind is np.float32 else "double"
    vec = vectors[vector_col].cast(f"array<{element}>")
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vec.alias("vec"))
    bad = F.exists("vec", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    useful = F.coalesce(~bad & F.exists("vec", lambda c: c != 0), F.lit(False)) & F.col("vec_id").isNotNull()
    hashes = [F.xxhash64("vec").alias("h1"), F.xxhash64("vec", F.lit(1)).alias("h2")]
    rows = rows.select("vec_id", F.when(useful, F.col("vec")).alias("vec"))
    sizes = rows.filter("vec IS NOT NULL").groupBy(F.size("vec").alias("size")).count()
    usual = sizes.orderBy(F.col("count").desc(), "size").first()
    size = usual["size"] if usual else 1
    rows = rows.select("vec_id", F.when(F.size("vec") == size, F.col("vec")).alias("vec")).select("vec_id", *hashes, "vec")
    good = rows.filter("vec IS NOT NULL").mapInArrow(_packed(kind), "vec_id long, h1 long, h2 long, vec binary")
    classes = good.dropDuplicates(["vec_id", "h1", "h2"]).groupBy("h1", "h2")
    classes = written(classes.agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"), F.any_value("vec").alias("vec")), "pivot-vectors")

    n = classes.count()
    most = pivots or min(MAX_PIVOTS, max(MIN_PIVOTS, PIVOT_BYTES // (8 * size)))
    base = pivots or max(MIN_PIVOTS, min(most, ceil(sqrt(n / 3))))
    asked = min(most, base * 8) + CALIBRATED
    share = min(1.0, 1.2 * asked / max(1, n))
    sample = classes.filter(F.pmod(F.xxhash64("h1", F.lit("pivot")), F.lit(1 << 30)) < int(share * (1 << 30)))
    found = [r["vec"] for r in sample.select("h1", "h2", "vec").orderBy("h1", "h2").limit(asked).collect()]
    points = np.frombuffer(b"".join(map(bytes, found)), kind).reshape(-1, size)
    index = calibrated(points, n, base, most, threshold)
    index.k = min(nearest or index.k, len(index.directions))

    schema = "list long, vec_id long, copies long, vec binary, near binary, close binary"
    described = classes.select("vec_id", "copies", "vec").repartition(spark.sparkContext.defaultParallelism * 2, "vec_id")
    shared = spark.sparkContext.broadcast(index)
    postings = described.mapInArrow(_postings(shared, kind), schema)
    lists = described.mapInArrow(_postings(shared, kind, True), "list long").groupBy("list").agg(F.count("*").alias("n")).filter("n > 1")
    lists = written(lists.select("list", "n", F.ceil(F.col("n") / BLOCK).cast("int").alias("chunks")), "pivot-lists")
    packs = max(1, (lists.filter("chunks = 1").agg(F.sum("n")).first()[0] or 0) // PACKED)
    pack = F.when(F.col("chunks") > 1, F.col("list")).otherwise(F.pmod(F.xxhash64("list"), F.lit(packs)))
    lists = lists.select("list", "chunks", (F.col("chunks") > 1).alias("long"), pack.alias("pack"))
    dealt = postings.join(lists, "list").withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.col("chunks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = dealt.withColumn("low_chunk", F.least("chunk", "other")).withColumn("high_chunk", F.greatest("chunk", "other"))
    blocks = dealt.drop("other", "chunks").groupBy("long", "pack", "low_chunk", "high_chunk")  # short lists are compared some at a time
    links = written(blocks.applyInArrow(_compare(size, kind, index.k, len(index.directions), threshold), "a long, b long, links long"), "pivot-links")

    groups = components(links.select("a", "b")).select(F.col("node").alias("rep"), "component")
    counts = links.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    named = classes.select("h1", "h2", F.col("vec_id").alias("rep"), "copies")
    named = written(named.join(groups, "rep", "left").join(counts, "rep", "left"), "pivot-classes")
    usable = F.col("vec").isNotNull()
    out = rows.select("vec_id", *(F.when(usable, F.col(c)).alias(c) for c in ("h1", "h2"))).join(named, ["h1", "h2"], "left")
    n_links = F.coalesce(F.coalesce("links", F.lit(0)) + F.col("copies") - 1, F.lit(0)).cast("long")
    component = F.coalesce("component", "rep", "vec_id")
    return out.select("vec_id", n_links.alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
