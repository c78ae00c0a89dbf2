"""Near-duplicate documents by MinHash, sequential Bayesian verification and exact sets.

A document's set holds its distinct shingles (``shingle`` consecutive words, A-Z
lower-cased; a shorter text is one shingle).  Two documents are linked when
``100 * |A & B| >= 100 * threshold * |A | B|``; components of links are the groups.

1. One pass sketches each text: set size, a 128-bit hash of the set, and a signature of
   ``bands * rows`` minima.  Equal sets are folded to their smallest id by a pre-aggregated
   grouping, so thousands of copies cost one signature from here on.
2. Signatures are cut into bands; equal bands share a bucket.  With 32 bands of 4 a pair at
   similarity 0.75 misses every bucket with probability 5e-6.
3. Candidates are compared signature batch by batch.  After n hashes with m agreeing, the
   similarity's posterior under a uniform prior is Beta(m + 1, n - m + 1); a pair is dropped
   as soon as P(similarity >= threshold) < ``miss``.
4. Survivors are verified on their full sets, read again from the texts.

Candidates never become all pairs of a bucket.  Each document is first verified against the
bucket leader it shares most bands with, which already joins most of a group of copies.
Only buckets whose members are still in different components go on, and of their members only
those that can link there: shingles that open documents of one component alone hold are in no
link to another, which bounds a document's similarity from above.  That groups the open
documents' shingles twice and empties the crowded buckets of families whose members differ
too much.  The rest are compared in blocks of ``BLOCK`` (the signatures of one block pair
meet in a task); a bucket's largest component is only compared with the rest, members
of one component are not compared again, and each document's best candidate is verified.
In the last round all survivors between components that are still apart are verified where
they meet: the sets of the documents with survivors join their block, and only a spanning
forest of the links leaves the task.  No cap drops a pair.  What follows an intermediate
without rows has none either and is not run.

Defined results: null, empty or blank text has an empty set, is linked with nothing and is
kept; a null id gets a null component and is kept; rows that repeat an id are one document
and get one component (they are expected to repeat its text: of differing texts under one id
the one whose set has the smallest hash is compared); one row results per input row; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import merged, spanning_labels, star_edges
from .tables import only_ids, ship_code, written
from .words import Rolling, Texts, mix, signed, slices

SHINGLE, THRESHOLD = 5, 0.75
BANDS, ROWS = 32, 4
BATCH = 32  # signature positions compared at a time
MISS = 1e-5  # chance with which a batch may drop a pair at the threshold
BLOCK = 512  # members of a bucket compared in one block
BLOCK_SCHEMA = "bucket long, doc_id long, component long, chunk int, low_chunk int, high_chunk int, sig binary"
_LOW52 = np.uint64((1 << 52) - 1)


def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    raw = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (raw[:n] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (raw[n:] >> np.uint64(32)).astype(np.uint32)


def shingle_sets(t: Texts, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and 52-bit hash of every distinct shingle, sorted by both."""
    roll = Rolling(t.word_hashes(lower=True))
    at = t.windows(k)
    few = np.flatnonzero((t.n_words > 0) & (t.n_words < k))
    start = np.concatenate((at, t.first[few]))
    end = np.concatenate((at + k, t.first[few + 1]))
    doc = np.concatenate((t.doc_of_word()[at], few)).astype(np.uint64)
    key = np.unique((doc << np.uint64(52)) | (roll.spans(start, end) >> np.uint64(12)))
    return (key >> np.uint64(52)).astype(np.int64), key & _LOW52


def _signatures(h: np.ndarray, begin: np.ndarray, size: int) -> np.ndarray:
    """One row of ``size`` minima for every run of ``h`` (runs begin at ``begin``)."""
    factor, flip = _seeds(size)
    h32 = (mix(h) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(begin), size), np.uint32)
    work = np.empty_like(h32)
    for k in range(size):
        np.bitwise_xor(h32, flip[k], out=work)
        np.multiply(work, factor[k], out=work)
        out[:, k] = np.minimum.reduceat(work, begin)
    return out


def _sums(h: np.ndarray, n: np.ndarray) -> list[pa.Array]:
    """Two hashes of every set; set i has n[i] of the hashes."""
    full, sums = np.flatnonzero(n), []
    for salt in (0, 0xD6E8FEB86659FD93):
        total = np.zeros(len(n), np.uint64)
        if len(h):
            total[full] = np.add.reduceat(mix(h ^ np.uint64(salt)), (np.cumsum(n) - n)[full])
        sums.append(signed(total))
    return sums


def _sketches(k: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, t in slices(batch.column(1)):
                doc, h = shingle_sets(t, k)
                n = np.bincount(doc, minlength=t.n)
                full = np.flatnonzero(n)
                sums = _sums(h, n)
                sig: list[bytes | None] = [None] * t.n
                if len(h):
                    rows = _signatures(h, (np.cumsum(n) - n)[full], size)
                    for i, row in zip(full, rows, strict=True):
                        sig[i] = row.tobytes()
                arrays = [batch.column(0).slice(lo, hi - lo), pa.array(n.astype(np.int64)), *sums, pa.array(sig, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_shingles", "s1", "s2", "sig"])

    return run


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, size)


def _buckets(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = _matrix(batch.column(1), bands * rows).reshape(-1, bands, rows).astype(np.uint64)
            key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), sig.shape[:2])
            for r in range(rows):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, :, r])
            ids = np.repeat(batch.column(0).to_numpy(), bands)
            n = np.repeat(batch.column(2).to_numpy(), bands)
            yield pa.RecordBatch.from_arrays([signed(np.ascontiguousarray(key).ravel()), pa.array(ids), pa.array(n)], ["bucket", "doc_id", "n"])

    return run


def least_matches(n: int, threshold: float, miss: float) -> int:
    """Fewest agreeing hashes among ``n`` for which P(similarity >= threshold) is at least ``miss``.

    With a uniform prior that posterior is P(Binomial(n + 1, threshold) <= m)."""
    total = 0.0
    for m in range(n + 1):
        total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if total >= miss:
            return m
    return n


def _survivors(a: np.ndarray, b: np.ndarray, threshold: float, miss: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the paired signatures that no batch dropped, and their agreeing hashes."""
    alive, same = np.arange(len(a)), np.zeros(len(a), np.int64)
    for end in range(BATCH, a.shape[1] + 1, BATCH):
        part = slice(end - BATCH, end)
        same = same + (a[alive, part] == b[alive, part]).sum(1)
        keep = same >= least_matches(end, threshold, miss)
        alive, same = alive[keep], same[keep]
    return alive, same


def _prune(size: int, threshold: float, miss: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alive, _ = _survivors(_matrix(batch.column(2), size), _matrix(batch.column(3), size), threshold, miss)
            yield pa.RecordBatch.from_arrays([batch.column(k).take(pa.array(alive)) for k in (0, 1)], ["a", "b"])

    return run


def _candidates(group: pa.Table, size: int, threshold: float, miss: float):
    """Rows (left, right) of one block pair that survive, with their agreeing hashes; rows
    whose components are equal are not compared."""
    ids, comp, chunk = (group.column(c).to_numpy() for c in ("doc_id", "component", "chunk"))
    sig = _matrix(group.column("sig"), size)
    first, second = group.column("low_chunk")[0].as_py(), group.column("high_chunk")[0].as_py()
    left, right = np.flatnonzero(chunk == first), np.flatnonzero(chunk == second)
    found = [(np.empty(0, np.int64),) * 3]
    for strip in range(0, len(left), 64):
        rows = left[strip : strip + 64]
        i, j = np.nonzero(comp[rows][:, None] != comp[right][None, :])
        i, j = rows[i], right[j]
        if first == second:
            once = ids[i] < ids[j]
            i, j = i[once], j[once]
        for part in range(0, len(i), 1 << 15):
            x, y = i[part : part + (1 << 15)], j[part : part + (1 << 15)]
            alive, same = _survivors(sig[x], sig[y], threshold, miss)
            found.append((x[alive], y[alive], same))
    i, j, same = (np.concatenate(x) for x in zip(*found))
    return ids, i, j, same


def _best_candidates(size: int, threshold: float, miss: float):
    """For every row of a block pair its best candidate (of equally good ones the smallest id)."""

    def run(group: pa.Table) -> pa.Table:
        ids, i, j, same = _candidates(group, size, threshold, miss)
        a, b, same = np.concatenate((i, j)), np.concatenate((j, i)), np.concatenate((same, same))
        order = np.lexsort((ids[b], -same, a))
        new = np.ones(len(order), bool)
        new[1:] = a[order][1:] != a[order][:-1]
        a, b = ids[a[order[new]]], ids[b[order[new]]]
        return pa.table({"a": pa.array(np.maximum(a, b), pa.int64()), "b": pa.array(np.minimum(a, b), pa.int64())})

    return run


def _with_candidates(size: int, threshold: float, miss: float):
    """The rows of a block pair that have a candidate in it."""

    def run(group: pa.Table) -> pa.Table:
        _, i, j, _ = _candidates(group, size, threshold, miss)
        return group.take(pa.array(np.union1d(i, j)))

    return run


def _links_of_block(size: int, threshold: float, miss: float):
    """A spanning forest of the links between the rows of a block pair, on their full sets."""

    def run(group: pa.Table) -> pa.Table:
        ids, i, j, _ = _candidates(group, size, threshold, miss)
        sets = group.column("shingles").combine_chunks()
        n = sets.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        _, flat = np.unique(sets.flatten().to_numpy(), return_inverse=True)
        begin = np.cumsum(n) - n
        links = np.zeros((len(ids), len(ids)), bool)
        mark = np.zeros(int(flat.max(initial=-1)) + 1, np.int64)
        order = np.argsort(i, kind="stable")
        i, j = i[order], j[order]
        for a in np.unique(i):  # candidates of one row against the marked set of that row
            others = j[np.searchsorted(i, a) : np.searchsorted(i, a, "right")]
            mark[flat[begin[a] : begin[a] + n[a]]] = 1
            for part in range(0, len(others), 64):
                some = others[part : part + 64]
                edge = np.cumsum(n[some]) - n[some]
                at = np.arange(int(n[some].sum())) + np.repeat(begin[some] - edge, n[some])
                both = np.add.reduceat(mark[flat[at]], edge)
                links[a, some] = 100 * both >= round(100 * threshold) * (n[a] + n[some] - both)
            mark[flat[begin[a] : begin[a] + n[a]]] = 0
        every = np.arange(len(ids))
        label = spanning_labels(ids, every, every, links | links.T)
        far = label != ids
        return pa.table({"a": pa.array(ids[far], pa.int64()), "b": pa.array(label[far], pa.int64())})

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, t in slices(batch.column(1)):
                doc, h = shingle_sets(t, k)
                n = np.bincount(doc, minlength=t.n)
                sets = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)).astype(np.int32)), signed(h))
                arrays = [batch.column(0).slice(lo, hi - lo), *_sums(h, n), sets]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "s1", "s2", "shingles"])

    return run


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    threshold: float = THRESHOLD,
    bands: int = BANDS,
    rows: int = ROWS,
    miss: float = MISS,
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (the component's smallest id) of every row."""
    ship_code(docs.sparkSession)
    size = bands * rows
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    sketch = written(
        texts.mapInArrow(_sketches(shingle, size), "doc_id long, n_shingles long, s1 long, s2 long, sig binary"), "minhash-sketch"
    )
    full = sketch.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    same = ["s1", "s2", "n_shingles"]
    classes = full.groupBy(*same).agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    classes = written(classes.filter("low < high").drop("high"), "minhash-classes")
    copy_links = written(
        full.select("doc_id", *same).join(classes, same).filter("doc_id > low").select(F.col("doc_id").alias("a"), F.col("low").alias("b")),
        "minhash-copies",
    )

    ones = only_ids(full.select("doc_id", "n_shingles", "s1", "s2", "sig"), copy_links.select(F.col("a").alias("doc_id")).distinct(), "doc_id", "left_anti")
    buckets = ones.select("doc_id", "sig", "n_shingles").mapInArrow(_buckets(bands, rows), "bucket long, doc_id long, n long")
    crowded = buckets.groupBy("bucket").agg(F.min("doc_id").alias("leader"), F.max("doc_id").alias("high"))
    crowded = written(crowded.filter("leader < high").drop("high"), "minhash-buckets")
    members = written(buckets.join(crowded, "bucket").groupBy("bucket", "doc_id", "leader").agg(F.min("n").alias("n")), "minhash-members")
    member_ids = written(members.select("doc_id").distinct(), "minhash-member-ids")
    # of differing texts under one id, the one with the smallest sums is compared, here and below
    near = only_ids(ones, member_ids, "doc_id").groupBy("doc_id").agg(F.min(F.struct("s1", "s2", "sig")).alias("least"))
    sigs = written(near.select("doc_id", "least.sig"), "minhash-signatures")

    def sets_of(ids: DataFrame) -> DataFrame:
        found = only_ids(texts, written(ids.distinct(), "minhash-set-ids"), "doc_id")
        sets = found.mapInArrow(_sets(shingle), "doc_id long, s1 long, s2 long, shingles array<long>").filter(F.size("shingles") > 0)
        sets = sets.groupBy("doc_id").agg(F.min(F.struct("s1", "s2", "shingles")).alias("least"))
        return written(sets.select("doc_id", "least.shingles"), "minhash-sets")

    def verified(pairs: DataFrame) -> DataFrame:
        """Links among the pairs (a, b), on their full sets."""
        pairs = written(pairs.distinct(), "minhash-survivors")
        if pairs.isEmpty():
            return pairs
        sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")))
        both = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")), "a")
        both = both.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y")), "b")
        shared = both.select("a", "b", F.size(F.array_intersect("x", "y")).alias("n"), (F.size("x") + F.size("y")).alias("total"))
        linked = F.col("n") * 100 >= round(100 * threshold) * (F.col("total") - F.col("n"))
        return written(shared.filter(linked).select("a", "b"), "minhash-links")

    counts = members.filter("doc_id > leader").groupBy("doc_id", "leader").count()
    best = counts.groupBy("doc_id").agg(F.max_by("leader", F.struct("count", -F.col("leader"))).alias("b"))
    both = best.select(F.col("doc_id").alias("a"), "b").join(sigs.select(F.col("doc_id").alias("a"), F.col("sig").alias("sig_a")), "a")
    both = both.join(sigs.select(F.col("doc_id").alias("b"), F.col("sig").alias("sig_b")), "b")
    links = verified(both.select("a", "b", "sig_a", "sig_b").mapInArrow(_prune(size, threshold, miss), "a long, b long"))

    def linkable(apart: DataFrame) -> DataFrame:
        """Rows of the documents that can link in a bucket: what a document shares with another
        component is held by two at least, and none it meets has fewer than ``least`` shingles."""
        if apart.isEmpty():
            return apart
        percent, sets = round(100 * threshold), sets_of(apart.select("doc_id"))
        for _ in range(2):  # documents that are out no longer hold shingles
            open_ids = apart.groupBy("doc_id", "component").agg(F.min("least").alias("least"))
            held = sets.join(written(open_ids, "minhash-open-ids"), "doc_id")
            held = held.select("doc_id", "component", "least", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
            between = held.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
            found = held.join(between, "shingle", "left_semi").groupBy("doc_id", "least", "n").agg(F.count("*").alias("shared"))
            union = F.col("n") + F.greatest(F.col("least") - F.col("shared"), F.lit(0))
            found = written(found.filter(F.col("shared") * 100 >= percent * union).select("doc_id"), "minhash-linkable-ids")
            apart = _apart(only_ids(apart.select("bucket", "doc_id", "n"), found, "doc_id"), groups)
            if apart.isEmpty():
                break
        return apart

    limits, groups = (size, threshold, miss), star_edges(links)
    apart = linkable(_apart(members, groups))
    blocks = _blocks(apart, sigs)
    if not apart.isEmpty():
        groups = merged(groups, verified(blocks.applyInArrow(_best_candidates(*limits), "a long, b long")))
        apart = _apart(apart.select("bucket", "doc_id", "n"), groups)
    blocks, rest = _blocks(apart, sigs), copy_links
    if not apart.isEmpty():
        left = written(blocks.applyInArrow(_with_candidates(*limits), BLOCK_SCHEMA), "minhash-open")
        if not left.isEmpty():
            left = left.join(sets_of(left.select("doc_id")), "doc_id").groupBy("bucket", "low_chunk", "high_chunk")
            rest = rest.union(written(left.applyInArrow(_links_of_block(*limits), "a long, b long"), "minhash-links"))

    groups = merged(groups, rest).withColumnRenamed("node", "doc_id")
    out = sketch.select("doc_id", "n_shingles").join(groups, "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def _apart(members: DataFrame, groups: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one component; a bucket has ``chunks`` of members
    outside its largest component (``main``), ``main_chunks`` of members in it, and ``least``
    shingles in its smallest member."""
    named = members.join(groups.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    named = named.select("bucket", "doc_id", "n", F.coalesce("component", "doc_id").alias("component"))
    counts = named.groupBy("bucket", "component").agg(F.count("*").alias("members"), F.min("n").alias("least"))
    mixed = counts.groupBy("bucket").agg(
        F.max_by("component", F.struct("members", "component")).alias("main"), F.max("members").alias("most"),
        F.sum("members").alias("all"), F.min("least").alias("least"),
    )
    chunks = F.ceil((F.col("all") - F.col("most")) / BLOCK).cast("int"), F.ceil(F.col("most") / BLOCK).cast("int")
    mixed = mixed.filter(F.col("most") < F.col("all")).select("bucket", "main", "least", chunks[0].alias("chunks"), chunks[1].alias("main_chunks"))
    return written(named.join(written(mixed, "minhash-mixed"), "bucket"), "minhash-apart")


def _blocks(apart: DataFrame, sigs: DataFrame):
    """Every member with its signature, once for every block pair it takes part in; no block
    pair lies inside the largest component."""
    main, number = F.col("component") == F.col("main"), F.xxhash64("doc_id")
    chunk: Column = F.when(main, F.col("chunks") + F.pmod(number, F.col("main_chunks"))).otherwise(F.pmod(number, F.col("chunks")))
    last = F.when(main, F.col("chunks")).otherwise(F.col("chunks") + F.col("main_chunks")) - 1
    rows = apart.withColumn("chunk", chunk.cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    rows = rows.withColumn("low_chunk", F.least("chunk", "other")).withColumn("high_chunk", F.greatest("chunk", "other"))
    rows = rows.join(sigs, "doc_id").select("bucket", "doc_id", "component", "chunk", "low_chunk", "high_chunk", "sig")
    return rows.groupBy("bucket", "low_chunk", "high_chunk")
