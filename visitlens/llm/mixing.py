"""Mixing sources to target weights by entropy balancing.

Every source gets a target of tokens (words).  Document rates come from the convex problem:
stay as close as possible, in relative entropy, to the reference in which every one of the
``max_copies`` chances of a document comes up half the time, under one token constraint per
source.  Its solution is an exponential tilt, ``rate = max_copies * s(lam * size / mean)``
with s the logistic function and ``lam`` the dual variable of the document's source, so no
rate passes ``max_copies``.  The dual is solved by Newton iterations, safeguarded by a
bracket; each is one grouping over a histogram, and only two numbers reach the driver.

Rates are then rounded into whole copies so that each source's tokens land near its target:
size cell by size cell (large first) the copies are rounded and the remainder carried to
the next cell; inside a cell, documents are taken in the order of a hash of their id, size
and text.  Rows equal in id, source and text are folded to one row with a count, which takes
as many consecutive places, so reruns agree whatever ids are null or repeated.

Scale: the texts are read once for their sizes.  The histogram has one row per source and
size cell (sizes up to 4096 are cells of their own, larger ones 64 cells per doubling), so
a hot source is as small as any other after map-side aggregation, and the carried rounding
sees at most a few thousand rows per source.  Cells with many documents are dealt into
subcells of about ``SUBCELL`` documents before any ranking, so no window holds a hot group.
Sources are ranked in sampled buckets of their names, so there may be many.

Rates follow a document's own size up to 4096 words and its cell's mean beyond (cells are 1.1 %
wide).  A dual that does not converge in ``ROUNDS`` steps raises an error.

Defined results: a null or blank text has size 0 and takes nothing; a very long text needs
memory for itself only; null is a source of its
own, last in order; rows that repeat an id are rows of their own; a source of size 0 has
target 0; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import measured_bytes
from ..operators.ranking import bucket_offsets, split_large_groups
from .tables import BROADCAST_BYTES, ship_code, written
from .words import byte_view, slices

WEIGHTS, SHARE, MAX_COPIES = (5.0, 2.0, 1.0), 1.5, 2
SUBCELL = 1000
ROUNDS = 60  # at most; the bracket halves when Newton does not help
TOLERANCE = 1e-7  # of the target


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets, _ = byte_view(batch.column(2))
        digests = [blake2b(data[a:b].tobytes(), digest_size=8).digest() for a, b in zip(offsets.tolist(), offsets[1:].tolist())]
        digest = np.frombuffer(b"".join(digests), np.int64)
        for lo, hi, t in slices(batch.column(2)):
            kept = [batch.column(k).slice(lo, hi - lo) for k in (0, 1)]
            arrays = [*kept, pa.array(t.n_words.astype(np.int64)), pa.array(digest[lo:hi])]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "source", "size", "digest"])


def source_targets(sources: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """``sources`` (source, source_size) with sid (rank by code point, null last) and target."""
    named = sources.withColumns({"every": F.lit(1), "unnamed": F.col("source").isNull()})
    named = split_large_groups(named, ["every"], ["unnamed", "source"])
    offsets = bucket_offsets(named, ["every"], ["_bucket"]).select("_bucket", "rows_before")
    within = Window.partitionBy("_bucket").orderBy("unnamed", "source")
    ranked = named.join(offsets, "_bucket").withColumn("sid", (F.col("rows_before") + F.row_number().over(within)).cast("long"))
    ranked = ranked.select("source", "source_size", "sid")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weight = F.element_at(cycle, (F.pmod(F.col("sid") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = written(ranked.withColumn("weight", weight), "mix-sources")
    limit = F.col("source_size") * F.lit(float(cap))
    budget = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    level = 0.0
    while True:  # reshare the excess of capped sources until none is above its limit
        above = F.col("weight") * F.lit(level) >= limit
        capped, free = ranked.agg(
            F.sum(F.when(above, limit).otherwise(0.0)), F.sum(F.when(above, 0.0).otherwise(F.col("weight")))
        ).first()
        new = (budget - capped) / free if free else level
        if not free or new <= level:
            break
        level = new
    return ranked.withColumn("target", F.least(F.col("weight") * F.lit(level), limit))


def _rate(cap: float) -> Column:
    return F.lit(float(cap)) / (F.lit(1.0) + F.exp(-F.col("lam") * F.col("x")))


def solve_dual(cells: DataFrame, sources: DataFrame, cap: float) -> DataFrame:
    """sid and the dual variable ``lam`` of every source whose target is inside (0, cap * size)."""
    inside = sources.filter((F.col("target") > 0) & (F.col("target") < cap * F.col("source_size")))
    state = inside.select(
        "sid", "target", F.lit(0.0).alias("lam"), F.lit(-1e12).alias("low"), F.lit(1e12).alias("high"), F.lit(False).alias("done")
    )
    for _ in range(ROUNDS):
        rate = _rate(cap)
        slope = rate * (1 - rate / cap) * F.col("x")
        sums = cells.join(state.select("sid", "lam"), "sid").groupBy("sid").agg(
            F.sum(F.col("tokens") * rate).alias("got"), F.sum(F.col("tokens") * slope).alias("slope")
        )
        gap = F.col("got") - F.col("target")
        low = F.when(gap < 0, F.col("lam")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("lam")).otherwise(F.col("high"))
        reach = 1 + F.abs("lam")  # at most doubles, so a flat stretch cannot throw the step away
        step = F.coalesce(F.try_divide(gap, F.col("slope")), F.signum(gap) * reach)
        newton = F.col("lam") - F.greatest(-reach, F.least(reach, step))
        stepped = state.join(sums, "sid").withColumns({"low2": low, "high2": high, "newton": newton})
        inside_bracket = (F.col("newton") > F.col("low2")) & (F.col("newton") < F.col("high2"))
        done = F.abs(gap) <= TOLERANCE * F.col("target")
        moved = F.when(inside_bracket, F.col("newton")).otherwise((F.col("low2") + F.col("high2")) / 2)
        state = written(
            stepped.select(
                "sid", "target", F.when(done, F.col("lam")).otherwise(moved).alias("lam"), F.col("low2").alias("low"),
                F.col("high2").alias("high"), done.alias("done"),
            ),
            "mix-dual",
        )
        if state.filter("NOT done").isEmpty():
            return state.select("sid", "lam")
    raise RuntimeError(f"the dual of some sources did not converge in {ROUNDS} steps")


def _round_cells(cap: float):
    def run(cells: pd.DataFrame) -> pd.DataFrame:
        cells = cells.sort_values(["mean", "cell"], ascending=False, kind="stable")
        copies, carried = [], 0.0
        for n, tokens, mean, rate in zip(cells["n"], cells["tokens"], cells["mean"], cells["rate"], strict=True):
            wanted = tokens * rate + carried
            k = int(min(max(np.floor(wanted / mean + 0.5), 0), cap * n)) if mean > 0 else 0
            copies.append(k)
            carried = wanted - k * mean
        return pd.DataFrame({"sid": cells["sid"], "cell": cells["cell"], "n": cells["n"], "copies": copies, "rate": cells["rate"]})

    return run


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    max_copies: int = MAX_COPIES,
) -> DataFrame:
    """doc_id, size, source_size, target, taken, source, copies and rate of every input row."""
    ship_code(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[source_col].cast("string").alias("source"), docs[text_col].alias("text"))
    sized = rows.mapInArrow(_sizes, "doc_id long, source string, size long, digest long")
    sized = written(sized.groupBy("doc_id", "source", "size", "digest").agg(F.count("*").alias("rows")), "mix-sizes")
    sources = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    sources = written(source_targets(sources, weights, share, max_copies), "mix-targets")
    size = F.col("size").cast("double")
    cell = F.when(F.col("size") <= 4096, F.col("size")).otherwise(4097 + F.floor(F.log2(size / 4096) * 64))
    keys = sources.select(F.col("source").alias("named"), "sid", "source_size", "target")
    if measured_bytes(keys)[1] <= BROADCAST_BYTES:
        keys = F.broadcast(keys)
    placed = sized.withColumn("cell", cell).join(keys, F.col("source").eqNullSafe(F.col("named"))).drop("named")
    cells = placed.groupBy("sid", "cell").agg(F.sum("rows").alias("n"), F.sum(F.col("size") * F.col("rows")).alias("tokens"))
    per_source = sources.select("sid", "source_size").join(placed.groupBy("sid").agg(F.sum("rows").alias("docs")), "sid")
    scale = per_source.select("sid", (F.col("source_size") / F.col("docs")).alias("scale"))
    cells = cells.join(scale, "sid").withColumn("mean", F.col("tokens") / F.col("n"))
    cells = written(cells.withColumn("x", F.coalesce(F.try_divide("mean", "scale"), F.lit(0.0))), "mix-cells")

    dual = solve_dual(cells, sources, max_copies)
    rated = cells.join(dual, "sid", "left").join(sources.select("sid", "target"), "sid")
    rate = F.when(F.col("target") <= 0, 0.0).when(F.col("lam").isNull(), float(max_copies)).otherwise(_rate(max_copies))
    rated = rated.select("sid", "cell", "n", "tokens", "mean", rate.alias("rate"))
    schema = "sid long, cell long, n long, copies long, rate double"
    rounded = written(rated.groupBy("sid").applyInPandas(_round_cells(max_copies), schema), "mix-copies")

    dealt = placed.join(rounded, ["sid", "cell"]).withColumn("draw", F.xxhash64("doc_id", "size", "digest", F.lit("mix")))
    dealt = dealt.withColumn("sub", F.pmod(F.xxhash64("draw"), F.ceil(F.col("n") / SUBCELL)))
    subs = dealt.groupBy("sid", "cell", "sub").agg(F.sum("rows").alias("m"), F.first("n").alias("n"), F.first("copies").alias("copies"))
    upto = Window.partitionBy("sid", "cell").orderBy("sub")
    subs = subs.withColumn("upto", F.sum("m").over(upto))
    whole = lambda c: F.floor(F.col("copies").cast("decimal(19,0)") * c.cast("decimal(19,0)") / F.col("n")).cast("long")
    subs = subs.withColumn("own", whole(F.col("upto")) - whole(F.col("upto") - F.col("m")))
    subs = written(subs.select("sid", "cell", "sub", "m", "own"), "mix-subcells")
    order = Window.partitionBy("sid", "cell", "sub").orderBy("draw", "doc_id", "size", "digest")
    before = F.coalesce(F.sum("rows").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    dealt = dealt.withColumn("before", before).join(subs, ["sid", "cell", "sub"])
    more = F.greatest(F.lit(0), F.least(F.col("rows"), F.expr("own % m") - F.col("before")))  # rows that take one more copy
    dealt = dealt.withColumn("more", more).withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    copies = F.expr("own div m") + F.when(F.col("row") <= F.col("more"), 1).otherwise(0)
    dealt = dealt.withColumn("copies", copies.cast("long"))
    return dealt.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies", "rate"
    )
