"""Ranks inside large groups without gathering a group in one task.

A plain ``row_number`` over a group sends the whole group to one task as soon as the wanted
number of rows is too large for a partial limit.  Here the group is first cut into buckets
that follow the ranking order.  Counting the buckets is a pre-aggregated grouping; running
sums over that small table give the rows before each bucket; buckets beyond the limit are
dropped before anything is sorted; and only rows of one bucket meet in a window.  Ranks are
exact for any limit.

Where the ranking order has no natural buckets (many ties of one count, ids that begin
alike, one long session), ``split_large_groups`` cuts a group at sampled splitters: rows whose
key hashes below a share of the group's size are a mergeable sample, every 64th of them in
order is a splitter, and a binary search gives a row its bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Groups up to this many rows are one bucket; larger ones get SPLITS buckets from about
# SPLITS * SAMPLED sampled keys, so a bucket's size varies by an eighth of its mean.
SPLIT_ROWS, SPLITS, SAMPLED = 10_000, 256, 64


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which NULL meets NULL; the keys are the left side's."""
    other = right.withColumnsRenamed({k: f"{k}__r" for k in keys})
    on = [left[k].eqNullSafe(other[f"{k}__r"]) for k in keys]
    return left.join(other, on, how).drop(*[f"{k}__r" for k in keys])


def split_large_groups(
    df: DataFrame, group: list[str], key: list[str], bucket: str = "_bucket", rows: int = SPLIT_ROWS
) -> DataFrame:
    """``df`` with a ``bucket`` number that ascends with ``key`` (distinct in a group) and cuts
    groups of more than ``rows`` rows into about ``SPLITS`` buckets of like size."""
    keyed = df.select(*group, F.struct(*key).alias("_key"))
    large = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_size")).where(F.col("_size") > F.lit(int(rows)))
    drawn = F.pmod(F.xxhash64("_key"), F.lit(1 << 40)) * F.col("_size") < F.lit(SPLITS * SAMPLED) * F.lit(float(1 << 40))
    sample = join_null_safe(keyed, large, group).where(drawn)
    points = sample.groupBy(*group).agg(F.sort_array(F.collect_list("_key")).alias("_keys"))
    place = lambda i: F.greatest(F.lit(1), F.floor(i * F.size("_keys") / SPLITS).cast("int"))
    points = points.select(*group, F.transform(F.sequence(F.lit(1), F.lit(SPLITS - 1)), lambda i: F.element_at("_keys", place(i))).alias("_points"))
    placed = join_null_safe(df.withColumn("_key", F.struct(*key)), points, group, "left")
    halves = F.array(*[F.lit(SPLITS >> i) for i in range(1, SPLITS.bit_length())])
    passed = lambda at, step: F.get(F.col("_points"), at + step - 1) <= F.col("_key")
    found = F.aggregate(halves, F.lit(0), lambda at, step: at + F.when(passed(at, step), step).otherwise(0))
    number = F.when(F.col("_points").isNull(), F.lit(0)).otherwise(found)
    return placed.withColumn(bucket, number).drop("_key", "_points")


def bucket_offsets(df: DataFrame, group: list[str], buckets: list[str], weight: Column | None = None) -> DataFrame:
    """``group``, ``buckets``, ``rows_before`` and ``weight_before`` of every bucket.

    Buckets are ordered by their columns, ascending; none of the columns may be NULL."""
    weight = F.lit(1) if weight is None else weight
    counts = df.groupBy(*group, *buckets).agg(F.count(F.lit(1)).alias("_n"), F.sum(weight).cast("bigint").alias("_w"))
    before = Window.partitionBy(*group).orderBy(*buckets).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    return counts.select(
        *group,
        *buckets,
        F.coalesce(F.sum("_n").over(before), zero).alias("rows_before"),
        F.coalesce(F.sum("_w").over(before), zero).alias("weight_before"),
    )


def rank_in_buckets(
    df: DataFrame, offsets: DataFrame, group: list[str], buckets: list[str], order: list, most: int | None = None
) -> DataFrame:
    """Rows of the buckets in ``offsets`` with their exact ``rank`` in the group (NULL groups too).

    ``order`` ranks the rows of one bucket; the bucket order must agree with it.  With
    ``most`` only the first so many rows of a bucket are kept, in every task before the shuffle
    (Spark's window group limit)."""
    within = Window.partitionBy(*group, *buckets).orderBy(*order)
    placed = join_null_safe(df, offsets, [*group, *buckets]).withColumn("_row", F.row_number().over(within))
    if most is not None:
        placed = placed.where(F.col("_row") <= F.lit(int(most)))
    return placed.withColumn("rank", F.col("rows_before") + F.col("_row")).drop("_row")
