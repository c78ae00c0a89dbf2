"""Size-checked broadcast of a small join side.

AQE can turn a sort-merge join into a broadcast join once it has measured
the small side, but by then it has usually already run the shuffle of the
big side (that stage has no dependencies, so it starts first).  When one
side is a bounded result (top sessions, drawn sessions) and the other is the
whole visit log, that wasted shuffle is the most expensive step of the job.

``broadcast_if_small`` measures the small side with one aggregate and adds a
broadcast hint only when the measured size is under the session's broadcast
threshold.  Beyond it the join stays a sort-merge join (with AQE skew
splitting).  A caller that passes a ``kept`` list owns the persisted side and
releases it; without one nothing is persisted, and the side is computed once
more when the join runs.

``probably_in`` serves sides beyond that limit: the ids become a bitmap of hashed bits (a
Bloom filter with one hash), built by an aggregate, and the big side is probed with it
map-side before the shuffle.  It keeps every row whose id is there and few others, so the
exact join that follows shuffles little more than its result.
"""

from __future__ import annotations

import re

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
          "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}
ROW_OVERHEAD, COLUMN_OVERHEAD = 32, 16  # bytes per row and column in a hashed broadcast relation, roughly


def parse_bytes(text: str) -> int:
    m = re.fullmatch(r"\s*(-?\d+)\s*([a-zA-Z]*)\s*", str(text))
    if not m or m.group(2).lower() not in _UNITS:
        raise ValueError(f"not a byte size: {text!r}")
    return int(m.group(1)) * _UNITS[m.group(2).lower()]


def broadcast_threshold(df: DataFrame) -> int:
    """The session's ``spark.sql.autoBroadcastJoinThreshold`` in bytes (-1 = off)."""
    return parse_bytes(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB"))


def measured_bytes(df: DataFrame) -> tuple[int, int]:
    """``(rows, approximate bytes)`` of ``df`` from one aggregate."""
    widths = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns]
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(sum(widths, F.lit(0))).alias("w")).first()
    rows = int(row["n"] or 0)
    return rows, int(row["w"] or 0) + rows * (ROW_OVERHEAD + COLUMN_OVERHEAD * len(df.columns))


def broadcast_if_small(
    df: DataFrame, kept: list[DataFrame] | None = None, max_bytes: int | None = None
) -> tuple[DataFrame, bool]:
    """Measure ``df`` and return it with a broadcast hint when small.

    With ``kept`` the frame is persisted and appended there; its owner unpersists it.
    """
    limit = broadcast_threshold(df) if max_bytes is None else max_bytes
    small = df
    if kept is not None:
        small = df.persist(StorageLevel.MEMORY_AND_DISK)
        kept.append(small)
    _, size = measured_bytes(small)
    if 0 <= size <= limit:
        return F.broadcast(small), True
    return small, False


# A bitmap row covers this many bits: 512 words of 64.  16 bits an id let about 6 % of other ids pass.
BLOCK_BITS, BITS_PER_ID = 1 << 15, 16


def id_bitmap(ids: DataFrame, key: str, bits: int) -> DataFrame:
    """``block, words``: the bitmap of the hashed ids, ``bits`` a multiple of ``BLOCK_BITS``."""
    place = F.pmod(F.xxhash64(key), F.lit(bits))
    one = F.lit(1).cast("bigint")
    marks = ids.where(F.col(key).isNotNull()).select(
        F.floor(place / 64).alias("word"), F.call_function("shiftleft", one, (place % 64).cast("int")).alias("mark")
    )
    empty = ids.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("mark"))
    words = marks.groupBy("word").agg(F.bit_or("mark").alias("mark")).unionByName(empty)
    words = words.groupBy("word").agg(F.bit_or("mark").alias("mark"))
    block = F.floor(F.col("word") * 64 / BLOCK_BITS).alias("block")
    rows = words.groupBy(block).agg(F.sort_array(F.collect_list(F.struct("word", "mark"))).alias("words"))
    return rows.select("block", F.transform("words", lambda w: w["mark"]).alias("words"))


def probably_in(df: DataFrame, ids: DataFrame, key: str, max_bytes: int | None = None) -> DataFrame:
    """Rows of ``df`` whose ``key`` is among the ``ids``, and a few others; without a shuffle of ``df``.

    The bitmap has 16 bits an id and is broadcast; it is made smaller (and lets more
    pass) where that is more than ``max_bytes`` (the session's broadcast limit).  With
    more ids than half its bits it would let too much pass: ``df`` comes back as it is.
    """
    limit = broadcast_threshold(df) if max_bytes is None else max_bytes
    n = ids.count()
    most = max(0, limit) * 8 // BLOCK_BITS * BLOCK_BITS
    if n > most // 2:
        return df
    bits = min(most, max(1, -(-n * BITS_PER_ID // BLOCK_BITS)) * BLOCK_BITS)
    bitmap = id_bitmap(ids, key, bits)
    place = F.pmod(F.xxhash64(df[key]), F.lit(bits))
    near = df.withColumns({"_block": F.floor(place / BLOCK_BITS), "_place": (place % BLOCK_BITS).cast("int")})
    near = near.join(F.broadcast(bitmap), near["_block"] == bitmap["block"])
    word = F.get("words", F.floor(F.col("_place") / 64).cast("int"))
    mark = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_place") % 64)
    # Catalyst would push a semi join that follows below this probe; it moves nothing past a
    # filter that is not deterministic
    stays = F.monotonically_increasing_id() >= 0
    return near.where(F.col(key).isNotNull() & (word.bitwiseAND(mark) != 0) & stays).select(*df.columns)
