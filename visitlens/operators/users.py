"""Users folded to distinct attribute rows with their multiplicity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

USER_ATTRS = ["userid", "age", "professional", "city", "sex"]


def user_variants(users: DataFrame) -> DataFrame:
    """Users pre-aggregated to distinct ``(userid, age, professional, city, sex)``
    rows with ``weight`` = how many identical user rows each stands for.

    A userid listed many times would otherwise multiply every one of its
    sessions in the join; the weight carries the multiplicity instead, and
    every consumer sums weights where the reference counts joined rows.  The
    grouping is finer than the join key, so the join has exchanges on both
    sides and adaptive execution can split a hot user.
    """
    return users.groupBy(*USER_ATTRS).agg(F.count(F.lit(1)).alias("weight"))
