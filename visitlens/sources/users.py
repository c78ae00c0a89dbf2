"""User-profile source (``userid, age, professional, city, sex``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.schema import USER_INFO

USER_COLUMNS = [f.name for f in USER_INFO.fields]


def conform_users(df: DataFrame) -> DataFrame:
    missing = [c for c in USER_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"user_info lacks columns {missing}")
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in USER_INFO.fields])


def read_user_info(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return conform_users(spark.read.format(fmt).load(path))


def read_hive_users(spark: SparkSession, table: str = "default.user_info") -> DataFrame:
    return conform_users(spark.table(table))
