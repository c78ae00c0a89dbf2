"""Reading tables, writing intermediates to the shared folder, size-checked joins."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Bytes of a join side (measured) up to which it is broadcast; beyond, the join shuffles.
BROADCAST_BYTES = 32 << 20


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors (``addPyFile``), once per application, and hand
    Python workers smaller batches where the session has no setting of its own.

    Functions passed to Spark find it only if they are passed afterwards, so every operator
    begins with this."""
    app = spark.sparkContext.applicationId
    if spark.conf.get(_BATCH_ROWS) == "10000":  # Spark's default, large for whole texts
        spark.conf.set(_BATCH_ROWS, "1000")
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    path = Path(tempfile.mkdtemp(prefix="visitlens-code-")) / "visitlens_code.zip"
    with zipfile.ZipFile(path, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, str(file.relative_to(package.parent)))
    spark.sparkContext.addPyFile(str(path))
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only in local mode without one."""
    sc = spark.sparkContext
    named = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    local = sc.master.startswith("local") and not sc.master.startswith("local-")
    return checkpoint_dir(spark, tempfile.mkdtemp(prefix="visitlens-") if local and not named else None)


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: its lineage ends there."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def only_ids(df: DataFrame, ids: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """Semi (or anti) join on a long key; ``ids`` (distinct, written) is broadcast if small by count."""
    if ids.count() * 64 <= BROADCAST_BYTES:
        ids = F.broadcast(ids)
    return df.join(ids, key, how)
