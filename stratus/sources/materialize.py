"""Lineage cuts through a table written to the shared checkpoint folder.

``Dataset.checkpoint`` keeps the plan's constraint set, which Catalyst derives
by propagating every predicate through every alias; on wide feature plans
(60+ columns) that derivation explodes.  Writing Parquet into the folder named
by ``spark.checkpoint.dir`` and reading it back cuts lineage just as
reliably (the files survive executor loss), stores columns compressed, and
lets later scans prune columns.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir

_WRITTEN: list[str] = []


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and return a scan of it."""
    path = scratch(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def scratch(spark: SparkSession, label: str) -> str:
    """A new path under the checkpoint folder, removed by :func:`cleanup`."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stratus-{label}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def cleanup(spark: SparkSession) -> int:
    """Delete the tables this process materialised (call when the job's
    results are written; DataFrames reading them become invalid)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    while _WRITTEN:
        p = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            fs.delete(p, True)
            removed += 1
    return removed
