"""Cutting lineage with a written table in shared storage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Where none is set, a session in one process (``local[...]``, as in tests) gets
    one for its lifetime; a session on a cluster, also a local one, stops.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if not configured:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="scorecard-")
        spark.conf.set(CHECKPOINT_DIR, configured)
    return configured.rstrip("/")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back, so every reader sees the same rows.

    A written table outlives a lost executor, and row-to-partition choices that
    would differ between two runs of the same plan are fixed by it. Hashed IDs are most
    of its bytes; the default codec leaves them as long as they are.
    """
    path = f"{shared_dir(df.sparkSession)}/scorecard/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)
