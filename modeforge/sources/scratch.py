"""Where intermediate results go, and how lineage is cut.

Everything intermediate lives in the shared checkpoint folder of the cluster,
so that the loss of an executor never forces a second scan of the input.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A local session without that setting gets a new temporary folder; on a
    cluster a missing setting is an error, as no machine-local folder would do.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named.rstrip("/")
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="modeforge-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the scratch folder; nothing is created."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Compute once, keep in the shared folder, read from there ever after."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


def kept_table(df: DataFrame, label: str) -> DataFrame:
    """The same in a columnar, compressed form, for rows that are long or read by columns; their order is not kept."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
