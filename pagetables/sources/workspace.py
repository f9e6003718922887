"""Shared scratch space of a run."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DIR = "spark.checkpoint.dir"


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder path in the cluster's shared folder (``spark.checkpoint.dir``).

    Only a local session without that setting gets a temporary folder: on a
    cluster a machine's own disk is out of reach for the other executors.
    """
    shared = spark.conf.get(_DIR, None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_DIR} to a folder all executors share")
        shared = tempfile.gettempdir()
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Rows written once as Parquet into the shared folder, for consumers that read them more than once.

    Each consumer then reads the columns it needs, and the rows survive the loss of executors.
    """
    path = workspace(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
