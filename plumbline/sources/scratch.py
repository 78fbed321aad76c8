"""Derived tables in the shared folder the session names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder, because
    executors on other machines could not read it.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="plumbline-")
    spark.conf.set(CHECKPOINT_CONF, folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used yet."""
    return f"{shared_folder(spark)}/plumbline/{name}-{uuid.uuid4().hex}"


def materialize_once(df: DataFrame, name: str) -> DataFrame:
    """Write the table and read it back: cuts the lineage and survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
