"""Tables written on the way: cut lineage in storage all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DIR_KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A local master without the setting gets a temporary folder, kept for the
    life of the Spark session. A cluster without it is an error: a folder of
    one machine would be lost with that machine.
    """
    context = spark.sparkContext
    configured = context.getConf().get(_DIR_KEY) or spark.conf.get(_DIR_KEY, None)
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_DIR_KEY} to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="clickspark-")
    spark.conf.set(_DIR_KEY, made)
    return made


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later stages then restart from the files when executors are lost, and
    branches that use different columns each read only theirs.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
