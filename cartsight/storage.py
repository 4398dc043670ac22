"""Where intermediate tables go: the shared folder named by ``spark.checkpoint.dir``."""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def shared_base(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/intermediate"


def shared_path(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name that no other run uses."""
    return f"{shared_base(spark)}/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, purpose: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written table."""
    path = shared_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def kept(*frames: DataFrame) -> Iterator[None]:
    """Hold ``frames`` on the executors while several jobs read them; lost blocks are recomputed."""
    for frame in frames:
        frame.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield
    finally:
        for frame in frames:
            frame.unpersist()
