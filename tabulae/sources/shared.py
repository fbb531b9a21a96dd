"""Tables in the folder that driver and executors share."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one that the session names in ``spark.checkpoint.dir``.

    A local session without that setting gets a folder of its own; on a cluster its absence
    is an error, as a machine-local folder would not be seen by the other machines.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        sc.setCheckpointDir(base)
    return f"{base.rstrip('/')}/tabulae-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder.

    Every later use reads the same rows, whatever the plan reuses, and lost executors cost no
    recomputation of what lies before.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
