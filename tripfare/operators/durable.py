"""Cut a plan by writing it to the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Only a local session, where driver and tasks share one disk, may fall back
    to a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tripfare-"))
    return context.getCheckpointDir().rstrip("/")


def durable(frame: DataFrame, label: str) -> DataFrame:
    """Write ``frame`` once as Parquet and read it back.

    The result no longer depends on the plan behind it, so a lost executor
    costs a re-read, and a sample can never be drawn differently a second time.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
