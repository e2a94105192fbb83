"""Written intermediate results in the folder that the cluster's tasks share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one in local mode alone."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and context.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="chunkloom-shared-"))
    return context._jsc.sc().getCheckpointDir().get()


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder, so that a lost executor loses nothing and plans stay short."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
