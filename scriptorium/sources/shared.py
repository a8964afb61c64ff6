"""The shared folder in which plans of several rounds cut their lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that all executors see. Only a session of one process gets a temporary one where none is set, as in tests."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        told = spark.conf.get("spark.checkpoint.dir", None)
        if told is None and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(told or tempfile.mkdtemp(prefix="scriptorium-"))
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def saved(frame: DataFrame) -> DataFrame:
    """Writes the rows to the shared folder and reads them back: a cut of lineage that outlives executors."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/saved/{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def clear_saved(spark: SparkSession) -> None:
    """Deletes what the session has saved so far. Frames that weren't written out before can't be read any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/saved")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
