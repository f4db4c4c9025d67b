"""The folder for intermediate data that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder where that is unset and the master is local."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="offerloom-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in that folder that nothing else uses, below a folder of this application."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table of that folder: worked out once, however often it is read, and no longer dependent on what made it."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def rename_parts(spark: SparkSession, staging: str, path: str, ending: str) -> None:
    """Move the file of each folder ``column=value`` below ``staging`` to ``path``/value + ``ending``, replacing what is there."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop(path))
    for folder in fs.listStatus(hadoop(staging)):
        name = folder.getPath().getName()
        if "=" in name:
            target = hadoop(path, name.split("=", 1)[1] + ending)
            fs.delete(target, False)
            part = next(f.getPath() for f in fs.listStatus(folder.getPath()) if f.getPath().getName().startswith("part-"))
            fs.rename(part, target)


def clean_up(spark: SparkSession) -> None:
    """Delete all intermediate data of this application, once no result is read any more."""
    remove(spark, f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")
