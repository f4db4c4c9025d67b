"""Incremental ingest of new files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def ingest_stream(spark: SparkSession, path: str, schema, target: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None, fmt: str = "json", files_per_batch: int = 1000, multi_line: bool = True) -> StreamingQuery:
    """Read each file below ``path`` once, apply ``transform`` and append to the Parquet table at ``target``.

    The checkpoint remembers the files; a batch that is run again after a failure replaces its own output, as each batch
    writes to a partition of its own (batch_id). ``multi_line`` is for JSON files that hold one value each; else each line is one. Returns the started query, which ends when all files are read.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", True)
    if fmt == "json":
        reader = reader.option("multiLine", multi_line)
    rows = reader.format(fmt).load(path).select("*", F.col("_metadata.file_path").alias("source_file"))

    def write(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch) if transform else batch
        out.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(target)

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
