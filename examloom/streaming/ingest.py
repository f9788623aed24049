"""Reports as a stream: files that arrive are read, and operators without state across documents are applied as they come."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def report_stream(spark: SparkSession, path: str, encoding: str = "ISO-8859-1", per_trigger: int = 1000) -> DataFrame:
    """(path, file_name, text) of new files."""
    df = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("maxFilesPerTrigger", per_trigger).load(path)
    return df.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"), F.decode("content", encoding).alias("text"))


def extract_stream(stream: DataFrame, extract: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Each batch of documents goes through `extract` and is written under its batch id, so a repeated batch replaces itself."""

    def write(batch: DataFrame, epoch: int) -> None:
        extract(batch).write.mode("overwrite").parquet(f"{out}/batch={epoch}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
