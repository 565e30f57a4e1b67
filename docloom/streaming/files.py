"""Markdown folders as a stream: each new file is chunked as a whole, exactly once for each checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators.chunking import chunks


def markdown_stream(spark: SparkSession, path: str) -> DataFrame:
    files = spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", "*.md").load(path)
    return files.select(F.col("_metadata.file_name").alias("source"), F.col("value").alias("md"))


def chunk_stream(spark: SparkSession, path: str, out: str, checkpoint: str, **options):
    """A query that writes the chunks of each new file below ``out``; a batch that is run again replaces its own folder."""

    def write(batch: DataFrame, number: int) -> None:
        chunks(batch, **options).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return markdown_stream(spark, path).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
