"""Reading request logs as files, in batch or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from doclog import schema as S


def read_requests(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Requests with the declared schema; a JSON document is kept as its text, whatever is inside."""
    return spark.read.schema(S.REQUEST).format(fmt).load(path)


def stream_requests(
    spark: SparkSession, path: str, fmt: str = "json", max_files: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(S.REQUEST).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)
