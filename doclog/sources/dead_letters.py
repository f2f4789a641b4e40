"""What could not be applied, kept with its place in the log: single requests and whole segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from doclog import schema as S
from doclog.functions.scale import meet
from doclog.sources.files import exists


def write_dead_letter(letters: DataFrame, path: str) -> None:
    """Store dead letters by target and segment; storing a segment's again replaces them.

    A segment's letters meet before they are written, so there is a file for each segment and not one for each segment
    and task.
    """
    (
        meet(letters, ["target", "segment_id"]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("target", "segment_id").parquet(path)
    )


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    """All dead letters; none when nothing was ever stored."""
    return spark.read.schema(S.LETTERS).parquet(path) if exists(spark, path) else spark.createDataFrame([], S.LETTERS)


SEGMENT_ERROR = "segment_id long, seq long, reason string, tries int, skipped boolean"


def write_segment_errors(report: DataFrame, table_path: str) -> None:
    """Keep the report of segments in error with the table; reporting a segment again replaces its row."""
    (
        report.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("segment_id").parquet(f"{table_path}/_segment_errors")
    )


def read_segment_errors(spark: SparkSession, table_path: str) -> DataFrame:
    path = f"{table_path}/_segment_errors"
    if not exists(spark, path):
        return spark.createDataFrame([], SEGMENT_ERROR)
    return spark.read.schema(SEGMENT_ERROR).parquet(path).select("segment_id", "seq", "reason", "tries", "skipped")
