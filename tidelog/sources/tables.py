"""Stored tables and delimited files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.schema import LOG_DATA

UNDATED = "undated"
STORED = T.StructType([*LOG_DATA.fields, T.StructField("event_date", T.StringType())])


def log_table(spark: SparkSession, path: str, dates: Sequence[str] | None = None) -> DataFrame:
    """The stored log table, partitioned by ``event_date`` (text, ``undated`` for
    rows without an event time). A missing table reads as an empty one. With
    ``dates`` only the folders of these are listed, however many the table has."""
    reader = spark.read.schema(STORED)
    try:
        if dates is None:
            return reader.parquet(path)
        if dates:
            return reader.option("basePath", path).parquet(f"{path}/event_date={{{','.join(sorted(dates))}}}")
        return spark.createDataFrame([], STORED)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STORED)


def with_event_date(rows: DataFrame) -> DataFrame:
    day = F.col("event_ts").cast("date").cast("string")
    return rows.withColumn("event_date", F.coalesce(day, F.lit(UNDATED)))


def delimited(spark: SparkSession, path: str, schema: T.StructType, separator: str = "\t") -> DataFrame:
    """Headerless delimited text with a fixed schema; malformed rows fail."""
    return spark.read.schema(schema).csv(path, sep=separator, header=False, mode="FAILFAST", quote="")
