"""Typed readers for the two fact tables (parquet path or catalog table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feedlens.sources.schemas import FEED, MESSAGES, PART_DAY, PART_EVENT_DAY, check_schema


def _load(spark: SparkSession, where: str) -> DataFrame:
    if "/" in where or where.endswith(".parquet"):
        return spark.read.parquet(where)
    return spark.table(where)


def _typed(df: DataFrame, schema: StructType, name: str, partition_col: str | None, lateness_days: int) -> DataFrame:
    cols = [F.col(c) for c in schema.fieldNames()]
    if partition_col:
        # The partition's day rides along under internal names.  A row of day d
        # lies in a partition from d to d + lateness; day filters of the operators
        # repeat on these bounds, so only the wanted partitions are listed and
        # read, and the exact filter on ``time`` stays.
        day = F.col(partition_col).cast("date")
        cols += [day.alias(PART_DAY), F.date_sub(day, lateness_days).alias(PART_EVENT_DAY)]
    return check_schema(df, schema, name).select(*cols)


def read_feed(spark: SparkSession, where: str, partition_col: str | None = None, lateness_days: int = 0) -> DataFrame:
    """Feed actions from a parquet path or a table name, checked against FEED.

    ``partition_col`` names the table's day partition, if day filters are to prune
    by it: a row must then lie in the partition of its day or at most
    ``lateness_days`` days later (a partition by ingestion day).  Without it
    nothing is assumed about the layout."""
    return _typed(_load(spark, where), FEED, "feed_actions", partition_col, lateness_days)


def read_messages(spark: SparkSession, where: str, partition_col: str | None = None, lateness_days: int = 0) -> DataFrame:
    """Message actions, likewise, checked against MESSAGES."""
    return _typed(_load(spark, where), MESSAGES, "message_actions", partition_col, lateness_days)
