"""Distributed running totals over a sorted key, without a one-partition window.

A window ordered over the whole table moves every row to one task.  Instead the
rows are range-partitioned by the key, into as many ranges as the session has
shuffle partitions; per-range totals (one row per range) give each range its
offset, and the running sum inside a range is a window partitioned by range.
Exact for any range boundaries; Spark's sample of the keys only balances them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens.session import materialize


def running_total_below(df: DataFrame, key: str, weights: list[str], ranges: int | None = None) -> DataFrame:
    """Add ``<w>_below`` = sum of ``w`` over rows whose ``key`` is strictly smaller.

    ``key`` must be unique per row and non-NULL (e.g. a distinct-value table).
    The ranged rows are checkpointed, as they are read twice and a row must keep
    its range."""
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = materialize(df.repartitionByRange(ranges, key).withColumn("_range", F.spark_partition_id()))
    totals = x.groupBy("_range").agg(*[F.sum(w).alias(f"_tot_{w}") for w in weights])
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range: as small as the number of shuffle partitions, so the
    # planner's own size check decides on the join.
    offsets = totals.select(
        "_range", *[F.coalesce(F.sum(f"_tot_{w}").over(before), F.lit(0)).alias(f"_off_{w}") for w in weights]
    )
    inside = Window.partitionBy("_range").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    out = x.join(offsets, "_range")
    for w in weights:
        out = out.withColumn(f"{w}_below", F.col(f"_off_{w}") + F.coalesce(F.sum(w).over(inside), F.lit(0)))
    return out.drop("_range", *[f"_off_{w}" for w in weights])
