"""
scale factor, from Spark's event log (written to a fresh scratch folder).

Usage: python scripts/measure_rewrites.py [sf_dir] [event_log_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from feedlens.functions.columns import age_band_etl, to_day, week_start  # noqa: E402
from feedlens.operators import cube as C  # noqa: E402
from feedlens.operators import retention as R  # noqa: E402
from feedlens.sources.fixtures import feed_actions, message_actions  # noqa: E402
from feedlens.sources.schemas import MEASURES  # noqa: E402


def marginals_three_passes(cube: DataFrame) -> DataFrame:
    """The reference's shape: one groupBy per dimension, then a union."""
    sums = [F.sum(m).cast("bigint").alias(m) for m in MEASURES]
    g = cube.filter(F.col("gender").isNotNull()).groupBy("event_date", F.col("gender").cast("string").alias("dimension_value")).agg(*sums)
    o = cube.filter(F.col("os").isNotNull()).groupBy("event_date", F.col("os").alias("dimension_value")).agg(*sums)
    a = cube.filter(age_band_etl("age").isNotNull()).groupBy("event_date", age_band_etl("age").alias("dimension_value")).agg(*sums)
    return (
        g.withColumn("dimension", F.lit("gender"))
        .unionByName(o.withColumn("dimension", F.lit("os")))
        .unionByName(a.withColumn("dimension", F.lit("age")))
    )


def weekly_flow_arrays(feed: DataFrame) -> DataFrame:
    """The dashboard SQL's shape: weeks collected per user, exploded, tested with array_contains."""
    base = feed.groupBy("user_id").agg(F.collect_set(week_start(to_day("time"))).alias("weeks"))
    x = base.select("user_id", "weeks", F.explode("weeks").alias("week"))
    nr = x.groupBy(
        "week", F.when(F.array_contains("weeks", F.date_sub("week", 7)), "retained").otherwise("new").alias("status")
    ).agg(F.count_distinct("user_id").alias("users"))
    gone = (
        x.filter(~F.array_contains("weeks", F.date_add("week", 7)))
        .groupBy(F.date_add("week", 7).alias("week"))
        .agg((-F.count_distinct("user_id")).alias("users"))
        .select("week", F.lit("gone").alias("status"), "users")
    )
    return nr.unionByName(gone).groupBy("week", "status").agg(F.sum("users").cast("bigint").alias("users"))


def weekly_flow_windows(feed: DataFrame) -> DataFrame:
    """Alternative: distinct (user, week), previous / next week from lag / lead per user."""
    from pyspark.sql import Window

    uw = feed.select("user_id", week_start(to_day("time")).alias("week")).distinct()
    w = Window.partitionBy("user_id").orderBy("week")
    links = uw.select(
        "week",
        F.coalesce(F.lag("week").over(w) == F.date_sub("week", 7), F.lit(False)).alias("retained"),
        F.coalesce(F.lead("week").over(w) != F.date_add("week", 7), F.lit(True)).alias("gone_next"),
    )
    own = F.struct(F.col("week").alias("w"), F.when(F.col("retained"), "retained").otherwise("new").alias("s"), F.lit(1).alias("d"))
    gone = F.struct(F.date_add("week", 7).alias("w"), F.lit("gone").alias("s"), F.lit(-1).alias("d"))
    ev = F.when(F.col("gone_next"), F.array(own, gone)).otherwise(F.array(own))
    return links.select(F.inline(ev)).groupBy("w", "s").agg(F.sum("d").alias("users"))


def shuffle_bytes_by_group(log_dir: str) -> dict[str, int]:
    stage_group: dict[int, str] = {}
    written: dict[int, int] = {}
    paths = [p for p in glob.glob(os.path.join(log_dir, "**", "events_*"), recursive=True)]
    paths += [p for p in glob.glob(os.path.join(log_dir, "*")) if os.path.isfile(p)]
    for path in paths:
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        if group:
                            stage_group[sid] = group
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    for acc in info.get("Accumulables", []):
                        if acc.get("Name") == "internal.metrics.shuffle.write.bytesWritten":
                            written[info["Stage ID"]] = written.get(info["Stage ID"], 0) + int(acc.get("Value", 0))
    out: dict[str, int] = {}
    for sid, b in written.items():
        g = stage_group.get(sid)
        if g:
            out[g] = out.get(g, 0) + b
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="feedlens-eventlog-")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", log_dir)
        .config("spark.eventLog.compress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    feed, msgs = feed_actions(spark, sf_dir), message_actions(spark, sf_dir)
    cube, _ = C.build_cube(feed, msgs)
    variants = {
        "A18_marginals_one_pass": lambda: C.metrics_cube(cube),
        "A18_marginals_three_passes": lambda: marginals_three_passes(cube),
        "J5_weekly_flow_operator_week_sets": lambda: R.weekly_user_flow(feed),
        "J5_weekly_flow_lag_lead_windows": lambda: weekly_flow_windows(feed),
        "J5_weekly_flow_dashboard_arrays": lambda: weekly_flow_arrays(feed),
    }
    walls: dict[str, float] = {}
    for rep in range(2):  # the second round is reported (warm JVM)
        for name, build in variants.items():
            spark.sparkContext.setJobGroup(f"{name}#{rep}", name)
            t0 = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            walls[name] = round(time.perf_counter() - t0, 3)
    spark.stop()
    shuffled = shuffle_bytes_by_group(log_dir)
    report = {
        name: {"wall_s": walls[name], "shuffle_write_bytes": shuffled.get(f"{name}#1", 0)} for name in variants
    }
    print(json.dumps({"sf_dir": sf_dir, "event_log": log_dir, "results": report}, indent=1))


if __name__ == "__main__":
    main()
