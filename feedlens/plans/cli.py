"""Command line for the recurring jobs (run with spark-submit or python -m).

    python -m feedlens.plans.cli cube     --feed F --messages M --as-of 2024-01-31 --target T [--profiles P]
    python -m feedlens.plans.cli backfill --feed F --messages M --start D1 --end D2 --target T
    python -m feedlens.plans.cli report   --feed F --messages M --as-of 2024-01-31 --out P
    python -m feedlens.plans.cli ab       --feed F --start D1 --end D2 --out P
    python -m feedlens.plans.cli power    --feed F --start D1 --end D2 [--threshold 50] --out P
    python -m feedlens.plans.cli forecast --feed F --as-of D --anomaly D1 D2 [--by os] --out P

``F`` / ``M`` are parquet paths or table names; ``--partition-col`` names their day
partition if filters may prune by it, ``--lateness`` how many days late a row may
lie there (or, with ``--profiles`` and no partition, may arrive).  Results are written as parquet to ``--out``.  The session comes from
spark-submit (or a default builder); nothing is read from the clock.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from feedlens.operators import forecast as FC
from feedlens.operators import power as Q
from feedlens.operators import report as B
from feedlens.plans.ab_analysis import ab_summary
from feedlens.plans.daily_cube import backfill_cube, run_daily_cube
from feedlens.sources import read_feed, read_messages


_NEEDS = {
    "cube": ("messages", "as_of", "target"),
    "backfill": ("messages", "start", "end", "target"),
    "report": ("messages", "as_of", "out"),
    "ab": ("start", "end", "out"),
    "power": ("start", "end", "out"),
    "forecast": ("as_of", "anomaly", "out"),
}


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="feedlens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name, needs in _NEEDS.items():
        p = sub.add_parser(name)
        p.add_argument("--feed", required=True)
        p.add_argument("--partition-col")
        p.add_argument("--lateness", type=int, default=0)
        for arg in needs:
            p.add_argument("--" + arg.replace("_", "-"), required=True, **({"nargs": 2} if arg == "anomaly" else {}))
        if name in ("cube", "backfill"):
            p.add_argument("--profile", default="all", choices=["all", "latest"])
        if name == "cube":
            p.add_argument("--profiles")
        if name == "ab":
            p.add_argument("--seed", type=int, default=42)
        if name == "power":
            p.add_argument("--threshold", type=int, default=50)
        if name == "forecast":
            p.add_argument("--by", nargs="*")
    return ap


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"feedlens-{args.cmd}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    layout = {"partition_col": args.partition_col, "lateness_days": args.lateness}
    feed = read_feed(spark, args.feed, **layout)

    def emit(df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(args.out)

    if args.cmd in ("cube", "backfill", "report"):
        msgs = read_messages(spark, args.messages, **layout)
    if args.cmd == "cube":
        run_daily_cube(feed, msgs, args.as_of, args.target, args.profile, args.profiles, args.lateness)
    elif args.cmd == "backfill":
        backfill_cube(feed, msgs, args.start, args.end, args.target, args.profile)
    elif args.cmd == "report":
        emit(B.feed_report(feed, args.as_of).unionByName(B.service_report(feed, msgs, args.as_of)))
    elif args.cmd == "ab":
        emit(ab_summary(feed, args.start, args.end, seed=args.seed))
    elif args.cmd == "power":
        period = (feed, args.start, args.end)
        emit(Q.expected_power(Q.views_distribution(*period), Q.ctr_distribution(*period), Q.group_size(*period), views_threshold=args.threshold))
    elif args.cmd == "forecast":
        prepared = FC.prepare(feed, args.as_of, tuple(args.anomaly), 14, args.by or None)
        emit(FC.compare(prepared, FC.forecast(prepared, 30)))


if __name__ == "__main__":
    main()
