"""Messenger per-user-day facts and the daily metric cube."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.functions.columns import ETL_AGE_LABELS, age_band_etl, as_date, to_day
from feedlens.operators.engagement import _in_days
from feedlens.sources.schemas import MEASURES

CUBE_KEYS = ["user_id", "event_date", "gender", "age", "os"]
MESSAGE_MEASURES = ["messages_sent", "users_sent", "messages_received", "users_received"]


def sent_user_day(msgs: DataFrame, start=None, end=None) -> DataFrame:
    """Per (event_date, sender) messages sent and distinct receivers."""
    df = _in_days(msgs.withColumn("event_date", to_day("time")), start, end, day="event_date")
    return df.groupBy("event_date", "user_id").agg(
        F.count("receiver_id").alias("messages_sent"),
        F.count_distinct("receiver_id").alias("users_sent"),
    )


def received_user_day(msgs: DataFrame, start=None, end=None) -> DataFrame:
    """Per (event_date, receiver) messages received and distinct senders.

    Distinct senders is the documented meaning of ``users_received``.  Spark
    plans the distinct count in two phases (partial aggregation per sender
    first), so a very popular receiver does not land whole in one task.
    """
    df = _in_days(msgs.withColumn("event_date", to_day("time")), start, end, day="event_date")
    return df.groupBy("event_date", F.col("receiver_id").alias("user_id")).agg(
        F.count("user_id").alias("messages_received"),
        F.count_distinct("user_id").alias("users_received"),
    )


def message_user_day(msgs: DataFrame, start=None, end=None) -> DataFrame:
    """Both directions in one row per (event_date, user_id), missing side = 0.

    One scan: every message becomes an outgoing row for its sender and an
    incoming row for its receiver (peer = the other side).  A first aggregation
    per (day, user, direction, peer) collapses repeats map-side and spreads a
    very active user over tasks by peer; the second, per (day, user), counts
    messages and distinct peers of each direction.
    """
    df = _in_days(msgs.withColumn("event_date", to_day("time")), start, end, day="event_date")
    sides = F.array(
        F.struct(F.col("user_id").alias("user"), F.col("receiver_id").alias("peer"), F.lit(True).alias("outgoing")),
        F.struct(F.col("receiver_id").alias("user"), F.col("user_id").alias("peer"), F.lit(False).alias("outgoing")),
    )
    pairs = (
        df.select("event_date", F.inline(sides))
        .groupBy("event_date", "user", "outgoing", "peer")
        .agg(F.count("*").alias("n"))
    )
    out, inc = F.col("outgoing"), ~F.col("outgoing")
    has_peer = F.col("peer").isNotNull()
    return pairs.groupBy("event_date", F.col("user").alias("user_id")).agg(
        F.coalesce(F.sum(F.when(out & has_peer, F.col("n"))), F.lit(0)).cast("bigint").alias("messages_sent"),
        F.count(F.when(out & has_peer, 1)).alias("users_sent"),
        F.coalesce(F.sum(F.when(inc & has_peer, F.col("n"))), F.lit(0)).cast("bigint").alias("messages_received"),
        F.count(F.when(inc & has_peer, 1)).alias("users_received"),
    )


PROFILE = ["os", "age", "gender"]


def profile_tuples(msgs: DataFrame) -> DataFrame:
    """Profile tuples of senders (user_id, os, age, gender) with the time of their
    last message: all that a profile needs of the message history."""
    return msgs.groupBy("user_id", *PROFILE).agg(F.max("time").alias("last_time"))


def merge_profiles(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two tables of profile tuples as one."""
    return a.unionByName(b).groupBy("user_id", *PROFILE).agg(F.max("last_time").alias("last_time"))


def sender_profile(
    msgs: DataFrame, profile: str = "all", users: DataFrame | None = None, tuples: DataFrame | None = None
) -> DataFrame:
    """Profile tuples (user_id, os, age, gender) of senders over all message history.

    ``profile="all"`` keeps every distinct tuple of a user (a user seen with two
    OS values gets two rows: the reference's fan-out); ``"latest"`` keeps the
    tuple of the user's last message (ties broken by the tuple).  ``users``
    keeps only those users (a semi-join after the reduction).  ``tuples`` is a kept
    table of ``profile_tuples``, read instead of the history.
    """
    # Reduce first (partial aggregation collapses a very active sender map-side),
    # then keep the wanted users: no raw history row is shuffled by user.
    tuples = profile_tuples(msgs) if tuples is None else tuples
    if users is not None:
        tuples = tuples.join(users.select("user_id").distinct(), "user_id", "left_semi")
    if profile == "all":
        return tuples.select("user_id", *PROFILE)
    if profile != "latest":
        raise ValueError(f"profile must be 'all' or 'latest', not {profile!r}")
    pick = F.max_by(F.struct(*PROFILE), F.struct("last_time", *PROFILE))
    return tuples.groupBy("user_id").agg(pick.alias("p")).select("user_id", *[F.col(f"p.{c}").alias(c) for c in PROFILE])


def with_profile(
    mud: DataFrame, msgs: DataFrame, profile: str = "all", start=None, end=None, tuples: DataFrame | None = None
) -> DataFrame:
    """C4: attach the sender profile to message user-days (left join; receivers
    who never sent keep NULL profile columns).

    With a day range the profiles are semi-joined to the people who sent or
    received in that range (read from a pruned scan of the range, not from
    ``mud``) after they are reduced, so the join carries compact tuples."""
    users = None
    if start is not None or end is not None:
        day = _in_days(msgs.withColumn("event_date", to_day("time")), start, end, day="event_date")
        users = day.select("user_id").unionByName(day.select(F.col("receiver_id").alias("user_id")))
    return mud.join(sender_profile(msgs, profile, users, tuples), "user_id", "left")


def _null_safe(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])


def user_day_cube(feed_ud: DataFrame, msg_ud: DataFrame) -> DataFrame:
    """Null-safe full outer join of feed and messenger user-days; measures
    missing on one side become 0."""
    f, m = feed_ud.alias("f"), msg_ud.alias("m")
    joined = f.join(m, _null_safe(f, m, CUBE_KEYS), "full_outer")
    return joined.select(
        *[F.coalesce(F.col(f"f.{k}"), F.col(f"m.{k}")).alias(k) for k in CUBE_KEYS],
        F.coalesce(F.col("f.likes"), F.lit(0)).cast("bigint").alias("likes"),
        F.coalesce(F.col("f.views"), F.lit(0)).cast("bigint").alias("views"),
        *[F.coalesce(F.col(f"m.{c}"), F.lit(0)).cast("bigint").alias(c) for c in MESSAGE_MEASURES],
    )


DIMENSIONS = ("gender", "os", "age")


def metrics_cube(cube: DataFrame, start=None, end=None) -> DataFrame:
    """Single-dimension marginals by gender, os and ETL age band, long format.

    One pass: every user-day row is expanded to its three (dimension, value)
    pairs and a single aggregation sums the measures (partial aggregation
    before the shuffle).  Rows with a NULL dimension value are left out of that
    dimension.  Every age label appears for every day, empty ones as 0: with a
    known day range the zero rows come from a generated calendar; otherwise
    they are added per day from the small aggregated result itself.  Either
    way the user-day cube has a single consumer and is computed once.
    """
    pairs = F.array(
        F.struct(F.lit("gender").alias("dimension"), F.col("gender").cast("string").alias("dimension_value")),
        F.struct(F.lit("os").alias("dimension"), F.col("os").alias("dimension_value")),
        F.struct(F.lit("age").alias("dimension"), age_band_etl("age").alias("dimension_value")),
    )
    rows = cube.select("event_date", *MEASURES, F.inline(pairs)).filter(F.col("dimension_value").isNotNull())
    if start is not None and end is not None:
        calendar = cube.sparkSession.range(1).select(
            F.explode(F.sequence(as_date(start), as_date(end))).alias("event_date"),
            F.lit("age").alias("dimension"),
        )
        zeros = calendar.select(
            "event_date",
            "dimension",
            F.explode(F.array(*[F.lit(x) for x in ETL_AGE_LABELS])).alias("dimension_value"),
            *[F.lit(0).cast("bigint").alias(m) for m in MEASURES],
        )
        rows = rows.unionByName(zeros)
    long = rows.groupBy("event_date", "dimension", "dimension_value").agg(
        *[F.sum(m).cast("bigint").alias(m) for m in MEASURES]
    )
    if start is not None and end is not None:
        return long.select("event_date", "dimension", "dimension_value", *MEASURES)
    return _dense_ages(long)


def _dense_ages(long: DataFrame) -> DataFrame:
    """Add zero rows for the age labels a day lacks.  ``long`` has a few rows
    per day; the first row of each day carries the missing labels, so ``long``
    is read by one consumer only."""
    day = Window.partitionBy("event_date")
    long = long.select(
        "*",
        F.collect_set(F.when(F.col("dimension") == "age", F.col("dimension_value"))).over(day).alias("_present"),
        (F.row_number().over(day.orderBy("dimension", "dimension_value")) == 1).alias("_first"),
    )
    present, first = F.col("_present"), F.col("_first")
    labels = F.array(*[F.lit(x) for x in ETL_AGE_LABELS])
    me = F.struct(F.col("dimension"), F.col("dimension_value"), *[F.col(m) for m in MEASURES])

    def zero(label):
        return F.struct(F.lit("age").alias("dimension"), label.alias("dimension_value"), *[F.lit(0).cast("bigint").alias(m) for m in MEASURES])

    extra = F.transform(F.array_except(labels, present), zero)
    out = F.when(first, F.concat(F.array(me), extra)).otherwise(F.array(me))
    return long.select("event_date", F.inline(out)).select("event_date", "dimension", "dimension_value", *MEASURES)


def cube_null_keys(cube: DataFrame) -> DataFrame:
    """Data-quality count: per day, user-day rows with a NULL dimension key and
    their measures (these rows are in no marginal of that dimension)."""
    missing = F.col("gender").isNull() | F.col("age").isNull() | F.col("os").isNull()
    return (
        cube.filter(missing)
        .groupBy("event_date")
        .agg(F.count("*").alias("rows"), *[F.sum(m).cast("bigint").alias(m) for m in MEASURES])
    )


def build_cube(
    feed: DataFrame, msgs: DataFrame, start=None, end=None, profile: str = "all", tuples: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """The whole ETL as one lazy plan: (user-day cube C5, marginals C6).  ``tuples``:
    a kept table of profile tuples, read instead of the message history."""
    from feedlens.operators.engagement import feed_user_day

    feed_ud = feed_user_day(feed, start, end)
    msg_ud = with_profile(message_user_day(msgs, start, end), msgs, profile, start, end, tuples)
    cube = user_day_cube(feed_ud, msg_ud)
    return cube, metrics_cube(cube, start, end)


def publish_cube(df: DataFrame, path: str) -> None:
    """Write cube rows partitioned by event_date; a re-run of a day replaces
    that day's partition (dynamic partition overwrite) instead of duplicating it.
    The directory is created on first write."""
    cols = ["dimension", "dimension_value", *MEASURES, "event_date"]
    (
        df.select(*cols)
        .repartition("event_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date")
        .parquet(path)
    )


def create_cube_table(spark, table: str, location: str | None = None) -> None:
    """Create the cube table if absent, partitioned by event_date."""
    from feedlens.sources.schemas import CUBE_DDL

    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({CUBE_DDL}) USING parquet PARTITIONED BY (event_date){where}")


def publish_cube_table(df: DataFrame, table: str) -> None:
    """S5 for a catalog table: insert with dynamic partition overwrite, so the
    days in ``df`` replace their partitions and other days stay."""
    cols = ["dimension", "dimension_value", *MEASURES, "event_date"]
    spark = df.sparkSession
    previous = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        df.select(*cols).repartition("event_date").write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", previous)


def read_cube(spark, path: str) -> DataFrame:
    from feedlens.sources.schemas import CUBE

    return spark.read.schema(CUBE).parquet(path).select("event_date", "dimension", "dimension_value", *MEASURES)
