"""Registered upkeep of the published cube, with the oracle of a full rebuild."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from feedlens.operators import cube as C
from feedlens.operators import cube_upkeep as U
from feedlens.plans.catalog_cube import METRICS_CUBE_SQL
from feedlens.plans.registry import register
from feedlens.session import shared_path
from feedlens.sources.fixtures import feed_actions, message_actions, with_fixtures

#: Days before this one are published with the profiles of that time; the messages
#: from it on bring new tuples of their senders.
LATE_DAY = "2024-01-16"


@register("cube_upkeep", with_fixtures(f"SELECT * FROM ({METRICS_CUBE_SQL}) c WHERE event_date < DATE '{LATE_DAY}'", feed=True, messages=True))
def q_cube_upkeep(spark, sf_dir):
    """The cube of the earlier days, published, then brought up to date by the later
    profile tuples alone."""
    feed, msgs = feed_actions(spark, sf_dir), message_actions(spark, sf_dir)
    early = F.to_date("time") < F.lit(LATE_DAY).cast("date")
    before, arrived = C.profile_tuples(msgs.where(early)), C.profile_tuples(msgs.where(~early))
    target = shared_path(spark, f"cube-upkeep-{uuid.uuid4().hex}")
    user_days, marginals = C.build_cube(feed.where(early), msgs.where(early), tuples=before)
    U.publish_checked(marginals, target, "first", {**U.CHECKS, "totals": U.totals_of(user_days)})
    U.apply_late_profiles(target, C.message_user_day(msgs.where(early)), before, arrived, "late")
    return C.read_cube(spark, target)
