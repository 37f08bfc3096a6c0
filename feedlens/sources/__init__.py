from feedlens.sources.fixtures import feed_actions, message_actions
from feedlens.sources.readers import read_feed, read_messages
from feedlens.sources.schemas import CUBE, FEED, MEASURES, MESSAGES, check_schema

__all__ = [
    "feed_actions",
    "message_actions",
    "read_feed",
    "read_messages",
    "CUBE",
    "FEED",
    "MEASURES",
    "MESSAGES",
    "check_schema",
]
