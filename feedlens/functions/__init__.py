from feedlens.functions.columns import (
    BOT_AGE_LABELS,
    ETL_AGE_LABELS,
    age_band_bot,
    age_band_etl,
    as_date,
    floor_to_hundredth,
    hashed_uniform,
    md5_bucket,
    safe_ratio,
    to_day,
    week_start,
    xxhash_bucket,
)

__all__ = [
    "BOT_AGE_LABELS",
    "ETL_AGE_LABELS",
    "age_band_bot",
    "age_band_etl",
    "as_date",
    "floor_to_hundredth",
    "hashed_uniform",
    "md5_bucket",
    "safe_ratio",
    "to_day",
    "week_start",
    "xxhash_bucket",
]
