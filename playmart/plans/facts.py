"""The plays fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.functions import calendar as cal
from playmart.functions.casts import to_decimal, to_int
from playmart.plans.dims import plays


def fact_songplays(events: DataFrame) -> DataFrame:
    """Typed plays without the surrogate key; a row-level projection, no shuffle.

    The fact keeps artist and song names as its natural keys.
    """
    stamped = plays(events).withColumn("start_time", cal.epoch_millis_to_timestamp("ts"))
    return stamped.select(
        "start_time",
        cal.time_key("start_time").alias("start_time_key"),
        to_int("userId").alias("user_id"),
        "level",
        F.col("song").alias("song_title"),
        F.col("artist").alias("artist_name"),
        to_int("sessionId").alias("session_id"),
        "location",
        F.col("userAgent").alias("user_agent"),
        to_decimal("length", 19, 4).alias("stream_duration"),
    )
