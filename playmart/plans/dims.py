"""Song title, user and hour dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.functions import calendar as cal
from playmart.functions.casts import to_decimal, to_int, to_long
from playmart.operators.ranking import first_row_per
from playmart.schemas import TIME

PLAY_PAGE = "NextSong"


def plays(events: DataFrame) -> DataFrame:
    """Only the events that are plays."""
    return events.where(F.col("page") == PLAY_PAGE)


def dim_song_titles(songs: DataFrame) -> DataFrame:
    """One row per (artist name, title) with the latest year and the longest duration."""
    return songs.groupBy("artist_name", "title").agg(
        F.max(to_int("year")).alias("year"),
        F.max(to_decimal("duration", 19, 4)).alias("duration"),
    )


def dim_song_titles_lexical(songs: DataFrame) -> DataFrame:
    """The same with maxima taken over the staged text, cast afterwards."""
    return songs.groupBy("artist_name", "title").agg(
        to_int(F.max("year")).alias("year"),
        to_decimal(F.max("duration"), 19, 4).alias("duration"),
    )


def latest_first() -> list[Column]:
    """Newest event first; equal times are settled by item, session and level."""
    newest = [to_long(c).desc_nulls_last() for c in ("ts", "itemInSession", "sessionId")]
    return [*newest, F.col("level").asc_nulls_last()]


def dim_users(events: DataFrame) -> DataFrame:
    """One row per user, as the user's latest play shows them."""
    rows = plays(events).withColumn("user_id", to_int("userId"))
    return first_row_per(rows, ["user_id"], latest_first()).select(
        "user_id",
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        "gender",
        "level",
    )


def dim_time(events: DataFrame) -> DataFrame:
    """One row per hour with at least one play.

    Plays shrink to distinct hours first; calendar parts are worked out per hour.
    """
    millis = cal.epoch_millis("ts")
    hours = (
        plays(events)
        .select((millis - F.pmod(millis, F.lit(cal.HOUR_MILLIS))).alias("hour_millis"))
        .distinct()
    )
    stamp = cal.epoch_millis_to_timestamp("hour_millis")
    return calendar_columns(hours.select(stamp.alias("timestamp_date")))


def calendar_columns(hours: DataFrame) -> DataFrame:
    ts = "timestamp_date"
    return hours.select(
        cal.time_key(ts).alias("time_key"),
        ts,
        F.hour(ts).alias("hour"),
        F.dayofmonth(ts).alias("day"),
        F.weekofyear(ts).alias("week"),
        F.month(ts).alias("month"),
        F.year(ts).alias("year"),
        cal.day_of_week(ts).alias("day_of_week"),
        cal.day_name(ts).alias("day_of_week_name"),
        cal.is_weekend(ts).alias("is_weekend"),
    ).select(*TIME.columns)
