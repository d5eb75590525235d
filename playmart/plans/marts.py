"""Reports on the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.operators.ranking import first_row_per

PLAYED_SECONDS = "decimal(29,4)"


def play_count() -> Column:
    return F.count("start_time").alias("stream_count")


def play_seconds() -> Column:
    return F.sum("stream_duration").cast(PLAYED_SECONDS).alias("stream_duration")


def state_of(location: str = "location") -> Column:
    """Second comma-separated part of a location, leading blank kept."""
    return F.split_part(location, F.lit(","), F.lit(2))


def plays_per_user(songplays: DataFrame, users: DataFrame) -> DataFrame:
    """Plays per full name. Plays are counted per user id before the join."""
    counted = songplays.groupBy("user_id").agg(play_count())
    named = counted.join(users.select("user_id", "first_name", "last_name"), "user_id", "left")
    full_name = F.concat("first_name", F.lit(" "), "last_name")
    return named.groupBy(full_name.alias("full_name")).agg(
        F.sum("stream_count").alias("stream_count")
    )


def top_users(songplays: DataFrame, users: DataFrame, n: int = 5) -> DataFrame:
    """Names with most plays; users who share a full name count together."""
    return plays_per_user(songplays, users).orderBy(
        F.desc("stream_count"), F.col("full_name").asc_nulls_last()
    ).limit(n)


def plays_per_hour_of_day(songplays: DataFrame, time: DataFrame) -> DataFrame:
    """Plays per hour of day. Plays are counted per time key before the join."""
    counted = songplays.groupBy("start_time_key").agg(play_count())
    keys = time.select(F.col("time_key").alias("start_time_key"), "hour")
    return (
        counted.join(keys, "start_time_key", "left")
        .groupBy("hour")
        .agg(F.sum("stream_count").alias("stream_count"))
    )


def busiest_hours(songplays: DataFrame, time: DataFrame, n: int = 5) -> DataFrame:
    return plays_per_hour_of_day(songplays, time).orderBy(
        F.desc("stream_count"), F.col("hour").asc_nulls_last()
    ).limit(n)


def plays_per_state(songplays: DataFrame) -> DataFrame:
    return songplays.groupBy(state_of().alias("state")).agg(play_count(), play_seconds())


def busiest_states(songplays: DataFrame, n: int = 5) -> DataFrame:
    return plays_per_state(songplays).orderBy(
        F.desc("stream_count"),
        F.col("stream_duration").desc_nulls_last(),
        F.col("state").asc_nulls_last(),
    ).limit(n)


def ranked_artists_by_state(songplays: DataFrame, n: int = 1) -> DataFrame:
    """The ``n`` most played artists of each state, with their place."""
    counted = songplays.groupBy(state_of().alias("state"), "artist_name").agg(
        play_count(), play_seconds()
    )
    order = [
        F.desc("stream_count"),
        F.col("stream_duration").desc_nulls_last(),
        F.col("artist_name").asc_nulls_last(),
    ]
    return first_row_per(counted, ["state"], order, n, rank_as="place")


def top_artist_by_state(songplays: DataFrame) -> DataFrame:
    """Most played artist of each state, busiest first."""
    return ranked_artists_by_state(songplays).drop("place").orderBy(
        F.desc("stream_count"),
        F.col("stream_duration").desc_nulls_last(),
        F.col("state").asc_nulls_last(),
    )


def artist_before(songs: DataFrame, names: list[str]) -> DataFrame:
    """Artist variants as recorded, for chosen names."""
    return (
        songs.select(
            "artist_id",
            F.col("artist_name").alias("name"),
            F.col("artist_latitude").alias("latitude"),
            F.col("artist_longitude").alias("longitude"),
            F.col("artist_location").alias("location"),
        )
        .where(F.col("name").isin(names))
        .distinct()
        .orderBy("name", "artist_id", "latitude", "longitude", "location")
    )


def artist_after(artist_names: DataFrame, names: list[str]) -> DataFrame:
    """The resolved artist rows of chosen names."""
    return artist_names.where(F.col("name").isin(names))
