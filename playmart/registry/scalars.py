"""Scalar functions, each over every row of a staging table."""

from __future__ import annotations

from pyspark.sql import functions as F

from playmart.bindings import staging_events, staging_songs
from playmart.functions import calendar as cal
from playmart.functions.casts import (
    NUMERIC_PATTERN,
    numeric_score,
    text_score,
    to_decimal,
    to_int,
)
from playmart.plans import dims, identity, marts
from playmart.registry import Registry

REGISTRY = Registry()
query = REGISTRY.query


def songs(spark, sf_dir, *columns):
    rows = staging_songs(spark, sf_dir)
    return rows.select(*columns) if columns else rows


def play_times(spark, sf_dir):
    rows = dims.plays(staging_events(spark, sf_dir, "page", "ts", "userId"))
    return rows.withColumn("start_time", cal.epoch_millis_to_timestamp("ts"))


@query(
    "cast_decimal",
    """
SELECT song_id, TRY_CAST(artist_latitude AS DECIMAL(10,8)) AS latitude,
  TRY_CAST(artist_longitude AS DECIMAL(11,8)) AS longitude,
  TRY_CAST(duration AS DECIMAL(38,19)) AS duration FROM staging_songs""",
)
def cast_decimal(spark, sf_dir):
    return songs(spark, sf_dir).select(
        "song_id",
        to_decimal("artist_latitude", 10, 8).alias("latitude"),
        to_decimal("artist_longitude", 11, 8).alias("longitude"),
        to_decimal("duration", 38, 19).alias("duration"),
    )


@query(
    "cast_int",
    "SELECT TRY_CAST(userId AS INTEGER) AS user_id, TRY_CAST(sessionId AS INTEGER) AS session_id, "
    "TRY_CAST(auth AS INTEGER) AS not_a_number FROM staging_events",
)
def cast_int(spark, sf_dir):
    return staging_events(spark, sf_dir, "userId", "sessionId", "auth").select(
        to_int("userId").alias("user_id"),
        to_int("sessionId").alias("session_id"),
        to_int("auth").alias("not_a_number"),
    )


@query(
    "implicit_cast",
    "SELECT userId, CAST(TRY_CAST(ts AS BIGINT) // 1000 AS BIGINT) AS seconds, "
    "TRY_CAST(length AS DECIMAL(19,4)) AS stream_duration FROM staging_events",
)
def implicit_cast(spark, sf_dir):
    """Text used as a number, with the cast written out."""
    return staging_events(spark, sf_dir, "userId", "ts", "length").select(
        "userId",
        F.expr("try_cast(ts as bigint) div 1000").alias("seconds"),
        to_decimal("length", 19, 4).alias("stream_duration"),
    )


@query(
    "regex_match",
    f"""
SELECT artist_latitude, CAST(CASE WHEN regexp_matches(artist_latitude, '{NUMERIC_PATTERN}') THEN 1
  ELSE 0 END AS INTEGER) AS score FROM staging_songs""",
)
def regex_match(spark, sf_dir):
    return songs(spark, sf_dir, "artist_latitude", numeric_score("artist_latitude").alias("score"))


@query("trim", "SELECT artist_location, trim(artist_location) AS trimmed FROM staging_songs")
def trim(spark, sf_dir):
    return songs(spark, sf_dir, "artist_location", F.trim("artist_location").alias("trimmed"))


@query(
    "coalesce",
    "SELECT coalesce(artist_id, artist_name, title) AS label FROM staging_songs",
)
def coalesce(spark, sf_dir):
    return songs(spark, sf_dir, F.coalesce("artist_id", "artist_name", "title").alias("label"))


@query(
    "case_when",
    """
SELECT artist_location, CAST(CASE WHEN trim(artist_location) <> '' THEN 1 ELSE 0 END AS INTEGER)
  AS score FROM staging_songs""",
)
def case_when(spark, sf_dir):
    return songs(spark, sf_dir, "artist_location", text_score("artist_location").alias("score"))


@query(
    "concat_strings",
    "SELECT artist_name || ' - ' || title AS label FROM staging_songs",
)
def concat_strings(spark, sf_dir):
    """A NULL part makes the whole NULL."""
    return songs(spark, sf_dir, F.concat("artist_name", F.lit(" - "), "title").alias("label"))


@query(
    "concat_numbers",
    """
SELECT DISTINCT year(start_time) || '-' || month(start_time) || '-' || day(start_time) AS day_text
FROM plays""",
)
def concat_numbers(spark, sf_dir):
    ts = "start_time"
    parts = [F.year(ts), F.lit("-"), F.month(ts), F.lit("-"), F.dayofmonth(ts)]
    text = F.concat(*[p.cast("string") for p in parts])
    return play_times(spark, sf_dir).select(text.alias("day_text")).distinct()


@query(
    "split_part",
    """
SELECT location, split_part(location, ',', 2) AS state, split_part(artist, ',', 2) AS missing
FROM staging_events""",
)
def split_part(spark, sf_dir):
    return staging_events(spark, sf_dir, "location", "artist").select(
        "location", marts.state_of().alias("state"), marts.state_of("artist").alias("missing")
    )


@query("epoch_millis_to_timestamp", "SELECT ts, start_time FROM plays")
def epoch_millis_to_timestamp(spark, sf_dir):
    return play_times(spark, sf_dir).select("ts", "start_time")


@query(
    "extract_parts",
    """
SELECT start_time, CAST(hour(start_time) AS INTEGER) AS hour,
  CAST(day(start_time) AS INTEGER) AS day, CAST(week(start_time) AS INTEGER) AS week,
  CAST(month(start_time) AS INTEGER) AS month, CAST(year(start_time) AS INTEGER) AS year FROM plays""",
)
def extract_parts(spark, sf_dir):
    ts = "start_time"
    return play_times(spark, sf_dir).select(
        ts,
        F.hour(ts).alias("hour"),
        F.dayofmonth(ts).alias("day"),
        F.weekofyear(ts).alias("week"),
        F.month(ts).alias("month"),
        F.year(ts).alias("year"),
    )


@query(
    "day_of_week",
    "SELECT start_time, CAST(dayofweek(start_time) AS INTEGER) AS day_of_week FROM plays",
)
def day_of_week(spark, sf_dir):
    return play_times(spark, sf_dir).select(
        "start_time", cal.day_of_week("start_time").alias("day_of_week")
    )


@query("day_name", "SELECT start_time, rpad(dayname(start_time), 9, ' ') AS day_name FROM plays")
def day_name(spark, sf_dir):
    return play_times(spark, sf_dir).select(
        "start_time", cal.day_name("start_time").alias("day_name")
    )


@query(
    "truncate_to_hour",
    "SELECT start_time, CAST(date_trunc('hour', start_time) AS TIMESTAMP) AS hour_start FROM plays",
)
def truncate_to_hour(spark, sf_dir):
    return play_times(spark, sf_dir).select(
        "start_time", cal.truncate_to_hour("start_time").alias("hour_start")
    )


@query("int_time_key", "SELECT start_time, start_time_key AS time_key FROM songplays")
def int_time_key(spark, sf_dir):
    return play_times(spark, sf_dir).select(
        "start_time", cal.time_key("start_time").alias("time_key")
    )


@query(
    "score_sum",
    "SELECT artist_id, artist_name, artist_latitude_score, artist_longitude_score, "
    "artist_lat_long_score FROM artist_row",
)
def score_sum(spark, sf_dir):
    return identity.artist_rows(songs(spark, sf_dir)).select(
        "artist_id",
        "artist_name",
        "artist_latitude_score",
        "artist_longitude_score",
        "artist_lat_long_score",
    )


@query("boolean_in", "SELECT start_time, dayofweek(start_time) IN (0, 6) AS is_weekend FROM plays")
def boolean_in(spark, sf_dir):
    return play_times(spark, sf_dir).select(
        "start_time", cal.is_weekend("start_time").alias("is_weekend")
    )


@query(
    "interval_arithmetic",
    """
SELECT ts, TIMESTAMP '1970-01-01' + to_milliseconds(CAST(ts AS BIGINT)) AS start_time,
  start_time + INTERVAL 1 HOUR AS hour_later FROM plays""",
)
def interval_arithmetic(spark, sf_dir):
    seconds = (to_decimal("ts", 18, 0) / 1000).cast("decimal(18,6)")
    elapsed = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    started = F.expr(cal.EPOCH) + elapsed
    return play_times(spark, sf_dir).select(
        "ts",
        started.alias("start_time"),
        (started + F.expr("INTERVAL '1' HOUR")).alias("hour_later"),
    )
